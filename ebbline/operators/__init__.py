"""DataFrame operators: features, trends, quality, drift, metrics, models."""
