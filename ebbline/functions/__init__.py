"""Column-level helpers and the as-of calendar."""
