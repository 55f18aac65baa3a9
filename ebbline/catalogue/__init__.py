"""The registered queries: operators applied to the star-schema tables."""

from ebbline.catalogue import features, models, quality_drift  # noqa: F401
from ebbline.catalogue.registry import QUERIES

__all__ = ["QUERIES"]
