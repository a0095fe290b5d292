"""All registered queries; importing the modules registers them."""

from meterloom.plans import (  # noqa: F401
    queries_clean,
    queries_features,
    queries_ingest,
    queries_metrics,
    queries_models,
    queries_sketches,
    queries_upkeep,
)
from meterloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
