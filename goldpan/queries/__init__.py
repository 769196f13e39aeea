"""All registered queries."""

from goldpan.queries import etl, evaluation, features, forecast, models, relational, search, series  # noqa: F401
from goldpan.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
