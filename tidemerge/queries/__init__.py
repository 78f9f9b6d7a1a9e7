"""All registered queries with the SQL they are checked against."""

from tidemerge.queries import control, datasets, merges, normalized, plans, quality, scalars, scans, streams, views  # noqa: F401
from tidemerge.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
