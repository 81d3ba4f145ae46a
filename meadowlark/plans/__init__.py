"""The queries by name, with their SQL."""

from meadowlark.plans import facts, files, keys, landings, prices, repair, scale, series, small, streams, tables  # noqa: F401
from meadowlark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
