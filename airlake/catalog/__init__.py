"""Named queries over the given tables, each with the SQL it is checked against."""

from airlake.catalog import (  # noqa: F401
    conditions,
    forecasting,
    places,
    relational,
    series,
    storage,
    streams,
)
from airlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
