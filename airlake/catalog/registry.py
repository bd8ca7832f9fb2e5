"""Named queries and the independent SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airlake.catalog.inputs import Inputs, finish

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Register ``fn(inputs) -> DataFrame`` under a name, with its SQL when one exists.

    ``dates`` names the civil-date columns, which both sides return as ``YYYY-MM-DD`` text.
    """
    if sql is not None and dates:
        as_text = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
        sql = f"SELECT * REPLACE ({as_text}) FROM ({sql.strip()}) AS result"

    def wrap(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(Inputs(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap
