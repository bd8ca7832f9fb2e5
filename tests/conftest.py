from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from airlake import build_session, use_utc  # noqa: E402
from helpers import text  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "airlake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return use_utc(session)


@pytest.fixture
def frame(spark):
    """Literal rows; columns of a timestamp type may be given as datetimes (UTC)."""

    def build(rows, schema: str):
        from pyspark.sql import functions as F

        names = [c.strip().split()[0] for c in schema.split(",")]
        kinds = [c.strip().split(None, 1)[1] for c in schema.split(",")]
        plain = ", ".join(
            f"{n} {'string' if k == 'timestamp' else k}" for n, k in zip(names, kinds, strict=True)
        )
        data = [tuple(text(v) if isinstance(v, datetime) else v for v in r) for r in rows]
        df = spark.createDataFrame(data, plain)
        return df.select(*[F.col(n).cast(k).alias(n) if k == "timestamp" else F.col(n) for n, k in zip(names, kinds)])

    return build
