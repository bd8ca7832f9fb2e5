"""Times and plans shared by the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

T0 = datetime(2026, 1, 1, 0, 30)


def hour(n: float) -> datetime:
    return T0 + timedelta(hours=n)


def text(ts: datetime) -> str:
    return ts.isoformat(sep=" ")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
