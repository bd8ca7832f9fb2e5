"""Alert decisions with memory: repeat muting and status announcements.

Batch. Muting: within a bucket as long as the mute time a key sends at most once, so a chain of sent alerts is a path that visits
each bucket at most once. From every instant one window over a bucket finds the next instant that would be sent. Paths are then
shortened over blocks of 32, 1024 ... buckets (fewer and fewer instants can be the first sent of a block) and read back
from the largest block down. A key's alerts are spread over its blocks at every step; no task walks a key.
Announcements: the status known before a row is the last delivered one, found inside each hour of a key and, across hours,
from one row an hour.

Streams keep one value a key in the state store: what was sent last, or what is known. A micro-batch touches the state
of its own keys only. The rows of a key in one micro-batch (17 bytes each) are sorted in one task, so the trigger's
``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds that task; history at large belongs to the batch forms.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from airlake.config import CONFIG, Config
from airlake.session import stored
from airlake.streaming.runs import run_append

HOUR_MICROS = 3_600_000_000
RADIX = 32
NEVER = -(1 << 62)


def _next_sent(instants: DataFrame, mute: int) -> DataFrame:
    """alert_key, at, next: the first instant at least ``mute`` after each (null: none)."""
    bucket = lambda c: F.floor(F.col(c) / mute)
    asked = instants.select("alert_key", (F.col("at") + mute).alias("t"), F.col("at").alias("asker"))
    both = asked.unionByName(instants.select("alert_key", F.col("at").alias("t"), F.lit(None).cast("long").alias("asker")))
    both = both.withColumn("bucket", bucket("t"))
    # from the last row back, as a frame that grows costs one step a row and one that shrinks is made anew for each row;
    # at one moment the asker comes first, so an instant exactly ``mute`` later counts
    ahead = Window.partitionBy("alert_key", "bucket").orderBy(F.desc("t"), F.col("asker").isNull().desc())
    is_instant = F.when(F.col("asker").isNull(), F.col("t"))
    found = both.withColumn("next", F.min(is_instant).over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    # one row a bucket: where a bucket has nothing left, the next one that has something
    buckets = both.groupBy("alert_key", "bucket").agg(F.min(is_instant).alias("first"))
    later = Window.partitionBy("alert_key").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("alert_key", "bucket", F.min("first").over(later).alias("later"))
    return found.where("asker IS NOT NULL").join(buckets, ["alert_key", "bucket"]).select(
        "alert_key", F.col("asker").alias("at"), F.coalesce("next", "later").alias("next")
    )


def _hop(at: np.ndarray, onward: np.ndarray) -> np.ndarray:
    """For each instant of a block the place of its next one in the block, or its own place when the next lies beyond."""
    to = np.searchsorted(at, onward)
    to[to == len(at)] = 0
    return np.where(at[to] == onward, to, np.arange(len(at)))


def _exits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From every instant of a block to the first one sent beyond it."""
    for frame in frames:
        out = []
        for at, onward in zip(frame["at"], frame["next"], strict=True):
            hop = _hop(at, onward)
            while True:
                far = hop[hop]
                if (far == hop).all():
                    break
                hop = far
            out.append(onward[hop])
        sizes = frame["at"].str.len()
        yield pd.DataFrame({
            "alert_key": frame["alert_key"].repeat(sizes), "at": np.concatenate(list(frame["at"]) or [np.array([], np.int64)]),
            "next": np.concatenate(out or [np.array([], np.int64)]),
        })


def _visited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The instants that are sent in a block, from the one it is entered by."""
    for frame in frames:
        keys, out = [], []
        for key, at, onward, entry in zip(frame["alert_key"], frame["at"], frame["next"], frame["entry"], strict=True):
            hop, here = _hop(at, onward), int(np.searchsorted(at, entry))
            while True:
                keys.append(key)
                out.append(at[here])
                if hop[here] == here:
                    break
                here = hop[here]
        yield pd.DataFrame({"alert_key": keys, "at": out})


def _sent(instants: DataFrame, starts: DataFrame, mute: int) -> DataFrame:
    """alert_key, at of every alert sent, from the starts on. ``instants`` hold the starts and have no repeats."""
    step = stored(_next_sent(instants, mute), "next-alert")
    low, high = step.agg(F.min("at"), F.max("at")).first()
    if low is None:
        return starts.limit(0)
    block = lambda c, k: F.floor((F.col(c) - low) / (mute * RADIX**k))
    kind = instants.schema["alert_key"].dataType.simpleString()

    def by_block(rows: DataFrame, k: int) -> DataFrame:
        """One row a block of RADIX^k buckets, its instants in order."""
        pair = F.struct("at", F.coalesce("next", F.lit(NEVER)).alias("next"))
        rows = rows.groupBy("alert_key", block("at", k).alias("block")).agg(F.sort_array(F.collect_list(pair)).alias("s"))
        return rows.select("alert_key", "block", F.col("s.at").alias("at"), F.col("s.next").alias("next"))

    levels, k = [step], 1
    while (high - low) // (mute * RADIX**k) > 0:
        beyond = step.where(block("at", k) != block("next", k)).select("alert_key", F.col("next").alias("at"))
        entries = beyond.unionByName(starts).distinct()
        exits = by_block(step, k).drop("block").mapInPandas(_exits, f"alert_key {kind}, at long, next long")
        step = stored(exits.withColumn("next", F.nullif("next", F.lit(NEVER))).join(entries, ["alert_key", "at"]), f"next-alert-{k}")
        levels.append(step)
        k += 1
    sent = starts
    for k in range(len(levels), 0, -1):
        entered = sent.select("alert_key", block("at", k).alias("block"), F.col("at").alias("entry"))
        paths = by_block(levels[k - 1], k).join(entered, ["alert_key", "block"]).drop("block")
        sent = stored(paths.mapInPandas(_visited, f"alert_key {kind}, at long"), f"sent-{k}")
    return sent


def mute_repeats(
    df: DataFrame, key: str, ts: str, cfg: Config = CONFIG, delivered: Column | None = None,
    last: DataFrame | None = None,
) -> DataFrame:
    """The alerts that went out: at most one per key within the mute time, which starts with a delivered alert only.

    ``delivered`` tells for each row whether a message sent then would have arrived (default: always). ``last``
    (alert_key, at in microseconds) is what went out before; earlier instants are settled.
    """
    mute = cfg.repeat_alert_hours * 3600 * 1_000_000
    rows = df if delivered is None else df.where(delivered)
    instants = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("alert_key"), F.unix_micros(ts).alias("at")
    )
    if last is not None:
        known = last.select("alert_key", F.col("at").alias("before"))
        instants = instants.join(known, "alert_key", "left").where("before IS NULL OR at >= before").select("alert_key", "at")
        instants = instants.unionByName(last.select("alert_key", "at"))
    instants = stored(instants.distinct(), "alert-instants")
    sent = _sent(instants, instants.groupBy("alert_key").agg(F.min("at").alias("at")), mute)
    if last is not None:
        sent = sent.join(last.select("alert_key", "at"), ["alert_key", "at"], "left_anti")
    return sent.select("alert_key", F.timestamp_micros("at").alias("sent_at"))


def announcements(
    df: DataFrame, key: str, ts: str, status: str, delivered: Column | None = None, last: DataFrame | None = None
) -> DataFrame:
    """alert_key, at, previous, status of every row whose status differs from the known one.

    A first check that is ok is silent. What could not be delivered stays unknown, so the next check speaks again.
    ``last`` (alert_key, status) is what was known before.
    """
    rows = df.select(
        F.col(key).alias("alert_key"), F.unix_micros(ts).alias("at"), F.col(status).alias("status"),
        (F.lit(True) if delivered is None else delivered).alias("arrived"),
    ).withColumn("hour", F.floor(F.col("at") / HOUR_MICROS))
    known = F.when(F.col("arrived"), F.col("status"))
    ok = (F.col("status") == "ok").cast("int")
    inside = Window.partitionBy("alert_key", "hour").orderBy("at", "status").rowsBetween(Window.unboundedPreceding, -1)
    order = F.struct("at", "status")
    hours = rows.groupBy("alert_key", "hour").agg(
        F.max_by(known, F.when(F.col("arrived"), order)).alias("said"), F.max(ok).alias("was_ok")
    )
    if last is not None:
        hours = hours.unionByName(
            last.select("alert_key", F.lit(-(2**62)).cast("long").alias("hour"), F.col("status").alias("said"), F.lit(0).alias("was_ok"))
        )
    before = Window.partitionBy("alert_key").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select(
        "alert_key", "hour", F.last("said", True).over(before).alias("said_before"), F.max("was_ok").over(before).alias("ok_before")
    )
    judged = rows.withColumns(
        {"said": F.last(known, True).over(inside), "was_ok": F.max(ok).over(inside)}
    ).join(hours, ["alert_key", "hour"])
    any_ok = F.greatest(F.coalesce("was_ok", F.lit(0)), F.coalesce("ok_before", F.lit(0))) == 1
    previous = F.coalesce("said", "said_before", F.when(any_ok, F.lit("ok")))
    judged = judged.withColumn("previous", previous)
    speaks = F.when(F.col("previous").isNull(), F.col("status") != "ok").otherwise(F.col("previous") != F.col("status"))
    return judged.where(speaks).select("alert_key", F.timestamp_micros("at").alias("at"), "previous", "status")


def _micro_batch(rows: Iterator[pd.DataFrame], *columns: str) -> list[np.ndarray]:
    """The rows of a key in this micro-batch, in order of the columns."""
    parts = [f[list(columns)] for f in rows]
    frame = pd.concat(parts).sort_values(list(columns), kind="stable", na_position="first")
    return [frame[c].to_numpy() for c in columns]


class _Muting(StatefulProcessor):
    """The instant of the last message that went out for a key."""

    def __init__(self, mute: int, forget_ms: int | None):
        self.mute, self.forget_ms = mute, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long", self.forget_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (at,) = _micro_batch(rows, "at")
        ready = self.last.get()[0] + self.mute if self.last.exists() else NEVER
        sent, n = [], 0
        while (n := int(np.searchsorted(at, ready))) < len(at):
            sent.append(int(at[n]))
            ready = sent[-1] + self.mute
        if sent:
            self.last.update((sent[-1],))
            yield pd.DataFrame({"alert_key": key[0], "at": sent})

    def close(self) -> None:
        pass


def _null_status_first(row: tuple) -> tuple:
    at, status, arrived = row
    return at, status is not None, status or "", arrived


class _Announcing(StatefulProcessor):
    """What the receivers of a key know, and whether it was ever fine.

    Keys are many and have few rows each in a micro-batch, so they are handled as plain rows: a pandas frame for each key costs
    more than its rows do.
    """

    def __init__(self, forget_ms: int | None):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "status string, was_ok boolean", self.forget_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.known.get() or (None, False)
        said, was_ok = before
        for at, status, arrived in sorted(((r.at, r.status, r.arrived) for r in rows), key=_null_status_first):
            previous = said if said is not None else "ok" if was_ok else None
            if status is not None and (status != "ok" if previous is None else status != previous):
                yield Row(alert_key=key[0], at=at, previous=previous, status=status)
            said = status if arrived and status is not None else said
            was_ok |= status == "ok"
        if (said, was_ok) != tuple(before):
            self.known.update((said, was_ok))

    def close(self) -> None:
        pass


def _time_mode(forget: timedelta | None) -> str:
    return "ProcessingTime" if forget else "None"


def _millis(forget: timedelta | None) -> int | None:
    return None if forget is None else int(forget.total_seconds() * 1000)


def muting(
    stream: DataFrame, key: str, ts: str, cfg: Config = CONFIG, delivered: Column | None = None, forget: timedelta | None = None
) -> DataFrame:
    """alert_key, sent_at: the stream of alerts that went out, by the rule of :func:`mute_repeats`.

    ``delivered`` tells whether a message sent for a row would have arrived; what did not arrive mutes nothing. The memory of a key is
    its last message, across micro-batches and restarts; instants before it are settled. With ``forget`` a key that has sent nothing
    for that long (by the clock, well above the mute time and any delay of the feed) leaves no state behind.
    """
    rows = stream if delivered is None else stream.where(delivered)
    rows = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).cast("string").alias("alert_key"), F.unix_micros(ts).alias("at")
    )
    mute = cfg.repeat_alert_hours * 3600 * 1_000_000
    sent = rows.groupBy("alert_key").transformWithStateInPandas(
        _Muting(mute, _millis(forget)), "alert_key string, at long", "append", _time_mode(forget)
    )
    return sent.select("alert_key", F.timestamp_micros("at").alias("sent_at"))


def announcing(
    stream: DataFrame, key: str, ts: str, status: str, delivered: Column | None = None, forget: timedelta | None = None
) -> DataFrame:
    """alert_key, at, previous, status: the stream of announcements, by the rule of :func:`announcements`."""
    rows = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).cast("string").alias("alert_key"), F.unix_micros(ts).alias("at"), F.col(status).alias("status"),
        F.coalesce(F.lit(True) if delivered is None else delivered, F.lit(False)).alias("arrived"),
    )
    schema = "alert_key string, at long, previous string, status string"
    told = rows.groupBy("alert_key").transformWithState(_Announcing(_millis(forget)), schema, "append", _time_mode(forget))
    return told.select("alert_key", F.timestamp_micros("at").alias("at"), "previous", "status")


def run_muting(stream: DataFrame, key: str, ts: str, table: str, checkpoint: str, cfg: Config = CONFIG, **how) -> list[dict]:
    """Append what is sent, batch by batch; a replayed batch replaces its own results, and its state is that of its start."""
    return run_append(muting(stream, key, ts, cfg, **how), table, checkpoint)


def run_announcing(stream: DataFrame, key: str, ts: str, status: str, table: str, checkpoint: str, **how) -> list[dict]:
    """Append what is announced, batch by batch."""
    return run_append(announcing(stream, key, ts, status, **how), table, checkpoint)
