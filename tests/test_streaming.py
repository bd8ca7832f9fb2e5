from __future__ import annotations

import random
from datetime import timedelta

from helpers import hour, plan_of
from pyspark.sql import functions as F

from airlake.functions.numeric import fixed_sum
from airlake.operators.dedupe import newest
from airlake.session import shared_path
from airlake.sources.tables import add_sums, read_table
from airlake.streaming import alerts, runs, windows


def arrivals(frame, spark, n=300, files=3):
    """Events in time order, one file per slice, plus a late correction in the last file."""
    rng = random.Random(11)
    rows = sorted((rng.choice("ab"), hour(rng.uniform(0, 60)), round(rng.uniform(0, 50), 2)) for _ in range(n))
    rows.sort(key=lambda r: r[1])
    path = shared_path(spark, "arrivals")
    size = n // files
    for j in range(files):
        part = rows[j * size : (j + 1) * size]
        if j == files - 1:
            part.append(("a", hour(20), 7.0))
        frame([(k, t, v, j) for k, t, v in part], "k string, ts timestamp, v double, file int").coalesce(1).write.mode(
            "append"
        ).parquet(f"{path}/part{j}")
    batch = spark.read.parquet(*[f"{path}/part{j}" for j in range(files)])
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{path}/part*")
    return batch, stream


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_hourly_counts_over_several_batches_equal_batch(spark, frame):
    batch, stream = arrivals(frame, spark)
    table = shared_path(spark, "hourly")
    counts = windows.hourly_counts(stream, ["k"], "ts", "v")
    runs.run_upsert_windows(spark, counts, table, shared_path(spark, "cp"), ["k", "hour_utc"], "hour_utc")
    assert rows(read_table(spark, table).select("k", "hour_utc", "n", "total")) == rows(hourly(batch))


def hourly(batch):
    return batch.groupBy("k", F.date_trunc("hour", "ts").alias("hour_utc")).agg(
        F.count(F.lit(1)).alias("n"), fixed_sum("v").alias("total")
    )


def days_out_of_order(frame, spark):
    """Three files over three months, the newest first, with nulls and one hour in all of them."""
    rng = random.Random(5)
    path = shared_path(spark, "days")
    for n, day in enumerate((60, 0, 31)):
        part = [(rng.choice("ab"), hour(24 * day + rng.uniform(0, 30)), round(rng.uniform(-9, 9), 3)) for _ in range(80)]
        part += [("a", hour(5.2), 0.1 * n), ("b", None, 1.0), ("a", hour(7), None), (None, hour(24 * day), 2.0)]
        frame(part, "k string, ts timestamp, v double").coalesce(1).write.parquet(f"{path}/p{n}")
    batch = spark.read.parquet(f"{path}/p*")
    return batch, spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/p*")


def test_hours_from_deltas_equal_batch_and_keep_no_state(spark, frame):
    batch, stream = days_out_of_order(frame, spark)
    table = shared_path(spark, "hours")
    progress = runs.run_hours(spark, stream, table, shared_path(spark, "cp"), ["k"], "ts", "v")
    assert len(progress) == 3 and not any(p["stateOperators"] for p in progress)
    got = read_table(spark, table).select("k", "hour_utc", "n", F.col("total").cast("double"))
    want = hourly(batch.where("ts IS NOT NULL")).fillna(0.0, subset=["total"])
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_a_replayed_batch_adds_nothing(spark, frame):
    one = frame([("a", hour(0), 1.5), ("a", hour(24 * 40), 2.0)], "k string, ts timestamp, v double")
    two = frame([("a", hour(0.2), 0.25), ("b", hour(0.2), 4.0)], "k string, ts timestamp, v double")
    table = shared_path(spark, "replayed")
    add = lambda df, n: add_sums(spark, table, runs.hour_deltas(df, ["k"], "ts", "v"), ["k", "hour_utc"], ["n", "total"], "hour_utc", n)
    add(one, 0)
    add(one, 0)
    add(two, 1)
    # half of a batch had been swapped in when it failed: its months are left alone, the others get their share
    add(two.unionByName(frame([("a", hour(24 * 40), 8.0)], "k string, ts timestamp, v double")), 1)
    got = {(r.k, r.hour_utc): (r.n, float(r.total)) for r in read_table(spark, table).collect()}
    assert got == {("a", hour(-0.5)): (2, 1.75), ("b", hour(-0.5)): (1, 4.0), ("a", hour(24 * 40 - 0.5)): (2, 10.0)}


def test_sliding_sums_over_several_batches_equal_batch(spark, frame):
    batch, stream = days_out_of_order(frame, spark)
    table = shared_path(spark, "sliding")
    runs.run_sliding(spark, stream, shared_path(spark, "hours"), table, shared_path(spark, "cp"), ["k"], "ts", "v", 24)
    want = batch.where("ts IS NOT NULL").groupBy("k", F.window("ts", "24 hours", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(fixed_sum("v"), F.lit(0.0)).alias("total")
    ).select("k", "w.start", "w.end", "n", "total")
    key = lambda r: (str(r[0]), r[1])
    got = read_table(spark, table).select("k", "window_start_utc", "window_end_utc", "n", "total").collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_first_seen_without_state_equals_distinct(spark, frame):
    batch, stream = days_out_of_order(frame, spark)
    keyed = lambda df: df.where("ts IS NOT NULL").withColumn("hour_utc", F.date_trunc("hour", "ts"))
    table, cp = shared_path(spark, "first"), shared_path(spark, "cp")
    progress = runs.run_first_seen(spark, keyed(stream), table, cp, ["k", "hour_utc"], "ts", ["v"])
    assert not any(p["stateOperators"] for p in progress)
    got = spark.read.parquet(table)
    key = lambda r: (str(r[0]), r[1])
    want = keyed(batch).select("k", "hour_utc").distinct().collect()
    assert sorted(map(tuple, got.select("k", "hour_utc").collect()), key=key) == sorted(map(tuple, want), key=key)


def test_stream_upsert_equals_batch_dedupe(spark, frame):
    batch, stream = arrivals(frame, spark)
    table = shared_path(spark, "upserted")
    keyed = lambda df: df.withColumn("hour_utc", F.date_trunc("hour", "ts"))
    runs.run_upsert(
        spark, keyed(stream), table, shared_path(spark, "cp"), ["k", "hour_utc"],
        [F.col("ts").desc(), F.col("v").desc()], "hour_utc",
    )
    want = newest(keyed(batch), ["k", "hour_utc"], "ts", F.col("v").desc())
    cols = ["k", "hour_utc", "v"]
    assert rows(read_table(spark, table).select(cols)) == rows(want.select(cols))


def muted(times, gap=timedelta(hours=6)):
    out = []
    for t in sorted(times):
        if not out or t - out[-1] >= gap:
            out.append(t)
    return out


def test_muting_batch_equals_greedy_walk(spark, frame):
    rng = random.Random(4)
    data = [(k, hour(round(rng.uniform(0, span), 3))) for k, span, n in (("busy", 90, 400), ("calm", 400, 40)) for _ in range(n)]
    data += data[:50]
    df = frame(data, "k string, ts timestamp")
    got = {}
    for r in alerts.mute_repeats(df, "k", "ts").orderBy("sent_at").collect():
        got.setdefault(r.alert_key, []).append(r.sent_at)
    assert got == {k: muted([t for kk, t in data if kk == k]) for k in ("busy", "calm")}


def test_muting_remembers_across_batches_and_restarts(spark, frame):
    path, table, cp = (shared_path(spark, n) for n in ("failures", "sent", "cp"))
    schema = "k string, ts timestamp"
    sent = []
    for part, times in enumerate(([0, 1, 5], [5.5, 6, 7], [11.9, 12, 30])):
        frame([("dag", hour(t)) for t in times], schema).coalesce(1).write.parquet(f"{path}/p{part}")
        stream = spark.readStream.schema(frame([("x", hour(0))], schema).schema).parquet(f"{path}/p*")
        alerts.run_muting(stream, "k", "ts", table, cp)
        sent = sorted(r.sent_at for r in spark.read.parquet(table).collect())
    assert sent == [hour(0), hour(6), hour(12), hour(30)]


def test_announcements_remember_the_last_status(spark, frame):
    path, table, cp = (shared_path(spark, n) for n in ("checks", "said", "cp"))
    schema = "source string, ts timestamp, status string"
    for part, states in enumerate((["ok", "ok", "outage"], ["outage", "ok"], ["ok", "degraded"])):
        rows_ = [("feed", hour(10 * part + n), s) for n, s in enumerate(states)]
        frame(rows_, schema).coalesce(1).write.parquet(f"{path}/p{part}")
        stream = spark.readStream.schema(frame(rows_, schema).schema).parquet(f"{path}/p*")
        alerts.run_announcing(stream, "source", "ts", "status", table, cp)
    said = [(r.previous, r.status) for r in spark.read.parquet(table).orderBy("at").collect()]
    assert said == [("ok", "outage"), ("outage", "ok"), ("ok", "degraded")]


def keyed_arrivals(frame, spark, schema, parts):
    """Runs of a stream over one more part each time: as many micro-batches, with restarts."""
    path = shared_path(spark, "parts")
    for n, part in enumerate(parts):
        frame(part, schema).write.parquet(f"{path}/p{n}")
        yield spark.readStream.schema(spark.read.parquet(f"{path}/p{n}").schema).parquet(f"{path}/p*")


def test_streamed_muting_with_failed_sends_equals_batch_and_touches_its_keys_only(frame, spark):
    rng = random.Random(8)
    schema = "k string, ts timestamp, arrived boolean"
    parts = []
    for n in range(5):
        keys = ["busy", f"only{n}", None] if n else ["busy", "first"]
        times = sorted(rng.uniform(30 * n, 30 * n + 30) for _ in range(60))
        parts.append([(rng.choice(keys), hour(round(t, 3)), rng.random() < 0.6) for t in times])
    table, cp = shared_path(spark, "sent"), shared_path(spark, "cp")
    touched = []
    for stream in keyed_arrivals(frame, spark, schema, parts):
        progress = alerts.run_muting(stream, "k", "ts", table, cp, delivered=F.col("arrived"))
        touched.append(sum(o["numRowsUpdated"] for p in progress for o in p["stateOperators"]))
    everything = frame([r for p in parts for r in p], schema)
    want = rows(alerts.mute_repeats(everything, "k", "ts", delivered=F.col("arrived")))
    assert rows(spark.read.parquet(table).select("alert_key", "sent_at")) == want
    assert {r[0] for r in want} == {"busy", "first", "only1", "only2", "only3", "only4"}
    # six keys are known in the end, yet no batch writes more than its own two
    assert all(n <= 2 for n in touched) and len(touched) == 5
    state = spark.read.format("statestore").option("stateVarName", "last").load(cp)
    assert state.count() == 6


def test_streamed_announcements_with_failed_sends_equal_batch(frame, spark):
    rng = random.Random(6)
    schema = "source string, ts timestamp, status string, arrived boolean"
    parts = [
        [(rng.choice("abc"), hour(20 * n + rng.uniform(0, 20)), rng.choice(["ok", "ok", "outage", "degraded", None]), rng.random() < 0.5)
         for _ in range(40)]
        for n in range(4)
    ]
    table, cp = shared_path(spark, "said"), shared_path(spark, "cp")
    for stream in keyed_arrivals(frame, spark, schema, parts):
        alerts.run_announcing(stream, "source", "ts", "status", table, cp, delivered=F.col("arrived"))
    everything = frame([r for p in parts for r in p], schema)
    want = alerts.announcements(everything, "source", "ts", "status", F.col("arrived"))
    key = lambda r: (r.alert_key, r.at)
    assert sorted(spark.read.parquet(table).select(want.columns).collect(), key=key) == sorted(want.collect(), key=key)


def test_forgotten_keys_leave_no_state(frame, spark):
    table, cp = shared_path(spark, "sent"), shared_path(spark, "cp")
    parts = [[("a", hour(0))], [("b", hour(100))]]
    for n, stream in enumerate(keyed_arrivals(frame, spark, "k string, ts timestamp", parts)):
        alerts.run_muting(stream, "k", "ts", table, cp, forget=timedelta(milliseconds=1))
    assert rows(spark.read.parquet(table).select("alert_key", "sent_at")) == [("a", hour(0)), ("b", hour(100))]


def test_a_busy_key_without_pauses_is_spread_over_tasks(spark):
    """An alert every 20 seconds for half a year in one key, nowhere a pause of six hours."""
    n, step = 800_000, 20
    df = spark.range(n, numPartitions=4).select(
        F.lit("dag").alias("k"), F.timestamp_seconds(F.col("id") * step + F.col("id") % 7).alias("ts")
    )
    sent = [r.sent_at for r in alerts.mute_repeats(df, "k", "ts").orderBy("sent_at").collect()]
    times = [i * step + i % 7 for i in range(n)]
    want, at = [], None
    for t in times:
        if at is None or t - at >= 6 * 3600:
            want.append(t)
            at = t
    assert [s.timestamp() for s in sent] == want
    # the exchange deals rows out by key and bucket, of which none holds more than a few thousand
    instants = df.select(F.col("k").alias("alert_key"), F.unix_micros("ts").alias("at"))
    step = alerts._next_sent(instants, 6 * 3600 * 10**6)
    assert step.groupBy(F.floor(F.col("at") / (6 * 3600 * 10**6))).count().agg(F.max("count")).first()[0] < n / 500
    blocks = step.groupBy(F.floor(F.col("at") / (alerts.RADIX * 6 * 3600 * 10**6))).count()
    assert blocks.agg(F.max("count")).first()[0] < n / 20
    assert "hashpartitioning(alert_key" in plan_of(step) and "bucket" in plan_of(step).split("hashpartitioning(alert_key")[1][:40]


def test_undelivered_messages_do_not_mute_and_are_tried_again(frame):
    df = frame([("a", hour(n), n != 0) for n in (0, 1, 3, 7)], "k string, ts timestamp, arrived boolean")
    got = alerts.mute_repeats(df, "k", "ts", delivered=F.col("arrived")).orderBy("sent_at").collect()
    assert [r.sent_at for r in got] == [hour(1), hour(7)]
    states = [("ok", True), ("outage", False), ("outage", True), ("outage", True), ("ok", False), ("outage", True), ("ok", True)]
    df = frame([("f", hour(n), s, a) for n, (s, a) in enumerate(states)], "k string, ts timestamp, status string, arrived boolean")
    said = alerts.announcements(df, "k", "ts", "status", F.col("arrived")).orderBy("at").collect()
    assert [(r.at, r.previous, r.status) for r in said] == [
        (hour(1), "ok", "outage"), (hour(2), "ok", "outage"), (hour(4), "outage", "ok"), (hour(6), "outage", "ok")
    ]


def test_the_next_alert_is_found_with_growing_frames_only(spark):
    # 60,000 instants in one bucket: a frame that shrinks would look at 1.8 thousand million rows
    instants = spark.range(60_000).select(F.lit("a").alias("alert_key"), (F.col("id") * 100_000).alias("at"))
    step = alerts._next_sent(instants, 6 * 3600 * 1_000_000)
    assert "unboundedfollowing" not in plan_of(step).lower()
    assert step.count() == 60_000 and step.where("next IS NOT NULL").count() == 0


def test_a_batch_of_envelopes_is_pruned_before_it_is_staged(spark, tmp_path, monkeypatch):
    """Many fetches of one key in a batch: one row a key is staged for the table, the newest."""
    docs = [(f'{{"k": {n % 2}, "v": {n}, "ts": "2026-01-01T0{n % 3}:00:00Z"}}',) for n in range(60)]
    spark.createDataFrame(docs, "value string").coalesce(1).write.text(str(tmp_path / "in"))
    staged, upsert = [], runs.upsert

    def counted(spark, table, incoming, keys, order, ts):
        staged.append(incoming.count())
        upsert(spark, table, incoming, keys, order, ts)

    monkeypatch.setattr(runs, "upsert", counted)
    runs.run_envelopes(
        spark, runs.read_json_files(spark, str(tmp_path / "in"), "k int, v int, ts string"), str(tmp_path / "table"), str(tmp_path / "bad"),
        str(tmp_path / "checkpoint"), lambda d: d, F.col("v") >= 3, lambda good: good.withColumn("ts", F.to_timestamp("ts")),
        ["k", "ts"], [F.col("v").desc()], "ts",
    )
    assert staged == [6]
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "table")).collect()) == [54, 55, 56, 57, 58, 59]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 3
