"""Nested data, reshaping, joins, quality checks, access logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs
from airlake.catalog.registry import query
from airlake.catalog.views import using
from airlake.functions.geo import sector_position
from airlake.functions.numeric import exact
from airlake.functions.text import redact
from airlake.functions.time import half_hour_floor, hour_floor
from airlake.operators import checks
from airlake.operators.bands import band_totals, join_bands
from airlake.operators.incremental import todo_days
from airlake.operators.reshape import melt, previous_runs_to_rows, with_neighbours
from airlake.operators.timegrid import month_chunks
from airlake.plans import fires, hourly, oplogs
from airlake.sources.envelopes import hourly_rows, split, valid_response

# --- nested data ----------------------------------------------------------------------------------


@query("json_props", using("ev", body="SELECT event_id, k FROM ev"))
def _(i: Inputs):
    parsed = i.table("events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.select("event_id", "p.k")


@query("explode_map", using("ev", body="""
    SELECT event_id, name, value FROM (
        UNPIVOT (SELECT event_id, value AS level, CAST(k AS DOUBLE) AS coverage, CAST(user_id AS DOUBLE) AS sensor FROM ev)
        ON level, coverage, sensor INTO NAME name VALUE value)"""))
def _(i: Inputs):
    m = F.create_map(
        F.lit("level"), F.col("value"), F.lit("coverage"), F.col("k").cast("double"),
        F.lit("sensor"), F.col("user_id").cast("double"),
    )
    return i.events().select("event_id", F.explode(m).alias("name", "value"))


def _arrays(i: Inputs):
    """Events as hourly responses: three times, three values, and a shorter second variable."""
    stamp = F.date_format(hour_floor("ts"), "yyyy-MM-dd'T'HH:mm")
    later = F.date_format(hour_floor("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm")
    v = F.col("value")
    ragged = F.when(F.col("event_id") % 5 == 0, F.array(F.col("k").cast("double"))).otherwise(
        F.array(F.col("k").cast("double"), F.col("k") + 1.0)
    )
    hourly = F.struct(F.array(stamp, later).alias("time"), F.array(v, v * 2).alias("pm2_5"), ragged.alias("pm10"))
    return i.events().select("event_id", F.struct(F.lit(0).alias("utc_offset_seconds"), hourly.alias("hourly")).alias("r"))


@query("zip_arrays_inline", using("ev", body="""
    SELECT event_id, strftime(date_trunc('hour', ts) + to_hours(n), '%Y-%m-%dT%H:%M') AS time,
           value * (n + 1) AS pm2_5, CASE WHEN n = 0 OR event_id % 5 <> 0 THEN CAST(k + n AS DOUBLE) END AS pm10
    FROM ev, range(2) AS r(n)"""))
def _(i: Inputs):
    return hourly_rows(_arrays(i), ("pm2_5", "pm10"), "event_id")


@query("envelope_validation", using("ev", body="""
    SELECT event_id % 5 <> 0 AS is_good, count(*) AS n FROM ev GROUP BY 1"""))
def _(i: Inputs):
    good, bad = split(_arrays(i), valid_response(("pm2_5", "pm10")))
    rows = good.select(F.lit(True).alias("is_good")).unionByName(bad.select(F.lit(False).alias("is_good")))
    return rows.groupBy("is_good").agg(F.count(F.lit(1)).alias("n"))


# --- reshaping ------------------------------------------------------------------------------------


@query("previous_runs_unpivot", using("ev", body="""
    SELECT event_id, CAST(d AS BIGINT) AS days_before, round(value * d, 6) AS temperature_2m,
           CAST(k + d AS DOUBLE) AS precipitation
    FROM ev, range(1, 5) AS r(d)"""))
def _(i: Inputs):
    wide = i.events().select(
        "event_id",
        *[(F.col("value") * n).alias(f"temperature_2m_previous_day{n}") for n in (1, 2, 3, 4)],
        *[(F.col("k") + n).cast("double").alias(f"precipitation_previous_day{n}") for n in (1, 2, 3, 4)],
    )
    rows = previous_runs_to_rows(wide, ["event_id"], ["temperature_2m", "precipitation"])
    return rows.withColumn("temperature_2m", F.round("temperature_2m", 6))


@query("melt_series", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, series, value FROM (
        UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
        ON l_quantity, l_discount, l_tax INTO NAME series VALUE value)""")
def _(i: Inputs):
    return melt(i.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("union_history_live", using("ev", body="""
    SELECT user_id, source, count(*) AS n, min(ts) AS first_ts FROM (
        SELECT user_id, ts, 'history' AS source FROM ev
        UNION ALL SELECT user_id, ts + INTERVAL 1 HOUR, 'hourly' FROM ev) GROUP BY ALL"""))
def _(i: Inputs):
    past = i.events().select("user_id", "ts", F.lit("history").alias("source"))
    live = i.events().select(
        "user_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), F.lit("hourly").alias("source")
    )
    return past.unionByName(live).groupBy("user_id", "source").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts")
    )


@query("sector_neighbours", using("olocated", body="""
    SELECT w AS wind_index, count(*) AS n FROM (
        SELECT list_position(['N','NE','E','SE','S','SW','W','NW'], sector) - 1 AS s FROM olocated)
    JOIN range(8) AS d(w) ON least(abs(s - w), 8 - abs(s - w)) <= 1 GROUP BY 1"""))
def _(i: Inputs):
    placed = fires.locate(i.order_fires()).select(sector_position("sector").alias("s"))
    # Counted per sector first, so the fan-out touches eight rows.
    counts = placed.groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    return with_neighbours(counts, "s", "wind_index").groupBy("wind_index").agg(F.sum("c").alias("n"))


@query("chunk_plan", """
    WITH span AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z
                  FROM orders GROUP BY 1)
    SELECT o_custkey, greatest(a, m) AS chunk_start, least(z, CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)) AS chunk_end
    FROM (SELECT *, CAST(unnest(generate_series(date_trunc('month', a), z, INTERVAL 1 MONTH)) AS DATE) AS m FROM span)""", dates=("chunk_start", "chunk_end"))
def _(i: Inputs):
    day = F.to_date("o_orderdate")
    span = i.table("orders").groupBy("o_custkey").agg(F.min(day).alias("a"), F.max(day).alias("z"))
    return month_chunks(span, "a", "z").select("o_custkey", "chunk_start", "chunk_end")


@query("backfill_plan", """
    WITH span AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z
                  FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1),
    want AS (SELECT o_custkey, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day, z FROM span),
    have AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT o_custkey, count(*) AS days_to_fetch, max(day) AS last_day FROM want w
    WHERE z - day < 7 OR NOT EXISTS (SELECT 1 FROM have h WHERE h.o_custkey = w.o_custkey AND h.day = w.day)
    GROUP BY 1""", dates=("last_day",))
def _(i: Inputs):
    days = i.table("orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    known = i.table("customer").select(F.col("c_custkey").alias("o_custkey"))
    return todo_days(days.join(known, "o_custkey", "left_semi"), ["o_custkey"], "day", CFG.refresh_days)


# --- joins ----------------------------------------------------------------------------------------

_PART_BANDS = ((0, 950), (951, 1200), (1201, 1600), (1601, None))


@query("band_range_join", f"""
    SELECT p_partkey, band FROM part LEFT JOIN (VALUES {', '.join(
        f"({n}, {lo}, {'NULL' if hi is None else hi})" for n, (lo, hi) in enumerate(_PART_BANDS))}) AS b(band, lo, hi)
      ON round(p_retailprice) BETWEEN lo AND coalesce(hi, 1e9)""")
def _(i: Inputs):
    bands = i.spark.createDataFrame([(n, *ends) for n, ends in enumerate(_PART_BANDS)], "band int, lo int, hi int")
    return join_bands(i.table("part"), F.round("p_retailprice"), bands, "lo", "hi").select("p_partkey", "band")


# A band for every customer with a balance, as wide as its key says, some of them open at an end.
_BALANCE_BANDS = """
    SELECT c_custkey AS band_id, CASE WHEN c_custkey % 97 <> 0 THEN round(c_acctbal, 0) END AS lo,
           CASE WHEN c_custkey % 89 <> 0 THEN round(c_acctbal, 0) + c_custkey % 7 END AS hi FROM customer"""


@query("band_join_many", f"""
    WITH b AS ({_BALANCE_BANDS})
    SELECT s_suppkey, count(band_id) AS n_bands, min(band_id) AS first_band, coalesce(sum(band_id), 0)::BIGINT AS band_sum
    FROM supplier LEFT JOIN b ON (lo IS NULL OR s_acctbal >= lo) AND (hi IS NULL OR s_acctbal <= hi)
    GROUP BY s_suppkey""")
def _(i: Inputs):
    key, whole = F.col("c_custkey"), F.round("c_acctbal", 0)
    bands = i.table("customer").select(
        key.alias("band_id"), F.when(key % 97 != 0, whole).alias("lo"), F.when(key % 89 != 0, whole + key % 7).alias("hi")
    )
    totals = {"n": (F.count("band_id"), "sum"), "first": (F.min("band_id"), "min"), "total": (F.sum("band_id"), "sum")}
    met = band_totals(i.table("supplier"), F.col("s_acctbal"), bands, "lo", "hi", totals)
    return met.groupBy("s_suppkey").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_bands"), F.min("first").alias("first_band"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("band_sum"),
    )


# Breakpoints edited in a table: twelve units of each nation, the last one open.
_SEED = """
    SELECT n_name AS category, (n_nationkey + 1)::INT AS category_order, 12 * n_nationkey AS lo,
           CASE WHEN n_nationkey < 24 THEN 12 * n_nationkey + 11 END AS hi, 20 * n_nationkey AS a, 20 * n_nationkey + 19 AS z FROM nation"""


@query("aqi_breakpoint_table", using("aqi", body=f"""
    SELECT aqi.* REPLACE (category AS aqi_category, category_order AS aqi_category_order,
                          CAST(round(a + (z - a) * (round(pm25_24h) - lo) / (hi - lo)) AS INT) AS pm25_subindex)
    FROM aqi LEFT JOIN ({_SEED}) ON round(pm25_24h) >= lo AND (hi IS NULL OR round(pm25_24h) <= hi)"""))
def _(i: Inputs):
    n = F.col("n_nationkey")
    seed = i.table("nation").select(
        F.col("n_name").alias("category"), (n + 1).cast("int").alias("category_order"), (12 * n).alias("pm25_low"),
        F.when(n < 24, 12 * n + 11).alias("pm25_high"), (20 * n).alias("aqi_low"), (20 * n + 19).alias("aqi_high"),
    )
    return hourly.aqi_hourly(i.grid(), i.stations(), CFG, breakpoints=seed)


@query("anti_orphans", """
    SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def _(i: Inputs):
    done = i.table("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return checks.orphans(i.table("customer"), done, ["c_custkey"]).select("c_custkey")


@query("semi_chosen", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem
    WHERE (l_suppkey, l_shipdate) IN (SELECT l_suppkey, max(l_shipdate) FROM lineitem GROUP BY 1)""")
def _(i: Inputs):
    lines = i.table("lineitem")
    chosen = lines.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("l_shipdate"))
    return lines.join(chosen, ["l_suppkey", "l_shipdate"], "left_semi").select("l_orderkey", "l_linenumber")


@query("fact_dimension_join", """
    SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def _(i: Inputs):
    # Summed per customer before any join: the joins move one row per customer.
    per = i.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(exact("o_totalprice")).alias("m")
    )
    nations = i.table("nation").join(
        i.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    rows = per.join(i.table("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(nations, "c_nationkey")
    return rows.groupBy("r_name", "n_name").agg(F.sum("n").alias("n"), F.round(F.sum("m").cast("double"), 2).alias("total"))


# --- quality checks -------------------------------------------------------------------------------


@query("dq_unique", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(i: Inputs):
    return checks.unique(i.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_not_null", using("hourly", body="""
    SELECT location_id, hour_start_utc FROM hourly WHERE pm25 IS NULL"""))
def _(i: Inputs):
    return checks.not_null(i.grid(), "pm25").select("location_id", "hour_start_utc")


@query("dq_relationships", """
    SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(i: Inputs):
    return checks.orphans(i.table("documents"), i.table("labels"), ["doc_id"]).select("doc_id")


@query("dq_range", """
    SELECT o_orderkey FROM orders WHERE o_totalprice NOT BETWEEN 5000 AND 480000""")
def _(i: Inputs):
    return checks.accepted_range(i.table("orders"), "o_totalprice", 5000, 480000).select("o_orderkey")


@query("dq_accepted", """
    SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')""")
def _(i: Inputs):
    return checks.accepted_values(i.table("events"), "event_type", ["click", "view"]).select("event_id", "event_type")


@query("dq_expression", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE NOT (l_extendedprice >= l_quantity * 1000)""")
def _(i: Inputs):
    bad = checks.expression_holds(i.table("lineitem"), F.col("l_extendedprice") >= F.col("l_quantity") * 1000)
    return bad.select("l_orderkey", "l_linenumber")


@query("dq_half_hour", using("ev", body="""
    SELECT event_id FROM ev WHERE event_id % 2 = 0
      AND (minute(date_trunc('hour', ts)) <> 30 OR second(date_trunc('hour', ts)) <> 0)"""))
def _(i: Inputs):
    e = i.events()
    hour = F.when(F.col("event_id") % 2 == 0, hour_floor("ts")).otherwise(half_hour_floor("ts"))
    return checks.starts_on_half_hour(e.withColumn("h", hour), "h").select("event_id")


@query("dq_single_product", using("ofire", body="""
    SELECT acq_date, sensor FROM ofire GROUP BY ALL HAVING count(DISTINCT product) > 1"""), dates=("acq_date",))
def _(i: Inputs):
    return checks.one_product_per_day(i.order_fires())


@query("dq_config_sync", """
    SELECT k AS custkey, CASE WHEN c_custkey IS NULL THEN 'right' ELSE 'left' END AS missing_in
    FROM (SELECT coalesce(c_custkey, o_custkey) AS k, c_custkey, o_custkey FROM customer
          FULL JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') ON o_custkey = c_custkey)
    WHERE c_custkey IS NULL OR o_custkey IS NULL""")
def _(i: Inputs):
    left = i.table("orders").filter("o_orderpriority LIKE '1%'").select(F.col("o_custkey").alias("custkey"))
    right = i.table("customer").select(F.col("c_custkey").alias("custkey"))
    return checks.out_of_step(left, right, "custkey")


@query("dq_one_zone_each", """
    SELECT l_suppkey, count(DISTINCT l_returnflag) AS n_parents FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) <> 1""")
def _(i: Inputs):
    membership = i.table("lineitem").select("l_suppkey", "l_returnflag").distinct()
    return checks.one_parent_each(membership, "l_suppkey", "l_returnflag")


# --- access logs ----------------------------------------------------------------------------------

# One log line per event: an operation by type, a key below three areas.
_OPS = "['REST.PUT.OBJECT', 'REST.GET.OBJECT', 'REST.GET.BUCKET', 'REST.HEAD.OBJECT', 'REST.COPY.OBJECT']"
_LINES = f"""
    SELECT event_id, {_OPS}[1 + k % 5] AS op, 'bronze/' || event_type || '/dt=' || strftime(ts, '%Y-%m-%d') || '/f.json' AS key,
           ts FROM ev"""


def _lines(i: Inputs):
    ops = F.array(*[F.lit(o) for o in (
        "REST.PUT.OBJECT", "REST.GET.OBJECT", "REST.GET.BUCKET", "REST.HEAD.OBJECT", "REST.COPY.OBJECT")])
    op = F.element_at(ops, (F.col("k") % 5 + 1).cast("int"))
    day = F.date_format("ts", "yyyy-MM-dd")
    key = F.concat(F.lit("bronze/"), "event_type", F.lit("/dt="), day, F.lit("/f.json"))
    listing = op == "REST.GET.BUCKET"
    uri = F.when(listing, F.concat(F.lit("GET /?list-type=2&prefix=bronze%2F"), "event_type", F.lit("%2Fdt="), day, F.lit("&max-keys=2 HTTP/1.1")))
    uri = uri.otherwise(F.concat(F.lit("GET /"), key, F.lit(" HTTP/1.1")))
    line = F.concat(
        F.lit("own bkt ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] 10.0.0.1 who req "),
        op, F.lit(" "), F.when(listing, F.lit("-")).otherwise(key), F.lit(' "'), uri, F.lit('" 200 - 12 12 5 4 "-" "x" -'),
    )
    return i.events().select(line.alias("value"))


@query("log_parse", using("ev", body=f"""
    SELECT date_trunc('second', ts) AS time, op, CASE op WHEN 'REST.GET.BUCKET' THEN '-' ELSE key END AS key,
           CASE WHEN op IN ('REST.PUT.OBJECT', 'REST.COPY.OBJECT', 'REST.GET.BUCKET') THEN 1 ELSE 2 END::BIGINT AS tier,
           split_part(key, '/f.json', 1) AS area
    FROM ({_LINES})"""))
def _(i: Inputs):
    return oplogs.parse(_lines(i)).select("time", "op", "key", "tier", "area")


@query("log_report", using("ev", body=f"""
    SELECT count(*) AS requests, count(*) FILTER (t1) AS tier1, count(*) FILTER (NOT t1) AS tier2,
           round(count(*) FILTER (t1) * 0.000005 + count(*) FILTER (NOT t1) * 0.0000004, 9)::DOUBLE AS cost_usd
    FROM (SELECT op IN ('REST.PUT.OBJECT', 'REST.COPY.OBJECT', 'REST.GET.BUCKET') AS t1 FROM ({_LINES}))"""))
def _(i: Inputs):
    return oplogs.totals(oplogs.parse(_lines(i))).withColumn("cost_usd", F.round("cost_usd", 9))


@query("log_top_areas", using("ev", body=f"""
    SELECT split_part(key, '/f.json', 1) AS area, count(*) AS n FROM ({_LINES})
    WHERE op IN ('REST.PUT.OBJECT', 'REST.COPY.OBJECT', 'REST.GET.BUCKET')
    GROUP BY 1 ORDER BY n DESC, area LIMIT 10"""))
def _(i: Inputs):
    return oplogs.report(oplogs.parse(_lines(i)))[2]


@query("topk_counts", """
    SELECT host, count(*) AS n FROM (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages)
    GROUP BY 1 ORDER BY n DESC, host LIMIT 8""")
def _(i: Inputs):
    hosts = i.table("pages").select(F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"))
    return oplogs.top_counts(hosts, "host", 8)


@query("redact_text", """
    SELECT doc_id, replace(replace(text, 'password', '***'), 'Copyright', '***') AS text FROM documents""")
def _(i: Inputs):
    return i.table("documents").select("doc_id", redact("text", ["password", "short", "Copyright"]).alias("text"))
