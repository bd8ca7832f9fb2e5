from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlake.catalog.inputs import Inputs
from airlake.config import CONFIG
from airlake.plans import evaluation as ev
from airlake.plans import features, models
from airlake.session import shared_path

TINY = models.TreeParams(trees=2, depth=2, min_instances=5, max_bins=32)
BASE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    """Training and live features stored once, and a model per horizon."""
    i = Inputs(spark, BASE)
    train = i.stored(i.features("train"), "train")
    live = i.stored(i.features("live"), "live")
    fitted = {h: models.fit(train.filter(F.col("horizon_h") == h), params=TINY) for h in CONFIG.horizons}
    return train, live, fitted


def test_every_station_gets_a_rounded_prediction_per_horizon(tables):
    _, live, fitted = tables
    out = models.predict_live(live, fitted, "v9").collect()
    assert len(out) == live.count()
    assert all(r.pm25_pred >= 0 and r.pm25_pred == round(r.pm25_pred, 1) for r in out)
    assert {r.model_version for r in out} == {"v9"}


def test_promotion_is_complete_or_refused_and_loads_back(spark, tables):
    _, live, fitted = tables
    base = shared_path(spark, "models")
    with pytest.raises(FileNotFoundError, match="72"):
        models.promote(spark, {h: fitted[h] for h in (24, 48)}, base, datetime(2026, 1, 1), datetime(2026, 1, 1))
    models.promote(spark, fitted, base, datetime(2026, 1, 1), datetime(2025, 12, 31), card={"note": 1})
    manifest, loaded = models.load_production(spark, base)
    assert manifest["version"] == "20260101T000000Z" and sorted(loaded) == [24, 48, 72]
    a = models.predict_live(live, fitted, "v").orderBy("location_id", "horizon_h").collect()
    b = models.predict_live(live, loaded, "v").orderBy("location_id", "horizon_h").collect()
    assert a == b


def test_too_little_new_data_keeps_production(tables):
    train, _, fitted = tables
    last = train.agg(F.max("target_hour_start_utc").cast("timestamp_ntz")).first()[0]
    got = models.decide(train, fitted, last - timedelta(days=2), params=TINY)
    assert not got["promote"] and got["mae"] == {} and "shorter than 3" in got["why"]


def test_comparison_scores_both_on_the_holdout(tables):
    train, _, fitted = tables
    got = models.decide(train, fitted, datetime(2024, 1, 1), params=TINY)
    assert {(r["horizon_h"], r["role"]) for r in got["horizons"]} == {
        (h, role) for h in (24, 48, 72) for role in ("challenger", "production")
    }
    assert got["promote"] == (got["mae"]["challenger"] < got["mae"]["production"])


def test_each_model_decodes_with_its_own_transform(tables):
    _, live, fitted = tables
    manifest = {"horizons": {str(h): {"target_transform": "absolute" if h == 24 else "log_ratio"} for h in fitted}}
    mixed = models.predict_live(live, fitted, "v", models.transforms(manifest))
    plain = models.predict_live(live, fitted, "v")
    same = mixed.join(plain.withColumnRenamed("pm25_pred", "other"), ["location_id", "horizon_h"]).filter("pm25_pred = other")
    assert {r.horizon_h for r in same.select("horizon_h").distinct().collect()} >= {48, 72}
    assert mixed.filter("horizon_h = 24").exceptAll(plain.filter("horizon_h = 24")).count() > 0


def test_more_categories_than_bins_and_unseen_ones(tables):
    train, _, _ = tables
    rows = train.filter(F.col("horizon_h") == 24)
    wide = rows.withColumn("location_id", F.expr("pmod(xxhash64(issue_time_utc, location_id), 500)"))
    model = models.fit(wide, params=TINY)
    new = models.score(model, wide.withColumn("location_id", F.lit(-1).cast("long")))
    assert new.filter("y_pred IS NULL").count() == 0 and new.count() == wide.count()


def test_importance_is_sorted_and_bounded(tables):
    _, _, fitted = tables
    top = models.importance(fitted[24], 5)
    assert len(top) == 5
    assert [v for _, v in top] == sorted((v for _, v in top), reverse=True)


def test_out_of_fold_rows_come_from_later_months(spark):
    """Two horizons of synthetic months: every scored row lies in its own test month."""
    i = Inputs(spark, "/root/testdata/sf0.001")
    train = i.features("train").filter("target_pm25 IS NOT NULL")
    spread = train.withColumn("m", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    for c in ("issue_time_utc", "target_hour_start_utc", "issue_hour_start_utc"):
        spread = spread.withColumn(c, F.add_months(F.col(c).cast("date"), F.col("m")).cast("timestamp"))
    spread = spread.withColumn("target_hour_start_utc", F.col("issue_time_utc") + F.expr("INTERVAL 1 DAY"))
    spread = i.stored(spread.filter("horizon_h = 24"), "months")
    from dataclasses import replace

    oof = models.out_of_fold(spread, params=TINY, cfg=replace(CONFIG, horizons=(24,)), min_train_months=1)
    rows = ev.fold_of(oof.withColumnRenamed("fold", "tested")).select("fold", "tested").distinct().collect()
    assert rows and all(r.fold == r.tested for r in rows)


def test_drift_needs_enough_served_hours(spark, tables):
    train, live, _ = tables
    out = models.drift_summary(live, train)
    assert out["status"].startswith("too little data: 1 of ")
    served = train.filter(F.col("horizon_h") == 24)
    done = models.drift_summary(served.withColumn("pm25_lag0", F.col("pm25_lag0") + 500), train)
    assert done["status"] == "ok" and "pm25_lag0" in done["drifted_columns"]
    assert 0 < done["share_drifted"] <= 1


def test_served_rows_come_back_from_their_day(spark, tables):
    from airlake.sources.envelopes import read_served

    _, live, _ = tables
    path = shared_path(spark, "served")
    models.write_served(live, path)
    day = live.first().issue_time_utc.strftime("%Y-%m-%d")
    schema = "location_id bigint, horizon_h int, issue_time_utc string, pm25_lag0 double"
    assert read_served(spark, path, schema, day).count() == live.count()
    assert read_served(spark, path, schema, "9999-01-01").count() == 0


def test_reference_sample_is_repeatable(tables):
    train, _, _ = tables
    a, b = features.reference_sample(train).count(), features.reference_sample(train).count()
    assert a == b > 0


def test_median_leaves_beat_mean_signs_at_equal_trees(spark):
    """Skewed noise: the same number of trees of the same size, with Spark's own L1 boosting beside it."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from airlake.plans.boosting import boost
    from airlake.session import stored

    x = [F.rand(n).alias(f"x{n}") for n in range(4)]
    rows = spark.range(6000, numPartitions=4).select("id", *x).withColumn(
        "label", 30 * F.sin(6 * F.col("x0")) + 20 * F.col("x1") * F.col("x2") + F.exp(2 * F.randn(9))
    )
    rows = stored(VectorAssembler(inputCols=["x0", "x1", "x2", "x3"], outputCol="features").transform(rows), "skewed")
    train, test = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    params = models.TreeParams(trees=12, depth=3, min_instances=10, learning_rate=0.3, max_bins=32)
    model = boost(train, ["x0", "x1", "x2", "x3"], params, store_every=5)
    other = GBTRegressor(lossType="absolute", maxIter=12, maxDepth=3, stepSize=0.3, minInstancesPerNode=10, subsamplingRate=0.8, seed=42)
    theirs = other.fit(train).transform(test).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    import numpy as np

    got = test.select("features", "label").collect()
    ours = float(np.abs(model.predict(np.array([r.features.toArray() for r in got])) - np.array([r.label for r in got])).mean())
    assert ours < theirs, (ours, theirs)
    assert len(model.trees) == 12 and max(model.importances(), key=model.importances().get) == "x0"
