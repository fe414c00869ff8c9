import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import dicts
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators import nest, series


@pytest.fixture(scope="module")
def events(spark):
    """Random series with ties, missing times and one key that holds most rows."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
        ts = None if rng.random() < 0.1 else datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 90), minutes=30 * rng.randrange(2))
        rows.append((i, key, ts, round(rng.uniform(0.1, 20), 1)))
    return spark.createDataFrame(rows, "id int, key string, ts timestamp, value double").cache()


def same(a, b, *order):
    assert dicts(a, *order) == dicts(b, *order)


def test_recency_rank_equals_plain_rank(events):
    plain = events.withColumn("r", F.rank().over(Window.partitionBy("key").orderBy(F.col("ts").desc_nulls_first())))
    same(series.recency_rank(events, "key", "ts", "r"), plain, "id")


def test_previous_row_equals_plain_lag(events):
    w = Window.partitionBy("key").orderBy(F.col("ts").asc_nulls_first(), "id")
    plain = events.withColumns({"pv": F.lag("value").over(w), "pt": F.lag("ts").over(w)})
    same(series.previous_row(events, "key", "ts", "id", {"value": "pv", "ts": "pt"}), plain, "id")


def test_running_low_equals_plain_window(events):
    w = Window.partitionBy("key").orderBy(F.col("ts").asc_nulls_first(), "id").rowsBetween(Window.unboundedPreceding, -1)
    same(series.running_low(events, "key", "ts", "id", "value", "low"), events.withColumn("low", F.min("value").over(w)), "id")


def test_later_high_equals_brute_force(events):
    rows = events.collect()
    want = {}
    for r in rows:
        later = [o.value for o in rows if r.ts and o.ts and o.key == r.key and (o.ts.date() - r.ts.date()).days >= 21]
        want[r.id] = max(later) if later else None
    got = {r["id"]: r["high"] for r in series.later_high(events, "key", "ts", "value", 21, "high").collect()}
    assert got == want


def test_rows_are_never_gathered_by_key_alone(spark, events):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (series.recency_rank(events, "key", "ts", "r"), series.previous_row(events, "key", "ts", "id", {"value": "pv"}),
                    series.running_low(events, "key", "ts", "id", "value", "low"), series.later_high(events, "key", "ts", "value", 21, "high")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            left = plan[plan.index("SortMergeJoin"):plan.index("REPARTITION_BY_COL")]
            assert left.count("Exchange") == 2, plan  # rows by (key, slot), then the summary
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def psa(spark, *points):
    rows = [("p", f"o{i}", datetime(2024, 1, 1) + timedelta(days=d), Decimal(v)) for i, (d, v) in enumerate(points)]
    return spark.createDataFrame(rows, "patient_id string, observation_id string, effective_datetime timestamp, value_quantity_value decimal(15,4)")


def test_progression_is_confirmed_after_three_weeks(spark):
    out = dicts(series.progression(psa(spark, (0, "10"), (10, "1"), (20, "1.5"), (30, "3.5"), (51, "3.6"))), "observation_id")
    assert [(r["is_rise"], r["is_confirmed"]) for r in out] == [
        (False, False), (False, False), (False, False), (True, True), (True, False)]
    assert out[3]["nadir"] == Decimal("1")
    early = dicts(series.progression(psa(spark, (0, "10"), (10, "1"), (30, "3.5"), (50, "3.6"))), "observation_id")
    assert early[2]["is_rise"] and not early[2]["is_confirmed"]


def test_doubling_time(spark):
    out = dicts(series.doubling_time(psa(spark, (0, "1"), (100, "2"), (200, "2"), (1200, "4"))), "observation_id")
    assert [None if r["doubling_days"] is None else round(r["doubling_days"], 6) for r in out] == [None, 100.0, None, 1000.0]
    assert [r["is_high_risk"] for r in out] == [None, True, None, False]
    assert [r["days_between"] for r in out] == [None, 100, 100, 1000]


@pytest.mark.parametrize("value, unit, want", [
    ("49.9", "ng/dL", "Castrate"), ("50", "ng/dL", "Non-Castrate"), ("1.69", "nmol/L", "Castrate"), ("1.7", "nmol/L", "Non-Castrate"),
    ("1", "other", "Non-Castrate"), (None, "ng/dL", "Non-Castrate"), ("1", None, "Non-Castrate"),
])
def test_castrate_limits(spark, value, unit, want):
    df = spark.createDataFrame([(None if value is None else Decimal(value), unit)], "v decimal(15,4), u string")
    assert df.select(series.threshold_status(F.col("v"), F.col("u")).alias("x")).first()["x"] == want


def test_distinct_counts_and_text_with_hot_key(spark, events):
    out = {r["key"]: r for r in nest.distinct_counts(events, "key", "id", large=F.col("value") > 10).collect()}
    rows = events.collect()
    for key in {r.key for r in rows}:
        own = [r for r in rows if r.key == key]
        assert out[key]["total"] == len({r.id for r in own}) and out[key]["large"] == len({r.id for r in own if r.value > 10})
    text = {r["key"]: r["t"] for r in nest.distinct_text(events, ["key"], F.floor("value").cast("string"), "t", ",").collect()}
    assert text["hot"] == ",".join(sorted({str(int(r.value)) for r in rows if r.key == "hot"}))
