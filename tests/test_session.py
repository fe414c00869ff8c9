"""Which sides of joins are broadcast."""

from pyspark.sql import functions as F

from carelake import session


def _joined(spark, tmp_path, children):
    items = F.transform(F.sequence(F.lit(1), F.lit(children)), lambda i: F.struct(i.alias("n"), F.lit("same text in all rows").alias("text")))
    path = str(tmp_path / f"nested-{children}")
    spark.range(0, 100_000, 1, 4).select(F.col("id").cast("string").alias("id"), items.alias("child")).write.parquet(path)
    rows = spark.read.parquet(path).select("id", F.explode("child").alias("x")).select("id", "x.text")
    ids = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("id"))
    return ids.join(rows, "id", "left")


def test_exploded_children_are_not_broadcast_by_their_file_size(spark, tmp_path):
    session.configure(spark)
    df = _joined(spark, tmp_path, 20)  # under a MB of files, two million rows
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 20_000
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in final


def test_threshold_of_the_session_holds_for_measured_sizes(spark):
    before = {k: spark.conf.get(k, None) for k in (session.ESTIMATED, session.MEASURED)}
    try:
        spark.conf.unset(session.MEASURED)
        spark.conf.set(session.ESTIMATED, "256k")
        for _ in range(2):
            session.configure(spark)
            assert (spark.conf.get(session.ESTIMATED), spark.conf.get(session.MEASURED)) == (session.TINY, "256k")
        spark.conf.set(session.ESTIMATED, "-1")
        session.configure(spark)
        assert spark.conf.get(session.ESTIMATED) == "-1"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_plans_at_once_share_their_broadcasts(spark):
    from carelake.plans import jobs
    from carelake.session import MEASURED, shared_broadcasts

    before, seen = spark.conf.get(MEASURED, None), []
    try:
        spark.conf.set(MEASURED, "8m")
        jobs.at_once(spark, lambda name: seen.append(spark.conf.get(MEASURED)), iter("abcd"), most=2)
        assert seen == [str(4 << 20)] * 4 and spark.conf.get(MEASURED) == "8m"
        spark.conf.set(MEASURED, "-1")
        with shared_broadcasts(spark, 8):
            assert spark.conf.get(MEASURED) == "-1"
        spark.conf.unset(MEASURED)
        with shared_broadcasts(spark, 2):
            assert spark.conf.get(MEASURED) is not None
        assert spark.conf.get(MEASURED, None) is None
    finally:
        spark.conf.set(MEASURED, before) if before is not None else spark.conf.unset(MEASURED)
