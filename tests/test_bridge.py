"""Resources derived from tables with odd rows."""

from carelake.session import ESTIMATED
from carelake.sources import bridge


def test_codings_of_an_order(spark, tmp_path):
    parts = [(1, "Brand#2", "LARGE"), (2, "Brand#1", "LARGE"), (3, "Brand#3", None), (4, "Brand#25", "unheard of"), (1, "Brand#2", "SMALL")]
    lines = [(10, 1), (10, 1), (10, 2), (11, 3), (12, 4), (12, 9), (13, 9), (None, 2), (14, None)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = bridge._order_codings(spark, str(tmp_path))
    got = {r["l_orderkey"]: ([(x["system"][-6:], x["code"], x["display"]) for x in r["codings"]], r["name"]) for r in df.collect()}
    icd = lambda k: ("icd-10-cm"[-6:], bridge.ICD_CODES[k], bridge.ICD_NAMES[k])
    sct = lambda t: ("med.info/sct"[-6:], bridge.SNOMED_BY_TYPE[t], None)
    none = (sct("LARGE")[0], None, None)
    assert got[10] == ([icd(0), icd(1), *sorted([sct("LARGE"), sct("SMALL")])], bridge.ICD_NAMES[0])
    assert got[11] == ([icd(2), none], bridge.ICD_NAMES[2])
    assert got[12] == ([icd(24), none], bridge.ICD_NAMES[24])
    assert got[None] == ([icd(0), sct("LARGE")], bridge.ICD_NAMES[0])
    assert set(got) == {10, 11, 12, None}
    # one row a line meets its order: no coding is exploded and shuffled
    assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_is_projected_from_its_rows(spark):
    """A resource of wide nested rows is not written to read a few of its fields."""
    from conftest import SF

    from carelake.catalog import stage

    for name in ("child_encounter_locations", "child_patient_communications", "child_medication_request_notes"):
        plan = _plan(stage.table(spark, SF, name.removeprefix("child_")))
        assert "Location: InMemoryFileIndex" in plan and "/carelake/" not in plan
    prescriptions = _plan(stage.table(spark, SF, "medication_request_identifiers"))
    assert "l_partkey" in prescriptions and not any(c in prescriptions for c in ("p_name", "l_shipdate", "l_quantity"))


def test_prescriptions_meet_their_order_where_they_are(spark, tmp_path):
    ship = "2020-01-0{} 00:00:00"
    lines = [(1, 7, 2.0, 1, 5), (1, 7, 3.0, 4, 4), (1, 8, 1.0, 2, 3), (2, 7, 1.0, 3, 2), (3, 7, 1.0, 3, 2), (1, 99, 1.0, 3, 2), (None, 7, 1.0, 3, 2)]
    frame = spark.createDataFrame(
        [(o, p, q, ship.format(d), "A" if d < 3 else "R", "O", s) for o, p, q, d, s in lines],
        "l_orderkey long, l_partkey long, l_quantity double, l_shipdate string, l_returnflag string, l_linestatus string, l_suppkey long")
    frame.withColumn("l_shipdate", frame["l_shipdate"].cast("timestamp")).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(7, "blue x"), (8, "y"), (8, "y")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get(ESTIMATED)
    spark.conf.set(ESTIMATED, "-1")
    try:
        df = bridge.rows(spark, str(tmp_path), "prescriptions")
        assert _plan(df).count("hashpartitioning(l_orderkey") == 1
    finally:
        spark.conf.set(ESTIMATED, before)
    got = sorted((r["l_orderkey"], r["l_partkey"], r["o_custkey"], r["amount"], r["first_day"].day, r["last_day"].day, r["flag"], r["supplier"]) for r in df.collect())
    assert got == [(1, 7, 10, 5, 1, 4, "R", 4), (1, 8, 10, 1, 2, 2, "A", 3), (1, 8, 10, 1, 2, 2, "A", 3), (2, 7, 20, 1, 3, 3, "R", 2), (2, 7, 21, 1, 3, 3, "R", 2)]
