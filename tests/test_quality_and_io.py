import json

from conftest import dicts
from pyspark.sql import functions as F

from carelake.operators import quality
from carelake.plans import jobs
from carelake.session import shared_folder
from carelake.sources import io, schemas
from carelake.streaming.incremental import load_batch, run_increments


def test_null_profile_and_drift(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [(r["column_name"], r["null_count"], r["null_rate"]) for r in dicts(quality.null_profile(df, ["a", "b"]), "column_name")] == [("a", 0, 0.0), ("b", 1, 0.5)]
    expected = schemas.datatype("a bigint, c date")
    got = {r["column_name"]: (r["status"], r["filled_rows"]) for r in quality.schema_report(df, expected).collect()}
    assert got == {"a": ("type_differs", 2), "b": ("unexpected", 1), "c": ("missing", None)}


def test_missing_tables(spark):
    spark.range(1).createOrReplaceTempView("present_view")
    assert quality.missing_tables(spark, ["surely_absent"]) == ["surely_absent"]
    try:
        quality.require_tables(spark, ["surely_absent"])
    except LookupError as error:
        assert "surely_absent" in str(error)
    else:
        raise AssertionError("expected a LookupError")


def test_conform_and_read_with_explicit_schema(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([("1", "final")], "id string, status string").write.json(path)
    df = io.read_resource(spark, "Observation", path, file_format="json")
    assert df.schema == schemas.resource_schema("Observation") and df.first()["component"] is None
    out = io.conform(spark.createDataFrame([(1,)], "HASMEMBER int"), schemas.datatype("hasMember int, x string"))
    assert out.columns == ["hasMember", "x"] and out.first()["hasMember"] == 1


def test_sinks(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    io.bookmark_sink(df, path, has_mark=False)
    io.bookmark_sink(df, path, has_mark=True)
    assert spark.read.parquet(path).count() == 6
    io.full_refresh(df, path)
    assert spark.read.parquet(path).count() == 3
    io.write_json_lines(df.withColumn("n", F.struct(F.lit("v").alias("f"))), str(tmp_path / "j"), {"id": "key", "n.f": "f"})
    assert dicts(spark.read.json(str(tmp_path / "j")), "key")[0] == {"f": "v", "key": 0}


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == named.rstrip("/") if named else shared_folder(spark) == shared_folder(spark)


def test_increments(spark, tmp_path):
    source, check = tmp_path / "in", str(tmp_path / "check")
    source.mkdir()
    target = jobs.store(spark, "Medication", str(tmp_path / "out"), buckets=4).create()

    def arrive(name, *rows):
        (source / name).write_text("\n".join(json.dumps(r) for r in rows))
        run_increments(spark, "Medication", str(source), target, check, as_of="2024-01-01").awaitTermination()

    def row(i, day, status):
        return {"id": i, "status": status, "meta": {"lastUpdated": f"2024-01-{day:02d}T00:00:00Z"}, "identifier": [{"value": status}]}

    def content():
        return ([(r["medication_id"], r["status"]) for r in dicts(target.read("medications"), "medication_id")],
                sorted(r["identifier_value"] for r in dicts(target.read("medication_identifiers"))))

    arrive("a.json", row("1", 1, "a"), row("2", 1, "b"))
    arrive("b.json", row("1", 2, "c"), row("2", 1, "late copy"), row("3", 1, "d"))
    assert content() == ([("1", "c"), ("2", "b"), ("3", "d")], ["b", "c", "d"])

    # a batch that is repeated changes nothing; one of one row writes files of that row only
    before = sorted(tmp_path.glob("out/**/*.parquet"))
    again = spark.read.schema(schemas.resource_schema("Medication")).json(str(source / "b.json"))
    assert load_batch("Medication", again, 1, target, "2024-01-01") is None
    assert sorted(tmp_path.glob("out/**/*.parquet")) == before
    arrive("c.json", row("2", 9, "e"))
    new = sorted(p.relative_to(tmp_path / "out").parts[:2] for p in tmp_path.glob("out/**/*_gen=3/**/*.parquet"))
    assert new == [("keys", "_gen=3"), ("rows", "medication_identifiers"), ("rows", "medications")]
    assert content() == ([("1", "c"), ("2", "e"), ("3", "d")], ["c", "d", "e"])
