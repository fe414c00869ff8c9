from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from carelake.functions import columns as C

col = F.col


def one(spark, expr, **values):
    ddl = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [
    ("2024-01-02T03:04:05.123456789+02:00", datetime(2024, 1, 2, 1, 4, 5, 123456)),
    ("2024-01-02T03:04:05.123Z", datetime(2024, 1, 2, 3, 4, 5, 123000)),
    ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.123", None),
    ("2024-01-02", None),
    ("3/18/15", None),
    ("garbage", None),
    (None, None),
])
def test_iso_timestamps(spark, text, want):
    assert one(spark, C.parse_timestamp(col("t")), t=text) == want


@pytest.mark.parametrize("text, want", [
    ("3/18/15", datetime(2015, 3, 18)), ("3/18/2015", datetime(2015, 3, 18)), ("2024-01-02", datetime(2024, 1, 2)),
    ("1/2", None), ("garbage", None), (None, None),
])
def test_dates_and_short_dates(spark, text, want):
    assert one(spark, C.parse_timestamp(col("t"), dates=True, short=True), t=text) == want


@pytest.mark.parametrize("ref, pid, kind, any_id", [
    ("Patient/1", "1", "Patient", "1"), ("Group/1", None, "Group", "1"), ("Patient/", None, "Patient", None),
    (None, None, None, None), ("malformed", None, None, None), ("OtherPatient/7", None, "OtherPatient", "7"),
    ("https://h/fhir/Patient/1", "1", "Patient", "1"),
])
def test_references(spark, ref, pid, kind, any_id):
    assert one(spark, C.reference_id(col("r"), "Patient"), r=ref) == pid
    assert one(spark, C.reference_type(col("r")), r=ref) == kind
    assert one(spark, C.reference_any_id(col("r")), r=ref) == any_id


def test_first_coding_of_absent_empty_and_filled(spark, resource_rows):
    df = resource_rows(
        "Medication", {"id": "1"}, {"id": "2", "code": {"coding": []}},
        {"id": "3", "code": {"coding": [{"code": '"C61"'}, {"code": "b"}]}},
    )
    got = {r["id"]: r["c"] for r in df.select("id", C.strip_quotes(C.first_coding(col("code"), "code")).alias("c")).collect()}
    assert got == {"1": None, "2": None, "3": "C61"}


def test_text_sanitizers(spark):
    text = 'a"b\\c\nd\te\r'
    assert one(spark, C.strip_control(col("t")), t=text) == "ab\\cde"
    assert one(spark, C.strip_escapes(col("t")), t=text) == "abc\nd\te\r"
    assert one(spark, C.escape_backslashes(col("t")), t=text) == "ab\\\\cde"
    assert one(spark, C.plain_name(col("t")), t="O'Neil, Ann-Marie 3.") == "ONeil Ann-Marie 3."


def test_date_prefix_and_numbers(spark):
    assert one(spark, C.date_prefix(col("t")), t="2024-01-02T00:00:00Z") == date(2024, 1, 2)
    assert one(spark, C.date_prefix(col("t")), t="unknown") is None
    assert float(one(spark, C.numeric_value(col("a"), col("b")), a="x", b="1.5")) == 1.5


def test_document_class(spark):
    kind = lambda code, system: one(spark, C.document_class(col("c"), col("s")), c=code, s=system)
    assert kind("11526-1", "http://loinc.org") == "pathology"
    assert kind("28570-0", "http://loinc.org") == "history"
    assert kind("11526-1", "other") == "unknown"
    assert kind(None, None) == "unknown"


def test_concept_dump(spark):
    dump = (
        "{id=null, extension=null, coding=[{id=null, extension=null, system=http://snomed.info/sct, _system=null, version=null, "
        "_version=null, code=399068003, _code=null, display=Malignant neoplasm of prostate, _display=null, userSelected=null, "
        "_userSelected=null}, {id=null, extension=null, system=http://hl7.org/fhir/sid/icd-10-cm, _system=null, version=null, "
        "_version=null, code=C61, _code=null, display=Malignant neoplasm of prostate, _display=null, userSelected=null, "
        "_userSelected=null}], text=Malignant neoplasm of prostate, _text=null}"
    )
    got = one(spark, C.parse_concept_dump(col("t")), t=dump)
    assert got["text"] == "Malignant neoplasm of prostate"
    assert [(c["system"], c["code"], c["display"]) for c in got["coding"]] == [
        ("http://snomed.info/sct", "399068003", "Malignant neoplasm of prostate"),
        ("http://hl7.org/fhir/sid/icd-10-cm", "C61", "Malignant neoplasm of prostate"),
    ]
    assert one(spark, C.parse_concept_dump(col("t")), t="{coding=[{system=null, code=null}], text=x}") is None
    assert one(spark, C.parse_concept_dump(col("t")), t=None) is None


def test_inferred_evidence(spark, resource_rows):
    source = {"reference": "DocumentReference/1", "display": "d", "extension": [
        {"url": "urn:Evidence:a", "valueString": "s", "extension": [{"url": "n", "valueInteger": 3}]}, {"url": "urn:other"}]}
    tag = {"security": [{"code": "AIAST"}]}
    df = resource_rows(
        "Observation", {"id": "1", "meta": tag, "derivedFrom": [source, {"reference": "x"}]},
        {"id": "2", "meta": {"security": [{"code": "R"}]}, "derivedFrom": [source]}, {"id": "3", "meta": tag}, {"id": "4"},
    )
    got = {r["id"]: r["e"] for r in df.select("id", C.inferred_evidence(col("meta"), col("derivedFrom"), "evidence").alias("e")).collect()}
    assert got["1"] == (
        '[{"url":"urn:Evidence:a","reference":"DocumentReference/1","display":"d","valueString":"s",'
        '"value":[{"url":"n","valueInteger":3}]}]'
    )
    assert got["2"] is None and got["3"] is None and got["4"] is None
