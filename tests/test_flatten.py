import json
from decimal import Decimal

import pytest
from conftest import dicts

from carelake.operators import quality
from carelake.operators.flatten import RULES, flatten, flatten_all, tables_of
from carelake.plans import resources  # noqa: F401
from carelake.plans.resources import observation_component
from carelake.sources import io, schemas


def test_thirteen_main_and_57_child_tables():
    assert set(RULES) == set(schemas.TABLES)
    assert sum(r.is_main for r in RULES.values()) == 13 and len(RULES) == 70


@pytest.mark.parametrize("resource", list(schemas.RESOURCES))
def test_layout_and_absent_elements(spark, resource_rows, resource):
    """A resource with an id and a patient only: fixed layouts, no child rows, no errors."""
    row = {"id": "1", "subject": {"reference": "Patient/1"}}
    df = resource_rows(resource, row)
    main, children = tables_of(resource)
    tables = flatten_all(df, resource, "2024-01-01")
    for table, out in tables.items():
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.table_schema(table)]
    counts = {r["table_name"]: r["rows"] for r in quality.row_counts(tables).collect()}
    assert counts == {t: int(t == main) for t in (main, *children)}


def test_patient_is_required_where_the_table_is_patient_owned(spark, resource_rows):
    df = resource_rows("Observation", {"id": "1", "subject": {"reference": "Group/1"}}, {"subject": {"reference": "Patient/1"}})
    assert flatten(df, "observations").count() == 0
    assert flatten(resource_rows("Patient", {"id": "1"}), "patients").count() == 1


def test_codes_of_three_systems_null_and_quoted(spark, resource_rows):
    codings = [{"system": "a", "code": '"C61"'}, {"system": "b", "code": None}, None, {"system": "c", "code": "x", "display": "X"}]
    df = resource_rows("Observation", {"id": "1", "subject": {"reference": "Patient/9"}, "code": {"coding": codings, "text": "T"}})
    assert [(r["code_system"], r["code_code"], r["code_text"]) for r in dicts(flatten(df, "observation_codes"), "code_system")] == [
        ("a", "C61", "T"), ("c", "x", "T")]


def test_empty_reference_ids_are_dropped(spark, resource_rows):
    df = resource_rows("CarePlan", {"id": "1", "subject": {"reference": "Patient/1"}, "goal": [
        {"reference": "Goal/"}, {"reference": "Goal/7"}, {"reference": "Task/1"}, {}]})
    assert [r["goal_id"] for r in dicts(flatten(df, "care_plan_goals"))] == ["7"]


def test_reference_range_needs_a_value(spark, resource_rows):
    df = resource_rows("Observation", {"id": "1", "subject": {"reference": "Patient/1"}, "referenceRange": [
        {"low": {"value": 1.5, "unit": "u"}}, {"text": "t"}, {"type": {"text": "only"}}, {}]})
    rows = dicts(flatten(df, "observation_reference_ranges"), "range_text")
    assert [(r["range_low_value"], r["range_text"]) for r in rows] == [(Decimal("1.5000"), None), (None, "t")]


def test_component_value_by_system(spark, resource_rows):
    component = {"code": {"coding": [{"system": "urn:dated", "code": "c"}]}, "valueString": "s", "valueDateTime": "2024-01-02"}
    df = resource_rows("Observation", {"id": "1", "subject": {"reference": "Patient/1"}, "component": [component]})
    assert dicts(flatten(df, "observation_components"))[0]["component_value_string"] == "s"
    from pyspark.sql import functions as F

    items = df.select("subject", F.explode("component").alias("i")).select("subject", "i", F.explode("i.code.coding").alias("c"))
    text = observation_component(F.col("i"), F.col("c"), dated_system="urn:dated")["component_value_string"]
    assert items.select(text.alias("v")).first()["v"] == "2024-01-02"


def test_extension_order_and_kind(spark, resource_rows):
    df = resource_rows("Condition", {"id": "1", "subject": {"reference": "Patient/1"}, "extension": [
        {"url": "a", "valueCode": "c"}, {"url": "b", "extension": [{"url": "n"}]}, {"url": "c", "valueReference": {"reference": "X/1"}}]})
    rows = [r for r in dicts(flatten(df, "condition_extensions"), "extension_order") if r["parent_extension_url"] is None]
    assert [(r["extension_order"], r["extension_type"], r["value_type"]) for r in rows] == [
        (0, "simple", "code"), (1, "nested", "unknown"), (2, "simple", "reference")]
    assert rows[2]["value_reference"] == "X/1"


def test_attachment_placeholder(spark, resource_rows):
    df = resource_rows("DocumentReference", {"id": "1", "subject": {"reference": "Patient/1"}, "content": [
        {"attachment": {"url": "u", "data": "d"}}, {"attachment": {"data": "d"}}, {"attachment": {}}]})
    assert [r["attachment_url"] for r in dicts(flatten(df, "document_reference_content"), "attachment_url")] == [
        "ref:content[1].attachment.data", "u"]


def test_medication_without_codings_has_null_text(spark, resource_rows):
    df = resource_rows("Medication", {"id": "1"}, {"id": "2", "code": {"coding": [{"code": "c"}]}})
    assert [r["code"] for r in dicts(flatten(df, "medications"), "medication_id")] == ["null", '[{"code":"c"}]']


def test_only_needed_nested_fields_are_scanned(spark, resource_rows, tmp_path):
    path = str(tmp_path / "observation")
    resource_rows("Observation", {"id": "1"}).write.parquet(path)
    df = flatten(spark.read.schema(schemas.resource_schema("Observation")).parquet(path), "observation_codes")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema"):]
    assert "component" not in scan and "valueQuantity" not in scan and "Exchange" not in plan


def deep(depth):
    """An extension with ``depth`` levels, named by level."""
    inner = {"url": f"l{depth}", "valueInteger": depth}
    for level in range(depth - 1, 0, -1):
        inner = {"url": f"l{level}", "extension": [inner, {"url": f"side{level}", "valueReference": {"reference": f"X/{level}"}}]}
    return inner


def test_extensions_of_any_depth(spark, resource_rows):
    source = resource_rows(
        "Condition", {"id": "1", "subject": {"reference": "Patient/1"}, "extension": [deep(3), {"url": "flat", "valueDecimal": 0.5}]},
        {"id": "2", "extension": [deep(5)]}, {"id": "3", "extension": [{"url": "odd", "extension": []}]}, {"id": "4"})
    rows = dicts(flatten(source, "condition_extensions"))
    found = {(r["condition_id"], r["parent_extension_url"], r["extension_url"], r["extension_type"], r["value_type"], r["extension_order"]) for r in rows}
    assert len(rows) == 5 + 1 + 9 + 1
    for key, depth in (("1", 3), ("2", 5)):
        for level in range(1, depth):
            assert (key, f"l{level - 1}" if level > 1 else None, f"l{level}", "nested", "unknown", 0) in found
            assert (key, f"l{level}", f"side{level}", "simple", "reference", 1) in found
        assert (key, f"l{depth - 1}", f"l{depth}", "simple", "integer", 0) in found
    assert {r["value_reference"] for r in rows if r["extension_url"].startswith("side")} == {f"X/{k}" for k in range(1, 5)}
    assert ("3", None, "odd", "nested", "unknown", 0) in found and ("1", None, "flat", "simple", "decimal", 1) in found


def test_extensions_that_are_columns_become_text(spark, tmp_path):
    source = {"id": "1", "extension": [deep(4)]}
    path = str(tmp_path / "r")
    spark.read.json(spark.sparkContext.parallelize([json.dumps(source)])).write.parquet(path)
    df = io.read_resource(spark, "Condition", path)
    assert df.schema == schemas.resource_schema("Condition")
    urls = [r["extension_url"] for r in dicts(flatten(df, "condition_extensions"), "extension_url")]
    assert urls == ["l1", "l2", "l3", "l4", "side1", "side2", "side3"]
