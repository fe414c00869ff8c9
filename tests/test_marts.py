from collections import defaultdict
from datetime import datetime
from decimal import Decimal

from conftest import SF, dicts
from pyspark.sql import functions as F

from carelake.catalog import stage
from carelake.operators import nest
from carelake.operators.flatten import RULES, flatten_all
from carelake.plans import facts, oncology, refresh, reports, resources  # noqa: F401  (resources registers the rules)
from carelake.sources import io, schemas


def tables(spark, **frames):
    out = defaultdict(dict)
    return {t: frames.get(t) if frames.get(t) is not None else io.empty_table(spark, t) for t in schemas.TABLES}


def test_care_plan_children_do_not_multiply(spark, resource_rows):
    df = resource_rows("CarePlan", {"id": "1", "subject": {"reference": "Patient/1"}, "status": "active",
                                    "category": [{"coding": [{"code": "a"}, {"code": "b"}]}],
                                    "goal": [{"reference": f"Goal/{i}"} for i in range(3)]})
    row = dicts(facts.care_plans(tables(spark, **flatten_all(df, "CarePlan"))))[0]
    assert (row["categories_count"], row["goals_count"], row["care_teams_count"]) == (2, 3, 0)
    assert row["care_teams"] == [] and [g["goal_id"] for g in row["goals"]] == ["0", "1", "2"]


def test_encounter_with_two_conditions_of_two_codes_is_one_row(spark, resource_rows):
    conditions = [{"id": f"c{i}", "subject": {"reference": "Patient/1"}, "encounter": {"reference": "Encounter/e"},
                   "onsetDateTime": f"2024-01-0{2 - i}T00:00:00Z",
                   "code": {"text": "t", "coding": [{"system": facts.codes.SNOMED, "code": f"s{i}"}, {"system": facts.codes.ICD10CM, "code": f"I{i}", "display": f"d{i}"}]}}
                  for i in range(2)]
    encounter = {"id": "e", "subject": {"reference": "Patient/1"}, "status": "finished", "period": {"start": "2024-01-01T00:00:00Z"}}
    t = tables(spark, **flatten_all(resource_rows("Encounter", encounter), "Encounter"),
               **flatten_all(resource_rows("Condition", *conditions), "Condition"))
    rows = dicts(facts.encounters(t, "2024-02-01"))
    assert len(rows) == 1 and rows[0]["diagnosis_count"] == 2
    assert (rows[0]["primary_diagnosis_code"], rows[0]["primary_diagnosis_display"]) == ("I0", "d0")
    assert rows[0]["all_diagnoses"] == "ICD10:I1:d1 | SNOMED:s1:t | ICD10:I0:d0 | SNOMED:s0:t"


def test_codes_survive_flatten_and_nest(spark, resource_rows):
    codings = [{"system": s, "code": c, "display": "d"} for s, c in (("http://loinc.org", "9"), ("x", "1"), ("http://snomed.info/sct", "5"), ("http://loinc.org", "2"))]
    df = resource_rows("Observation", {"id": "1", "status": "final", "subject": {"reference": "Patient/1"}, "code": {"coding": codings}})
    row = dicts(facts.observations(tables(spark, **flatten_all(df, "Observation"))))[0]
    assert [(c["code"], c["rank"]) for c in row["codes"]] == [("2", 1), ("9", 2), ("5", 3), ("1", 4)]
    assert {(c["system"], c["code"]) for c in row["codes"]} == {(c["system"], c["code"]) for c in codings}
    assert row["primary_code"] == "2" and row["has_value"] is False


def test_vital_signs_and_others_split(spark, resource_rows):
    make = lambda i, code, display=None: {
        "id": i, "status": "final", "subject": {"reference": "Patient/1"}, "category": [{"coding": [{"code": code, "display": display}]}]}
    df = resource_rows("Observation", make("1", "vital-signs"), make("2", "x", "Vital thing"), make("3", "laboratory"),
                       {"id": "4", "status": "final", "subject": {"reference": "Patient/1"}}, {"id": "5", "subject": {"reference": "Patient/1"}})
    t = tables(spark, **flatten_all(df, "Observation"))
    ids = lambda f: [r["observation_id"] for r in dicts(f(t), "observation_id")]
    assert ids(facts.vital_signs) == ["1", "2"] and ids(facts.observations) == ["3", "4"]


def test_stage_row_is_kept_whole(spark):
    stages = spark.createDataFrame([("1", "a", "z"), ("1", "b", None)], "condition_id string, stage_summary_system string, stage_summary_code string")
    t = tables(spark, condition_stages=io.conform(stages, schemas.table_schema("condition_stages")), conditions=io.conform(
        spark.createDataFrame([("1", "p")], "condition_id string, patient_id string"), schemas.table_schema("conditions")))
    summary = dicts(facts.conditions(t, "2024-01-01"))[0]["stages"]["summary"]
    assert (summary["system"], summary["code"]) == ("b", "")


def test_json_columns(spark):
    df = spark.createDataFrame([("1", 'say "hi"\n')], "id string, text string")
    nested = nest.nest_children(df, "id", "notes", text=F.col("text"), none=F.lit(None).cast("string"))
    assert nest.to_json_columns(nested).first()["notes"] == '[{"text":"say \\"hi\\"\\n"}]'


def _conditions(spark, *rows):
    ddl = "patient_id string, code_code string, severity_display string, is_active boolean, onset_datetime timestamp, recorded_date timestamp"
    return spark.createDataFrame(list(rows), ddl)


def test_cardiac_criteria(spark):
    day = lambda m, d: datetime(2024, m, d)
    rows = _conditions(
        spark,
        ("1", "I50.9", "NYHA Class III", True, day(1, 1), day(1, 2)), ("2", "I50.9", "mild", True, day(1, 1), day(1, 2)),
        ("3", "I20.9", None, False, day(5, 2), day(5, 2)), ("4", "I20.9", None, True, day(1, 1), day(6, 1)),
        ("5", "I20.9", None, True, None, day(5, 30)), ("1", "I25.5", None, True, None, day(3, 1)), ("6", "I25.5", None, False, None, day(3, 1)),
        ("7", "I21.9", None, None, day(1, 1), day(1, 1)), ("9", "I25.5", None, True, None, day(3, 1)),
    )
    people = spark.createDataFrame([(str(i),) for i in range(1, 9)], "patient_id string")
    out = {r["patient_id"]: r for r in dicts(reports.cardiac_exclusions({"fact_conditions": rows}, people, "2024-06-01"))}
    assert set(out) == {"1", "3", "5", "7"}
    assert (out["1"]["cardiac_exclusion_count"], out["1"]["has_severe_chf"], out["1"]["has_significant_cardiac"]) == (2, 1, 1)
    assert out["1"]["earliest_cardiac_event"] == day(1, 1) and out["1"]["most_recent_recording"] == day(3, 1)


def test_lab_predicates(spark):
    ddl = "observation_text string, primary_code string, value_quantity_unit string, status string, observation_category string, has_value boolean"
    texts = [("Neutrophils", None, "%"), ("Neutrophils", None, "10*3"), ("Neutrophils", None, None), ("Free PSA", "2857-1", "ng"),
             ("Antigen", "2857-1", "ng"), ("psa", None, None), ("Globulin ALB", None, None), ("ALB", None, None), ("CD4", "8122-4", None)]
    df = spark.createDataFrame([(*t, "final", "laboratory", True) for t in texts] + [
        ("ALT", None, None, "final", "imaging", True), ("ALT", None, None, "preliminary", "laboratory", True),
        ("ALT", None, None, "amended", "laboratory", False), ("ALT", None, None, "amended", "laboratory", True)], ddl)
    hits = lambda name: df.filter(reports.LABS[name].predicate()).count()
    assert hits("report_neutrophils") == 1 and hits("report_psa_total") == 2
    assert hits("report_serum_albumin") == 1 and hits("report_cd4") == 1 and hits("report_alt") == 1


def test_hormone_status_tree(spark):
    obs = "patient_id string, observation_id string, effective_datetime timestamp, value_quantity_value decimal(15,4), value_quantity_unit string, primary_code string, primary_display string"
    rows, day = [], lambda d: datetime(2024, 1 + d // 28, 1 + d % 28)
    for p, testosterone in (("inadequate", "60"), ("stable", "20"), ("resistant", "20")):
        rows.append((p, f"{p}-t", day(1), Decimal(testosterone), "ng/dL", "2986-8", "Testosterone"))
    for i, v in enumerate(("10", "1", "1.5", "3.5", "3.6")):
        for p in ("stable", "resistant", "earlier", "undated"):
            value = "1" if p == "stable" else v
            rows.append((p, f"{p}-{i}", day(i if i < 4 else 30), Decimal(value), "ng/mL", "2857-1", "PSA"))
        rows.append(("stable", f"percent-{i}", day(i if i < 4 else 30), Decimal(v), "%", "2857-1", "PSA free ratio"))
    rows += [(p, f"{p}-t", day(1), Decimal("20"), "ng/dL", "2986-8", "Testosterone") for p in ("earlier", "undated")]
    treated = {"inadequate": day(0), "stable": day(0), "resistant": day(0), "earlier": day(35), "undated": None}
    meds = spark.createDataFrame([(p, "Lupron Depot", at) for p, at in treated.items()],
                                 "patient_id string, medication_display string, authored_on timestamp")
    people = spark.createDataFrame([("naive",), *[(p,) for p in treated]], "patient_id string")
    marts = {"fact_medication_requests": meds, "fact_observations": spark.createDataFrame(rows, obs)}
    got = {r["patient_id"]: (r["hormone_code"], r["reason"]) for r in dicts(oncology.hormone_status(marts, people))}
    assert got == {"naive": ("Z19.1", "treatment-naive"), "inadequate": ("Z19.1", "inadequate-suppression"),
                   "stable": ("Z19.1", "castrate-sensitive"), "resistant": ("Z19.2", "castration-resistant"),
                   "earlier": ("Z19.1", "castrate-sensitive"), "undated": ("Z19.2", "castration-resistant")}
    short = {r["patient_id"]: r["reason"] for r in dicts(oncology.hormone_status(marts, people, lasts_days=1))}
    assert short["resistant"] == "castrate-sensitive" and short["undated"] == "castration-resistant"


def test_refresh_levels_cover_all_marts(spark):
    names = [n for level in refresh.LEVELS.values() for n in level]
    assert len(names) == len(set(names)) == 37 and set(facts.FACTS) <= set(names)
    assert len([n for n in names if n.startswith("report_")]) == 25
    assert all(refresh.builder(n, {}) for n in names)


def test_refresh_and_registry(spark, tmp_path):
    t = tables(spark)
    marts = refresh.refresh(spark, t, str(tmp_path), levels=(0, 1, 2, 3), as_of="2024-01-01")
    assert len(marts) == 13
    entries = refresh.registry_rows(spark, marts, "2024-01-01")
    registry = refresh.update_registry(spark.createDataFrame([], refresh.REGISTRY), entries)
    later = refresh.registry_rows(spark, {"report_cohort": marts["report_cohort"]}, "2024-02-01")
    updated = refresh.update_registry(registry, later)
    assert updated.count() == 13 and updated.filter("last_refreshed > '2024-01-15'").count() == 1
    report = refresh.builder("report_psa_total", t)(marts)
    assert report.count() == 0 and report.columns[0] == "names"


def test_marts_refreshed_by_touched_keys_equal_marts_built_anew(spark, tmp_path):
    only = {"fact_practitioners", "fact_patients", "fact_conditions", "fact_encounters", "report_cohort"}
    before, after = stage.Tables(spark, SF), stage.Tables(spark, SF)
    changes = {}
    for resource, main, key in (("Condition", "conditions", "condition_id"), ("Encounter", "encounters", "encounter_id")):
        gone, renamed = F.col(key).cast("long") % 20 == 3, F.col(key).cast("long") % 20 == 5
        changes[resource] = before[main].where(gone | renamed).select(key)
        for name, rule in RULES.items():
            if rule.resource == resource:
                after[name] = before[name].where(~gone)
        # the other changed rows move to another patient
        after[main] = after[main].withColumn("patient_id", F.when(renamed, F.lit("1")).otherwise(F.col("patient_id")))
    periods = {"as_of": stage.AS_OF, "only": only, "cohort_from": "1990-01-01", "report_from": "1990-01-01"}
    root = str(tmp_path / "marts")
    marts = refresh.refresh_stores(spark, before, root, **periods)
    periods.pop("only")
    marts = refresh.refresh_changes(spark, before, after, changes, marts, root, **periods)
    whole = refresh.refresh_stores(spark, after, str(tmp_path / "whole"), only=only, **periods)

    def content(df):
        return sorted(map(str, df.drop("etl_created_at", "etl_updated_at", "created_at", "updated_at").collect()))

    for name in only:
        assert content(marts[name]) == content(whole[name]), name
    touched = refresh.Store(spark, f"{root}/fact_conditions", {"fact_conditions": marts["fact_conditions"].schema}, "condition_id", 16)
    written = touched.written(2, "fact_conditions")
    assert 0 < written.count() < marts["fact_conditions"].count() / 5
    assert not (tmp_path / "marts/fact_practitioners/commits/gen=2").exists()


def _observation_tables(spark, resource_rows):
    df = resource_rows("Observation", {
        "id": "1", "status": "final", "subject": {"reference": "Patient/1"}, "valueString": "v", "effectiveDateTime": "2024-01-02T00:00:00Z",
        "code": {"text": "t", "coding": [{"system": "http://loinc.org", "code": "9", "display": "d"}]}, "note": [{"text": "n"}],
        "category": [{"coding": [{"system": facts.codes.OBSERVATION_CATEGORY, "code": "laboratory"}]}]},
        {"id": "2", "status": "entered-in-error", "subject": {"reference": "Patient/1"}}, {"id": "3", "status": "final", "subject": {"reference": "Patient/2"}})
    return tables(spark, **flatten_all(df, "Observation"))


def test_children_that_are_not_read_are_not_nested(spark, resource_rows):
    t = _observation_tables(spark, resource_rows)
    narrow = facts.build("fact_observations", t, columns=("observation_id", "primary_code", "value_string"))
    assert narrow.columns == ["observation_id", "primary_code", "value_string"]
    assert [tuple(r) for r in sorted(narrow.collect())] == [("1", "9", "v"), ("3", None, None)]
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "AS notes" not in plan and "AS effective_datetime" not in plan


def test_every_column_of_a_narrow_mart_is_that_of_the_whole_one(spark, resource_rows):
    t = _observation_tables(spark, resource_rows)
    whole = facts.build("fact_observations", t)
    rows = {r["observation_id"]: r for r in whole.collect()}
    assert set(facts.INPUTS["fact_observations"]) <= set(whole.columns)
    for c in ("has_value", "observation_category", "codes", "code_count", "note_count", "notes", "effective_datetime"):
        got = facts.build("fact_observations", t, columns=("observation_id", c))
        assert got.schema[c].dataType == whole.schema[c].dataType
        assert {r["observation_id"]: r[c] for r in got.collect()} == {k: r[c] for k, r in rows.items()}
    other = {"fact_patients": "patient_id", "fact_conditions": "condition_id", "fact_medication_requests": "medication_request_id"}
    staged = stage.Tables(spark, SF)
    for mart, key in other.items():
        whole = facts.build(mart, staged, stage.AS_OF).cache()
        assert facts.build(mart, staged, stage.AS_OF, ("etl_updated_at",)).filter("etl_updated_at IS NULL").isEmpty()
        inputs = {k: v for k, v in facts.INPUTS[mart].items() if not k.startswith("etl_")}  # the time of the run
        for c in dict.fromkeys(inputs.values()):
            columns = (key, *(k for k, v in inputs.items() if v == c))
            got = facts.build(mart, staged, stage.AS_OF, columns)
            assert got.exceptAll(whole.select(*columns)).count() == 0 and got.count() == whole.count(), columns
        whole.unpersist()


def test_a_written_mart_serves_fewer_columns(spark):
    wide = stage.fact(spark, SF, "fact_conditions", ("condition_id", "patient_id", "code_code"))
    narrow = stage.fact(spark, SF, "fact_conditions", ("code_code", "patient_id"))
    assert narrow.columns == ["code_code", "patient_id"] and set(narrow.inputFiles()) == set(wide.inputFiles())


def test_medications_of_requests(spark, resource_rows):
    """A request has the catalogue entry of its own medication, or none; requests of one id are one row."""
    request = lambda i, m, **more: {
        "id": i, "status": "active", "subject": {"reference": "Patient/1"}, "medicationReference": {"reference": f"Medication/{m}"}, **more}
    t = tables(spark, **flatten_all(resource_rows(
        "MedicationRequest", request("a", "1"), request("a", "1"), request("b", "2"), request("c", "9"),
        request("d", "1", status="cancelled")), "MedicationRequest"),
        **flatten_all(resource_rows("Medication", {"id": "1", "status": "active", "code": {"text": "one"}}, {"id": "2", "code": {"text": "two"}}), "Medication"))
    df = facts.medication_requests(t)
    rows = dicts(df, "medication_request_id")
    assert [(r["medication_request_id"], r["medication_name"], r["medication_status"], r["medication_id"]) for r in rows] == [
        ("a", "one", "active", "1"), ("b", "two", None, "2"), ("c", None, None, "9")]
    # the wide request rows are dealt out once, by their own id
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") == 0


def test_requests_are_dealt_without_what_follows_from_other_fields(spark, resource_rows, monkeypatch):
    """Texts and names are derived after the rows of a request have met; the lists are sorted and distinct as before."""
    dosage = [{"text": t, "timing": {"repeat": {"frequency": n}}} for t, n in (("b\\c", 2), ("b\\c", 1), ("b\\c", 2), ("a\n", 1), ("a", 1))]
    request = {"id": "1", "status": "active", "subject": {"reference": "Patient/1"}, "medicationReference": {"reference": "Medication/m"},
               "dosageInstruction": dosage}
    t = tables(spark, **flatten_all(resource_rows("MedicationRequest", request), "MedicationRequest"),
               **flatten_all(resource_rows("Medication", {"id": "m", "code": {"text": "Drug"}}), "Medication"))
    dealt, assemble = {}, nest.assemble

    def spied(*args, **options):
        dealt.update({n: df.schema["item"].dataType.fieldNames() for n, df in options["sets"].items()})
        return assemble(*args, **options)

    monkeypatch.setattr(nest, "assemble", spied)
    row = dicts(facts.medication_requests(t, "2024-02-01"))[0]
    assert "text" not in dealt["_dosage"] and "medication_name" not in dealt["_catalogue"]
    assert [(d["text"], d["timing"]["frequency"], d["asNeeded"]) for d in row["dosage_instructions"]] == [
        ("a", 1, None), ("b\\\\c", 1, None), ("b\\\\c", 2, None)]
    assert list(row["dosage_instructions"][0]) == ["text", "timing", "route", "dose", "asNeeded"]
    assert (row["dosage_instruction_count"], row["medication_name"], row["medication_primary_text"]) == (3, "Drug", "Drug")
    assert not {"o_orderkey", "p_partkey"} & set(stage.bridge.rows(spark, SF, "prescriptions").columns)
