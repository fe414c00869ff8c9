"""Mart registry and refresh by dependency level, whole or of changed keys only.

Marts live in stores (one table each).  A whole refresh writes every row as one
generation; a refresh after changes finds, from the changed resource keys, the keys of
each mart that may read differently (``EDGES``), builds the mart from the rows of
these keys alone and appends them as a generation.  Marts of one level do not read
each other and are submitted at the same time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import load, quality
from carelake.operators.generations import Store
from carelake.plans import facts, reports
from carelake.plans.jobs import at_once
from carelake.session import shared_folder
from carelake.sources import io

Frames = dict[str, DataFrame]

REGISTRY = (
    "mart_name string, dependency_level int, mart_type string, mart_category string, "
    "last_refreshed timestamp, row_count long"
)

# Dependency level of every mart (fixed values); marts of a level are independent.
LEVELS = {
    0: ("fact_practitioners",),
    1: ("fact_patients", "fact_allergy_intolerance", "fact_care_plans", "fact_medication_requests",
        "fact_procedures", "fact_diagnostic_reports", "fact_document_references"),
    2: ("fact_observations", "fact_vital_signs", "fact_conditions", "fact_encounters"),
    3: ("report_cohort",),
    4: ("report_adt_medications", "report_psa_total", "report_testosterone_total", "report_treatment_start"),
    5: ("report_neutrophils", "report_platelets", "report_hemoglobin", "report_creatinine", "report_egfr",
        "report_alt", "report_ast", "report_total_bilirubin", "report_serum_albumin", "report_serum_potassium",
        "report_hba1c", "report_cd4", "report_hiv_viral_load", "report_inferred_progression"),
    6: ("report_additional_malignancy", "report_liver_disease", "report_cardiac_exclusions",
        "report_cns_metastases", "report_hormone_sensitivity"),
    7: ("report_after_diagnosis",),
}


def level_of(mart: str) -> int:
    return next(level for level, names in LEVELS.items() if mart in names)


def builder(mart: str, tables: Frames, as_of=None, cohort_from: str = reports.codes.COHORT_FROM,
            report_from: str = reports.codes.REPORT_FROM) -> Callable[[Frames], DataFrame]:
    """Function from the marts of lower levels to this mart."""
    if mart in facts.FACTS:
        return lambda marts: facts.FACTS[mart](tables, as_of)
    if mart == "report_cohort":
        return lambda marts: reports.cohort(marts, cohort_from)

    def target(marts: Frames) -> DataFrame:
        return reports.recent(marts["report_cohort"], report_from)

    if mart in reports.LABS:
        return lambda marts: reports.lab_report(reports.LABS[mart], marts, target(marts))
    if mart in reports.CONDITION_REPORTS:
        return lambda marts: reports.condition_report(mart, marts, target(marts))
    return {
        "report_adt_medications": lambda marts: reports.medication_report(marts, target(marts)),
        "report_treatment_start": lambda marts: reports.treatment_start(tables, target(marts)),
        "report_inferred_progression": lambda marts: reports.inferred_progression(tables, target(marts)),
        "report_cardiac_exclusions": lambda marts: reports.cardiac_exclusions(marts, target(marts), as_of),
        "report_hormone_sensitivity": lambda marts: reports.hormone_sensitivity_codes(marts, target(marts)),
        "report_after_diagnosis": lambda marts: reports.reports_after_diagnosis(marts, target(marts)),
    }[mart]


# --- refresh into stores, whole or of changed keys ---------------------------------

# Which keys of a mart a changed resource touches: rows of ``table`` whose ``match``
# column holds a changed key name the mart's keys in their ``key`` column.
EDGES: dict[str, tuple[tuple[str, str, str, str], ...]] = {
    "fact_practitioners": (("Practitioner", "practitioners", "practitioner_id", "practitioner_id"),),
    "fact_patients": (
        ("Patient", "patients", "patient_id", "patient_id"), ("Encounter", "encounters", "encounter_id", "patient_id"),
        ("Condition", "conditions", "condition_id", "patient_id")),
    "fact_allergy_intolerance": (("AllergyIntolerance", "allergy_intolerance", "allergy_intolerance_id", "allergy_intolerance_id"),),
    "fact_care_plans": (("CarePlan", "care_plans", "care_plan_id", "care_plan_id"),),
    "fact_medication_requests": (
        ("MedicationRequest", "medication_requests", "medication_request_id", "medication_request_id"),
        ("Medication", "medication_requests", "medication_id", "medication_request_id")),
    "fact_procedures": (("Procedure", "procedures", "procedure_id", "procedure_id"),),
    "fact_diagnostic_reports": (("DiagnosticReport", "diagnostic_reports", "diagnostic_report_id", "diagnostic_report_id"),),
    "fact_document_references": (("DocumentReference", "document_references", "document_reference_id", "document_reference_id"),),
    "fact_observations": (("Observation", "observations", "observation_id", "observation_id"),),
    "fact_vital_signs": (("Observation", "observations", "observation_id", "observation_id"),),
    "fact_conditions": (("Condition", "conditions", "condition_id", "condition_id"),),
    "fact_encounters": (
        ("Encounter", "encounters", "encounter_id", "encounter_id"), ("Condition", "conditions", "condition_id", "encounter_id")),
}
# Reports hold rows of patients: those of any changed row that carries one.
REPORT_EDGES = (
    *EDGES["fact_patients"], ("Observation", "observations", "observation_id", "patient_id"),
    ("DiagnosticReport", "diagnostic_reports", "diagnostic_report_id", "patient_id"),
    ("MedicationRequest", "medication_requests", "medication_request_id", "patient_id"),
    ("Medication", "medication_requests", "medication_id", "patient_id"),
)
# Marts that rank their rows among those of a group: a touched key touches the whole group.
PEERS = {"fact_encounters": ("encounters", "patient_id")}
# Tables without the key of a mart, and the table that leads to them.
VIA = {"condition_codes": ("conditions", "condition_id")}


def edges_of(mart: str) -> tuple[tuple[str, str, str, str], ...]:
    return EDGES.get(mart, REPORT_EDGES)


def key_of(mart: str) -> str:
    return edges_of(mart)[0][3]


class _Touched(dict):
    """Frames by name, reduced to the rows of some keys; made on first use."""

    def __init__(self, frames: Frames, key: str, keys: DataFrame):
        super().__init__()
        self.frames, self.key, self.keys = frames, key, keys

    def __missing__(self, name: str) -> DataFrame:
        df = self.frames[name]
        if self.key in df.columns:
            df = df.join(self.keys, self.key, "left_semi")
        elif name in VIA:
            table, link = VIA[name]
            df = df.join(self[table].select(link).distinct(), link, "left_semi")
        self[name] = df
        return df


def touched_keys(mart: str, changes: Frames, before: Frames, after: Frames) -> DataFrame | None:
    """Keys of a mart that changed resource keys (frames of one column, by resource) may alter; None: none."""
    key, parts = key_of(mart), []
    for resource, table, match, column in edges_of(mart):
        if resource not in changes:
            continue
        changed = changes[resource].toDF(match)
        if match == column:
            parts.append(changed.toDF(key))
        else:
            parts += [df[table].join(changed, match, "left_semi").select(F.col(column).alias(key)) for df in (before, after)]
    if not parts:
        return None
    keys = reduce(DataFrame.unionByName, parts).where(F.col(key).isNotNull()).distinct()
    if mart in PEERS:
        table, group = PEERS[mart]
        groups = reduce(DataFrame.unionByName, [df[table].join(keys, key, "left_semi").select(F.col(group).alias("_group")) for df in (before, after)])
        same = F.col(group).eqNullSafe(F.col("_group"))
        peers = [df[table].join(groups.distinct(), same, "left_semi").select(key) for df in (before, after)]
        keys = reduce(DataFrame.unionByName, [keys, *peers]).where(F.col(key).isNotNull()).distinct()
    return keys


def _append(spark: SparkSession, root: str, mart: str, df: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Write a generation of a mart's store, the first one as a new store; returns the live rows."""
    store = Store(spark, f"{root}/{mart}", {mart: df.schema}, key_of(mart), buckets=16)
    if keys is None:
        store.create()
    gen = store.commits()[-1]["gen"] + 1
    store.write_rows(gen, mart, df)
    if keys is not None:
        store.write_keys(gen, keys)
    store.commit(gen)
    return store.read(mart)


def refresh_stores(spark: SparkSession, tables: Frames, root: str, as_of=None, only: set[str] | None = None, **periods) -> Frames:
    """Build all marts (or ``only`` some) into new stores below ``root``, level by level."""
    marts: Frames = {}

    def one(mart: str) -> None:
        marts[mart] = _append(spark, root, mart, builder(mart, tables, as_of, **periods)(marts), None)

    for names in LEVELS.values():
        at_once(spark, one, [n for n in names if only is None or n in only])
    return marts


def refresh_changes(
    spark: SparkSession, before: Frames, after: Frames, changes: Frames, marts: Frames, root: str, as_of=None, **periods
) -> Frames:
    """Marts after ``changes``; only the touched keys are read and written.

    ``before`` and ``after`` are the flat tables around the changes (two generations
    of a store), ``marts`` the live rows of the stores below ``root``.  Marts that
    depend on time (``as_of``) are those of the given day only for touched keys.
    """
    marts, folder = dict(marts), f"{shared_folder(spark)}/carelake/touched/{uuid.uuid4().hex}"

    def one(mart: str) -> None:
        keys = touched_keys(mart, changes, before, after)
        if keys is None:
            return
        io.full_refresh(keys, f"{folder}/{mart}")
        keys = spark.read.schema(keys.schema).parquet(f"{folder}/{mart}")
        key = key_of(mart)
        rows = builder(mart, _Touched(after, key, keys), as_of, **periods)(_Touched(marts, key, keys))
        marts[mart] = _append(spark, root, mart, rows, keys)

    for names in LEVELS.values():
        at_once(spark, one, [n for n in names if n in marts])
    return marts


def refresh(spark: SparkSession, tables: Frames, root: str, levels=None, as_of=None, **periods) -> Frames:
    """Build and write marts level by level; later levels read the written marts.

    A refresh of some levels only reads the lower ones from ``root``.
    """
    marts: Frames = {}
    for level, names in LEVELS.items():
        for name in names:
            path = f"{root}/{name}"
            if levels is None or level in levels:
                io.full_refresh(builder(name, tables, as_of, **periods)(marts), path)
                marts[name] = spark.read.parquet(path)
            elif levels is not None and level < max(levels):
                marts[name] = spark.read.parquet(path)
    return marts


def registry_rows(spark: SparkSession, marts: Frames, refreshed) -> DataFrame:
    """Registry entries of refreshed marts with their row counts."""
    entries = spark.createDataFrame(
        [(n, level_of(n), "MATERIALIZED", "FACT" if n.startswith("fact_") else "REPORTING") for n in marts],
        "mart_name string, dependency_level int, mart_type string, mart_category string",
    )
    counts = quality.freshness(marts).select(F.col("mart").alias("mart_name"), F.col("rows").alias("row_count"))
    return entries.join(counts, "mart_name").select(
        "mart_name", "dependency_level", "mart_type", "mart_category",
        F.lit(refreshed).cast("timestamp").alias("last_refreshed"), "row_count",
    )


def update_registry(registry: DataFrame, entries: DataFrame) -> DataFrame:
    """Registry with the given marts inserted or replaced."""
    return load.upsert(registry, entries, "mart_name", "last_refreshed")


def registry_summary(registry: DataFrame) -> DataFrame:
    return registry.groupBy("dependency_level", "mart_category", "mart_type").agg(
        F.count("*").alias("marts"), F.sum("row_count").alias("row_count")
    )
