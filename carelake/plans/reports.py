"""Cohort and report marts.

Reports restrict a fact mart to the cohort.  Row predicates sit on plain columns
of the fact, so they reach its scan; the cohort (one row per patient) is joined
with the strategy Spark picks from its measured size.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import codes
from carelake.functions import columns as C
from carelake.operators import nest

Frames = dict[str, DataFrame]


def last_encounters(facts: Frames) -> DataFrame:
    return facts["fact_encounters"].groupBy("patient_id").agg(F.max("start_time").alias("last_encounter_date"))


def coded_patients(facts: Frames, condition_codes=(codes.COHORT_CODE,), system: str = codes.ICD10CM) -> DataFrame:
    """Distinct (patient, code, system) of conditions with one of the codes as primary."""
    return (
        facts["fact_conditions"]
        .filter(F.col("code_code").isin(*condition_codes) & (F.col("code_system") == system))
        .select("patient_id", "code_code", "code_system").distinct()
    )


def cohort(facts: Frames, since: str = codes.COHORT_FROM, condition_codes=(codes.COHORT_CODE,)) -> DataFrame:
    """Patients with the diagnosis and an encounter on or after ``since``."""
    return (
        coded_patients(facts, condition_codes)
        .join(last_encounters(facts).filter(F.col("last_encounter_date") >= F.lit(since).cast("timestamp")), "patient_id")
        .select("patient_id", "last_encounter_date", "code_code", "code_system")
    )


def recent(cohort_rows: DataFrame, since: str = codes.REPORT_FROM) -> DataFrame:
    """Cohort rows seen on or after the report date."""
    return cohort_rows.filter(F.col("last_encounter_date") >= F.lit(since).cast("timestamp"))


def _with_person(rows: DataFrame, target: DataFrame, facts: Frames) -> DataFrame:
    """Rows of target patients with their person columns, in one join of the rows."""
    person = facts["fact_patients"].select("patient_id", "names", "birth_date", "gender")
    return rows.join(target.select("patient_id").join(person, "patient_id"), "patient_id")


# --- condition reports ----------------------------------------------------------

CONDITION_COLUMNS = (
    "names", "birth_date", "gender", "patient_id", "condition_id", "encounter_id", "clinical_status_code",
    "clinical_status_display", "verification_status_code", "condition_text", "severity_code", "severity_display",
    "onset_datetime", "abatement_datetime", "recorded_date", "code_system", "code_code", "code_display", "code_rank",
    "body_sites", "categories", "evidence", "notes", "stages", "is_active",
)


def _text_like(column: str, patterns) -> Column:
    upper = F.upper(F.col(column))
    return reduce(or_, [upper.like(p) for p in patterns])


def liver_disease() -> Column:
    code = F.col("code_code")
    return F.col("clinical_status_code").isin("active", "recurrence") & (
        C.starts_with_any(code, codes.LIVER_CODE_PREFIXES)
        | _text_like("condition_text", codes.LIVER_TEXT) | _text_like("code_display", codes.LIVER_DISPLAY)
    )


def additional_malignancy() -> Column:
    code, system = F.col("code_code"), F.col("code_system")
    icd10 = F.lower(system).contains("icd-10")
    return (
        F.col("clinical_status_code").isin("active", "recurrence", "remission", "resolved")
        & (system != codes.SNOMED) & ~code.startswith(codes.COHORT_CODE)
        & ((code.startswith("C") & icd10) | (code.startswith("D0") & icd10)
           | _text_like("condition_text", codes.MALIGNANCY_TEXT))
        & ~_text_like("condition_text", ["%PROSTATE%"])
    )


def cns_metastases() -> Column:
    return (
        F.col("clinical_status_code").isin("active", "recurrence", "remission")
        & (F.col("code_system") != codes.SNOMED)
        & (C.starts_with_any(F.col("code_code"), codes.CNS_CODE_PREFIXES)
           | _text_like("condition_text", codes.CNS_TEXT) | _text_like("code_display", codes.CNS_DISPLAY))
    )


CONDITION_REPORTS = {
    "report_liver_disease": liver_disease,
    "report_additional_malignancy": additional_malignancy,
    "report_cns_metastases": cns_metastases,
}


def condition_report(name: str, facts: Frames, target: DataFrame) -> DataFrame:
    rows = facts["fact_conditions"].filter(CONDITION_REPORTS[name]())
    return _with_person(rows, target, facts).select(*CONDITION_COLUMNS)


def hormone_sensitivity_codes(facts: Frames, target: DataFrame) -> DataFrame:
    """Latest hormone-sensitivity (Z19) condition per patient."""
    rows = facts["fact_conditions"].filter(F.col("code_code").ilike("%Z19%"))
    rows = rows.join(target.select("patient_id", "last_encounter_date"), "patient_id")
    best = nest.best_row(rows, "patient_id", F.col("recorded_date").desc_nulls_first(), F.col("condition_id"))
    return best.select(
        "patient_id", "last_encounter_date", "code_code", "code_system", "condition_id", "clinical_status_code",
        "verification_status_code", "condition_text", "severity_code", "onset_datetime", "onset_period_start",
        "onset_period_end", "onset_text", "abatement_boolean", "recorded_date", "meta_last_updated", "etl_created_at",
        "code_display", "code_text", "code_rank", "notes", "condition_duration_days", "is_active",
        F.lit(1).alias("rn"),
    )


def cardiac_criteria(as_of) -> dict[str, Column]:
    """Exclusion criteria over the condition fact, by flag name."""
    code, active = F.col("code_code"), F.col("is_active")
    today = F.lit(as_of).cast("date") if as_of else F.current_date()

    def since(months: int) -> Column:
        start = F.add_months(today, -months)
        onset, recorded = F.col("onset_datetime"), F.col("recorded_date")
        return (onset >= start) | (onset.isNull() & (recorded >= start))

    severe = C.matches_any(F.col("severity_display"), codes.HEART_FAILURE_SEVERITY)
    return {
        "has_severe_chf": active & (code.isin(*codes.SEVERE_HEART_FAILURE) | (code.isin(*codes.HEART_FAILURE) & severe)),
        "has_unstable_angina": active & code.isin(*codes.UNSTABLE_ANGINA),
        "has_new_angina": code.isin(*codes.NEW_ANGINA) & since(3),
        "has_recent_mi": code.isin(*codes.MYOCARDIAL_INFARCTION) & since(6),
        "has_significant_cardiac": active & code.isin(*codes.SIGNIFICANT_CARDIAC),
        "has_mi_history": active & code.isin(*codes.PAST_INFARCTION),
    }


def exclusion_flags(rows: DataFrame, target: DataFrame, criteria: dict[str, Column]) -> DataFrame:
    """Per target patient: one 0/1 flag per criterion, their number, and event times.

    All criteria are evaluated in one pass and folded with plain maxima, which
    equals stacking one labelled, de-duplicated set per criterion.
    """
    flags = {n: F.coalesce(c, F.lit(False)).cast("int") for n, c in criteria.items()}
    hits = rows.withColumns(flags).filter(reduce(or_, [F.col(n) == 1 for n in criteria]))
    hits = hits.join(target.select("patient_id"), "patient_id", "left_semi")
    summary = hits.groupBy("patient_id").agg(
        F.min(F.coalesce("onset_datetime", "recorded_date")).alias("earliest_cardiac_event"),
        F.max("recorded_date").alias("most_recent_recording"),
        *[F.max(n).alias(n) for n in criteria],
    )
    count = reduce(lambda a, b: a + b, [F.col(n) for n in criteria])
    return summary.withColumn("cardiac_exclusion_count", count.cast("long"))


def cardiac_exclusions(facts: Frames, target: DataFrame, as_of=None) -> DataFrame:
    flags = cardiac_criteria(as_of)
    out = exclusion_flags(facts["fact_conditions"], target, flags)
    return out.select(
        "patient_id", "cardiac_exclusion_count", "earliest_cardiac_event", "most_recent_recording", *flags,
        F.lit("EXCLUDED").alias("cardiac_eligibility_status"),
    )


# --- diagnostic reports around the diagnosis ------------------------------------


def first_diagnosis(facts: Frames, target: DataFrame) -> DataFrame:
    """Earliest active cohort diagnosis per target patient, unknown onsets last."""
    rows = facts["fact_conditions"].filter(
        (F.col("code_code") == codes.COHORT_CODE) & (F.col("code_system") == codes.ICD10CM)
        & (F.col("clinical_status_code") == "active")
    ).join(target.select("patient_id"), "patient_id", "left_semi")
    best = nest.best_row(rows, "patient_id", F.col("onset_datetime").asc_nulls_last(), F.col("condition_id"))
    return best.select("patient_id", F.col("onset_datetime").alias("diagnosis_onset"))


def reports_near(facts: Frames, diagnosis: DataFrame, days_before: int, report_codes, until_onset: bool = False) -> DataFrame:
    """Final reports of the listed codes from some days before the diagnosis on."""
    reports = facts["fact_diagnostic_reports"].filter(
        (F.col("status") == "final") & F.col("code_primary_code").isin(*report_codes)
    )
    onset, when = F.col("diagnosis_onset"), F.col("effective_datetime")
    near = when >= onset - F.make_dt_interval(F.lit(days_before))
    if until_onset:
        near = near & (when < onset)
    return reports.join(diagnosis, "patient_id").filter(near).select(
        "diagnostic_report_id", "patient_id", "status", "effective_datetime", "code_text", "code_primary_code",
        "code_primary_system", "code_primary_display", "encounter_id", "media", "presented_forms",
        onset.alias("c61_onset_datetime"),
    )


def reports_after_diagnosis(facts: Frames, target: DataFrame) -> DataFrame:
    return reports_near(facts, first_diagnosis(facts, target), 120, codes.REPORT_CODES_AFTER)


def reports_before_diagnosis(facts: Frames, target: DataFrame) -> DataFrame:
    """Older variant: every active diagnosis, the 90 days before its onset."""
    rows = facts["fact_conditions"].filter(
        (F.col("code_code") == codes.COHORT_CODE) & (F.col("code_system") == codes.ICD10CM)
        & (F.col("clinical_status_code") == "active")
    ).join(target.select("patient_id"), "patient_id", "left_semi")
    diagnosis = rows.select("patient_id", F.col("onset_datetime").alias("diagnosis_onset"))
    return reports_near(facts, diagnosis, 90, codes.REPORT_CODES_BEFORE, until_onset=True)


# --- medication report ------------------------------------------------------------


def drug_match(names, column: str = "medication_display") -> Column:
    return C.matches_any(F.col(column), [f"%{n}%" for n in names])


def medication_report(facts: Frames, target: DataFrame, names=codes.ADT_DRUGS) -> DataFrame:
    """One row per request of a target patient; a request has one drug, so its list is that name.

    The mart has one row per request: repeats can only come from the target,
    which is counted before the join, and no nested column is a grouping key.
    """
    rows = facts["fact_medication_requests"].filter(drug_match(names))
    seen = target.groupBy("patient_id", "last_encounter_date").agg(F.count("*").alias("_n"))
    keys = [
        "patient_id", "last_encounter_date", "medication_request_id", "medication_id", "medication_display",
        "authored_on", "medication_name", "medication_status", "medication_code", "medication_primary_code",
        "medication_primary_system", "medication_primary_text", "dosage_instructions", "categories", "notes",
    ]
    return rows.join(seen, "patient_id").select(
        *keys, F.col("medication_display").alias("medications_list"), F.col("_n").alias("total_medication_requests")
    )


# --- laboratory reports -------------------------------------------------------------


@dataclass(frozen=True)
class Lab:
    """Which observations a laboratory report keeps."""

    any_text: tuple[str, ...] = ()
    no_text: tuple[str, ...] = ()
    any_code: tuple[str, ...] = ()
    statuses: tuple[str, ...] = codes.RESULT_STATUSES
    not_unit: str | None = None
    both: tuple[str, str] | None = field(default=None)

    def predicate(self) -> Column:
        text = F.col("observation_text")
        hits = [text.ilike(p) for p in self.any_text]
        if self.any_code:
            hits.append(F.col("primary_code").isin(*self.any_code))
        if self.both:
            hits.append(text.ilike(self.both[0]) & ~text.ilike(self.both[1]))
        keep = [
            F.col("observation_category") == "laboratory", F.col("status").isin(*self.statuses), F.col("has_value"),
            reduce(or_, hits), *[~text.ilike(p) for p in self.no_text],
        ]
        if self.not_unit:
            keep.append(F.col("value_quantity_unit") != self.not_unit)
        return reduce(and_, keep)


# Patterns of the laboratory reports (fixed values).
LABS = {
    "report_neutrophils": Lab(("%neutrophil%",), not_unit="%"),
    "report_alt": Lab(("%ALT%", "%alanine%aminotransferase%", "%SGPT%")),
    "report_ast": Lab(("%AST%", "%aspartate%aminotransferase%", "%SGOT%")),
    "report_cd4": Lab(any_code=codes.CD4_CODES),
    "report_creatinine": Lab(("%creatinine%",), no_text=("%clearance%",)),
    "report_egfr": Lab(("%egfr%", "%GFR%", "%creatinine%clearance%")),
    "report_hba1c": Lab(("%HbA1c%", "%hemoglobin A1c%", "%glycohemo%", "%glycosylated%", "%A1C%")),
    "report_hemoglobin": Lab(("%hemoglobin%", "%HGB%", "%HB%")),
    "report_hiv_viral_load": Lab(("%HIV%viral%load%", "%HIV%RNA%")),
    "report_platelets": Lab(("%platelet%count%", "%PLT%")),
    "report_psa_total": Lab(("%PSA%", "%prostate specific a%"), ("%ratio%", "%free%"), codes.PSA_CODES, ("final",)),
    "report_serum_albumin": Lab(("%albumin%",), both=("%ALB%", "%globulin%")),
    "report_serum_potassium": Lab(("%potassium%", "%K+%")),
    "report_testosterone_total": Lab(("%testosterone%", "%testost%"), ("%ratio%", "%free%"), statuses=("final",)),
    "report_total_bilirubin": Lab(("%bilirubin%total%", "%total%bilirubin%")),
}


def lab_report(lab: Lab, facts: Frames, target: DataFrame) -> DataFrame:
    rows = facts["fact_observations"].filter(lab.predicate())
    return _with_person(rows, target, facts).select(
        "names", "birth_date", "gender", "patient_id", "observation_id", "encounter_id", "effective_datetime",
        "observation_text", F.get("codes", F.lit(0))["code"].alias("code"),
        C.first_text(F.col("value_string"), F.col("value_quantity_value")).alias("combined_value"),
        "value_quantity_value", "value_quantity_unit", "value_codeable_concept_code", "value_quantity_system",
        "value_string", "codes", "categories", "reference_ranges", "interpretations", "notes", "components",
        "derived_from",
    )


# --- inferred findings ----------------------------------------------------------------


def _finding_rows(tables: Frames, target: DataFrame, observations: Column, components: Column, code: Column | None) -> DataFrame:
    """Observations × codes × components × notes; the multiplicity is intended."""
    coded = tables["observation_codes"].select("observation_id", "code_code")
    coded = coded.filter(code) if code is not None else coded
    parts = tables["observation_components"].drop("patient_id").filter(components)
    notes = tables["observation_notes"].select("observation_id", "note_text")
    return (
        tables["observations"].filter(observations)
        .join(target.select("patient_id"), "patient_id", "left_semi")
        .join(coded, "observation_id").join(parts, "observation_id").join(notes, "observation_id", "left")
    )


def treatment_start(tables: Frames, target: DataFrame) -> DataFrame:
    """Inferred start of androgen deprivation."""
    rows = _finding_rows(
        tables, target, F.col("value_codeable_concept_code") == codes.ADT_STARTED_VALUE,
        F.col("component_code") == codes.ADT_START_COMPONENT, F.col("code_code") == codes.ADT_CODE,
    )
    return rows.select(
        "patient_id", "observation_id", "observation_text", "effective_datetime", "code_code",
        C.first_text(F.col("value_string"), F.col("value_quantity_value")).alias("combined_value"),
        "component_code", "component_display", "component_text",
        C.date_prefix(F.col("component_value_string")).alias("treatment_start_date"), "note_text",
    )


def inferred_progression(tables: Frames, target: DataFrame, id_prefix: str = codes.AI_ID_PREFIX) -> DataFrame:
    """Inferred PSA progression with its latest measurement."""
    value = F.col("value_codeable_concept_code")
    rows = _finding_rows(
        tables, target, value.isin(*codes.PROGRESSION_VALUES) & F.col("observation_id").startswith(id_prefix),
        F.col("component_code").isin(codes.LATEST_MEASUREMENT, codes.ANALYSIS_NOTE), None,
    )
    label = F.create_map(*[F.lit(x) for kv in codes.PROGRESSION_VALUES.items() for x in kv])
    return rows.select(
        "patient_id", "observation_id", "observation_text", "effective_datetime",
        F.col("code_code").alias("observation_code"), F.try_element_at(label, value).alias("psa_progression"),
        "value_codeable_concept_code", "value_codeable_concept_system", "value_codeable_concept_display",
        C.first_text(F.col("value_string"), F.col("value_quantity_value")).alias("combined_value"),
        "component_code", F.col("component_display").alias("psa_progression_display"), "component_text",
        F.when(F.col("component_code") == codes.LATEST_MEASUREMENT, C.date_prefix(F.col("component_value_string")))
        .alias("most_recent_measurement"),
        "component_value_string", "component_value_quantity_value", "note_text",
    )
