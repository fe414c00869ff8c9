"""Ad-hoc cohort queries and the documented clinical decision analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import codes
from carelake.functions import columns as C
from carelake.operators import series
from carelake.plans import reports
from carelake.plans.reports import LABS, Frames, drug_match, lab_report

# --- documents and medications of a patient group --------------------------------


def seen_group(facts: Frames, since: str | None = None, year: int | None = None) -> DataFrame:
    """(patient, code, system) of the group codes, seen since a date or in a year."""
    last = reports.last_encounters(facts)
    if since is not None:
        last = last.filter(F.col("last_encounter_date") >= F.lit(since).cast("timestamp"))
    if year is not None:
        last = last.filter(C.year_of(F.col("last_encounter_date")) == year)
    return reports.coded_patients(facts, codes.GROUP_CODES).join(last, "patient_id", "left_semi")


def _documents(facts: Frames, from_year: int) -> DataFrame:
    return facts["fact_document_references"].filter(
        (C.year_of(F.col("date")) >= from_year) & F.col("content").isNotNull()
    )


def _linked_content(tables: Frames) -> DataFrame:
    """Attachments that are links rather than references to inline data."""
    return tables["document_reference_content"].drop("meta_last_updated").filter(
        ~F.col("attachment_url").ilike("ref:%")
    )


def group_documents(facts: Frames, tables: Frames, seen_in: int = 2025, from_year: int = 2024) -> DataFrame:
    rows = seen_group(facts, year=seen_in).join(_documents(facts, from_year), "patient_id")
    return rows.join(_linked_content(tables), "document_reference_id").select(
        "patient_id", "date", "type_code", "type_display", "attachment_content_type", "attachment_url"
    )


def group_medications(facts: Frames, recorded_from: str = "2023-01-01") -> DataFrame:
    """Distinct medication ids of the group, as an id list for export."""
    group = facts["fact_conditions"].filter(
        F.col("code_code").isin(*codes.GROUP_CODES) & (F.col("recorded_date") >= F.lit(recorded_from).cast("timestamp"))
    )
    requests = facts["fact_medication_requests"].filter(
        F.col("status").isin("active", "completed", "on-hold", "stopped")
    )
    return (
        requests.join(group.select("patient_id"), "patient_id", "left_semi")
        .select(F.col("medication_id").alias("id"), F.lit("Medication").alias("resource_type")).distinct()
    )


def documents_with_content(facts: Frames, tables: Frames, since: str = codes.COHORT_FROM, from_year: int = 2024) -> DataFrame:
    """Linked documents of the group with the kind of their url, newest first per patient."""
    rows = seen_group(facts, since=since).join(_documents(facts, from_year), "patient_id")
    return rows.join(_linked_content(tables), "document_reference_id").select(
        "patient_id", F.col("code_code").alias("condition_code"), "document_reference_id",
        F.col("date").alias("document_date"), "type_code", "type_display", "content",
        "attachment_content_type", "attachment_url", C.url_kind(F.col("attachment_url")).alias("url_type"),
    ).orderBy("patient_id", F.col("document_date").desc_nulls_first())


def content_breakdown(facts: Frames, tables: Frames, since: str = codes.COHORT_FROM, from_year: int = 2024) -> DataFrame:
    """Documents and patients per attachment type.

    A document belongs to one patient, so one chain of aggregations, over
    (type, document), (type, patient) and then type, gives both counts, and the
    few types do not gather all rows.
    """
    group = seen_group(facts, since=since).select("patient_id").distinct()
    rows = _documents(facts, from_year).join(group, "patient_id").join(_linked_content(tables), "document_reference_id")
    kind = "attachment_content_type"
    documents = rows.groupBy(kind, "document_reference_id").agg(F.max("patient_id").alias("patient_id"))
    patients = documents.groupBy(kind, "patient_id").agg(F.count("*").alias("documents"))
    return patients.groupBy(kind).agg(
        F.sum("documents").alias("document_count"), F.count("*").alias("patient_count")
    ).orderBy(F.col("document_count").desc())


def medication_list(facts: Frames, cohort: DataFrame, authored_from: str = "2023-01-01") -> DataFrame:
    """Drug names and request count per cohort patient."""
    rows = facts["fact_medication_requests"].filter(
        drug_match(codes.ADT_DRUGS) & (F.col("authored_on") >= F.lit(authored_from).cast("timestamp"))
    ).join(cohort.select("patient_id", "last_encounter_date"), "patient_id")
    once = rows.groupBy("patient_id", "last_encounter_date", "medication_display").agg(
        F.count("medication_display").alias("n")
    )
    return once.groupBy("patient_id", "last_encounter_date").agg(
        F.array_join(F.sort_array(F.collect_list("medication_display")), ", ").alias("medications_list"),
        F.sum("n").alias("medication_count"),
    )


def recent_psa(facts: Frames, target: DataFrame, measured_from: str = "2024-01-01") -> DataFrame:
    rows = lab_report(LABS["report_psa_total"], facts, target)
    return rows.filter(F.col("effective_datetime") >= F.lit(measured_from).cast("timestamp")).select(
        "patient_id", "observation_id", "encounter_id", "effective_datetime", "observation_text", "code",
        "value_quantity_value", "value_quantity_unit", "value_codeable_concept_code", "value_quantity_system",
        "value_string", "codes", "categories", "reference_ranges", "interpretations", "notes",
    )


# --- measurements -------------------------------------------------------------------

MEASUREMENT = (
    "patient_id", "observation_id", "effective_datetime", "value_quantity_value", "value_quantity_unit",
    "primary_code", "primary_display",
)


def measurements(facts: Frames, any_code, any_text) -> DataFrame:
    hit = F.col("primary_code").isin(*any_code) | C.matches_any(F.col("primary_display"), any_text)
    return facts["fact_observations"].filter(hit).select(*MEASUREMENT)


def psa_values(facts: Frames) -> DataFrame:
    return measurements(facts, codes.PSA_TREND_CODES, ["%PSA%"])


def psa_concentrations(facts: Frames, units=codes.PSA_UNITS) -> DataFrame:
    """The PSA values that are concentrations: limits in ng/mL hold for no ratio or percentage."""
    ratio = F.coalesce(F.col("primary_display").ilike("%ratio%"), F.lit(False))
    return psa_values(facts).filter(F.col("value_quantity_unit").isin(*units) & ~ratio)


def testosterone_values(facts: Frames) -> DataFrame:
    return measurements(facts, codes.TESTOSTERONE_CODES, ["%testosterone%"])


def castration_status(facts: Frames) -> DataFrame:
    status = series.threshold_status(F.col("value_quantity_value"), F.col("value_quantity_unit"))
    return testosterone_values(facts).withColumn("castration_status", status)


def hormone_status(facts: Frames, cohort: DataFrame, lasts_days: int | None = None) -> DataFrame:
    """Z19.1 / Z19.2 per cohort patient, with the reason.

    No androgen deprivation, or a latest testosterone not at castrate level, or
    no confirmed PSA progression: hormone sensitive.  Castrate and progressing:
    hormone resistant.

    A treated patient's progression counts from the first request on and, with
    ``lasts_days``, until so many days after the last one; requests without any
    date do not limit it.
    """
    treated = facts["fact_medication_requests"].filter(drug_match(codes.ADT_SYNONYMS)).groupBy("patient_id").agg(
        F.min("authored_on").alias("_from"), F.max("authored_on").alias("_to")
    )
    latest = castration_status(facts).groupBy("patient_id").agg(
        F.max_by("castration_status", F.struct("effective_datetime", "observation_id")).alias("latest_status")
    )
    at = F.col("effective_datetime")
    during = F.coalesce(at >= F.col("_from"), F.lit(True))
    if lasts_days is not None:
        during = during & F.coalesce(at <= F.col("_to") + F.make_dt_interval(F.lit(lasts_days)), F.lit(True))
    rises = series.progression(psa_concentrations(facts)).filter("is_confirmed").select("patient_id", "effective_datetime")
    rising = rises.join(treated, "patient_id", "left").filter(during).select("patient_id").distinct()
    rising = rising.withColumn("progressed", F.lit(True))
    df = (
        cohort.select("patient_id").distinct()
        .join(treated.select("patient_id", F.lit(True).alias("on_adt")), "patient_id", "left")
        .join(latest, "patient_id", "left").join(rising, "patient_id", "left")
    )
    on_adt = F.coalesce("on_adt", F.lit(False))
    castrate = F.coalesce(F.col("latest_status") == "Castrate", F.lit(False))
    progressed = F.coalesce("progressed", F.lit(False))

    def decide(naive: str, inadequate: str, stable: str, resistant: str) -> Column:
        return F.when(~on_adt, naive).when(~castrate, inadequate).when(~progressed, stable).otherwise(resistant)

    return df.select(
        "patient_id", on_adt.alias("on_adt"), castrate.alias("is_castrate"), progressed.alias("has_progression"),
        decide("Z19.1", "Z19.1", "Z19.1", "Z19.2").alias("hormone_code"),
        decide("treatment-naive", "inadequate-suppression", "castrate-sensitive", "castration-resistant").alias("reason"),
    )


def medication_search(facts: Frames, recorded_year: int = 2025) -> DataFrame:
    """Requests for any known name of an androgen-deprivation drug, in the group."""
    group = facts["fact_conditions"].filter(
        F.col("code_code").isin(*codes.GROUP_CODES) & (C.year_of(F.col("recorded_date")) == recorded_year)
    ).select("patient_id", F.col("code_code").alias("condition_code")).distinct()
    rows = facts["fact_medication_requests"].filter(drug_match(codes.ADT_SYNONYMS))
    return rows.join(group, "patient_id").select(
        "patient_id", "medication_id", "condition_code", "medication_display", "authored_on", "status"
    )


def imaging_reports(facts: Frames) -> DataFrame:
    return facts["fact_diagnostic_reports"].filter(
        C.matches_any(F.col("code_primary_display"), codes.IMAGING_PATTERNS)
    ).select("patient_id", "diagnostic_report_id", "effective_datetime", "code_primary_display", "code_text")
