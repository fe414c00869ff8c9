"""Fact marts: one row per entity with its children nested back in.

Each builder takes the flat tables by name and returns a frame.  Children arrive
as sorted arrays of structs (``nest.to_json_columns`` turns them into JSON text
at a sink without nested types).  ``as_of`` fixes "today" for ages and recency.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import codes
from carelake.functions import columns as C
from carelake.operators import nest, series
from carelake.operators.nest import part

Tables = dict[str, DataFrame]
Wanted = Collection[str] | None  # what a builder nests (None: all), see INPUTS

CONDITION_SYSTEMS = (codes.ICD10CM, codes.ICD10, codes.SNOMED)
ENCOUNTER_SYSTEMS = (codes.ICD10CM, codes.ICD9CM, codes.SNOMED)
OBSERVATION_SYSTEMS = (codes.LOINC, "%snomed%")


def today(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def _etl(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"created_at": "etl_created_at", "updated_at": "etl_updated_at"})


def _cols(prefix: str, *names: str, **renamed: str) -> dict[str, Column]:
    """Fields named without their table prefix."""
    out = {n: F.col(f"{prefix}_{n}") for n in names}
    return {**out, **{k: F.col(v) for k, v in renamed.items()}}


def _count_distinct(items: Column, field: str) -> Column:
    values = F.filter(F.transform(items, lambda x: x[field]), lambda v: v.isNotNull())
    return F.size(F.array_distinct(values))


# --- patients -----------------------------------------------------------------


def patients(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    filled = lambda c: c.isNotNull() & (c != "")
    names = t["patient_names"].filter(filled(F.col("family_name")) | filled(F.col("name_text")))
    use = F.col("name_use")
    names = part(
        names, "patient_id",
        order=F.when(use == "official", 1).when(use == "usual", 2).otherwise(3),
        no_family=F.col("family_name").isNull(), family_name=F.col("family_name"),
        no_given=F.col("given_names").isNull(), given_names=F.col("given_names"),
        name_text=F.col("name_text"), prefix=F.col("prefix"), suffix=F.col("suffix"), name_use=use,
    )
    place = F.col("address_use")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    written = F.concat(
        blank("address_line"), F.lit(", "), blank("city"), F.lit(", "), blank("district"), F.lit(", "),
        blank("state"), F.lit(" "), blank("postal_code"),
    )
    addresses = part(
        t["patient_addresses"], "patient_id",
        order=F.when(place == "home", 1).when(place == "work", 2).otherwise(3),
        text=F.when(filled(F.col("address_text")), F.col("address_text")).otherwise(written),
    )
    year_ago = F.add_months(today(as_of), -12)
    # Ids are keys of their tables, so plain counts, combined before the shuffle, are distinct counts.
    visits = t["encounters"].groupBy("patient_id").agg(
        F.count("encounter_id").alias("total"),
        F.count_if(F.col("class_code") == "emergency").alias("emergency"),
        F.count_if(F.col("class_code") == "inpatient").alias("inpatient"),
        F.count_if(F.col("start_time") >= year_ago).alias("recent"),
        F.max("start_time").alias("last_seen"),
    )
    conditions = t["conditions"].groupBy("patient_id").agg(
        F.count("condition_id").alias("total"), F.count_if(F.col("clinical_status_code") == "active").alias("active")
    )
    df = nest.assemble(
        t["patients"], "patient_id",
        lists={"_names": names, "_addresses": addresses},
        singles={
            "_visits": part(visits, "patient_id", **{c: F.col(c) for c in ("total", "emergency", "inpatient", "recent", "last_seen")}),
            "_conditions": part(conditions, "patient_id", total=F.col("total"), active=F.col("active")),
        },
        wanted=wanted,
    )
    best = F.get("_names", F.lit(0))
    name_fields = ("name_text", "family_name", "given_names", "prefix", "suffix", "name_use")
    primary = {"use": "name_use", "text": "name_text", "family": "family_name", "given": "given_names",
               "prefix": "prefix", "suffix": "suffix"}
    seen, born = F.col("_visits.last_seen"), F.col("birth_date")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    df = _etl(df).select(
        "patient_id", "active", "gender", "birth_date", "deceased", "deceased_date", "managing_organization_id",
        "meta_last_updated", "meta_source", "meta_security", "meta_tag", "etl_created_at", "etl_updated_at",
        *[best[f].alias(f) for f in name_fields],
        F.struct(F.struct(*[
            F.coalesce(C.plain_name(best[source]), F.lit("")).alias(target) for target, source in primary.items()
        ]).alias("primary_name")).alias("names"),
        nest.joined_text(F.col("_addresses"), lambda x: x["text"], " | ").alias("all_addresses"),
        zero(F.col("_visits.total")).alias("total_encounter_count"),
        seen.alias("last_encounter_date"),
        zero(F.col("_visits.recent")).alias("encounters_last_year"),
        zero(F.col("_visits.emergency")).alias("emergency_encounter_count"),
        zero(F.col("_visits.inpatient")).alias("inpatient_encounter_count"),
        zero(F.col("_conditions.total")).alias("total_condition_count"),
        zero(F.col("_conditions.active")).alias("active_condition_count"),
        F.when(F.col("deceased") & F.col("deceased_date").isNotNull(), C.years_between(born, F.col("deceased_date")))
        .otherwise(C.years_between(born, today(as_of))).alias("current_age"),
        C.years_between(born, seen).alias("age_at_last_encounter"),
        C.days_between(seen, today(as_of)).alias("days_since_last_encounter"),
        C.activity_status(F.col("deceased"), seen, today(as_of)).alias("activity_status"),
    )
    return df


# --- practitioners ------------------------------------------------------------


def practitioners(t: Tables, as_of=None) -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    names = t["practitioner_names"].filter(filled("family") | filled("given") | filled("text"))
    names = part(
        names, "practitioner_id",
        order=F.when(filled("family") & filled("given"), 1).when(filled("family"), 2).when(filled("given"), 3).otherwise(4),
        no_family=F.col("family").isNull(), family=F.col("family"),
        no_given=F.col("given").isNull(), given=F.col("given"), text=F.col("text"),
    )
    clean = lambda c: F.coalesce(C.strip_control(F.col(c)), F.lit(""))
    addresses = part(
        t["practitioner_addresses"].filter(F.col("line").isNotNull()), "practitioner_id",
        city=clean("city"), state=clean("state"), line=clean("line"), postal_code=clean("postal_code"),
        raw_line=F.col("line"), raw_city=F.col("city"), raw_state=F.col("state"),
    )
    telecoms = part(
        t["practitioner_telecoms"].filter(F.col("value").isNotNull()), "practitioner_id",
        system=clean("system"), value=clean("value"), raw_system=F.col("system"), raw_value=F.col("value"),
    )
    df = nest.assemble(
        t["practitioners"], "practitioner_id", lists={"_names": names},
        sets={"_addresses": addresses, "_telecoms": telecoms},
    )
    best, addr, tel = F.get("_names", F.lit(0)), F.col("_addresses"), F.col("_telecoms")

    def highest(items: Column, field: str) -> Column:
        return F.array_max(F.transform(items, lambda x: x[field]))

    def contact(system: str) -> Column:
        return highest(F.filter(tel, lambda x: x["raw_system"] == system), "raw_value")

    name = F.struct(*[
        F.coalesce(C.strip_control(C.strip_escapes(best[f])), F.lit("")).alias(f) for f in ("text", "family", "given")
    ])
    return _etl(df).select(
        "practitioner_id", "resource_type", "active", "meta_last_updated", "etl_created_at", "etl_updated_at",
        F.struct(F.when(best.isNotNull(), name).alias("primary_name")).alias("names"),
        nest.null_if_empty(F.array_distinct(nest.without(addr, "raw_line", "raw_city", "raw_state"))).alias("addresses"),
        nest.null_if_empty(F.array_distinct(nest.without(tel, "raw_system", "raw_value"))).alias("telecoms"),
        F.when(F.size(tel) > 0, _count_distinct(tel, "raw_value")).cast("long").alias("telecom_count"),
        contact("phone").alias("primary_phone"),
        contact("email").alias("primary_email"),
        ((F.size(tel) > 0) & (F.size(addr) > 0)).alias("has_complete_contact"),
        highest(addr, "raw_city").alias("primary_city"),
        highest(addr, "raw_state").alias("primary_state"),
    )


# --- encounters ---------------------------------------------------------------


def encounter_diagnoses(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Per encounter: number of conditions, and its distinct codes with first onset.

    Codes are reduced to distinct ones in an aggregation spread over
    (encounter, code) before they meet at the encounter.
    """
    conditions = t["conditions"].filter(F.col("encounter_id").isNotNull()).select(
        "condition_id", "encounter_id", "onset_datetime"
    )
    coded = conditions.join(t["condition_codes"].drop("meta_last_updated"), "condition_id", "left")
    counts = conditions.groupBy("encounter_id").agg(F.count("condition_id").alias("total"))  # an id is a key of the table
    distinct = coded.groupBy(
        "encounter_id", "code_system", "code_code", F.coalesce("code_display", "code_text").alias("display")
    ).agg(F.min("onset_datetime").alias("onset"))
    return counts, distinct


def _diagnosis_text(x: Column) -> Column:
    system = x["system"]
    label = (
        F.when(system == codes.ICD10CM, "ICD10:").when(system == codes.ICD9CM, "ICD9:")
        .when(system == codes.SNOMED, "SNOMED:").otherwise(F.concat(F.coalesce(system, F.lit("UNK")), F.lit(":")))
    )
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(label, blank(x["code"]), F.lit(":"), blank(x["display"]))


def encounters(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    counts, diagnoses = encounter_diagnoses(t)
    coded = lambda p: _cols(p, "code", "system", "display", "text")
    who = part(t["encounter_participants"], "encounter_id", **_cols("participant", "type", "id", "display"))
    where = part(t["encounter_locations"], "encounter_id", id=F.col("location_id"))
    discharge = part(
        t["encounter_hospitalization"], "encounter_id",
        text=F.col("discharge_disposition_text"), code=F.col("discharge_code"), system=F.col("discharge_system"),
    )
    kept = t["encounters"].filter(F.col("status") != "cancelled")
    rank = "patient_encounter_rank"
    ranked = wanted is None or rank in wanted
    main = series.recency_rank(kept, "patient_id", "start_time", rank) if ranked else kept.withColumn(rank, F.lit(None).cast("int"))
    df = nest.assemble(
        main, "encounter_id",
        lists={
            "_who": who, "_where": where,
            "reasons": part(t["encounter_reasons"], "encounter_id", **coded("reason")),
            "types": part(t["encounter_types"], "encounter_id", **coded("type")),
            "_codes": part(
                diagnoses, "encounter_id", no_code=F.col("code_code").isNull(),
                order=C.system_priority(F.col("code_system"), ENCOUNTER_SYSTEMS), code=F.col("code_code"),
                display=F.col("display"), system=F.col("code_system"), onset=F.col("onset"),
            ),
            "_discharge": discharge,
        },
        singles={
            "_count": part(counts, "encounter_id", total=F.col("total")),
        },
        wanted=wanted,
    )
    primary = F.get("_codes", F.lit(0))
    texts = F.sort_array(F.transform("_codes", lambda x: F.struct(
        x["onset"].isNull().alias("no_onset"), x["onset"].alias("onset"), _diagnosis_text(x).alias("text")
    )))
    texts = F.array_distinct(F.transform(texts, lambda x: x["text"]))
    last_discharge = F.element_at(nest.null_if_empty(F.col("_discharge")), -1)
    who_text = lambda x: F.concat(
        x["type"], F.lit(":"), x["id"],
        F.when(x["display"].isNotNull(), F.concat(F.lit(" ("), x["display"], F.lit(")"))).otherwise(F.lit("")),
    )
    lead = F.filter(F.col("_who"), lambda x: x["type"] == "primary_performer")
    some = lambda items, n: F.when(F.size(items) > 0, n).cast("long")
    start, end = F.col("start_time"), F.col("end_time")
    return _etl(df).select(
        "encounter_id", "patient_id", "status", "resourcetype", "class_code", "class_display", "start_time", "end_time",
        "service_provider_id", "appointment_id", "parent_encounter_id", "meta_last_updated",
        "etl_created_at", "etl_updated_at",
        F.lit(None).cast("string").alias("all_identifiers"),
        F.lit(0).cast("long").alias("identifier_count"),
        last_discharge["text"].alias("discharge_disposition_text"),
        last_discharge["code"].alias("discharge_code"),
        last_discharge["system"].alias("discharge_system"),
        nest.joined_text(F.col("_where"), lambda x: x["id"], " -> ").alias("location_sequence"),
        some(F.col("_where"), _count_distinct(F.col("_where"), "id")).alias("location_count"),
        nest.joined_text(F.col("_who"), who_text, " | ").alias("all_participants"),
        some(F.col("_who"), _count_distinct(F.col("_who"), "id")).alias("participant_count"),
        some(F.col("_who"), _count_distinct(lead, "id")).alias("primary_performer_count"),
        nest.null_if_empty(F.col("reasons")).alias("reasons"),
        nest.null_if_empty(F.col("types")).alias("types"),
        F.when(F.size("_codes") > 0, F.array_join(texts, " | ")).alias("all_diagnoses"),
        F.col("_count.total").alias("diagnosis_count"),
        *[primary[f].alias(n) for f, n in (
            ("code", "primary_diagnosis_code"), ("display", "primary_diagnosis_display"),
            ("system", "primary_diagnosis_code_system"))],
        C.minutes_between(start, end).alias("duration_minutes"),
        F.col("status").isin("finished", "cancelled", "entered-in-error").alias("is_complete"),
        C.days_between(F.coalesce(end, start), today(as_of)).alias("days_since_encounter"),
        "patient_encounter_rank",
    )


# --- conditions ---------------------------------------------------------------


def conditions(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    clean = lambda c: F.coalesce(C.strip_control(F.col(c)), F.lit(""))

    def cleaned(prefix: str, *names: str) -> dict[str, Column]:
        return {n: clean(f"{prefix}_{n}") for n in names}

    present = lambda table, c: t[table].filter(F.col(c).isNotNull())
    coded = part(
        present("condition_codes", "code_code"), "condition_id",
        order=C.system_priority(F.col("code_system"), CONDITION_SYSTEMS), **_cols("code", "code", "system", "display", "text"),
    )
    notes = part(
        present("condition_notes", "note_text"), "condition_id",
        no_time=F.col("note_time").isNull(), time=F.col("note_time"),
        text=C.escape_backslashes(F.col("note_text")), author_reference=clean("note_author_reference"),
    )
    stage_fields = [f"{k}_{p}" for k in ("summary", "assessment", "type") for p in ("system", "code", "display")]
    stages = part(t["condition_stages"], "condition_id", **{f: F.col(f"stage_{f}") for f in stage_fields})
    df = nest.assemble(
        t["conditions"], "condition_id",
        lists={"codes": coded, "notes": notes, "_stages": stages},
        sets={
            "body_sites": part(present("condition_body_sites", "body_site_code"), "condition_id",
                               **cleaned("body_site", "system", "code", "display", "text")),
            "categories": part(present("condition_categories", "category_code"), "condition_id",
                               **cleaned("category", "system", "code", "display", "text")),
            "evidence": part(present("condition_evidence", "evidence_code"), "condition_id",
                             **cleaned("evidence", "system", "code", "display", "detail_reference")),
        },
        wanted=wanted,
    )
    best = F.get("codes", F.lit(0))
    stage = F.element_at(nest.null_if_empty(F.col("_stages")), -1)
    stage_struct = F.struct(*[
        F.struct(*[F.coalesce(C.strip_control(stage[f"{k}_{p}"]), F.lit("")).alias(p) for p in ("system", "code", "display")]).alias(k)
        for k in ("summary", "assessment", "type")
    ])
    children = ("codes", "notes", "_stages", "body_sites", "categories", "evidence")
    own = [c for c in _etl(df).columns if c not in children]
    end = F.col("abatement_datetime")
    return _etl(df).select(
        *own,
        *[best[f"{f}"].alias(f"code_{f}") for f in ("system", "code", "display", "text")],
        F.lit(1).alias("code_rank"),
        nest.null_if_empty(nest.ranked(F.col("codes"), "order")).alias("codes"),
        *[nest.null_if_empty(F.col(c)).alias(c) for c in ("body_sites", "categories", "evidence")],
        nest.null_if_empty(nest.without(F.col("notes"), "no_time")).alias("notes"),
        F.when(F.size("_stages") > 0, stage_struct).alias("stages"),
        F.coalesce(
            C.days_between(F.col("onset_datetime"), end),
            C.days_between(F.col("onset_period_start"), F.col("abatement_period_start")),
        ).alias("condition_duration_days"),
        F.coalesce((F.col("clinical_status_code") == "active") & (end.isNull() | (end > today(as_of))), F.lit(False))
        .alias("is_active"),
    )


# --- observations ---------------------------------------------------------------


def vital_ids(categories: DataFrame) -> DataFrame:
    """Ids of the observations that have a vital-signs category."""
    vital = (F.col("category_code") == "vital-signs") | F.col("category_display").ilike("%vital%")
    return categories.filter(vital).select("observation_id").distinct()


def split_observations(t: Tables, vital: bool, wanted: Wanted = None) -> DataFrame:
    """Observations that are vital signs, or that are not, with their children nested.

    The rows are split before they are nested, on the partitioning that nesting needs.
    """
    key = "observation_id"
    text = lambda prefix: _cols(prefix, "system", "code", "display", "text")
    coding = lambda p: F.array(F.struct(*[F.col(f"{p}_{f}").alias(f) for f in ("system", "code", "display")]))
    p = "component"
    number, answer, words = F.col(f"{p}_value_quantity_value"), F.col(f"{p}_value_codeable_concept_code"), F.col(f"{p}_value_string")
    components = part(
        t["observation_components"], key,
        code=F.struct(coding(p).alias("coding"), F.col(f"{p}_text").alias("text")),
        valueQuantity=F.when(number.isNotNull(), F.struct(number.alias("value"), F.col(f"{p}_value_quantity_unit").alias("unit"))),
        valueCodeableConcept=F.when(
            number.isNull() & answer.isNotNull(), F.struct(coding(f"{p}_value_codeable_concept").alias("coding"))),
        valueString=F.when(number.isNull() & answer.isNull() & (words != ""), words),
        dataAbsentReason=F.when(
            F.col(f"{p}_data_absent_reason_code").isNotNull(),
            F.struct(F.array(F.struct(*[F.col(f"{p}_data_absent_reason_{f}").alias(f) for f in ("code", "display")])).alias("coding"))),
    )
    df = nest.assemble(
        t["observations"], key,
        lists={
            "codes": part(t["observation_codes"].filter(F.col("code_code").isNotNull()), key,
                          order=C.system_priority(F.col("code_system"), OBSERVATION_SYSTEMS),
                          **_cols("code", "code", "system", "display", "text")),
            "components": components,
            "categories": part(t["observation_categories"], key, **text("category")),
            "reference_ranges": part(
                t["observation_reference_ranges"], key,
                low=F.col("range_low_value"), high=F.col("range_high_value"), lowUnit=F.col("range_low_unit"),
                highUnit=F.col("range_high_unit"), type=F.col("range_type_code"), typeSystem=F.col("range_type_system"),
                typeDisplay=F.col("range_type_display"), text=F.col("range_text")),
            "interpretations": part(t["observation_interpretations"], key, **_cols("interpretation", "code", "system", "display")),
            "notes": part(t["observation_notes"].filter(F.col("note_text") != ""), key,
                          text=F.col("note_text"), time=F.col("note_time"), authorReference=F.col("note_author_reference")),
            "performers": part(t["observation_performers"], key, performerId=F.col("performer_id"), performerType=F.col("performer_type")),
        },
        keys=vital_ids(t["observation_categories"]), inside=vital, wanted=wanted,
    ).filter(F.col("status") != "entered-in-error")
    best = F.get("codes", F.lit(0))
    category = F.get(F.sort_array(F.transform(
        F.filter("categories", lambda x: x["code"].isNotNull()),
        lambda x: F.struct(C.system_priority(x["system"], (codes.OBSERVATION_CATEGORY,)).alias("order"), x["code"].alias("code")),
    )), F.lit(0))["code"]
    counted = {"codes": "code", "components": "component", "categories": "category",
               "interpretations": "interpretation", "notes": "note", "performers": "performer"}
    own = [c for c in t["observations"].columns if c not in (
        "meta_source", "meta_profile", "meta_security", "meta_tag", "extensions", "created_at", "updated_at")]
    values = [F.col(c).isNotNull() for c in ("value_string", "value_quantity_value", "value_datetime", "value_boolean")]
    return _etl(df).select(
        *own, "etl_created_at", "etl_updated_at",
        *[best[f].alias(f"primary_{f}") for f in ("system", "code", "display")],
        (values[0] | values[1] | values[2] | values[3]).alias("has_value"),
        category.alias("observation_category"),
        nest.null_if_empty(nest.ranked(F.col("codes"), "order")).alias("codes"),
        *[nest.null_if_empty(F.col(c)).alias(c)
          for c in ("components", "categories", "reference_ranges", "interpretations", "notes", "performers")],
        *[F.size(c).cast("long").alias(f"{n}_count") for c, n in counted.items()],
    )


def observations(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    return split_observations(t, vital=False, wanted=wanted)


def vital_signs(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    return split_observations(t, vital=True, wanted=wanted)


# --- reports, documents, medication requests --------------------------------------


def _cleaned(prefix: str, *names: str) -> dict[str, Column]:
    return {n: F.coalesce(C.strip_control(F.col(f"{prefix}_{n}")), F.lit("")) for n in names}


def diagnostic_reports(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    key = "diagnostic_report_id"
    clean = lambda c: F.coalesce(C.strip_control(F.col(c)), F.lit(""))
    single = lambda table, c: part(t[table], key, id=F.col(c))
    forms = part(
        t["diagnostic_report_presented_forms"], key,
        title=clean("title"), content_type=clean("content_type"), data=clean("data"),
    )
    df = nest.assemble(
        t["diagnostic_reports"], key,
        lists={"presented_forms": forms},
        sets={
            "_results": single("diagnostic_report_results", "observation_id"),
            "_media": single("diagnostic_report_media", "media_id"),
            "_based_on": single("diagnostic_report_based_on", "service_request_id"),
            "performers": part(t["diagnostic_report_performers"], key, **_cleaned("performer", "id", "type")),
            "categories": part(t["diagnostic_report_categories"], key, **_cleaned("category", "code", "system", "display")),
        },
        wanted=wanted,
    )
    ids = lambda c: nest.null_if_empty(F.transform(c, lambda x: x["id"]))
    own = [c for c in _etl(t["diagnostic_reports"]).columns]
    return _etl(df).select(
        *own,
        ids("_results").alias("results"),
        F.size("_results").cast("long").alias("result_count"),
        nest.null_if_empty(F.col("performers")).alias("performers"),
        nest.null_if_empty(F.col("categories")).alias("categories"),
        ids("_media").alias("media"),
        nest.null_if_empty(F.col("presented_forms")).alias("presented_forms"),
        ids("_based_on").alias("based_on"),
        C.days_between(F.col("issued_datetime"), today(as_of)).alias("report_age_days"),
        F.coalesce(F.col("status").isin("final", "amended", "corrected", "appended"), F.lit(False)).alias("is_final"),
        (F.size("_results") > 0).alias("has_results"),
    )


def document_references(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    key = "document_reference_id"
    df = nest.assemble(
        t["document_references"].filter(~F.col("status").isin("entered-in-error", "superseded")), key,
        sets={
            "content": part(t["document_reference_content"], key,
                            contentType=F.col("attachment_content_type"), url=F.col("attachment_url")),
            "authors": part(t["document_reference_authors"], key, authorId=F.col("author_id")),
            "categories": part(t["document_reference_categories"], key, **_cols("category", "system", "code", "display")),
            "identifiers": part(t["document_reference_identifiers"], key, **_cols("identifier", "system", "value")),
        },
        wanted=wanted,
    )
    children = ("content", "authors", "categories", "identifiers")
    own = [c for c in _etl(t["document_references"]).columns if c != "meta_type"]
    return _etl(df).select(
        *own,
        *[nest.null_if_empty(F.col(c)).alias(c) for c in children],
        C.days_between(F.col("date"), today(as_of)).alias("document_age_days"),
        _count_distinct(F.col("categories"), "code").cast("long").alias("category_count"),
        (_count_distinct(F.col("content"), "contentType") > 0).alias("has_content"),
        _count_distinct(F.col("identifiers"), "value").cast("long").alias("identifier_count"),
    )


def medication_requests(t: Tables, as_of=None, wanted: Wanted = None) -> DataFrame:
    key = "medication_request_id"
    p, nested = "dosage", {
        "timing": {"frequency": "timing_frequency", "period": "timing_period", "periodUnit": "timing_period_unit"},
        "route": {f: f"route_{f}" for f in ("system", "code", "display")},
        "dose": {f: f"dose_{f}" for f in ("value", "unit", "system", "code")},
    }
    dosage = part(
        t["medication_request_dosage_instructions"], key,
        **{c: F.col(f"{p}_{c}") for cs in nested.values() for c in cs.values()},
        asNeeded=F.col("dosage_as_needed_boolean"),
        raw_text=F.col("dosage_text"),
    )
    # what follows from other fields of a row is added when the rows have met
    catalogue = t["medications"].select(F.col("medication_id").alias("_medication"), F.struct(
        F.col("medication_id"), F.col("status").alias("medication_status"), F.col("code").alias("medication_code"),
        F.col("primary_code").alias("medication_primary_code"), F.col("primary_system").alias("medication_primary_system"),
        F.col("primary_text").alias("medication_primary_text"),
    ).alias("item"))
    requests = t["medication_requests"].filter(~F.col("status").isin("entered-in-error", "cancelled"))
    # Only the two ids meet the catalogue; what they find is nested, so the request rows are dealt out once.
    found = requests.select(key, "medication_id").join(catalogue, F.col("medication_id") == F.col("_medication")).select(key, "item")
    df = nest.assemble(
        requests, key,
        lists={"notes": part(t["medication_request_notes"], key, text=C.escape_backslashes(F.col("note_text")))},
        sets={
            "_dosage": dosage,
            "categories": part(t["medication_request_categories"], key, **_cleaned("category", "system", "code", "display", "text")),
            "_catalogue": found,
        },
        wanted=wanted,
    )
    entry = F.get(F.filter("_catalogue", lambda x: x["medication_id"] == F.col("medication_id")), F.lit(0))
    named = [f"medication_{c}" for c in ("status", "code", "primary_code", "primary_system", "primary_text")]
    written = F.transform("_dosage", lambda x: F.struct(
        C.escape_backslashes(x["raw_text"]).alias("text"),
        *[F.struct(*[x[c].alias(f) for f, c in cs.items()]).alias(n) for n, cs in nested.items()], x["asNeeded"].alias("asNeeded")))
    own = [c for c in _etl(t["medication_requests"]).columns]
    return _etl(df).select(
        *own, entry["medication_primary_text"].alias("medication_name"), *[entry[c].alias(c) for c in named],
        nest.null_if_empty(F.sort_array(F.array_distinct(written))).alias("dosage_instructions"),
        nest.null_if_empty(F.col("categories")).alias("categories"),
        nest.null_if_empty(F.col("notes")).alias("notes"),
        C.days_between(F.col("authored_on"), today(as_of)).alias("request_age_days"),
        _count_distinct(F.col("_dosage"), "raw_text").cast("long").alias("dosage_instruction_count"),
        _count_distinct(F.col("categories"), "code").cast("long").alias("category_count"),
        F.size("notes").cast("long").alias("note_count"),
        F.col("status").isin("active", "on-hold", "unknown").alias("is_active_request"),
    )


# --- care plans, procedures, allergies ---------------------------------------------


def care_plans(t: Tables, as_of=None) -> DataFrame:
    key = "care_plan_id"
    children = {
        "categories": part(t["care_plan_categories"], key, **_cleaned("category", "code", "system", "display", "text")),
        "goals": part(t["care_plan_goals"], key, goal_id=F.col("goal_id")),
        "care_teams": part(t["care_plan_care_teams"], key, care_team_id=F.col("care_team_id")),
        "identifiers": part(t["care_plan_identifiers"], key, **_cleaned("identifier", "system", "value")),
    }
    df = nest.assemble(t["care_plans"].filter(F.col("status") != "entered-in-error"), key, lists=children)
    return _etl(df).select(
        *_etl(t["care_plans"]).columns, *children, *[F.size(c).cast("long").alias(f"{c}_count") for c in children]
    )


def procedures(t: Tables, as_of=None) -> DataFrame:
    key = "procedure_id"
    df = nest.assemble(
        t["procedures"].filter(~F.col("status").isin("not-done", "cancelled")), key,
        sets={
            "code_codings": part(t["procedure_code_codings"], key, **_cols("code", "system", "code", "display")),
            "identifiers": part(t["procedure_identifiers"], key, **_cols("identifier", "system", "value")),
        },
    )
    first = F.array_min(F.transform(
        "code_codings", lambda x: F.struct(x["code"].alias("code"), x["system"].alias("system"), x["display"].alias("display"))
    ))
    count = _count_distinct(F.col("code_codings"), "code").cast("long")
    return _etl(df).select(
        *_etl(t["procedures"]).columns,
        nest.null_if_empty(F.col("code_codings")).alias("code_codings"),
        nest.null_if_empty(F.col("identifiers")).alias("identifiers"),
        C.days_between(F.col("performed_date_time"), today(as_of)).alias("procedure_age_days"),
        F.coalesce(F.col("status") == "completed", F.lit(False)).alias("is_completed"),
        F.col("status").isin("not-done", "cancelled", "stopped", "aborted").alias("was_not_performed"),
        count.alias("code_coding_count"),
        _count_distinct(F.col("identifiers"), "value").cast("long").alias("identifier_count"),
        (count > 1).alias("has_multiple_codes"),
        first["code"].alias("primary_code"),
        first["system"].alias("primary_code_system"),
        first["display"].alias("primary_code_display"),
    )


def allergy_intolerance(t: Tables, as_of=None) -> DataFrame:
    flag = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    df = _etl(t["allergy_intolerance"])
    return df.select(
        "*",
        flag("clinical_status_code", "active").alias("is_active"),
        flag("verification_status_code", "confirmed").alias("is_confirmed"),
        flag("criticality", "high").alias("is_high_criticality"),
        F.coalesce("code_text", "code_display", F.lit("Unknown Allergy")).alias("combined_description"),
    )


FACTS = {
    "fact_practitioners": practitioners,
    "fact_patients": patients,
    "fact_allergy_intolerance": allergy_intolerance,
    "fact_care_plans": care_plans,
    "fact_medication_requests": medication_requests,
    "fact_procedures": procedures,
    "fact_diagnostic_reports": diagnostic_reports,
    "fact_document_references": document_references,
    "fact_observations": observations,
    "fact_vital_signs": vital_signs,
    "fact_conditions": conditions,
    "fact_encounters": encounters,
}

# What the columns of a mart come from, if not from the main column or child of their name.
_NAMED = ("name_text", "family_name", "given_names", "prefix", "suffix", "name_use", "names")
_VISITED = ("total_encounter_count", "last_encounter_date", "encounters_last_year", "emergency_encounter_count",
            "inpatient_encounter_count", "days_since_last_encounter")
_ETL = {"etl_created_at": ("created_at",), "etl_updated_at": ("updated_at",)}
_OBSERVED = {
    **_ETL, **{f"primary_{f}": ("codes",) for f in ("system", "code", "display")}, "observation_category": ("categories",),
    "has_value": ("value_string", "value_quantity_value", "value_datetime", "value_boolean"),
    "code_count": ("codes",), "component_count": ("components",), "category_count": ("categories",),
    "interpretation_count": ("interpretations",), "note_count": ("notes",), "performer_count": ("performers",),
}
INPUTS: dict[str, dict[str, tuple[str, ...]]] = {
    "fact_patients": {
        **_ETL, **dict.fromkeys(_NAMED, ("_names",)), **dict.fromkeys(_VISITED, ("_visits",)), "all_addresses": ("_addresses",),
        "total_condition_count": ("_conditions",), "active_condition_count": ("_conditions",),
        "current_age": ("deceased", "deceased_date", "birth_date"), "age_at_last_encounter": ("birth_date", "_visits"),
        "activity_status": ("deceased", "_visits"),
    },
    "fact_encounters": {
        **_ETL, **dict.fromkeys(("discharge_disposition_text", "discharge_code", "discharge_system"), ("_discharge",)),
        **dict.fromkeys(("location_sequence", "location_count"), ("_where",)),
        **dict.fromkeys(("all_participants", "participant_count", "primary_performer_count"), ("_who",)),
        **dict.fromkeys(("all_diagnoses", "primary_diagnosis_code", "primary_diagnosis_display", "primary_diagnosis_code_system"), ("_codes",)),
        "diagnosis_count": ("_count",), "duration_minutes": ("start_time", "end_time"), "is_complete": ("status",),
        "days_since_encounter": ("start_time", "end_time"),
    },
    "fact_conditions": {
        **_ETL, **{f"code_{f}": ("codes",) for f in ("system", "code", "display", "text")}, "stages": ("_stages",),
        "condition_duration_days": ("onset_datetime", "abatement_datetime", "onset_period_start", "abatement_period_start"),
        "is_active": ("clinical_status_code", "abatement_datetime"),
    },
    "fact_observations": _OBSERVED,
    "fact_vital_signs": _OBSERVED,
    "fact_diagnostic_reports": {
        **_ETL, **dict.fromkeys(("results", "result_count", "has_results"), ("_results",)), "media": ("_media",),
        "based_on": ("_based_on",), "report_age_days": ("issued_datetime",), "is_final": ("status",),
    },
    "fact_document_references": {
        **_ETL, "document_age_days": ("date",), "category_count": ("categories",), "has_content": ("content",),
        "identifier_count": ("identifiers",),
    },
    "fact_medication_requests": {
        **_ETL, **{f"medication_{c}": ("_catalogue", "medication_id") for c in ("name", "status", "code", "primary_code", "primary_system", "primary_text")},
        "dosage_instructions": ("_dosage",), "request_age_days": ("authored_on",), "dosage_instruction_count": ("_dosage",),
        "category_count": ("categories",), "note_count": ("notes",), "is_active_request": ("status",),
    },
}
# Read by a builder after nesting, whatever the columns.
FILTERED = {"fact_observations": ("status",), "fact_vital_signs": ("status",)}


def build(name: str, t: Tables, as_of=None, columns: Collection[str] | None = None) -> DataFrame:
    """A mart with all or the given columns; children that none of them comes from are not nested."""
    if columns is None:
        return FACTS[name](t, as_of)
    if name not in INPUTS:
        return FACTS[name](t, as_of).select(*columns)
    wanted = {i for c in columns for i in INPUTS[name].get(c, (c,))}.union(FILTERED.get(name, ()))
    return FACTS[name](t, as_of, wanted).select(*columns)
