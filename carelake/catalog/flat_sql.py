"""Oracle SQL of the flat tables, written against the driver tables.

Each table is a FROM clause with one or more branches of column expressions (one
branch per element a resource holds); columns a branch leaves out are NULL.
"""

from __future__ import annotations

import re

from carelake.functions import codes
from carelake.sources import bridge, schemas

RAW: dict[str, str] = {}


def columns_of(table: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a table's DDL."""
    ddl, depth, start, parts = " ".join(schemas.TABLES[table].split()), 0, 0, []
    for i, ch in enumerate(ddl):
        depth += ch in "<(" and 1 or 0
        depth -= ch in ">)" and 1 or 0
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    parts.append(ddl[start:])
    return [tuple(p.strip().split(" ", 1)) for p in parts]


def _duck_type(dtype: str) -> str:
    return {"string": "VARCHAR", "int": "INTEGER"}.get(dtype, "VARCHAR" if dtype.startswith("array") else dtype.upper())


def flat(table: str, source: str, *branches: dict) -> None:
    RAW[table] = rows_of(table, source, *branches)


def rows_of(table: str, source: str, *branches: dict) -> str:
    """SELECT with the columns of a table, one branch per element."""
    selects = []
    for cols in branches:
        cols = dict(cols)
        where = cols.pop("_where", None)
        names = [n for n, _ in columns_of(table)]
        unknown = set(cols) - set(names)
        if unknown:
            raise ValueError(f"{table}: {unknown}")
        body = ", ".join(
            f"CAST({cols.get(n, 'NULL')} AS {_duck_type(t)}) AS {n}" for n, t in columns_of(table) if n not in ("created_at", "updated_at")
        )
        selects.append(f"SELECT {body} FROM {source}" + (f" WHERE {where}" if where else ""))
    return " UNION ALL ".join(selects)


def rendered(name: str, dtype: str) -> str:
    """Column in the plain form results are compared in."""
    if dtype == "timestamp":
        return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"
    if dtype in ("date", "boolean"):
        return f"CAST({name} AS VARCHAR) AS {name}"
    if dtype.startswith("decimal"):
        return f"CAST({name} AS DOUBLE) AS {name}"
    if dtype == "int":
        return f"CAST({name} AS BIGINT) AS {name}"
    return name


def table_oracle(table: str, raw: str | None = None) -> str:
    cols = ", ".join(rendered(n, t) for n, t in columns_of(table) if n not in ("created_at", "updated_at"))
    return f"SELECT {cols} FROM ({raw or RAW[table]})"


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with CTEs of the flat tables and marts it names."""
    known = {**RAW, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(known[name])
                ordered.append(name)

    visit(sql)
    ctes = ", ".join(f"{n} AS ({known[n]})" for n in ordered)
    if not ctes:
        return sql
    return f"WITH {ctes} {sql}"


def text_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def case(column: str, mapping: dict, default: str = "NULL") -> str:
    return f"(CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {default} END)"


# --- Patient ------------------------------------------------------------------

_PAT = "customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"
_T = "(TIMESTAMP '2024-01-01 10:20:30' + to_days(c_nationkey))"
_PSTAMP = (
    f"(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {_T} - INTERVAL 2 HOUR + INTERVAL 123456 MICROSECOND "
    f"WHEN 'BUILDING' THEN {_T} + INTERVAL 123 MILLISECOND WHEN 'MACHINERY' THEN NULL ELSE {_T} END)"
)
_P = {"patient_id": "c_custkey", "meta_last_updated": _PSTAMP}
_MARITAL = "c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD')"
flat("patients", _PAT, {
    **_P, "active": "c_acctbal >= 0",
    "gender": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'female' ELSE 'male' END",
    "birth_date": "CASE WHEN c_acctbal >= 0 THEN make_date(1940 + c_nationkey, n_regionkey + 1, 15) END",
    "deceased": "c_acctbal > 9000",
    "deceased_date": "CASE WHEN c_acctbal > 9000 THEN TIMESTAMP '2023-06-15' END",
    "resourcetype": "'Patient'",
    "marital_status_code": f"CASE WHEN {_MARITAL} THEN substr(c_mktsegment, 1, 1) END",
    "marital_status_display": f"CASE WHEN {_MARITAL} THEN c_mktsegment END",
    "marital_status_system": f"CASE WHEN {_MARITAL} THEN 'urn:marital' END",
    "meta_security": """CASE WHEN c_acctbal >= 0 THEN '[{"system":"urn:security","code":"R"}]' END""",
    "extensions": """'[{"url":"urn:segment","valueString":"' || c_mktsegment || '"}]'""",
})
flat("patient_names", _PAT,
     {**_P, "name_use": "'official'", "name_text": "c_name", "family_name": "'Customer'",
      "given_names": "'C' || c_custkey || ' ' || c_mktsegment", "prefix": "'Mx.'", "period_start": "DATE '2020-01-01'"},
     {**_P, "name_use": "'usual'", "family_name": "n_name"})
flat("patient_telecoms", _PAT,
     {**_P, "telecom_system": "'phone'", "telecom_value": "'555-' || c_custkey", "telecom_use": "'home'"},
     {**_P, "telecom_system": "'email'", "telecom_value": "c_name || '@example.org'", "telecom_use": "'work'"})
flat("patient_addresses", _PAT,
     {**_P, "address_use": "'home'", "address_type": "'physical'",
      "address_line": """'["' || c_custkey || ' Main St","Apt ' || c_nationkey || '"]'""", "city": "n_name",
      "district": "r_name", "postal_code": "CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') "
      "ELSE substr(CAST(c_custkey AS VARCHAR), 1, 5) END", "country": "'US'", "period_start": "DATE '2020-01-01'"},
     {**_P, "address_use": "'work'", "address_text": "c_name || ' office'"})
flat("patient_contacts", _PAT, {
    **_P, "contact_relationship_code": "'N'", "contact_relationship_system": "'urn:relation'",
    "contact_relationship_display": "'Next of kin'", "contact_name_text": "'Kin of ' || c_name",
    "contact_name_given": """'["K","' || substr(c_mktsegment, 1, 1) || '"]'""", "contact_telecom_system": "'phone'",
    "contact_telecom_value": "'555'", "contact_telecom_use": "'mobile'",
})
flat("patient_communications", _PAT, {
    **_P, "language_code": "lower(substr(r_name, 1, 2))", "language_system": "'urn:ietf:bcp:47'",
    "language_display": "r_name", "preferred": "FALSE",
})
flat("patient_practitioners", _PAT,
     {**_P, "practitioner_id": "c_nationkey", "reference_type": "'Practitioner'"},
     {**_P, "practitioner_role_id": "n_regionkey", "reference_type": "'PractitionerRole'"},
     {**_P, "organization_id": "c_nationkey", "reference_type": "'Organization'"})
flat("patient_links", _PAT, {**_P, "other_patient_id": "c_custkey + 1", "link_type_code": "'seealso'"})

# --- Practitioner ---------------------------------------------------------------

_R = {"practitioner_id": "s_suppkey", "meta_last_updated": "TIMESTAMP '2024-02-01' + to_days(s_nationkey)"}
# Days 1 to 25 of the month: nation keys run from 0 to 24.
flat("practitioners", "supplier", {**_R, "resource_type": "'Practitioner'", "active": "s_acctbal >= 0"})
flat("practitioner_names", "supplier",
     {**_R, "text": "s_name", "family": "CASE WHEN s_acctbal >= 0 THEN 'Supplier' END",
      "given": "CASE WHEN s_acctbal >= 0 THEN 'S ' || s_suppkey ELSE '' END"},
     {**_R, "text": """'Dr "' || s_suppkey || '"'""", "family": "'Zed'", "given": "''"})
flat("practitioner_telecoms", "supplier",
     {**_R, "system": "'phone'", "value": "'1-' || s_suppkey"},
     {**_R, "system": "'email'", "value": "s_name || '@example.org'", "_where": "s_acctbal >= 0"})
flat("practitioner_addresses", "supplier",
     {**_R, "line": "s_suppkey || ' Care Rd, Suite ' || s_nationkey", "city": "'CITY_' || s_nationkey",
      "state": "'ST' || s_nationkey", "postal_code": "10000 + s_nationkey"},
     {**_R, "line": "''", "city": "'NOWHERE'"})

# --- Encounter ------------------------------------------------------------------

_D = "substr(o_orderpriority, 1, 1)"
_E = {"encounter_id": "o_orderkey", "meta_last_updated": "o_orderdate + INTERVAL 1 DAY"}
flat("encounters", "orders", {
    **_E, "patient_id": "o_custkey", "status": case("o_orderstatus", {"F": "finished", "O": "in-progress", "P": "cancelled"}),
    "resourcetype": "'Encounter'", "class_code": case("o_orderpriority", {"1-URGENT": "emergency", "2-HIGH": "inpatient"}, "'ambulatory'"),
    "class_display": "'urn:act'", "start_time": "o_orderdate",
    "end_time": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_minutes(CAST(floor(o_totalprice / 1000) AS BIGINT)) END",
    "service_provider_id": _D,
})
flat("encounter_types", "orders", {**_E, "type_code": _D, "type_system": "'urn:visit'", "type_display": "o_orderpriority", "type_text": "''"})
flat("encounter_participants", "orders",
     *[{**_E, "participant_type": f"'{t}'", "participant_id": _D, "period_start": "o_orderdate"} for t in ("primary_performer", "ATND")],
     {**_E, "participant_type": "'CON'", "participant_id": "'0'"})
flat("encounter_reasons", "orders", {
    **_E, "reason_text": "'Reason ' || o_orderpriority",
    **{f"reason_{k}": f"CASE WHEN o_orderstatus = 'F' THEN {v} END"
       for k, v in (("code", _D), ("system", "'urn:reason'"), ("display", "o_orderpriority"))}})
flat("encounter_locations", "orders", {**_E, "location_id": f"'L' || {_D}"}, {**_E, "location_id": "'A'"})
flat("encounter_hospitalization", "orders", {
    **_E, "discharge_disposition_text": "'Home'", "discharge_code": "'home'", "discharge_system": "'urn:discharge'",
    "_where": "o_orderstatus = 'F'"})

# --- Condition ------------------------------------------------------------------

_NUMBER = "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)"
CODINGS = f"""(SELECT DISTINCT l_orderkey, u.system, u.code, u.display FROM lineitem JOIN part ON l_partkey = p_partkey,
 LATERAL (SELECT '{codes.ICD10CM}' AS system, {text_list(bridge.ICD_CODES)}[{_NUMBER}] AS code,
 {text_list(bridge.ICD_NAMES)}[{_NUMBER}] AS display UNION ALL
 SELECT '{codes.SNOMED}', {case('p_type', bridge.SNOMED_BY_TYPE)}, NULL) u)"""
_CONCEPT = f"(SELECT l_orderkey, max(display) AS name FROM {CODINGS} GROUP BY l_orderkey)"
_COND = f"orders LEFT JOIN {_CONCEPT} ON o_orderkey = l_orderkey"
_C = {"condition_id": "o_orderkey", "meta_last_updated": "o_orderdate + INTERVAL 2 DAY"}
flat("conditions", _COND, {
    **_C, "patient_id": "o_custkey", "encounter_id": "o_orderkey",
    "clinical_status_code": case("o_orderstatus", {"F": "active", "O": "recurrence", "P": "resolved"}),
    "clinical_status_system": "'urn:clinical'",
    "verification_status_code": case("o_orderpriority", {"5-LOW": "provisional"}, "'confirmed'"),
    "verification_status_system": "'urn:verify'", "condition_text": "name",
    "severity_code": "CASE WHEN o_orderpriority = '1-URGENT' THEN '24484000' END",
    "severity_system": f"CASE WHEN o_orderpriority = '1-URGENT' THEN '{codes.SNOMED}' END",
    # Two-digit years are read as 2000 to 2099.
    "onset_datetime": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderpriority = '2-HIGH' AND "
                      "year(o_orderdate) < 2000 THEN make_timestamp(year(o_orderdate) + 100, month(o_orderdate), "
                      "day(o_orderdate), 0, 0, 0) ELSE o_orderdate END",
    "abatement_datetime": "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY END",
    "recorded_date": "o_orderdate + INTERVAL 1 DAY",
    "meta_profile": """'["urn:profile","' || o_orderpriority || '"]'""",
})
flat("condition_codes", f"orders JOIN {CODINGS} c ON o_orderkey = c.l_orderkey JOIN {_CONCEPT} n ON o_orderkey = n.l_orderkey", {
    **_C, "code_code": "c.code", "code_system": "c.system", "code_display": "c.display", "code_text": "n.name"})
flat("condition_categories", "orders", {
    **_C, "category_code": "'encounter-diagnosis'", "category_system": "'urn:category'", "category_text": "'Diagnosis'"})
flat("condition_notes", "orders", {
    **_C, "note_text": """'Note "' || o_orderkey || '"' || chr(9) || 'for ' || chr(92) || o_orderpriority""",
    "note_author_reference": f"'Practitioner/' || {_D}", "note_time": "o_orderdate"})
flat("condition_body_sites", "orders", {
    **_C, "body_site_code": "'41216001'", "body_site_system": f"'{codes.SNOMED}'", "body_site_text": "'Prostate'",
    "_where": "o_orderstatus = 'F'"})
flat("condition_stages", "orders", {**_C, "stage_assessment_code": f"'Observation/stage-' || {_D}"})
flat("condition_evidence", "orders", {**_C, "evidence_code": _D, "evidence_system": "'urn:evidence'"})
flat("condition_extensions", "orders",
     {**_C, "extension_url": "'urn:note'", "extension_type": "'simple'", "value_type": "'string'",
      "value_string": "o_orderpriority", "extension_order": "0"},
     {**_C, "extension_url": "'urn:count'", "extension_type": "'simple'", "value_type": "'integer'",
      "value_integer": _D, "extension_order": "1"},
     {**_C, "extension_url": "'urn:group'", "extension_type": "'nested'", "value_type": "'unknown'", "extension_order": "2"},
     {**_C, "extension_url": "'urn:inner'", "extension_type": "'simple'", "value_type": "'boolean'", "value_boolean": "true",
      "parent_extension_url": "'urn:group'", "extension_order": "0"},
     {**_C, "extension_url": "'urn:two'", "extension_type": "'nested'", "value_type": "'unknown'",
      "parent_extension_url": "'urn:group'", "extension_order": "1"},
     {**_C, "extension_url": "'urn:three'", "extension_type": "'nested'", "value_type": "'code'", "value_code": "o_orderpriority",
      "parent_extension_url": "'urn:two'", "extension_order": "0"},
     {**_C, "extension_url": "'urn:four'", "extension_type": "'nested'", "value_type": "'unknown'",
      "parent_extension_url": "'urn:three'", "extension_order": "0"},
     {**_C, "extension_url": "'urn:five'", "extension_type": "'simple'", "value_type": "'integer'", "value_integer": _D,
      "parent_extension_url": "'urn:four'", "extension_order": "0"})

# --- Observation ----------------------------------------------------------------

EVENTS = """(SELECT *, k // 5 AS lab, event_type = 'signup' AS inferred, k // 5 IN (17, 18) AS vital,
 CASE WHEN event_type = 'signup' THEN 'to.ai-inference-' ELSE 'obs-' END || event_id AS oid
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
_NAME = f"{text_list(bridge.LAB_NAMES)}[lab + 1]"
_O = {"observation_id": "oid", "patient_id": "user_id"}
_KIND = lambda *k: "event_type IN (" + ", ".join(f"'{x}'" for x in k) + ")"
_IF = lambda cond, v: f"CASE WHEN {cond} THEN {v} END"
_NUMERIC = _KIND("view", "purchase", "error")
ANSWER = (f"(CASE WHEN k < 25 THEN '{codes.ADT_STARTED_VALUE}' WHEN k < 50 THEN '277022003' "
          "WHEN k < 75 THEN '359746009' ELSE '261665006' END)")
flat("observations", EVENTS, {
    **_O, "encounter_id": _IF(_KIND("click"), "event_id"), "specimen_id": _IF(_KIND("view"), "'S' || k"),
    "status": case("event_type", {"error": "entered-in-error", "click": "amended"}, "'final'"),
    "observation_text": f"CASE WHEN inferred THEN 'Inferred finding' ELSE {_NAME} END",
    "value_string": _IF(_KIND("click"), "'k=' || k"),
    "value_quantity_value": _IF(_NUMERIC, "CAST(round(value, 2) AS DECIMAL(15,4))"),
    "value_quantity_unit": _IF(_NUMERIC, f"{text_list(bridge.LAB_UNITS)}[lab + 1]"),
    "value_quantity_system": _IF(_NUMERIC, "'urn:ucum'"),
    "value_codeable_concept_code": _IF("inferred", ANSWER),
    "value_codeable_concept_system": _IF("inferred", f"'{codes.SNOMED}'"),
    "value_codeable_concept_display": _IF("inferred", "'Answer'"),
    "value_codeable_concept_text": _IF("inferred", "'Answer'"),
    "data_absent_reason_code": _IF("inferred", "'unknown'"),
    "data_absent_reason_display": _IF("inferred", "'Unknown'"),
    "data_absent_reason_system": _IF("inferred", "'urn:absent'"),
    "effective_datetime": "ts", "effective_period_start": _IF(_KIND("view"), "date_trunc('day', ts)"),
    "issued": "date_trunc('second', ts) + INTERVAL 1 HOUR", "meta_last_updated": "ts",
    "meta_security": _IF("inferred", """'[{"system":"urn:security","code":"AIAST"}]'"""),
    "derived_from": _IF("inferred", "'DocumentReference/' || k || '|Source;Observation/obs-1|Observation'"),
})
flat("observation_codes", EVENTS,
     {**_O, "code_code": f"'{codes.ADT_CODE}'", "code_system": f"'{codes.SNOMED}'", "code_display": "'Androgen deprivation'",
      "code_text": "'Inferred finding'", "_where": "inferred"},
     {**_O, "code_code": "'L' || lab", "code_system": "'urn:local'", "code_display": _NAME, "code_text": _NAME, "_where": "NOT inferred"},
     {**_O, "code_code": "'S' || lab", "code_system": f"'{codes.SNOMED}'", "code_display": _NAME, "code_text": _NAME, "_where": "NOT inferred"},
     {**_O, "code_code": f"{text_list(bridge.LAB_CODES)}[lab + 1]", "code_system": f"'{codes.LOINC}'", "code_display": _NAME,
      "code_text": _NAME, "_where": "NOT inferred"})
flat("observation_categories", EVENTS,
     {**_O, "category_code": "CASE WHEN vital THEN 'vital-signs' ELSE 'laboratory' END",
      "category_system": f"'{codes.OBSERVATION_CATEGORY}'",
      "category_display": "CASE WHEN vital THEN 'Vital Signs' ELSE 'Laboratory' END", "category_text": "'Main'"},
     {**_O, "category_code": "'exam'", "category_system": "'urn:local'", "_where": _KIND("view")})
flat("observation_interpretations", EVENTS, {
    **_O, "interpretation_code": "'H'", "interpretation_system": "'urn:flag'", "interpretation_display": "'High'",
    "interpretation_text": "'High'", "_where": _KIND("purchase")})
flat("observation_reference_ranges", EVENTS, {
    **_O, "range_low_value": "0.5", "range_low_unit": "'u'", "range_high_value": _IF(_KIND("view"), "4"),
    "range_high_unit": _IF(_KIND("view"), "'u'"), "range_type_code": "'normal'", "range_type_system": "'urn:range'",
    "range_text": _IF(_KIND("view"), "'0.5-4'"), "_where": _KIND("view", "click")})
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
flat("observation_components", EVENTS,
     {**_O, "component_code": f"CASE WHEN k < 25 THEN '{codes.ADT_START_COMPONENT}' ELSE '{codes.LATEST_MEASUREMENT}' END",
      "component_system": "'urn:result'", "component_display": "'Result date'", "component_text": "'Date'",
      "component_value_string": _ISO, "_where": "inferred"},
     {**_O, "component_code": f"'{codes.ANALYSIS_NOTE}'", "component_system": "'urn:analysis'", "component_display": "'Note'",
      "component_text": "'Analysis'", "component_value_string": "'k=' || k", "_where": "inferred"},
     {**_O, "component_code": "'8480-6'", "component_system": f"'{codes.LOINC}'", "component_display": "'Systolic'",
      "component_text": "'Systolic'", "component_value_quantity_value": "k", "component_value_quantity_unit": "'mmHg'",
      "_where": _KIND("purchase")},
     {**_O, "component_code": "'8462-4'", "component_system": f"'{codes.LOINC}'", "component_display": "'Diastolic'",
      "component_text": "'Diastolic'", "component_value_codeable_concept_code": "'N'",
      "component_value_codeable_concept_system": f"'{codes.SNOMED}'", "component_value_codeable_concept_display": "'Normal'",
      "component_data_absent_reason_code": "'error'", "component_data_absent_reason_display": "'Error'", "_where": _KIND("purchase")})
flat("observation_notes", EVENTS, {**_O, "note_text": """'note "' || k || '"'""", "_where": _KIND("error", "click", "signup")})
flat("observation_performers", EVENTS,
     {**_O, "performer_type": "'Practitioner'", "performer_id": "k"}, {**_O, "performer_type": "'Organization'", "performer_id": "'1'"})
flat("observation_members", EVENTS, {**_O, "member_observation_id": "'obs-' || event_id", "_where": _KIND("purchase")})
flat("observation_derived_from", EVENTS,
     {**_O, "reference": "'DocumentReference/' || k", "reference_type": "'DocumentReference'", "reference_id": "k",
      "display": "'Source'", "_where": "inferred"},
     {**_O, "reference": "'Observation/obs-1'", "reference_type": "'Observation'", "reference_id": "'obs-1'", "_where": "inferred"})

# --- DiagnosticReport -------------------------------------------------------------

_G = {"diagnostic_report_id": "'dr-' || o_orderkey"}
flat("diagnostic_reports", "orders", {
    **_G, "resource_type": "'DiagnosticReport'", "status": case("o_orderstatus", {"F": "final", "O": "registered", "P": "cancelled"}),
    "effective_datetime": "o_orderdate", "issued_datetime": _IF("o_orderstatus <> 'O'", "o_orderdate + INTERVAL 1 DAY"),
    "code_text": "'Report ' || o_orderpriority",
    "code_primary_code": case("o_orderpriority", {k: v[0] for k, v in bridge.REPORTS.items()}),
    "code_primary_system": "'urn:report'",
    "code_primary_display": case("o_orderpriority", {k: v[1] for k, v in bridge.REPORTS.items()}),
    "patient_id": "o_custkey", "encounter_id": "o_orderkey", "meta_last_updated": "o_orderdate + INTERVAL 3 DAY",
    "extensions": """'[{"url":"urn:priority","valueString":"' || o_orderpriority ||
 '"},{"url":"urn:outer","extension":[{"extension":[{"extension":[{"extension":[{"url":"e","valueString":"' || o_orderpriority ||
 '"}],"url":"d"}],"url":"c"}],"url":"b"}]}]'""",
})
flat("diagnostic_report_categories", "orders",
     {**_G, "category_code": "'RAD'", "category_system": "'urn:section'", "category_display": "'Radiology'"},
     {**_G, "category_code": _D, "category_system": "'urn:section'"})
flat("diagnostic_report_performers", "orders",
     {**_G, "performer_type": "'Practitioner'", "performer_id": _D}, {**_G, "performer_type": "'Organization'", "performer_id": "'1'"})
flat("diagnostic_report_based_on", "orders", {**_G, "service_request_id": "o_orderkey"})
flat("diagnostic_report_results", "orders",
     *[{**_G, "observation_id": v, "_where": "o_orderstatus = 'F'"} for v in ("'obs-' || o_custkey", "'obs-' || o_custkey", "'obs-x'")])
flat("diagnostic_report_media", "orders", {**_G, "media_id": f"'m' || {_D}"})
flat("diagnostic_report_presented_forms", "orders", {
    **_G, "content_type": "'application/pdf'", "data": f"'ZGF0YQ' || {_D}", "title": "o_orderpriority"})

# --- DocumentReference --------------------------------------------------------------

_N = "CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER)"
_DAY = "(DATE '2022-06-01' + CAST(n_chars // 10 AS INTEGER))"
_F = {"document_reference_id": "doc_id", "meta_last_updated": f"{_DAY} + INTERVAL 1 DAY"}
flat("document_references", "documents", {
    **_F, "patient_id": "doc_id", "status": case("lang", {"de": "superseded", "es": "entered-in-error"}, "'current'"),
    "type_code": f"{text_list(bridge.DOCUMENT_CODES)}[{_N} + 1]", "type_system": f"'{codes.LOINC}'", "type_display": "source",
    "meta_type": f"{text_list([codes.DOCUMENT_CLASS.get(c, 'unknown') for c in bridge.DOCUMENT_CODES])}[{_N} + 1]",
    "date": f"CAST({_DAY} AS TIMESTAMP)", "custodian_id": _N, "description": "text",
    "context_period_start": f"CAST({_DAY} AS TIMESTAMP)",
})
flat("document_reference_identifiers", "documents", {**_F, "identifier_system": "'urn:doc'", "identifier_value": "'D' || doc_id"})
flat("document_reference_categories", "documents",
     {**_F, "category_code": "source", "category_system": "'urn:source'", "category_display": "lang"},
     {**_F, "category_code": "lang", "category_system": "'urn:lang'", "category_display": "lang"})
flat("document_reference_authors", "documents", {**_F, "author_id": _N})
flat("document_reference_content", "documents",
     {**_F, "attachment_content_type": "'text/plain'", "attachment_url": "'ref:content[0].attachment.data'"},
     {**_F, "attachment_content_type": "'text/html'",
      "attachment_url": "CASE WHEN lang = 'en' THEN 'https://example.org/' ELSE 's3://bucket/' END || doc_id"})

# --- Medication, requests, dispenses --------------------------------------------------

_FIRST_WORD = "split_part(p_name, ' ', 1)"
_DRUG = f"coalesce({case(_FIRST_WORD, bridge.DRUGS)}, p_name)"
_CODED = "p_type <> 'SMALL'"
flat("medications", "part", {
    "medication_id": "p_partkey", "resource_type": "'Medication'",
    "code": f"""CASE WHEN {_CODED} THEN '[{{"system":"urn:rxnorm","code":"' || p_brand || '","display":"' || p_type || '"}}]' ELSE 'null' END""",
    "primary_code": _IF(_CODED, "p_brand"), "primary_system": _IF(_CODED, "'urn:rxnorm'"), "primary_text": _DRUG,
    "status": "CASE WHEN p_size > 25 THEN 'active' ELSE 'inactive' END",
    "meta_last_updated": "TIMESTAMP '2024-03-01' + to_days(CAST(ceil(p_size / 2) AS INTEGER) - 1)",
})
flat("medication_identifiers", "part", {"medication_id": "p_partkey", "identifier_system": "'urn:part'", "identifier_value": "p_brand"})

LINES = """(SELECT l_orderkey, l_partkey, l_orderkey || '-' || l_partkey AS rx, CAST(sum(l_quantity) AS INTEGER) AS amount,
 min(l_shipdate) AS first_day, max(l_shipdate) AS last_day, max(l_returnflag) AS flag, max(l_linestatus) AS line_status,
 min(l_suppkey) AS supplier FROM lineitem GROUP BY l_orderkey, l_partkey) JOIN part ON l_partkey = p_partkey
 JOIN orders ON l_orderkey = o_orderkey"""
_M = {"medication_request_id": "rx"}
flat("medication_requests", LINES, {
    **_M, "patient_id": "o_custkey", "encounter_id": "l_orderkey", "medication_id": "l_partkey", "medication_display": _DRUG,
    "status": "CASE WHEN amount > 45 THEN 'cancelled' ELSE " + case("flag", {"A": "active", "N": "completed", "R": "stopped"}) + " END",
    "intent": "'order'", "reported_boolean": "line_status = 'O'", "authored_on": "first_day", "meta_last_updated": "last_day"})
flat("medication_request_identifiers", LINES, {**_M, "identifier_system": "'urn:rx'", "identifier_value": "rx"})
flat("medication_request_notes", LINES, {**_M, "note_text": "'Quantity ' || amount"})
flat("medication_request_dosage_instructions", LINES, {
    **_M, "dosage_text": "'Take ' || amount", "dosage_timing_frequency": "amount", "dosage_timing_period": "1",
    "dosage_timing_period_unit": "'d'", "dosage_route_code": "'26643006'", "dosage_route_system": f"'{codes.SNOMED}'",
    "dosage_route_display": "'Oral'", "dosage_dose_value": "amount", "dosage_dose_unit": "'mg'",
    "dosage_dose_system": "'urn:ucum'", "dosage_dose_code": "'mg'", "dosage_as_needed_boolean": "flag = 'R'"})
flat("medication_request_categories", LINES, {
    **_M, "category_code": "line_status", "category_system": "'urn:setting'", "category_display": "'Setting'", "category_text": "'Setting'"})
_Q = {"medication_dispense_id": "'md-' || rx", "meta_last_updated": "last_day"}
flat("medication_dispenses", LINES, {
    **_Q, "resource_type": "'MedicationDispense'", "status": case("flag", {"R": "stopped"}, "'completed'"), "patient_id": "o_custkey",
    "medication_id": "l_partkey", "medication_display": "p_name", "type_system": "'urn:fill'", "type_code": "flag",
    "type_display": "'Fill'", "quantity_value": "amount", "when_handed_over": "last_day"})
flat("medication_dispense_identifiers", LINES, {**_Q, "identifier_value": "rx"})
flat("medication_dispense_performers", LINES, {**_Q, "performer_actor_reference": "'Practitioner/' || supplier"})
flat("medication_dispense_auth_prescriptions", LINES, {**_Q, "authorizing_prescription_id": "rx", "_where": "flag <> 'N'"})
flat("medication_dispense_dosage_instructions", LINES,
     {**_Q, "dosage_dose_value": "amount", "dosage_dose_unit": "'mg'"}, {**_Q, "dosage_text": "'As directed'"})

# --- CarePlan, AllergyIntolerance, Procedure ---------------------------------------------

_L = {"care_plan_id": "'cp-' || c_custkey"}
flat("care_plans", "customer", {
    **_L, "patient_id": "c_custkey", "status": "CASE WHEN c_acctbal < 0 THEN 'entered-in-error' ELSE 'active' END", "intent": "'plan'",
    "title": "'Plan ' || c_mktsegment", "meta_last_updated": "TIMESTAMP '2024-04-01'"})
flat("care_plan_identifiers", "customer", {**_L, "identifier_value": "'CP' || c_custkey"})
flat("care_plan_categories", "customer",
     *[{**_L, "category_code": v, "category_system": "'urn:plan'"} for v in ("'assess'", "lower(c_mktsegment)")])
flat("care_plan_care_teams", "customer", {**_L, "care_team_id": "'T' || c_nationkey", "_where": "c_mktsegment <> 'MACHINERY'"})
flat("care_plan_goals", "customer", *[{**_L, "goal_id": v} for v in ("'g1'", "'g' || c_nationkey", "'z'")])

_A = {"allergy_intolerance_id": "'ai-' || c_custkey"}
_CASHEW = "c_mktsegment <> 'FURNITURE'"
_VERIFIED = "c_mktsegment <> 'MACHINERY'"
flat("allergy_intolerance", "customer", {
    **_A, "resourcetype": "'AllergyIntolerance'",
    "clinical_status_code": "CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END", "clinical_status_display": "'Status'",
    "clinical_status_system": "'urn:clinical'", "verification_status_code": _IF(_VERIFIED, "'confirmed'"),
    "verification_status_display": _IF(_VERIFIED, "'Confirmed'"), "verification_status_system": _IF(_VERIFIED, "'urn:verify'"),
    "type": "'allergy'", "category": """'["food","' || lower(c_mktsegment) || '"]'""",
    "criticality": case("c_mktsegment", {"BUILDING": "high"}, "'low'"), "code": _IF(_CASHEW, "'227493005'"),
    "code_display": _IF(_CASHEW, "'Cashew'"), "code_system": _IF(_CASHEW, f"'{codes.SNOMED}'"),
    "code_text": _IF("c_mktsegment IN ('AUTOMOBILE', 'BUILDING')", "'Allergy of ' || c_custkey"), "patient_id": "c_custkey",
    "onset_datetime": "TIMESTAMP '2019-01-02 02:04:05'", "onset_age_value": "c_nationkey", "onset_age_unit": "'a'",
    "onset_period_start": "DATE '2019-01-02'", "recorded_date": "TIMESTAMP '2020-01-02'", "recorder_practitioner_id": "c_nationkey",
    "note": """'[{"text":"n"}]'""", "reactions": """'[{"description":"rash","severity":"mild"}]'""",
    "meta_last_updated": "TIMESTAMP '2024-05-01 00:00:00.5'", "meta_source": "'urn:source'", "meta_tag": """'[{"code":"T"}]'"""})
flat("allergy_intolerance_identifiers", "customer", {
    **_A, "identifier_use": "'usual'", "identifier_type_code": "'MR'", "identifier_type_display": "'Record'",
    "identifier_system": "'urn:ai'", "identifier_value": "'A' || c_custkey", "identifier_period_start": "DATE '2020-02-03'"})

_X = {"procedure_id": "'pr-' || o_orderkey"}
flat("procedures", "orders", {
    **_X, "resource_type": "'Procedure'",
    "status": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not-done' ELSE "
              + case("o_orderstatus", {"F": "completed", "O": "in-progress", "P": "stopped"}) + " END",
    "patient_id": "o_custkey", "code_text": "'Procedure ' || o_orderpriority",
    "performed_date_time": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderpriority = '2-HIGH' AND "
                           "year(o_orderdate) < 2000 THEN make_timestamp(year(o_orderdate) + 100, month(o_orderdate), "
                           "day(o_orderdate), 0, 0, 0) ELSE o_orderdate END",
    "meta_last_updated": "o_orderdate"})
flat("procedure_identifiers", "orders", {**_X, "identifier_system": "'urn:proc'", "identifier_value": "'P' || o_orderkey"})
flat("procedure_code_codings", "orders",
     {**_X, "code_system": "'urn:cpt'", "code_code": f"'P' || {_D}", "code_display": "o_orderpriority", "_where": "o_orderstatus <> 'P'"},
     {**_X, "code_system": f"'{codes.SNOMED}'", "code_code": "o_orderstatus", "code_display": "'Status'", "_where": "o_orderstatus <> 'P'"})
