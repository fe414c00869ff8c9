"""Oracle SQL of the fact marts, written against the flat-table CTEs.

Scalars keep native types here, so that report oracles can build on them; nested
children are already in the delimited text form of ``render.plain``.
"""

from __future__ import annotations

from carelake.catalog.flat_sql import columns_of, rendered
from carelake.catalog.stage import AS_OF
from carelake.functions import codes

RAW: dict[str, str] = {}
COLUMNS: dict[str, list[tuple[str, str]]] = {}
_TYPES = {"t": "timestamp", "d": "date", "b": "boolean", "i": "int", "n": "decimal"}
TODAY = f"DATE '{AS_OF}'"


def own(table: str, *skip: str) -> str:
    short = {"timestamp": ":t", "date": ":d", "boolean": ":b", "int": ":i"}
    return " ".join(
        n + (short.get(t) or (":n" if t.startswith("decimal") else ""))
        for n, t in columns_of(table) if n not in ("created_at", "updated_at", *skip)
    )


def fact(name: str, columns: str, sql: str) -> None:
    RAW[name] = sql
    COLUMNS[name] = [(c.split(":")[0], _TYPES.get(c.partition(":")[2], "string")) for c in columns.split()]


def shown(columns: list[tuple[str, str]]) -> str:
    return ", ".join(rendered(n, t) for n, t in columns)


def fact_oracle(name: str) -> str:
    return f"SELECT {shown(COLUMNS[name])} FROM {name}"


def items(table: str, key: str, fields: str, order: str, distinct: bool = False, where: str = "TRUE") -> str:
    """Subquery (key, v): children of a key as delimited text."""
    inner = f"SELECT {'DISTINCT' if distinct else ''} {key}, concat_ws('|', {fields}) AS x, {order} FROM {table} WHERE {where}"
    keys = ", ".join(f"o{i} NULLS FIRST" for i in range(order.count(" AS o")))
    return f"(SELECT {key}, string_agg(x, ';' ORDER BY {keys}, x) AS v, count(*) AS n FROM ({inner}) GROUP BY {key})"


def sorted_items(table: str, key: str, *fields: str, distinct: bool = False, where: str = "TRUE") -> str:
    order = ", ".join(f"{f} AS o{i}" for i, f in enumerate(fields))
    return items(table, key, ", ".join(f"CAST({f} AS VARCHAR)" for f in fields), order, distinct, where)


def clean(*fields: str) -> list[str]:
    return [f"coalesce(regexp_replace({f}, '[\\r\\n\\t\"]', '', 'g'), '')" for f in fields]


def prefixed(prefix: str, *names: str) -> list[str]:
    return [f"{prefix}_{n}" for n in names]


def _priority(column: str, *systems: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(systems, 1)) + f" ELSE {len(systems) + 1} END"


# --- patients and practitioners -------------------------------------------------

_PLAIN = lambda c: f"coalesce(regexp_replace({c}, '[^a-zA-Z0-9 .-]', '', 'g'), '')"
fact("fact_patients", """patient_id active:b gender birth_date:d deceased:b deceased_date:t managing_organization_id
  meta_last_updated:t meta_source meta_security meta_tag name_text family_name given_names prefix suffix name_use names
  all_addresses total_encounter_count last_encounter_date:t encounters_last_year emergency_encounter_count
  inpatient_encounter_count total_condition_count active_condition_count current_age:i age_at_last_encounter:i
  days_since_last_encounter:i activity_status""", f"""
SELECT p.*, rn.* EXCLUDE (patient_id, meta_last_updated, period_start, period_end, r),
 concat_ws('|', {', '.join(_PLAIN('rn.' + c) for c in ('name_use', 'name_text', 'family_name', 'given_names', 'prefix', 'suffix'))}) AS names,
 a.all_addresses, coalesce(e.n, 0) AS total_encounter_count, e.last AS last_encounter_date, coalesce(e.recent, 0) AS encounters_last_year,
 coalesce(e.emergency, 0) AS emergency_encounter_count, coalesce(e.inpatient, 0) AS inpatient_encounter_count,
 coalesce(c.n, 0) AS total_condition_count, coalesce(c.active, 0) AS active_condition_count,
 CASE WHEN deceased AND deceased_date IS NOT NULL THEN year(deceased_date) - year(birth_date) ELSE year({TODAY}) - year(birth_date) END AS current_age,
 year(e.last) - year(birth_date) AS age_at_last_encounter, date_diff('day', CAST(e.last AS DATE), {TODAY}) AS days_since_last_encounter,
 CASE WHEN deceased THEN 'deceased' WHEN e.last IS NULL THEN 'no_encounters'
  WHEN date_diff('day', CAST(e.last AS DATE), {TODAY}) <= 90 THEN 'active'
  WHEN date_diff('day', CAST(e.last AS DATE), {TODAY}) <= 365 THEN 'inactive_recent' ELSE 'inactive_historical' END AS activity_status
FROM patients p
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY CASE name_use WHEN 'official' THEN 1 WHEN 'usual' THEN 2 ELSE 3 END,
  family_name NULLS LAST, given_names NULLS LAST) AS r FROM patient_names) rn ON p.patient_id = rn.patient_id AND rn.r = 1
LEFT JOIN (SELECT patient_id, string_agg(CASE WHEN address_text <> '' THEN address_text ELSE coalesce(address_line, '') || ', ' ||
  coalesce(city, '') || ', ' || coalesce(district, '') || ', ' || coalesce(state, '') || ' ' || coalesce(postal_code, '') END, ' | '
  ORDER BY CASE address_use WHEN 'home' THEN 1 WHEN 'work' THEN 2 ELSE 3 END) AS all_addresses
  FROM patient_addresses GROUP BY patient_id) a ON p.patient_id = a.patient_id
LEFT JOIN (SELECT patient_id, count(DISTINCT encounter_id) AS n, max(start_time) AS last,
  count(DISTINCT CASE WHEN class_code = 'emergency' THEN encounter_id END) AS emergency,
  count(DISTINCT CASE WHEN class_code = 'inpatient' THEN encounter_id END) AS inpatient,
  count(DISTINCT CASE WHEN start_time >= {TODAY} - INTERVAL 1 YEAR THEN encounter_id END) AS recent
  FROM encounters GROUP BY patient_id) e ON p.patient_id = e.patient_id
LEFT JOIN (SELECT patient_id, count(DISTINCT condition_id) AS n,
  count(DISTINCT CASE WHEN clinical_status_code = 'active' THEN condition_id END) AS active
  FROM conditions GROUP BY patient_id) c ON p.patient_id = c.patient_id""")

_ADDRESS = clean("city", "state", "line", "postal_code")
_STRIP = lambda c: f"coalesce(regexp_replace({c}, '[\\r\\n\\t\"\\\\]', '', 'g'), '')"
fact("fact_practitioners", """practitioner_id resource_type active:b meta_last_updated:t names addresses telecoms telecom_count
  primary_phone primary_email has_complete_contact:b primary_city primary_state""", f"""
SELECT p.*, CASE WHEN rn.practitioner_id IS NOT NULL THEN concat_ws('|', {_STRIP('rn.text')}, {_STRIP('rn.family')}, {_STRIP('rn.given')}) END AS names,
 aa.v AS addresses, t.v AS telecoms, tc.n AS telecom_count, tc.phone AS primary_phone, tc.email AS primary_email,
 coalesce(tc.n, 0) > 0 AND coalesce(ac.n, 0) > 0 AS has_complete_contact, ac.city AS primary_city, ac.state AS primary_state
FROM practitioners p
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY practitioner_id ORDER BY CASE WHEN family <> '' AND given <> '' THEN 1
  WHEN family <> '' THEN 2 WHEN given <> '' THEN 3 ELSE 4 END, family NULLS LAST, given NULLS LAST) AS r FROM practitioner_names) rn
  ON p.practitioner_id = rn.practitioner_id AND rn.r = 1
LEFT JOIN {sorted_items('practitioner_addresses', 'practitioner_id', *_ADDRESS, distinct=True, where='line IS NOT NULL')} aa
  ON p.practitioner_id = aa.practitioner_id
LEFT JOIN (SELECT practitioner_id, count(DISTINCT line) AS n, max(city) AS city, max(state) AS state FROM practitioner_addresses
  WHERE line IS NOT NULL GROUP BY practitioner_id) ac ON p.practitioner_id = ac.practitioner_id
LEFT JOIN {sorted_items('practitioner_telecoms', 'practitioner_id', *clean('system', 'value'), distinct=True)} t ON p.practitioner_id = t.practitioner_id
LEFT JOIN (SELECT practitioner_id, count(DISTINCT value) AS n, max(CASE WHEN system = 'phone' THEN value END) AS phone,
  max(CASE WHEN system = 'email' THEN value END) AS email FROM practitioner_telecoms GROUP BY practitioner_id) tc
  ON p.practitioner_id = tc.practitioner_id""")

# --- encounters -----------------------------------------------------------------

_LABEL = (f"CASE cc.code_system WHEN '{codes.ICD10CM}' THEN 'ICD10:' WHEN '{codes.ICD9CM}' THEN 'ICD9:' WHEN '{codes.SNOMED}' THEN 'SNOMED:' "
          "ELSE coalesce(cc.code_system, 'UNK') || ':' END || coalesce(cc.code_code, '') || ':' || coalesce(cc.code_display, cc.code_text, '')")
fact("fact_encounters", own("encounters") + """ all_identifiers identifier_count discharge_disposition_text discharge_code
  discharge_system location_sequence location_count all_participants participant_count primary_performer_count reasons types
  all_diagnoses diagnosis_count primary_diagnosis_code primary_diagnosis_display primary_diagnosis_code_system
  duration_minutes:i is_complete:b days_since_encounter:i patient_encounter_rank:i""", f"""
SELECT e.*, CAST(NULL AS VARCHAR) AS all_identifiers, CAST(0 AS BIGINT) AS identifier_count, h.* EXCLUDE (encounter_id, meta_last_updated),
 l.location_sequence, l.location_count, w.all_participants, w.participant_count, w.primary_performer_count, r.v AS reasons, t.v AS types,
 d.all_diagnoses, dc.diagnosis_count, p.code_code AS primary_diagnosis_code, p.display AS primary_diagnosis_display,
 p.code_system AS primary_diagnosis_code_system, CAST(round(date_diff('second', start_time, end_time) / 60.0) AS BIGINT) AS duration_minutes,
 status IN ('finished', 'cancelled', 'entered-in-error') AS is_complete,
 date_diff('day', CAST(coalesce(end_time, start_time) AS DATE), {TODAY}) AS days_since_encounter,
 rank() OVER (PARTITION BY e.patient_id ORDER BY start_time DESC NULLS FIRST) AS patient_encounter_rank
FROM encounters e LEFT JOIN encounter_hospitalization h ON e.encounter_id = h.encounter_id
LEFT JOIN (SELECT encounter_id, string_agg(location_id, ' -> ' ORDER BY location_id) AS location_sequence,
  count(DISTINCT location_id) AS location_count FROM encounter_locations GROUP BY encounter_id) l ON e.encounter_id = l.encounter_id
LEFT JOIN (SELECT encounter_id, string_agg(participant_type || ':' || participant_id, ' | ' ORDER BY participant_type, participant_id) AS all_participants,
  count(DISTINCT participant_id) AS participant_count,
  count(DISTINCT CASE WHEN participant_type = 'primary_performer' THEN participant_id END) AS primary_performer_count
  FROM encounter_participants GROUP BY encounter_id) w ON e.encounter_id = w.encounter_id
LEFT JOIN {sorted_items('encounter_reasons', 'encounter_id', *prefixed('reason', 'code', 'system', 'display', 'text'))} r ON e.encounter_id = r.encounter_id
LEFT JOIN {sorted_items('encounter_types', 'encounter_id', *prefixed('type', 'code', 'system', 'display', 'text'))} t ON e.encounter_id = t.encounter_id
LEFT JOIN (SELECT encounter_id, string_agg(x, ' | ' ORDER BY onset NULLS LAST, x) AS all_diagnoses FROM
  (SELECT c.encounter_id, {_LABEL} AS x, min(c.onset_datetime) AS onset FROM conditions c LEFT JOIN condition_codes cc
   ON c.condition_id = cc.condition_id GROUP BY 1, 2) GROUP BY encounter_id) d ON e.encounter_id = d.encounter_id
LEFT JOIN (SELECT encounter_id, count(DISTINCT condition_id) AS diagnosis_count FROM conditions GROUP BY encounter_id) dc ON e.encounter_id = dc.encounter_id
LEFT JOIN (SELECT c.encounter_id, code_code, coalesce(code_display, code_text) AS display, code_system, row_number() OVER (PARTITION BY c.encounter_id
  ORDER BY {_priority('code_system', codes.ICD10CM, codes.ICD9CM, codes.SNOMED)}, code_code) AS r
  FROM conditions c JOIN condition_codes cc ON c.condition_id = cc.condition_id) p ON e.encounter_id = p.encounter_id AND p.r = 1
WHERE e.status <> 'cancelled'""")

# --- conditions -----------------------------------------------------------------

_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY condition_id ORDER BY
 {_priority('code_system', codes.ICD10CM, codes.ICD10, codes.SNOMED)}, code_code) AS code_rank FROM condition_codes)"""
_NOTE = "replace(regexp_replace(note_text, '[\\r\\n\\t\"]', '', 'g'), chr(92), chr(92) || chr(92))"
_STAGE = ", ".join(f"coalesce(stage_{k}_{p}, '')" for k in ("summary", "assessment", "type") for p in ("system", "code", "display"))
fact("fact_conditions", own("conditions") + """ code_system code_code code_display code_text code_rank:i codes body_sites categories
  evidence notes stages condition_duration_days:i is_active:b""", f"""
SELECT c.*, p.code_system, p.code_code, p.code_display, p.code_text, 1 AS code_rank, a.codes, b.v AS body_sites, k.v AS categories,
 e.v AS evidence, n.notes, s.stages, date_diff('day', CAST(onset_datetime AS DATE), CAST(abatement_datetime AS DATE)) AS condition_duration_days,
 clinical_status_code = 'active' AND (abatement_datetime IS NULL OR abatement_datetime > {TODAY}) AS is_active
FROM conditions c LEFT JOIN {_RANKED} p ON c.condition_id = p.condition_id AND p.code_rank = 1
LEFT JOIN (SELECT condition_id, string_agg(concat_ws('|', code_code, code_system, code_display, code_text, code_rank), ';' ORDER BY code_rank)
  AS codes FROM {_RANKED} GROUP BY condition_id) a ON c.condition_id = a.condition_id
LEFT JOIN {sorted_items('condition_body_sites', 'condition_id', *clean(*prefixed('body_site', 'system', 'code', 'display', 'text')), distinct=True)} b
  ON c.condition_id = b.condition_id
LEFT JOIN {sorted_items('condition_categories', 'condition_id', *clean(*prefixed('category', 'system', 'code', 'display', 'text')), distinct=True)} k
  ON c.condition_id = k.condition_id
LEFT JOIN {sorted_items('condition_evidence', 'condition_id', *clean(*prefixed('evidence', 'system', 'code', 'display', 'detail_reference')), distinct=True)} e
  ON c.condition_id = e.condition_id
LEFT JOIN (SELECT condition_id, string_agg(concat_ws('|', strftime(note_time, '%Y-%m-%d %H:%M:%S.%f'), {_NOTE}, coalesce(note_author_reference, '')), ';'
  ORDER BY note_time) AS notes FROM condition_notes GROUP BY condition_id) n ON c.condition_id = n.condition_id
LEFT JOIN (SELECT condition_id, max(concat_ws('|', {_STAGE})) AS stages FROM condition_stages GROUP BY condition_id) s ON c.condition_id = s.condition_id""")

# --- observations ---------------------------------------------------------------

_OKEY = "observation_id"
_OORDER = "CASE WHEN code_system = 'http://loinc.org' THEN 1 WHEN code_system LIKE '%snomed%' THEN 2 ELSE 3 END"
_ORANK = f"(SELECT *, row_number() OVER (PARTITION BY observation_id ORDER BY {_OORDER}, code_code) AS code_rank FROM observation_codes)"
_CMP = "component_value_codeable_concept"
_COMPONENT = f"""component_system, component_code, component_display, component_text,
 CAST(component_value_quantity_value AS VARCHAR), CASE WHEN component_value_quantity_value IS NOT NULL THEN component_value_quantity_unit END,
 CASE WHEN component_value_quantity_value IS NULL AND {_CMP}_code IS NOT NULL THEN concat_ws('|', {_CMP}_system, {_CMP}_code, {_CMP}_display) END,
 CASE WHEN component_value_quantity_value IS NULL AND {_CMP}_code IS NULL AND component_value_string <> '' THEN component_value_string END,
 CASE WHEN component_data_absent_reason_code IS NOT NULL THEN concat_ws('|', component_data_absent_reason_code, component_data_absent_reason_display) END"""
OBSERVATION_COLUMNS = own("observations", "meta_source", "meta_profile", "meta_security", "meta_tag", "extensions") + """
  primary_system primary_code primary_display has_value:b observation_category codes components categories reference_ranges
  interpretations notes performers code_count component_count category_count interpretation_count note_count performer_count"""
_ranges = prefixed("range", "low_value", "high_value", "low_unit", "high_unit", "type_code", "type_system", "type_display", "text")
_VITAL = f"(SELECT {_OKEY} FROM observation_categories WHERE category_code = 'vital-signs' OR category_display ILIKE '%vital%')"


def _observations(vital: str) -> str:
    return f"""
SELECT o.*, p.code_system AS primary_system, p.code_code AS primary_code, p.code_display AS primary_display,
 value_string IS NOT NULL OR value_quantity_value IS NOT NULL OR value_datetime IS NOT NULL OR value_boolean IS NOT NULL AS has_value,
 oc.category_code AS observation_category, a.codes, m.v AS components, k.v AS categories, r.v AS reference_ranges, i.v AS interpretations,
 n.v AS notes, f.v AS performers, coalesce(a.n, 0) AS code_count, coalesce(m.n, 0) AS component_count, coalesce(k.n, 0) AS category_count,
 coalesce(i.n, 0) AS interpretation_count, coalesce(n.n, 0) AS note_count, coalesce(f.n, 0) AS performer_count
FROM observations o LEFT JOIN {_ORANK} p ON o.{_OKEY} = p.{_OKEY} AND p.code_rank = 1
LEFT JOIN (SELECT {_OKEY}, count(*) AS n, string_agg(concat_ws('|', code_code, code_system, code_display, code_text, code_rank), ';' ORDER BY code_rank)
  AS codes FROM {_ORANK} GROUP BY {_OKEY}) a ON o.{_OKEY} = a.{_OKEY}
LEFT JOIN {items('observation_components', _OKEY, _COMPONENT, 'component_system AS o0, component_code AS o1')} m ON o.{_OKEY} = m.{_OKEY}
LEFT JOIN {sorted_items('observation_categories', _OKEY, *prefixed('category', 'system', 'code', 'display', 'text'))} k ON o.{_OKEY} = k.{_OKEY}
LEFT JOIN {sorted_items('observation_reference_ranges', _OKEY, *_ranges)} r ON o.{_OKEY} = r.{_OKEY}
LEFT JOIN {sorted_items('observation_interpretations', _OKEY, *prefixed('interpretation', 'code', 'system', 'display'))} i ON o.{_OKEY} = i.{_OKEY}
LEFT JOIN {sorted_items('observation_notes', _OKEY, 'note_text', where="note_text <> ''")} n ON o.{_OKEY} = n.{_OKEY}
LEFT JOIN {sorted_items('observation_performers', _OKEY, 'performer_id', 'performer_type')} f ON o.{_OKEY} = f.{_OKEY}
LEFT JOIN (SELECT {_OKEY}, category_code, row_number() OVER (PARTITION BY {_OKEY} ORDER BY
  CASE WHEN category_system = '{codes.OBSERVATION_CATEGORY}' THEN 1 ELSE 2 END, category_code) AS r FROM observation_categories) oc
  ON o.{_OKEY} = oc.{_OKEY} AND oc.r = 1
WHERE o.status <> 'entered-in-error' AND o.{_OKEY} {vital} {_VITAL}"""


fact("fact_observations", OBSERVATION_COLUMNS, _observations("NOT IN"))
fact("fact_vital_signs", OBSERVATION_COLUMNS, _observations("IN"))

# --- reports, documents, medication requests -----------------------------------------

_RKEY = "diagnostic_report_id"


def _ids(table: str, column: str) -> str:
    return sorted_items(table, _RKEY, column, distinct=True)


fact("fact_diagnostic_reports", own("diagnostic_reports") + """ results result_count performers categories media presented_forms
  based_on report_age_days:i is_final:b has_results:b""", f"""
SELECT d.*, r.v AS results, coalesce(r.n, 0) AS result_count, p.v AS performers, c.v AS categories, m.v AS media, f.v AS presented_forms,
 b.v AS based_on, date_diff('day', CAST(issued_datetime AS DATE), {TODAY}) AS report_age_days,
 status IN ('final', 'amended', 'corrected', 'appended') AS is_final, coalesce(r.n, 0) > 0 AS has_results
FROM diagnostic_reports d LEFT JOIN {_ids('diagnostic_report_results', 'observation_id')} r ON d.{_RKEY} = r.{_RKEY}
LEFT JOIN {sorted_items('diagnostic_report_performers', _RKEY, *clean(*prefixed('performer', 'id', 'type')), distinct=True)} p ON d.{_RKEY} = p.{_RKEY}
LEFT JOIN {sorted_items('diagnostic_report_categories', _RKEY, *clean(*prefixed('category', 'code', 'system', 'display')), distinct=True)} c ON d.{_RKEY} = c.{_RKEY}
LEFT JOIN {_ids('diagnostic_report_media', 'media_id')} m ON d.{_RKEY} = m.{_RKEY}
LEFT JOIN {sorted_items('diagnostic_report_presented_forms', _RKEY, *clean('title', 'content_type', 'data'))} f ON d.{_RKEY} = f.{_RKEY}
LEFT JOIN {_ids('diagnostic_report_based_on', 'service_request_id')} b ON d.{_RKEY} = b.{_RKEY}""")

_DKEY = "document_reference_id"
fact("fact_document_references", own("document_references", "meta_type") + """ content authors categories identifiers
  document_age_days:i category_count has_content:b identifier_count""", f"""
SELECT d.* EXCLUDE (meta_type), c.v AS content, a.v AS authors, k.v AS categories, i.v AS identifiers,
 date_diff('day', CAST(date AS DATE), {TODAY}) AS document_age_days, coalesce(kc.n, 0) AS category_count, coalesce(c.n, 0) > 0 AS has_content,
 coalesce(ic.n, 0) AS identifier_count
FROM document_references d
LEFT JOIN {sorted_items('document_reference_content', _DKEY, 'attachment_content_type', 'attachment_url', distinct=True)} c ON d.{_DKEY} = c.{_DKEY}
LEFT JOIN {sorted_items('document_reference_authors', _DKEY, 'author_id', distinct=True)} a ON d.{_DKEY} = a.{_DKEY}
LEFT JOIN {sorted_items('document_reference_categories', _DKEY, *prefixed('category', 'system', 'code', 'display'), distinct=True)} k ON d.{_DKEY} = k.{_DKEY}
LEFT JOIN {sorted_items('document_reference_identifiers', _DKEY, 'identifier_system', 'identifier_value', distinct=True)} i ON d.{_DKEY} = i.{_DKEY}
LEFT JOIN (SELECT {_DKEY}, count(DISTINCT category_code) AS n FROM document_reference_categories GROUP BY 1) kc ON d.{_DKEY} = kc.{_DKEY}
LEFT JOIN (SELECT {_DKEY}, count(DISTINCT identifier_value) AS n FROM document_reference_identifiers GROUP BY 1) ic ON d.{_DKEY} = ic.{_DKEY}
WHERE status NOT IN ('entered-in-error', 'superseded')""")

_MKEY = "medication_request_id"
_DOSE = prefixed("dosage", "text", "timing_frequency", "timing_period", "timing_period_unit", "route_system", "route_code", "route_display",
                 "dose_value", "dose_unit", "dose_system", "dose_code", "as_needed_boolean")
fact("fact_medication_requests", own("medication_requests") + """ medication_name medication_status medication_code
  medication_primary_code medication_primary_system medication_primary_text dosage_instructions categories notes request_age_days:i
  dosage_instruction_count category_count note_count is_active_request:b""", f"""
SELECT r.*, m.primary_text AS medication_name, m.status AS medication_status, m.code AS medication_code, m.primary_code AS medication_primary_code,
 m.primary_system AS medication_primary_system, m.primary_text AS medication_primary_text, d.v AS dosage_instructions, k.v AS categories,
 n.v AS notes, date_diff('day', CAST(authored_on AS DATE), {TODAY}) AS request_age_days, coalesce(dc.n, 0) AS dosage_instruction_count,
 coalesce(kc.n, 0) AS category_count, coalesce(n.n, 0) AS note_count, r.status IN ('active', 'on-hold', 'unknown') AS is_active_request
FROM medication_requests r LEFT JOIN medications m ON r.medication_id = m.medication_id
LEFT JOIN {sorted_items('medication_request_dosage_instructions', _MKEY, *_DOSE, distinct=True)} d ON r.{_MKEY} = d.{_MKEY}
LEFT JOIN {sorted_items('medication_request_categories', _MKEY, *prefixed('category', 'system', 'code', 'display', 'text'), distinct=True)} k ON r.{_MKEY} = k.{_MKEY}
LEFT JOIN {sorted_items('medication_request_notes', _MKEY, 'note_text')} n ON r.{_MKEY} = n.{_MKEY}
LEFT JOIN (SELECT {_MKEY}, count(DISTINCT dosage_text) AS n FROM medication_request_dosage_instructions GROUP BY 1) dc ON r.{_MKEY} = dc.{_MKEY}
LEFT JOIN (SELECT {_MKEY}, count(DISTINCT category_code) AS n FROM medication_request_categories GROUP BY 1) kc ON r.{_MKEY} = kc.{_MKEY}
WHERE r.status NOT IN ('entered-in-error', 'cancelled')""")

# --- care plans, procedures, allergies --------------------------------------------------

_CKEY = "care_plan_id"
_CHILD = {
    "categories": sorted_items("care_plan_categories", _CKEY, *clean(*prefixed("category", "code", "system", "display", "text"))),
    "goals": sorted_items("care_plan_goals", _CKEY, "goal_id"),
    "care_teams": sorted_items("care_plan_care_teams", _CKEY, "care_team_id"),
    "identifiers": sorted_items("care_plan_identifiers", _CKEY, *clean(*prefixed("identifier", "system", "value"))),
}
fact("fact_care_plans", own("care_plans") + " " + " ".join(_CHILD) + " " + " ".join(f"{c}_count" for c in _CHILD), f"""
SELECT c.*, {', '.join(f"coalesce({n}.v, '') AS {n}, coalesce({n}.n, 0) AS {n}_count" for n in _CHILD)} FROM care_plans c
{' '.join(f'LEFT JOIN {s} {n} ON c.{_CKEY} = {n}.{_CKEY}' for n, s in _CHILD.items())} WHERE status <> 'entered-in-error'""")

_XKEY = "procedure_id"
fact("fact_procedures", own("procedures") + """ code_codings identifiers procedure_age_days:i is_completed:b was_not_performed:b
  code_coding_count identifier_count has_multiple_codes:b primary_code primary_code_system primary_code_display""", f"""
SELECT p.*, c.v AS code_codings, i.v AS identifiers, date_diff('day', CAST(performed_date_time AS DATE), {TODAY}) AS procedure_age_days,
 status = 'completed' AS is_completed, status IN ('not-done', 'cancelled', 'stopped', 'aborted') AS was_not_performed,
 coalesce(cc.n, 0) AS code_coding_count, coalesce(i.n, 0) AS identifier_count, coalesce(cc.n, 0) > 1 AS has_multiple_codes,
 b.code_code AS primary_code, b.code_system AS primary_code_system, b.code_display AS primary_code_display
FROM procedures p LEFT JOIN {sorted_items('procedure_code_codings', _XKEY, *prefixed('code', 'system', 'code', 'display'), distinct=True)} c ON p.{_XKEY} = c.{_XKEY}
LEFT JOIN {sorted_items('procedure_identifiers', _XKEY, *prefixed('identifier', 'system', 'value'), distinct=True)} i ON p.{_XKEY} = i.{_XKEY}
LEFT JOIN (SELECT {_XKEY}, count(DISTINCT code_code) AS n FROM procedure_code_codings GROUP BY 1) cc ON p.{_XKEY} = cc.{_XKEY}
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {_XKEY} ORDER BY code_code, code_system, code_display) AS r FROM procedure_code_codings) b
  ON p.{_XKEY} = b.{_XKEY} AND b.r = 1
WHERE status NOT IN ('not-done', 'cancelled')""")

fact("fact_allergy_intolerance", own("allergy_intolerance") + " is_active:b is_confirmed:b is_high_criticality:b combined_description", """
SELECT *, coalesce(clinical_status_code = 'active', FALSE) AS is_active, coalesce(verification_status_code = 'confirmed', FALSE) AS is_confirmed,
 coalesce(criticality = 'high', FALSE) AS is_high_criticality, coalesce(code_text, code_display, 'Unknown Allergy') AS combined_description
FROM allergy_intolerance""")
