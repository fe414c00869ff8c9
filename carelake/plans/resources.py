"""Flattening rules of the 13 resources: 13 main and 57 child tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.operators.flatten import rule

col = F.col


# --- shared pieces --------------------------------------------------------


def _ref(name: str, resource: str):
    return C.reference_id(col(f"{name}.reference"), resource)


def _patient():
    return {"patient_id": _ref("subject", "Patient")}


def _first(prefix: str, concept, parts=("code", "system", "display")):
    return {f"{prefix}_{p}": C.first_coding(concept, p) for p in parts}


def _coding(prefix: str, coding, parts=("code", "system", "display"), unquote=False):
    out = {f"{prefix}_{p}": coding[p] for p in parts}
    if unquote:
        out[f"{prefix}_code"] = C.strip_quotes(coding["code"])
    return out


def _identifier(item):
    return {"identifier_system": item["system"], "identifier_value": item["value"]}


def _dosage(item):
    dose = F.get(item["doseAndRate"], F.lit(0))["doseQuantity"]
    repeat = item["timing"]["repeat"]
    return {
        "dosage_text": item["text"],
        "dosage_timing_frequency": repeat["frequency"],
        "dosage_timing_period": repeat["period"],
        "dosage_timing_period_unit": repeat["periodUnit"],
        **_first("dosage_route", item["route"]),
        **{f"dosage_dose_{p}": dose[p] for p in ("value", "unit", "system", "code")},
    }


# --- Patient ----------------------------------------------------------------


@rule("Patient", "patients", "patient_id")
def _():
    return {
        "active": col("active"),
        "gender": col("gender"),
        "birth_date": C.parse_date(col("birthDate")),
        "deceased": C.is_present(col("deceasedDateTime")),
        "deceased_date": C.parse_timestamp(col("deceasedDateTime")),
        "resourcetype": F.lit("Patient"),
        **_first("marital_status", col("maritalStatus")),
        "meta_security": C.as_json(col("meta.security")),
        "extensions": C.extensions_json(col("extension")),
    }


@rule("Patient", "patient_names", "patient_id", ["name"], any_of=["family_name", "name_text"])
def _(name):
    return {
        "name_use": name["use"],
        "name_text": name["text"],
        "family_name": name["family"],
        "given_names": C.join_words(name["given"]),
        "prefix": name["prefix"],
        "suffix": name["suffix"],
        "period_start": C.parse_date(name["period"]["start"]),
        "period_end": C.parse_date(name["period"]["end"]),
    }


@rule("Patient", "patient_telecoms", "patient_id", ["telecom"], ["telecom_value"])
def _(telecom):
    return {
        "telecom_system": telecom["system"],
        "telecom_value": telecom["value"],
        "telecom_use": C.default_value(telecom["use"], "home"),
    }


@rule("Patient", "patient_addresses", "patient_id", ["address"], any_of=["city", "address_text"])
def _(address):
    return {
        "address_use": address["use"],
        "address_type": address["type"],
        "address_text": address["text"],
        "address_line": C.as_json(address["line"]),
        **{f: address[f] for f in ("city", "district", "state", "country")},
        "postal_code": address["postalCode"],
        "period_start": C.parse_date(address["period"]["start"]),
        "period_end": C.parse_date(address["period"]["end"]),
    }


@rule("Patient", "patient_contacts", "patient_id", ["contact"], any_of=["contact_name_family", "contact_name_text"])
def _(contact):
    return {
        **_first("contact_relationship", contact["relationship"]),
        "contact_name_text": contact["name"]["text"],
        "contact_name_family": contact["name"]["family"],
        "contact_name_given": C.as_json(contact["name"]["given"]),
        **{f"contact_telecom_{p}": contact["telecom"][p] for p in ("system", "value", "use")},
    }


@rule("Patient", "patient_communications", "patient_id", ["communication"], ["language_code"])
def _(communication):
    return {**_first("language", communication["language"]), "preferred": F.lit(False)}


@rule(
    "Patient", "patient_practitioners", "patient_id", ["generalPractitioner"],
    any_of=["practitioner_id", "practitioner_role_id", "organization_id"],
)
def _(practitioner):
    ids, kind = C.dispatch_reference(
        practitioner["reference"], ("Practitioner", "PractitionerRole", "Organization")
    )
    return {
        "practitioner_id": ids["Practitioner"],
        "practitioner_role_id": ids["PractitionerRole"],
        "organization_id": ids["Organization"],
        "reference_type": kind,
    }


@rule("Patient", "patient_links", "patient_id", ["link"], ["other_patient_id"])
def _(link):
    return {
        "other_patient_id": C.reference_id(link["other"]["reference"], "Patient"),
        "link_type_code": link["type"],
    }


# --- Practitioner -------------------------------------------------------------


@rule("Practitioner", "practitioners", "practitioner_id")
def _():
    return {"resource_type": col("resourceType"), "active": col("active")}


@rule("Practitioner", "practitioner_names", "practitioner_id", ["name"], ["text"])
def _(name):
    return {"text": name["text"], "family": name["family"], "given": C.join_lines(name["given"], " ")}


@rule("Practitioner", "practitioner_telecoms", "practitioner_id", ["telecom"], ["value"])
def _(telecom):
    return {"system": telecom["system"], "value": telecom["value"]}


@rule("Practitioner", "practitioner_addresses", "practitioner_id", ["address"])
def _(address):
    return {
        "line": C.join_lines(address["line"]),
        "city": address["city"],
        "state": address["state"],
        "postal_code": address["postalCode"],
    }


# --- Encounter ----------------------------------------------------------------


@rule("Encounter", "encounters", "encounter_id", required=["patient_id"])
def _():
    return {
        **_patient(),
        "status": col("status"),
        "resourcetype": F.lit("Encounter"),
        "class_code": col("class.code"),
        "class_display": col("class.system"),
        "start_time": C.parse_timestamp(col("period.start")),
        "end_time": C.parse_timestamp(col("period.end")),
        "service_provider_id": _ref("serviceProvider", "Organization"),
    }


@rule("Encounter", "encounter_types", "encounter_id", ["type", "coding"], ["type_code"])
def _(kind, coding):
    return {**_coding("type", coding), "type_text": F.lit("")}


@rule(
    "Encounter", "encounter_participants", "encounter_id", ["participant", "type", "coding"],
    ["participant_type", "participant_id"],
)
def _(participant, kind, coding):
    return {
        "participant_type": coding["code"],
        "participant_id": C.reference_id(participant["individual"]["reference"], "Practitioner"),
        "period_start": C.parse_timestamp(participant["period"]["start"]),
        "period_end": C.parse_timestamp(participant["period"]["end"]),
    }


@rule("Encounter", "encounter_reasons", "encounter_id", ["reasonCode"], ["reason_text"])
def _(reason):
    return {**_first("reason", reason), "reason_text": reason["text"]}


@rule("Encounter", "encounter_locations", "encounter_id", ["location"], ["location_id"])
def _(location):
    return {"location_id": C.reference_id(location["location"]["reference"], "Location")}


@rule(
    "Encounter", "encounter_hospitalization", "encounter_id",
    ["hospitalization.dischargeDisposition.coding"], ["discharge_code"],
)
def _(coding):
    return {
        "discharge_disposition_text": col("hospitalization.dischargeDisposition.text"),
        "discharge_code": coding["code"],
        "discharge_system": coding["system"],
    }


# --- Condition ----------------------------------------------------------------


@rule("Condition", "conditions", "condition_id", required=["patient_id"])
def _():
    return {
        **_patient(),
        "encounter_id": _ref("encounter", "Encounter"),
        **_first("clinical_status", col("clinicalStatus"), ("code", "system")),
        **_first("verification_status", col("verificationStatus"), ("code", "system")),
        "condition_text": col("code.text"),
        **_first("severity", col("severity"), ("code", "system")),
        "onset_datetime": C.parse_timestamp(col("onsetDateTime"), short=True),
        "abatement_datetime": C.parse_timestamp(col("abatementDateTime"), short=True),
        "recorded_date": C.parse_timestamp(col("recordedDate"), short=True),
        "meta_profile": C.as_json(col("meta.profile")),
    }


@rule("Condition", "condition_codes", "condition_id", ["code.coding"], ["code_code"])
def _(coding):
    return {**_coding("code", coding), "code_text": col("code.text")}


@rule("Condition", "condition_categories", "condition_id", ["category", "coding"], ["category_code"])
def _(category, coding):
    return {**_coding("category", coding, ("code", "system")), "category_text": category["text"]}


@rule("Condition", "condition_notes", "condition_id", ["note"], ["note_text"])
def _(note):
    return {
        "note_text": note["text"],
        "note_author_reference": note["authorReference"]["reference"],
        "note_time": F.try_to_timestamp(note["time"], F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
    }


@rule("Condition", "condition_body_sites", "condition_id", ["bodySite", "coding"], ["body_site_code"])
def _(site, coding):
    return {**_coding("body_site", coding, ("code", "system")), "body_site_text": site["text"]}


@rule("Condition", "condition_stages", "condition_id", ["stage"], ["stage_assessment_code"])
def _(stage):
    return {"stage_assessment_code": stage["assessment"]["reference"]}


@rule("Condition", "condition_evidence", "condition_id", ["evidence", "code.coding"], ["evidence_code"])
def _(evidence, coding):
    return _coding("evidence", coding, ("code", "system"))


@rule("Condition", "condition_extensions", "condition_id", [lambda: C.all_extensions(col("extension"))])
def _(extension):
    return {
        "extension_url": extension["url"],
        "extension_type": F.when(extension["nested"], F.lit("nested")).otherwise(F.lit("simple")),
        "value_type": C.value_kind(extension),
        "value_string": extension["valueString"],
        "value_datetime": C.parse_timestamp(extension["valueDateTime"], dates=True),
        "value_reference": extension["valueReference"],
        "value_code": extension["valueCode"],
        "value_boolean": extension["valueBoolean"],
        "value_decimal": extension["valueDecimal"],
        "value_integer": extension["valueInteger"],
        "parent_extension_url": extension["parent"],
        "extension_order": extension["position"],
    }


# --- Observation --------------------------------------------------------------


@rule("Observation", "observations", "observation_id", required=["patient_id"])
def _():
    value = col("valueCodeableConcept")
    return {
        **_patient(),
        "encounter_id": _ref("encounter", "Encounter"),
        "specimen_id": _ref("specimen", "Specimen"),
        "status": col("status"),
        "observation_text": col("code.text"),
        "value_string": col("valueString"),
        **{f"value_quantity_{p}": col(f"valueQuantity.{p}") for p in ("value", "unit", "system")},
        **_first("value_codeable_concept", value),
        "value_codeable_concept_text": value["text"],
        "value_datetime": C.parse_timestamp(col("valueDateTime")),
        **_first("data_absent_reason", col("dataAbsentReason")),
        "effective_datetime": C.parse_timestamp(col("effectiveDateTime"), short=True),
        "effective_period_start": C.parse_timestamp(col("effectivePeriod.start"), short=True),
        "issued": C.parse_timestamp(col("issued"), short=True),
        "meta_security": C.as_json(col("meta.security")),
        "extensions": C.extensions_json(col("extension")),
        "derived_from": F.transform(
            col("derivedFrom"),
            lambda d: F.struct(*[d[p].alias(p) for p in ("reference", "display", "type")]),
        ),
    }


@rule("Observation", "observation_codes", "observation_id", ["code.coding"], ["code_code", "patient_id"])
def _(coding):
    return {**_patient(), **_coding("code", coding, unquote=True), "code_text": col("code.text")}


@rule(
    "Observation", "observation_categories", "observation_id", ["category", "coding"],
    ["category_code", "patient_id"],
)
def _(category, coding):
    return {**_patient(), **_coding("category", coding, unquote=True), "category_text": category["text"]}


@rule(
    "Observation", "observation_interpretations", "observation_id", ["interpretation", "coding"],
    ["interpretation_code", "patient_id"],
)
def _(interpretation, coding):
    return {
        **_patient(),
        **_coding("interpretation", coding, unquote=True),
        "interpretation_text": interpretation["text"],
    }


@rule(
    "Observation", "observation_reference_ranges", "observation_id", ["referenceRange"], ["patient_id"],
    any_of=["range_text", "range_low_value", "range_high_value"],
)
def _(item):
    return {
        **_patient(),
        "range_low_value": C.numeric_value(item["low"]["value"]),
        "range_low_unit": item["low"]["unit"],
        "range_high_value": C.numeric_value(item["high"]["value"]),
        "range_high_unit": item["high"]["unit"],
        **_first("range_type", item["type"], ("code", "system")),
        "range_type_display": F.coalesce(C.first_coding(item["type"], "display"), item["type"]["text"]),
        "range_text": item["text"],
    }


def observation_component(item, coding, dated_system: str | None = None):
    """Component columns; codes of ``dated_system`` carry their value as a date-time.

    With no system given, a component with no text value falls back to its
    date-time value.
    """
    if dated_system is None:
        text = F.coalesce(item["valueString"], item["valueDateTime"])
    else:
        text = F.when(coding["system"] == dated_system, item["valueDateTime"]).otherwise(item["valueString"])
    return {
        **_patient(),
        **_coding("component", coding, unquote=True),
        "component_text": item["code"]["text"],
        "component_value_string": text,
        "component_value_quantity_value": item["valueQuantity"]["value"],
        "component_value_quantity_unit": item["valueQuantity"]["unit"],
        **_first("component_value_codeable_concept", item["valueCodeableConcept"]),
        **_first("component_data_absent_reason", item["dataAbsentReason"], ("code", "display")),
    }


rule(
    "Observation", "observation_components", "observation_id", ["component", "code.coding"],
    ["component_code", "patient_id"],
)(observation_component)


@rule("Observation", "observation_notes", "observation_id", ["note"], ["note_text", "patient_id"])
def _(note):
    return {**_patient(), "note_text": note["text"]}


@rule("Observation", "observation_performers", "observation_id", ["performer"], ["performer_id", "patient_id"])
def _(performer):
    return {
        **_patient(),
        "performer_type": C.reference_type(performer["reference"]),
        "performer_id": C.reference_any_id(performer["reference"]),
    }


@rule(
    "Observation", "observation_members", "observation_id", ["hasMember"],
    ["member_observation_id", "patient_id"],
)
def _(member):
    return {**_patient(), "member_observation_id": C.reference_id(member["reference"], "Observation")}


@rule("Observation", "observation_derived_from", "observation_id", ["derivedFrom"], ["reference", "patient_id"])
def _(source):
    return {
        **_patient(),
        "reference": source["reference"],
        "reference_type": F.coalesce(C.reference_type(source["reference"]), source["type"]),
        "reference_id": C.reference_any_id(source["reference"]),
        "display": source["display"],
    }


# --- DiagnosticReport ---------------------------------------------------------


@rule("DiagnosticReport", "diagnostic_reports", "diagnostic_report_id", required=["patient_id"])
def _():
    return {
        "resource_type": col("resourceType"),
        "status": col("status"),
        "effective_datetime": C.parse_timestamp(col("effectiveDateTime"), dates=True),
        "issued_datetime": C.parse_timestamp(col("issued")),
        "code_text": col("code.text"),
        **_first("code_primary", col("code")),
        **_patient(),
        "encounter_id": _ref("encounter", "Encounter"),
        "extensions": C.extensions_json(col("extension")),
    }


@rule(
    "DiagnosticReport", "diagnostic_report_categories", "diagnostic_report_id", ["category", "coding"],
    ["category_code"],
)
def _(category, coding):
    return _coding("category", coding)


@rule(
    "DiagnosticReport", "diagnostic_report_performers", "diagnostic_report_id", ["performer"],
    ["performer_type", "performer_id"],
)
def _(performer):
    return {
        "performer_type": C.reference_type(performer["reference"]),
        "performer_id": C.reference_any_id(performer["reference"]),
    }


def _link(table: str, path: str, column: str, resource: str, get=lambda item: item["reference"]):
    rule("DiagnosticReport", table, "diagnostic_report_id", [path], [column])(
        lambda item: {column: C.reference_id(get(item), resource)}
    )


_link("diagnostic_report_based_on", "basedOn", "service_request_id", "ServiceRequest")
_link("diagnostic_report_results", "result", "observation_id", "Observation")
_link("diagnostic_report_media", "media", "media_id", "Media", lambda item: item["link"]["reference"])


@rule(
    "DiagnosticReport", "diagnostic_report_presented_forms", "diagnostic_report_id", ["presentedForm"],
    any_of=["content_type", "data"],
)
def _(form):
    return {"content_type": form["contentType"], "data": form["data"], "title": form["title"]}


# --- DocumentReference ----------------------------------------------------------


@rule("DocumentReference", "document_references", "document_reference_id", required=["patient_id"])
def _():
    kind = col("type")
    return {
        **_patient(),
        "status": col("status"),
        **_first("type", kind),
        "meta_type": C.document_class(C.first_coding(kind, "code"), C.first_coding(kind, "system")),
        "date": C.parse_timestamp(col("date"), dates=True),
        "custodian_id": _ref("custodian", "Organization"),
        "description": col("description"),
        "context_period_start": C.parse_timestamp(col("context.period.start")),
        "context_period_end": C.parse_timestamp(col("context.period.end")),
    }


@rule(
    "DocumentReference", "document_reference_identifiers", "document_reference_id", ["identifier"],
    ["identifier_value"],
)
def _(identifier):
    return _identifier(identifier)


@rule(
    "DocumentReference", "document_reference_categories", "document_reference_id", ["category", "coding"],
    ["category_code"],
)
def _(category, coding):
    return _coding("category", coding)


@rule("DocumentReference", "document_reference_authors", "document_reference_id", ["author"], ["author_id"])
def _(author):
    return {"author_id": C.reference_id(author["reference"], "Practitioner")}


@rule(
    "DocumentReference", "document_reference_content", "document_reference_id", ["content"],
    ["attachment_url"], positions=True,
)
def _(content, position):
    attachment = content["attachment"]
    return {
        "attachment_content_type": attachment["contentType"],
        "attachment_url": C.attachment_location(attachment["url"], attachment["data"], position),
    }


# --- Medication -----------------------------------------------------------------


@rule("Medication", "medications", "medication_id")
def _():
    coding = col("code.coding")
    return {
        "resource_type": col("resourceType"),
        "code": F.when(F.size(coding) > 0, C.as_json(coding)).otherwise(F.lit("null")),
        **_first("primary", col("code"), ("code", "system")),
        "primary_text": col("code.text"),
        "status": col("status"),
    }


@rule("Medication", "medication_identifiers", "medication_id", ["identifier"], ["identifier_value"])
def _(identifier):
    return _identifier(identifier)


# --- MedicationRequest ------------------------------------------------------------


@rule("MedicationRequest", "medication_requests", "medication_request_id", required=["patient_id"])
def _():
    return {
        **_patient(),
        "encounter_id": _ref("encounter", "Encounter"),
        "medication_id": _ref("medicationReference", "Medication"),
        "medication_display": col("medicationReference.display"),
        "status": col("status"),
        "intent": col("intent"),
        "reported_boolean": col("reportedBoolean"),
        "authored_on": C.parse_timestamp(col("authoredOn")),
    }


@rule(
    "MedicationRequest", "medication_request_identifiers", "medication_request_id", ["identifier"],
    ["identifier_value"],
)
def _(identifier):
    return _identifier(identifier)


@rule("MedicationRequest", "medication_request_notes", "medication_request_id", ["note"], ["note_text"])
def _(note):
    return {"note_text": note["text"]}


@rule(
    "MedicationRequest", "medication_request_dosage_instructions", "medication_request_id",
    ["dosageInstruction"], ["dosage_text"],
)
def _(dosage):
    return {**_dosage(dosage), "dosage_as_needed_boolean": dosage["asNeededBoolean"]}


@rule(
    "MedicationRequest", "medication_request_categories", "medication_request_id", ["category", "coding"],
    ["category_code"],
)
def _(category, coding):
    return {**_coding("category", coding), "category_text": category["text"]}


# --- MedicationDispense -------------------------------------------------------------


@rule("MedicationDispense", "medication_dispenses", "medication_dispense_id", required=["patient_id"])
def _():
    return {
        "resource_type": col("resourceType"),
        "status": col("status"),
        **_patient(),
        "medication_id": _ref("medicationReference", "Medication"),
        "medication_display": col("medicationReference.display"),
        **_first("type", col("type")),
        "quantity_value": col("quantity.value"),
        "when_handed_over": C.parse_timestamp(col("whenHandedOver")),
    }


@rule(
    "MedicationDispense", "medication_dispense_identifiers", "medication_dispense_id", ["identifier"],
    ["identifier_value"],
)
def _(identifier):
    return {"identifier_value": identifier["value"]}


@rule(
    "MedicationDispense", "medication_dispense_performers", "medication_dispense_id", ["performer"],
    ["performer_actor_reference"],
)
def _(performer):
    return {"performer_actor_reference": performer["actor"]["reference"]}


@rule(
    "MedicationDispense", "medication_dispense_auth_prescriptions", "medication_dispense_id",
    ["authorizingPrescription"], ["authorizing_prescription_id"],
)
def _(prescription):
    return {"authorizing_prescription_id": C.reference_id(prescription["reference"], "MedicationRequest")}


@rule(
    "MedicationDispense", "medication_dispense_dosage_instructions", "medication_dispense_id",
    ["dosageInstruction"], any_of=["dosage_text", "dosage_dose_value"],
)
def _(dosage):
    return _dosage(dosage)


# --- CarePlan -------------------------------------------------------------------


@rule("CarePlan", "care_plans", "care_plan_id", required=["patient_id"])
def _():
    return {**_patient(), **{c: col(c) for c in ("status", "intent", "title")}}


@rule("CarePlan", "care_plan_identifiers", "care_plan_id", ["identifier"], ["identifier_value"])
def _(identifier):
    return {"identifier_value": identifier["value"]}


@rule("CarePlan", "care_plan_categories", "care_plan_id", ["category", "coding"], ["category_code"])
def _(category, coding):
    return _coding("category", coding, ("code", "system"))


@rule("CarePlan", "care_plan_care_teams", "care_plan_id", ["careTeam"], ["care_team_id"])
def _(team):
    return {"care_team_id": C.reference_id(team["reference"], "CareTeam")}


@rule("CarePlan", "care_plan_goals", "care_plan_id", ["goal"], ["goal_id"])
def _(goal):
    return {"goal_id": C.reference_id(goal["reference"], "Goal")}


# --- AllergyIntolerance -----------------------------------------------------------


@rule("AllergyIntolerance", "allergy_intolerance", "allergy_intolerance_id")
def _():
    return {
        "resourcetype": F.lit("AllergyIntolerance"),
        **_first("clinical_status", col("clinicalStatus")),
        **_first("verification_status", col("verificationStatus")),
        "type": col("type"),
        "category": C.as_json(col("category")),
        "criticality": col("criticality"),
        "code": C.first_coding(col("code"), "code"),
        "code_display": C.first_coding(col("code"), "display"),
        "code_system": C.first_coding(col("code"), "system"),
        "code_text": col("code.text"),
        "patient_id": _ref("patient", "Patient"),
        "encounter_id": _ref("encounter", "Encounter"),
        "onset_datetime": C.parse_timestamp(col("onsetDateTime")),
        "onset_age_value": col("onsetAge.value"),
        "onset_age_unit": col("onsetAge.unit"),
        "onset_period_start": C.date_prefix(col("onsetPeriod.start")),
        "onset_period_end": C.date_prefix(col("onsetPeriod.end")),
        "recorded_date": C.parse_timestamp(col("recordedDate")),
        "recorder_practitioner_id": _ref("recorder", "Practitioner"),
        "asserter_practitioner_id": _ref("asserter", "Practitioner"),
        "last_occurrence": C.parse_timestamp(col("lastOccurrence")),
        "note": C.as_json(col("note")),
        "reactions": C.as_json(col("reaction")),
        "meta_source": col("meta.source"),
        "meta_security": C.as_json(col("meta.security")),
        "meta_tag": C.as_json(col("meta.tag")),
        "extensions": C.extensions_json(col("extension")),
    }


@rule(
    "AllergyIntolerance", "allergy_intolerance_identifiers", "allergy_intolerance_id", ["identifier"],
    ["identifier_value"],
)
def _(identifier):
    return {
        "identifier_use": identifier["use"],
        **_first("identifier_type", identifier["type"], ("code", "display")),
        **_identifier(identifier),
        "identifier_period_start": C.parse_date(identifier["period"]["start"]),
        "identifier_period_end": C.parse_date(identifier["period"]["end"]),
    }


# --- Procedure --------------------------------------------------------------------


@rule("Procedure", "procedures", "procedure_id", required=["patient_id"])
def _():
    return {
        "resource_type": col("resourceType"),
        "status": col("status"),
        **_patient(),
        "code_text": col("code.text"),
        "performed_date_time": C.parse_timestamp(col("performedDateTime"), dates=True, short=True),
    }


@rule("Procedure", "procedure_identifiers", "procedure_id", ["identifier"], ["identifier_value"])
def _(identifier):
    return _identifier(identifier)


@rule("Procedure", "procedure_code_codings", "procedure_id", ["code.coding"], ["code_code"])
def _(coding):
    return _coding("code", coding)
