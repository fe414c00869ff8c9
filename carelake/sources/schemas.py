"""Schemas: FHIR datatypes, the 13 nested resources and the 70 flat tables.

Everything is declared as Spark DDL text and parsed on first use.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import StructType, _parse_datatype_string

# --- FHIR datatypes -------------------------------------------------------

CODING = "struct<system:string,code:string,display:string>"
CONCEPT = f"struct<coding:array<{CODING}>,text:string>"
REFERENCE = "struct<reference:string,display:string,type:string>"
QUANTITY = "struct<value:decimal(15,4),unit:string,system:string,code:string>"
PERIOD = "struct<start:string,end:string>"
IDENTIFIER = f"struct<use:string,type:{CONCEPT},system:string,value:string,period:{PERIOD}>"


# Extension is recursive in FHIR.  What lies below an extension is kept as JSON text,
# whatever its depth (a string field takes the text of a JSON list as it is).
EXTENSION = (
    "struct<url:string,valueString:string,valueDateTime:string,valueCode:string,"
    "valueBoolean:boolean,valueDecimal:decimal(18,6),valueInteger:int,"
    f"valueQuantity:{QUANTITY},valueReference:{REFERENCE},valueCodeableConcept:{CONCEPT},extension:string>"
)
META = (
    "struct<lastUpdated:string,source:string,profile:array<string>,"
    f"security:array<{CODING}>,tag:array<{CODING}>>"
)
NAME = (
    "struct<use:string,text:string,family:string,given:array<string>,"
    f"prefix:string,suffix:string,period:{PERIOD}>"
)
TELECOM = "struct<system:string,value:string,use:string>"
ADDRESS = (
    "struct<use:string,type:string,text:string,line:array<string>,city:string,district:string,"
    f"state:string,postalCode:string,country:string,period:{PERIOD}>"
)
DERIVED = f"struct<reference:string,display:string,type:string,extension:array<{EXTENSION}>>"
DOSAGE = (
    "struct<text:string,timing:struct<repeat:struct<frequency:int,period:int,periodUnit:string>>,"
    f"route:{CONCEPT},doseAndRate:array<struct<doseQuantity:{QUANTITY}>>,asNeededBoolean:boolean>"
)

_COMMON = f"id string, resourceType string, meta {META}, isDelete boolean, "

# --- nested resources (job inputs) -------------------------------------------

RESOURCES = {
    "Patient": f"""active boolean, gender string, birthDate string, deceasedDateTime string,
        maritalStatus {CONCEPT}, name array<{NAME}>, telecom array<{TELECOM}>, address array<{ADDRESS}>,
        contact array<struct<relationship:{CONCEPT},name:{NAME},telecom:{TELECOM}>>,
        communication array<struct<language:{CONCEPT}>>, generalPractitioner array<{REFERENCE}>,
        link array<struct<other:{REFERENCE},type:string>>, extension array<{EXTENSION}>""",
    "Practitioner": f"active boolean, name array<{NAME}>, telecom array<{TELECOM}>, address array<{ADDRESS}>",
    "Encounter": f"""status string, class {CODING}, subject {REFERENCE}, period {PERIOD},
        serviceProvider {REFERENCE}, type array<{CONCEPT}>,
        participant array<struct<type:array<{CONCEPT}>,period:{PERIOD},individual:{REFERENCE}>>,
        reasonCode array<{CONCEPT}>, location array<struct<location:{REFERENCE}>>,
        hospitalization struct<dischargeDisposition:{CONCEPT}>""",
    "Condition": f"""subject {REFERENCE}, encounter {REFERENCE}, clinicalStatus {CONCEPT},
        verificationStatus {CONCEPT}, severity {CONCEPT}, code {CONCEPT}, category array<{CONCEPT}>,
        bodySite array<{CONCEPT}>, onsetDateTime string, abatementDateTime string, recordedDate string,
        note array<struct<text:string,authorReference:{REFERENCE},time:string>>,
        stage array<struct<summary:{CONCEPT},assessment:{REFERENCE},type:{CONCEPT}>>,
        evidence array<struct<code:{CONCEPT},detail:array<{REFERENCE}>>>, extension array<{EXTENSION}>""",
    "Observation": f"""status string, subject {REFERENCE}, encounter {REFERENCE}, specimen {REFERENCE},
        code {CONCEPT}, category array<{CONCEPT}>, valueString string, valueQuantity {QUANTITY},
        valueCodeableConcept {CONCEPT}, valueDateTime string, dataAbsentReason {CONCEPT},
        effectiveDateTime string, effectivePeriod {PERIOD}, issued string, interpretation array<{CONCEPT}>,
        referenceRange array<struct<low:{QUANTITY},high:{QUANTITY},type:{CONCEPT},text:string>>,
        component array<struct<code:{CONCEPT},valueString:string,valueDateTime:string,
            valueQuantity:{QUANTITY},valueCodeableConcept:{CONCEPT},dataAbsentReason:{CONCEPT}>>,
        note array<struct<text:string>>, performer array<{REFERENCE}>, hasMember array<{REFERENCE}>,
        derivedFrom array<{DERIVED}>, extension array<{EXTENSION}>""",
    "DiagnosticReport": f"""status string, code {CONCEPT}, subject {REFERENCE}, encounter {REFERENCE},
        effectiveDateTime string, issued string, category array<{CONCEPT}>, performer array<{REFERENCE}>,
        basedOn array<{REFERENCE}>, result array<{REFERENCE}>, media array<struct<link:{REFERENCE}>>,
        presentedForm array<struct<contentType:string,data:string,title:string>>, extension array<{EXTENSION}>""",
    "DocumentReference": f"""status string, type {CONCEPT}, subject {REFERENCE}, date string,
        custodian {REFERENCE}, description string, context struct<period:{PERIOD}>,
        identifier array<{IDENTIFIER}>, category array<{CONCEPT}>, author array<{REFERENCE}>,
        content array<struct<attachment:struct<contentType:string,url:string,data:string>>>""",
    "Medication": f"code {CONCEPT}, status string, identifier array<{IDENTIFIER}>",
    "MedicationRequest": f"""subject {REFERENCE}, encounter {REFERENCE}, medicationReference {REFERENCE},
        status string, intent string, reportedBoolean boolean, authoredOn string,
        identifier array<{IDENTIFIER}>, note array<struct<text:string>>, category array<{CONCEPT}>,
        dosageInstruction array<{DOSAGE}>""",
    "MedicationDispense": f"""status string, subject {REFERENCE}, medicationReference {REFERENCE},
        type {CONCEPT}, quantity {QUANTITY}, whenHandedOver string, identifier array<{IDENTIFIER}>,
        performer array<struct<actor:{REFERENCE}>>, authorizingPrescription array<{REFERENCE}>,
        dosageInstruction array<{DOSAGE}>""",
    "CarePlan": f"""subject {REFERENCE}, status string, intent string, title string,
        identifier array<{IDENTIFIER}>, category array<{CONCEPT}>, careTeam array<{REFERENCE}>,
        goal array<{REFERENCE}>""",
    "AllergyIntolerance": f"""clinicalStatus {CONCEPT}, verificationStatus {CONCEPT}, type string,
        category array<string>, criticality string, code {CONCEPT}, patient {REFERENCE},
        encounter {REFERENCE}, onsetDateTime string, onsetAge {QUANTITY}, onsetPeriod {PERIOD},
        recordedDate string, recorder {REFERENCE}, asserter {REFERENCE}, lastOccurrence string,
        note array<struct<text:string>>,
        reaction array<struct<description:string,severity:string,manifestation:array<{CONCEPT}>>>,
        identifier array<{IDENTIFIER}>, extension array<{EXTENSION}>""",
    "Procedure": f"""status string, subject {REFERENCE}, code {CONCEPT}, performedDateTime string,
        identifier array<{IDENTIFIER}>""",
}

# --- flat tables (job outputs) ------------------------------------------------
# Column names and types of the relational model.


def _s(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


_TS = "meta_last_updated timestamp"
_AUDIT = "created_at timestamp, updated_at timestamp"
_DOSE_COLUMNS = (
    "dosage_text string, dosage_timing_frequency int, dosage_timing_period int, "
    + _s("dosage_timing_period_unit dosage_route_code dosage_route_system dosage_route_display")
    + ", dosage_dose_value decimal(10,2), "
    + _s("dosage_dose_unit dosage_dose_system dosage_dose_code")
)

TABLES = {
    "patients": f"""patient_id string, active boolean, gender string, birth_date date, deceased boolean,
        deceased_date timestamp, {_s('resourcetype marital_status_code marital_status_display marital_status_system')},
        multiple_birth boolean, birth_order int, {_s('managing_organization_id photos')}, {_TS},
        {_s('meta_source meta_security meta_tag extensions')}, {_AUDIT}""",
    "patient_names": f"""patient_id string, {_TS}, {_s('name_use name_text family_name given_names prefix suffix')},
        period_start date, period_end date""",
    "patient_telecoms": f"""patient_id string, {_TS}, {_s('telecom_system telecom_value telecom_use')},
        telecom_rank int, period_start date, period_end date""",
    "patient_addresses": f"""patient_id string, {_TS},
        {_s('address_use address_type address_text address_line city district state postal_code country')},
        period_start date, period_end date""",
    "patient_contacts": f"""patient_id string, {_TS}, {_s('contact_relationship_code contact_relationship_system '
        'contact_relationship_display contact_name_text contact_name_family contact_name_given '
        'contact_telecom_system contact_telecom_value contact_telecom_use contact_gender contact_organization_id')},
        period_start date, period_end date""",
    "patient_communications": f"""patient_id string, {_TS}, {_s('language_code language_system language_display')},
        preferred boolean, extensions string""",
    "patient_practitioners": f"""patient_id string, {_TS},
        {_s('practitioner_id practitioner_role_id organization_id reference_type')}""",
    "patient_links": f"""patient_id string, {_TS},
        {_s('other_patient_id link_type_code link_type_system link_type_display')}""",
    "practitioners": f"practitioner_id string, resource_type string, active boolean, {_TS}, {_AUDIT}",
    "practitioner_names": f"practitioner_id string, {_TS}, {_s('text family given')}",
    "practitioner_telecoms": f"practitioner_id string, {_TS}, {_s('system value')}",
    "practitioner_addresses": f"practitioner_id string, {_TS}, {_s('line city state postal_code')}",
    "encounters": f"""{_s('encounter_id patient_id status resourcetype class_code class_display')},
        start_time timestamp, end_time timestamp,
        {_s('service_provider_id appointment_id parent_encounter_id')}, {_TS}, {_AUDIT}""",
    "encounter_types": f"encounter_id string, {_TS}, {_s('type_code type_system type_display type_text')}",
    "encounter_participants": f"""encounter_id string, {_TS},
        {_s('participant_type participant_id participant_display')}, period_start timestamp, period_end timestamp""",
    "encounter_reasons": f"encounter_id string, {_TS}, {_s('reason_code reason_system reason_display reason_text')}",
    "encounter_locations": f"encounter_id string, {_TS}, location_id string",
    "encounter_hospitalization": f"""encounter_id string, {_TS},
        {_s('discharge_disposition_text discharge_code discharge_system')}""",
    "conditions": f"""{_s('condition_id patient_id encounter_id clinical_status_code clinical_status_display '
        'clinical_status_system verification_status_code verification_status_display verification_status_system '
        'condition_text severity_code severity_display severity_system')},
        onset_datetime timestamp, onset_age_value decimal(10,2), onset_age_unit string,
        onset_period_start timestamp, onset_period_end timestamp, onset_text string,
        abatement_datetime timestamp, abatement_age_value decimal(10,2), abatement_age_unit string,
        abatement_period_start timestamp, abatement_period_end timestamp, abatement_text string,
        abatement_boolean boolean, recorded_date timestamp,
        {_s('recorder_type recorder_id asserter_type asserter_id')}, {_TS},
        {_s('meta_source meta_profile meta_security meta_tag')}, {_AUDIT}""",
    "condition_codes": f"condition_id string, {_TS}, {_s('code_code code_system code_display code_text')}",
    "condition_categories": f"""condition_id string, {_TS},
        {_s('category_code category_system category_display category_text')}""",
    "condition_notes": f"condition_id string, {_TS}, {_s('note_text note_author_reference')}, note_time timestamp",
    "condition_body_sites": f"""condition_id string, {_TS},
        {_s('body_site_code body_site_system body_site_display body_site_text')}""",
    "condition_stages": f"""condition_id string, {_TS}, {_s('stage_summary_code stage_summary_system '
        'stage_summary_display stage_assessment_code stage_assessment_system stage_assessment_display '
        'stage_type_code stage_type_system stage_type_display')}""",
    "condition_evidence": f"""condition_id string, {_TS},
        {_s('evidence_code evidence_system evidence_display evidence_detail_reference')}""",
    "condition_extensions": f"""condition_id string, {_TS}, {_s('extension_url extension_type value_type value_string')},
        value_datetime timestamp, {_s('value_reference value_code')}, value_boolean boolean,
        value_decimal decimal(18,6), value_integer int, parent_extension_url string, extension_order int, {_AUDIT}""",
    "observations": f"""{_s('observation_id patient_id encounter_id specimen_id status observation_text value_string')},
        value_quantity_value decimal(15,4), {_s('value_quantity_unit value_quantity_system '
        'value_codeable_concept_code value_codeable_concept_system value_codeable_concept_display '
        'value_codeable_concept_text')}, value_datetime timestamp, value_boolean boolean,
        {_s('data_absent_reason_code data_absent_reason_display data_absent_reason_system')},
        effective_datetime timestamp, effective_period_start timestamp, effective_period_end timestamp,
        issued timestamp, {_s('body_site_code body_site_system body_site_display body_site_text '
        'method_code method_system method_display method_text')}, {_TS},
        {_s('meta_source meta_profile meta_security meta_tag extensions')},
        derived_from array<{REFERENCE}>, {_AUDIT}""",
    "observation_codes": _s("observation_id patient_id code_code code_system code_display code_text"),
    "observation_categories": _s("observation_id patient_id category_code category_system category_display category_text"),
    "observation_interpretations": _s(
        "observation_id patient_id interpretation_code interpretation_system interpretation_display interpretation_text"
    ),
    "observation_reference_ranges": f"""{_s('observation_id patient_id')}, range_low_value decimal(15,4),
        range_low_unit string, range_high_value decimal(15,4),
        {_s('range_high_unit range_type_code range_type_system range_type_display range_text')}""",
    "observation_components": f"""{_s('observation_id patient_id component_code component_system component_display '
        'component_text component_value_string')}, component_value_quantity_value decimal(15,4),
        {_s('component_value_quantity_unit component_value_codeable_concept_code '
        'component_value_codeable_concept_system component_value_codeable_concept_display '
        'component_data_absent_reason_code component_data_absent_reason_display')}""",
    "observation_notes": f"{_s('observation_id patient_id note_text note_author_reference')}, note_time timestamp",
    "observation_performers": _s("observation_id patient_id performer_type performer_id"),
    "observation_members": _s("observation_id patient_id member_observation_id"),
    "observation_derived_from": f"""{_s('observation_id patient_id reference reference_type reference_id display')},
        {_AUDIT}""",
    "diagnostic_reports": f"""{_s('diagnostic_report_id resource_type status')}, effective_datetime timestamp,
        issued_datetime timestamp, {_s('code_text code_primary_code code_primary_system code_primary_display '
        'patient_id encounter_id')}, {_TS}, extensions string, {_AUDIT}""",
    "diagnostic_report_categories": _s("diagnostic_report_id category_code category_system category_display"),
    "diagnostic_report_performers": _s("diagnostic_report_id performer_type performer_id"),
    "diagnostic_report_based_on": _s("diagnostic_report_id service_request_id"),
    "diagnostic_report_results": _s("diagnostic_report_id observation_id"),
    "diagnostic_report_media": _s("diagnostic_report_id media_id"),
    "diagnostic_report_presented_forms": _s("diagnostic_report_id content_type data title"),
    "document_references": f"""{_s('document_reference_id patient_id status type_code type_system type_display '
        'meta_type')}, date timestamp, {_s('custodian_id description')}, context_period_start timestamp,
        context_period_end timestamp, {_TS}, {_AUDIT}""",
    "document_reference_identifiers": f"document_reference_id string, {_TS}, {_s('identifier_system identifier_value')}",
    "document_reference_categories": f"""document_reference_id string, {_TS},
        {_s('category_code category_system category_display')}""",
    "document_reference_authors": f"document_reference_id string, {_TS}, author_id string",
    "document_reference_content": f"""document_reference_id string, {_TS},
        {_s('attachment_content_type attachment_url')}""",
    "medications": f"""{_s('medication_id resource_type code_text code primary_code primary_system primary_text status')},
        {_TS}, {_AUDIT}""",
    "medication_identifiers": _s("medication_id identifier_system identifier_value"),
    "medication_requests": f"""{_s('medication_request_id patient_id encounter_id medication_id medication_display '
        'status intent')}, reported_boolean boolean, authored_on timestamp, {_TS}, {_AUDIT}""",
    "medication_request_identifiers": _s("medication_request_id identifier_system identifier_value"),
    "medication_request_notes": _s("medication_request_id note_text"),
    "medication_request_dosage_instructions": f"""medication_request_id string, {_DOSE_COLUMNS},
        dosage_as_needed_boolean boolean""",
    "medication_request_categories": _s(
        "medication_request_id category_code category_system category_display category_text"
    ),
    "medication_dispenses": f"""{_s('medication_dispense_id resource_type status patient_id medication_id '
        'medication_display type_system type_code type_display')}, quantity_value decimal(10,2),
        when_handed_over timestamp, {_TS}, {_AUDIT}""",
    "medication_dispense_identifiers": f"medication_dispense_id string, {_TS}, {_s('identifier_system identifier_value')}",
    "medication_dispense_performers": f"medication_dispense_id string, {_TS}, performer_actor_reference string",
    "medication_dispense_auth_prescriptions": f"medication_dispense_id string, {_TS}, authorizing_prescription_id string",
    "medication_dispense_dosage_instructions": f"medication_dispense_id string, {_TS}, {_DOSE_COLUMNS}",
    "care_plans": f"{_s('care_plan_id patient_id status intent title')}, {_TS}, {_AUDIT}",
    "care_plan_identifiers": _s("care_plan_id identifier_system identifier_value"),
    "care_plan_categories": _s("care_plan_id category_code category_system category_display category_text"),
    "care_plan_care_teams": _s("care_plan_id care_team_id"),
    "care_plan_goals": _s("care_plan_id goal_id"),
    "allergy_intolerance": f"""{_s('allergy_intolerance_id resourcetype clinical_status_code clinical_status_display '
        'clinical_status_system verification_status_code verification_status_display verification_status_system '
        'type category criticality code code_display code_system code_text patient_id encounter_id')},
        onset_datetime timestamp, onset_age_value decimal(10,2), onset_age_unit string,
        onset_period_start date, onset_period_end date, recorded_date timestamp,
        {_s('recorder_practitioner_id asserter_practitioner_id')}, last_occurrence timestamp,
        {_s('note reactions')}, {_TS}, {_s('meta_source meta_security meta_tag extensions')}, {_AUDIT}""",
    "allergy_intolerance_identifiers": f"""{_s('allergy_intolerance_id identifier_use identifier_type_code '
        'identifier_type_display identifier_system identifier_value')}, identifier_period_start date,
        identifier_period_end date""",
    "procedures": f"""{_s('procedure_id resource_type status patient_id code_text')},
        performed_date_time timestamp, {_TS}, {_AUDIT}""",
    "procedure_identifiers": _s("procedure_id identifier_system identifier_value"),
    "procedure_code_codings": _s("procedure_id code_system code_code code_display"),
}


@lru_cache(maxsize=None)
def datatype(ddl: str):
    """Parse DDL text (needs an active session)."""
    return _parse_datatype_string(" ".join(ddl.split()))


def resource_schema(resource: str) -> StructType:
    return datatype(_COMMON + RESOURCES[resource])


def table_schema(table: str) -> StructType:
    return datatype(TABLES[table])
