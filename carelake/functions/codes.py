"""Code systems, code lists, patterns and thresholds of the marts."""

from __future__ import annotations

# Code systems (fixed values).
ICD10CM = "http://hl7.org/fhir/sid/icd-10-cm"
ICD10 = "http://hl7.org/fhir/sid/icd-10"
ICD9CM = "http://hl7.org/fhir/sid/icd-9-cm"
SNOMED = "http://snomed.info/sct"
LOINC = "http://loinc.org"
OBSERVATION_CATEGORY = "http://terminology.hl7.org/CodeSystem/observation-category"

# LOINC document type -> document class (fixed values).
DOCUMENT_CLASS = {
    "11502-2": "lab",
    "70006-2": "medication",
    "60591-5": "history",
    "28570-0": "history",
    "34117-2": "history",
    "11488-4": "history",
    "11506-3": "history",
    "78322-5": "surgery",
    "68629-5": "allergy",
    "18842-5": "discharge",
    "18748-4": "imaging",
    "87273-9": "immunization",
    "11526-1": "pathology",
    "75425-9": "cardiology",
}

# Accepted timestamp forms (fixed values): with fraction and offset, with offset,
# with neither; the same or a bare date; month/day with a 2- or 4-digit year.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSSXXX][XXX]"
ISO_OR_DATE_PATTERN = "yyyy-MM-dd['T'HH:mm:ss[.SSSSSSSSSXXX][XXX]]"
SHORT_DATE_PATTERN = "M/d/[yyyy][yy]"

# Cohort (fixed values).
COHORT_CODE = "C61"
COHORT_FROM = "2024-01-01"
REPORT_FROM = "2025-06-01"
GROUP_CODES = ("C61", "Z19.1", "Z19.2", "R97.21")

# Laboratory reports: (all-of-these-statuses, any pattern, none pattern, codes) (fixed values).
RESULT_STATUSES = ("final", "amended", "corrected")
PSA_CODES = (
    "59221-2", "19195-7", "100716-0", "59230-3", "47738-0", "2857-1", "19197-3",
    "83112-3", "72576-2", "35741-8", "53764-7", "59232-9", "19201-3", "59239-4",
    "59231-1", "10886-0", "19203-9", "33667-7", "83113-1", "97149-9",
)
CD4_CODES = ("54218-3", "24467-3", "8123-2", "8122-4", "8124-0")
PSA_TREND_CODES = ("2857-1", "83112-3", "19195-7", "35741-8")
PSA_UNITS = ("ng/mL", "ug/L")  # one concentration under two names
TESTOSTERONE_CODES = ("2986-8", "14913-8")

# Liver disease (fixed values).
LIVER_CODE_PREFIXES = (
    "B15", "B16", "B17", "B18", "B19", "K70", "K71", "K72", "K73", "K74", "K75", "K76", "K77",
)
LIVER_TEXT = ("%HEPATITIS%", "%CIRRHOSIS%", "%LIVER%DISEASE%", "%LIVER%FAILURE%", "%JAUNDICE%", "%HEPATIC%")
LIVER_DISPLAY = ("%HEPATITIS%", "%CIRRHOSIS%", "%LIVER%")

# Additional malignancy (fixed values).
MALIGNANCY_TEXT = (
    "%CANCER%", "%CARCINOMA%", "%MELANOMA%", "%LYMPHOMA%", "%LEUKEMIA%", "%SARCOMA%",
    "%TUMOR%", "%NEOPLASM%", "%MALIGNANCY%",
)

# Metastases of the central nervous system (fixed values).
CNS_CODE_PREFIXES = ("C79.3", "C79.4", "C79.5")
CNS_TEXT = (
    "%CNS%METASTA%", "%CENTRAL%NERVOUS%METASTA%", "%BRAIN%METASTA%", "%CEREBELLAR%METASTA%",
    "%LEPTOMENINGEAL%", "%SPINE%METASTA%", "%SPINAL%CORD%METASTA%", "%BRAIN%SECONDARY%",
)
CNS_DISPLAY = ("%BRAIN%METASTA%", "%CNS%METASTA%")

# Cardiac exclusion criteria (fixed values).
SEVERE_HEART_FAILURE = ("420300004", "421704003", "703272007", "23341000119109", "371807002")
HEART_FAILURE = (
    "42343007", "84114007", "88805009", "441530006", "441481004", "417996009",
    "I50.9", "I50.32", "I50.23",
)
HEART_FAILURE_SEVERITY = (
    "%NYHA%III%", "%NYHA%IV%", "%Class III%", "%Class IV%", "%severe%", "%advanced%",
)
UNSTABLE_ANGINA = ("4557003", "233840006", "59021001", "194821006", "233843008", "I20.1")
NEW_ANGINA = ("194828000", "85284003", "233819005", "300995000", "161504004", "I20.9")
MYOCARDIAL_INFARCTION = (
    "22298006", "57054005", "418304008", "194779001", "10633002", "698296002", "443344007",
    "443253003", "426856002", "443254009", "401303003", "401314000", "443343001", "698593009",
    "194767001", "194781004", "194766005", "90727007", "395105005", "403457003", "77737007",
    "196542004", "36315003", "170593007", "428752002", "I21.9", "I21.3",
)
SIGNIFICANT_CARDIAC = (
    "314207007", "83105008", "73795002", "120901000119108", "285721000119104", "85232009",
    "111000119104", "426263006", "I25.5",
)
PAST_INFARCTION = ("399211009", "1755008")

# Diagnostic reports kept after the first diagnosis (fixed values).
REPORT_CODES_BEFORE = (
    "5372066", "392068", "392161", "392176", "392553", "392678", "394253", "5327789",
    "394716", "36952.0", "38268-9",
)
REPORT_CODES_AFTER = REPORT_CODES_BEFORE + (
    "394251", "81551-4", "8106798", "2732048", "3463527", "8272112", "8352724", "1223755",
    "2856841", "30673-8", "30679-5", "30693-6", "30796-7", "346697", "36500-7", "392100",
    "392647", "392649", "392656", "392675", "392749", "393267", "394138", "394368",
    "4109882", "25031-6", "3468512", "347864", "392426", "392527", "394074", "395765",
    "39627-5", "39818-0", "39826-3", "39883-4", "425538", "427749", "48807-2", "5302337",
    "66108-2", "66119-9", "8269441", "83012-5", "83014-1", "8317095", "8317583", "955722",
)

# Androgen-deprivation drugs: report list and extended synonym list (fixed values).
ADT_DRUGS = (
    "casodex", "eligard", "xtandi", "abiraterone", "lupron", "bicalutamide", "trelstar",
    "enzalutamide", "zytiga", "leuprolide", "degarelix", "camcevi", "eulexin", "orgovyx",
    "yonsa", "firmagon", "flutamide", "zoladex",
)
ADT_SYNONYMS = (
    "Leuprolide", "Leuprorelin", "Leuproreline", "Lupron", "Eligard", "Camcevi", "Fensolvi",
    "Viadur", "TAP-144", "A-43818", "Abbott-43818", "Goserelin", "Zoladex", "ICI-118630",
    "Triptorelin", "Triptoréline", "Triptorelinum", "Trelstar", "Triptodur", "Decapeptyl",
    "CL 118532", "Degarelix", "Firmagon", "FE 200486", "ASP-3550", "Relugolix", "Orgovyx",
    "Relumina", "Myfembree", "Ryeqo", "TAK-385", "RVT-601", "Bicalutamide", "Casodex",
    "Cosudex", "Calutide", "ICI 176334", "ICI-176334", "Enzalutamide", "Xtandi", "MDV3100",
    "MDV 3100", "MDV-3100", "Abiraterone", "Zytiga", "Yonsa", "CB-7630", "CB7630", "CB 7630",
    "JNJ-212082", "JNJ212082", "JNJ 212082", "CB-7598", "Flutamide", "Eulexin", "SCH-13521",
    "Nilutamide", "Nilandron", "Anandron", "LHRH agonist", "GnRH agonist", "LHRH analog",
    "GnRH analog", "androgen deprivation", "antiandrogen", "anti-androgen",
)
IMAGING_PATTERNS = ("%CT%", "%MRI%", "%bone scan%", "%PET%", "%imaging%", "%radiology%")

# Inferred observations (fixed values).
AI_SECURITY_CODE = "AIAST"
AI_ID_PREFIX = "to.ai-inference-"
ADT_CODE, ADT_STARTED_VALUE, ADT_START_COMPONENT = "413712001", "385654001", "treatmentStartDate_v1"
PROGRESSION_VALUES = {"277022003": "TRUE", "359746009": "FALSE", "261665006": "UNKNOWN"}
LATEST_MEASUREMENT, ANALYSIS_NOTE = "mostRecentMeasurement_v1", "analysis-note"

# Thresholds (fixed values).
CASTRATE_LIMITS = {"ng/dL": "50", "nmol/L": "1.7"}
PROGRESSION_RATIO, PROGRESSION_RISE, CONFIRM_DAYS = "1.25", "2.0", 21
DOUBLING_RISK_MONTHS = 10
