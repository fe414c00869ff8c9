"""FHIR-shaped resources derived from the TPC-H-like driver tables.

Every resource covers the whole of its source table.  The odd values (bad
timestamps, empty ids, quoted codes, absent arrays) hang on attributes of the
rows, so that all parsing paths run at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import codes
from carelake.session import configure
from carelake.sources import schemas
from carelake.sources.nested import select_as

# Stand-in vocabularies, looked up by a number the driver tables hold (fixed values).
ICD_CODES = (
    "C61", "Z19.1", "Z19.2", "C79.31", "C79.51", "B18.2", "K74.6", "K70.30", "C34.9", "C18.9",
    "D05.1", "I50.9", "I50.23", "I20.1", "I20.9", "I21.9", "I25.5", "E11.9", "I10", "R97.21",
    "J45", "N18.3", "M17", "F32.9", "G20",
)
ICD_NAMES = (
    "Malignant neoplasm of prostate", "Hormone sensitive status", "Hormone resistant status",
    "Brain metastasis", "Bone metastasis", "Chronic hepatitis C", "Cirrhosis", "Alcoholic liver disease",
    "Lung carcinoma", "Colon cancer", "Breast carcinoma in situ", "Heart failure",
    "Acute on chronic heart failure", "Angina with spasm", "Angina pectoris", "Acute infarction",
    "Ischemic cardiomyopathy", "Type 2 diabetes", "Hypertension", "Rising PSA", "Asthma",
    "Kidney disease", "Knee arthrosis", "Depression", "Parkinson disease",
)
SNOMED_BY_TYPE = {
    "ECONOMY": "420300004", "LARGE": "42343007", "MEDIUM": "4557003",
    "PROMO": "314207007", "SMALL": "399211009", "STANDARD": "22298006",
}
LAB_NAMES = (
    "PSA total", "Testosterone total", "ALT (SGPT)", "AST (SGOT)", "Creatinine serum",
    "Creatinine clearance", "eGFR", "Hemoglobin", "HbA1c", "Platelet count", "Neutrophil count",
    "Bilirubin total", "Albumin serum", "Potassium", "CD4 cells", "HIV RNA viral load",
    "PSA free ratio", "Heart rate", "Body weight", "Prostate specific antigen",
)
LAB_CODES = (
    "2857-1", "2986-8", "1742-6", "1920-8", "2160-0", "2164-2", "33914-3", "718-7", "4548-4",
    "777-3", "751-8", "1975-2", "1751-7", "2823-3", "24467-3", "20447-9", "12841-3", "8867-4",
    "29463-7", "35741-8",
)
LAB_UNITS = (
    "ng/mL", "ng/dL", "U/L", "U/L", "mg/dL", "mL/min", "mL/min", "g/dL", "%", "10*3/uL", "10*3/uL",
    "mg/dL", "g/dL", "mmol/L", "/uL", "copies/mL", "%", "/min", "kg", "ng/mL",
)
DRUGS = {
    "blue": "Lupron Depot", "cold": "Bicalutamide 50 MG", "hot": "Xtandi capsule", "large": "Degarelix",
}
# A coding as one bit of a long: ICD codes from bit 0, SNOMED codes from bit 32, and one bit each for an unknown code.
ICD_BITS, SNOMED_BITS = [1 << k for k in range(len(ICD_CODES))], {t: 1 << (32 + k) for k, t in enumerate(SNOMED_BY_TYPE)}
NO_ICD, NO_SNOMED = 1 << 31, 1 << 62
DOCUMENT_CODES = tuple(codes.DOCUMENT_CLASS) + ("34133-9", "51848-0", "57133-1", "18776-5", "28636-9", "34111-5")
REPORTS = {
    "1-URGENT": ("5372066", "CT Chest"),
    "2-HIGH": ("38268-9", "Bone scan"),
    "3-MEDIUM": ("36500-7", "MRI Pelvis"),
    "4-NOT SPECIFIED": ("58410-2", "Blood panel"),
    "5-LOW": ("83012-5", "PET imaging"),
}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Driver table; zoneless timestamps become UTC timestamps."""
    configure(spark)
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(
        *[F.col(f.name).cast("timestamp") if f.dataType.typeName().startswith("timestamp") else F.col(f.name) for f in df.schema]
    )


def _input(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return load(spark, folder, table)


def _text(*parts) -> Column:
    return F.concat(*[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])


def _iso(ts: Column, suffix: str = "Z") -> Column:
    return _text(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), suffix)


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = F.lit(default)
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)).otherwise(expr)
    return expr


def _concept(*codings, text=None) -> dict:
    return {"coding": [dict(zip(("system", "code", "display"), c)) for c in codings], "text": text}


def _ref(*parts, display=None) -> dict:
    return {"reference": _text(*parts), "display": display}


def _digit(priority: Column) -> Column:
    return F.substring(priority, 1, 1)


def patient(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    df = (
        _input(spark, folder, "customer")
        .join(nation, c("c_nationkey") == c("n_nationkey"), "left")
        .join(region, c("n_regionkey") == c("r_regionkey"), "left")
    )
    stamp = _text("2024-01-", F.lpad((c("c_nationkey") + 1).cast("string"), 2, "0"), "T10:20:30")
    suffix = _case(
        c("c_mktsegment"),
        {"AUTOMOBILE": ".123456789+02:00", "BUILDING": ".123Z", "FURNITURE": "Z", "HOUSEHOLD": ""},
        " garbage",
    )
    birth = F.when(
        c("c_acctbal") >= 0, _text(F.lit(1940) + c("c_nationkey"), "-0", c("n_regionkey") + 1, "-15")
    ).otherwise(F.lit("1950"))
    first = F.substring("c_mktsegment", 1, 1)
    return select_as(df, schemas.resource_schema("Patient"), {
        "id": c("c_custkey"),
        "resourceType": "Patient",
        "meta": {
            "lastUpdated": _text(stamp, suffix),
            "security": (c("c_acctbal") >= 0, [{"system": "urn:security", "code": "R"}]),
        },
        "isDelete": c("c_acctbal") < -900,
        "active": c("c_acctbal") >= 0,
        "gender": F.when(c("c_mktsegment") == "BUILDING", "female").otherwise("male"),
        "birthDate": birth,
        "deceasedDateTime": (c("c_acctbal") > 9000, F.lit("2023-06-15T00:00:00Z")),
        "maritalStatus": (
            c("c_mktsegment") != "MACHINERY",
            {"coding": F.when(
                c("c_mktsegment") == "HOUSEHOLD", F.array().cast(schemas.datatype(f"array<{schemas.CODING}>"))
            ).otherwise(F.array(F.struct(
                F.lit("urn:marital").alias("system"), first.alias("code"), c("c_mktsegment").alias("display")
            )))},
        ),
        "name": [
            {"use": "official", "text": c("c_name"), "family": "Customer", "given": [_text("C", c("c_custkey")), c("c_mktsegment")],
             "prefix": "Mx.", "period": {"start": "2020-01-01"}},
            {"use": "usual", "family": c("n_name")},
            {"use": "old"},
        ],
        "telecom": [
            {"system": "phone", "value": _text("555-", c("c_custkey"))},
            {"system": "email", "value": _text(c("c_name"), "@example.org"), "use": "work"},
            {"system": "fax"},
        ],
        "address": [
            {"use": "home", "type": "physical", "line": [_text(c("c_custkey"), " Main St"), _text("Apt ", c("c_nationkey"))],
             "city": c("n_name"), "district": c("r_name"), "postalCode": F.lpad(c("c_custkey").cast("string"), 5, "0"),
             "country": "US", "period": {"start": "2020-01-01", "end": "bad"}},
            {"use": "work", "text": _text(c("c_name"), " office")},
            {"use": "temp"},
        ],
        "contact": [
            {"relationship": _concept(("urn:relation", "N", "Next of kin")),
             "name": {"text": _text("Kin of ", c("c_name")), "given": ["K", first]},
             "telecom": {"system": "phone", "value": "555", "use": "mobile"}},
            {"name": {"use": "usual"}},
        ],
        "communication": [
            {"language": _concept(("urn:ietf:bcp:47", F.lower(F.substring("r_name", 1, 2)), c("r_name")))},
            {"language": {"coding": []}},
        ],
        "generalPractitioner": [
            _ref("Practitioner/", c("c_nationkey")), _ref("PractitionerRole/", c("n_regionkey")),
            _ref("Organization/", c("c_nationkey")), _ref("Group/1"),
        ],
        "link": [
            {"other": _ref("Patient/", c("c_custkey") + 1), "type": "seealso"},
            {"other": _ref("Patient/"), "type": "refer"},
        ],
        "extension": [{"url": "urn:segment", "valueString": c("c_mktsegment")}],
    })


def practitioner(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    good = c("s_acctbal") >= 0
    return select_as(load(spark, folder, "supplier"), schemas.resource_schema("Practitioner"), {
        "id": c("s_suppkey"),
        "resourceType": "Practitioner",
        "meta": {"lastUpdated": _text("2024-02-", F.lpad((c("s_nationkey") + 1).cast("string"), 2, "0"), "T00:00:00Z")},
        "isDelete": False,
        "active": good,
        "name": [
            {"text": c("s_name"), "family": (good, F.lit("Supplier")), "given": (good, ["S", c("s_suppkey")])},
            {"text": _text('Dr "', c("s_suppkey"), '"'), "family": "Zed"},
            {"family": "None"},
        ],
        "telecom": [
            {"system": "phone", "value": _text("1-", c("s_suppkey"))},
            {"system": "email", "value": (good, _text(c("s_name"), "@example.org"))},
        ],
        "address": [
            {"line": [_text(c("s_suppkey"), " Care Rd"), _text("Suite ", c("s_nationkey"))],
             "city": _text("CITY_", c("s_nationkey")), "state": _text("ST", c("s_nationkey")),
             "postalCode": F.lit(10000) + c("s_nationkey")},
            {"city": "NOWHERE"},
        ],
    })


def encounter(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    pr, done = c("o_orderpriority"), c("o_orderstatus") == "F"
    end = c("o_orderdate") + F.make_dt_interval(mins=F.floor(c("o_totalprice") / 1000).cast("int"))
    return select_as(_input(spark, folder, "orders"), schemas.resource_schema("Encounter"), {
        "id": c("o_orderkey"),
        "resourceType": "Encounter",
        "meta": {"lastUpdated": _iso(F.date_add(c("o_orderdate"), 1).cast("timestamp"))},
        "isDelete": False,
        "status": _case(c("o_orderstatus"), {"F": "finished", "O": "in-progress", "P": "cancelled"}),
        "class": {"system": "urn:act", "code": _case(pr, {"1-URGENT": "emergency", "2-HIGH": "inpatient"}, "ambulatory")},
        "subject": _ref("Patient/", c("o_custkey")),
        "period": {"start": _iso(c("o_orderdate")), "end": (done, _iso(end))},
        "serviceProvider": _ref("Organization/", _digit(pr)),
        "type": [_concept(("urn:visit", _digit(pr), pr), ("urn:visit", None, "skipped"), text="Visit")],
        "participant": [
            {"type": [_concept(("urn:part", "primary_performer"), ("urn:part", "ATND"))],
             "period": {"start": _iso(c("o_orderdate"))}, "individual": _ref("Practitioner/", _digit(pr))},
            {"type": [_concept(("urn:part", "CON"))], "individual": _ref("Practitioner/0")},
            {"type": [_concept(("urn:part", "REF"))]},
        ],
        "reasonCode": [
            {"text": _text("Reason ", pr),
             "coding": (done, [{"system": "urn:reason", "code": _digit(pr), "display": pr}])},
            {"coding": [{"code": "no-text"}]},
        ],
        "location": [
            {"location": _ref("Location/L", _digit(pr))}, {"location": _ref("Location/A")}, {"location": _ref("Room/1")},
        ],
        "hospitalization": (done, {"dischargeDisposition": _concept(("urn:discharge", "home"), text="Home")}),
    })


def _order_bits(spark: SparkSession, folder: str) -> DataFrame:
    """Per order: the distinct codings of its lines, one bit each.

    A coding is one bit of a number until the lines of an order have met: one small
    row per order and task is shuffled, however many lines and texts there are.
    """
    c = F.col
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int") - 1
    part = load(spark, folder, "part").select(
        "p_partkey",
        F.coalesce(_pick(ICD_BITS, number).cast("long"), F.lit(NO_ICD)).bitwiseOR(
            _case(c("p_type"), SNOMED_BITS, NO_SNOMED).cast("long")).alias("bits"),
    )
    line = _input(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return line.join(part, c("l_partkey") == c("p_partkey")).groupBy("l_orderkey").agg(F.bit_or("bits").alias("bits"))


def _with_codings(df: DataFrame) -> DataFrame:
    """Sorted codings for the ``bits``, and the last name among them; NULL where there are no bits."""
    none = F.lit(None).cast("string")
    known = [
        *zip(ICD_BITS, [codes.ICD10CM] * len(ICD_BITS), ICD_CODES, ICD_NAMES), (NO_ICD, codes.ICD10CM, none, none),
        *[(SNOMED_BITS[t], codes.SNOMED, code, none) for t, code in SNOMED_BY_TYPE.items()], (NO_SNOMED, codes.SNOMED, none, none),
    ]

    def lit(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    all_codings = F.array(*[F.struct(
        F.lit(bit).cast("long").alias("bit"),
        F.struct(*[lit(v).alias(n) for n, v in zip(("system", "code", "display"), coding)]).alias("coding"),
    ) for bit, *coding in known])
    bits = F.col("bits")
    own = F.transform(F.filter(all_codings, lambda x: bits.bitwiseAND(x["bit"]) != 0), lambda x: x["coding"])
    df = df.withColumn("codings", F.when(bits.isNotNull(), F.sort_array(own)))
    return df.withColumn("name", F.array_max("codings.display"))


def _order_codings(spark: SparkSession, folder: str) -> DataFrame:
    """Per order: sorted distinct codings of its lines, and the last name among them."""
    return _with_codings(_order_bits(spark, folder)).drop("bits")


def _coded_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the bits of their codings, NULL for those without lines."""
    orders = _input(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return orders.join(_order_bits(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def condition(rows: DataFrame) -> DataFrame:
    c = F.col
    df = _with_codings(rows)
    pr, day = c("o_orderpriority"), c("o_orderdate")
    onset = _case(pr, {})
    onset = (
        F.when(pr == "1-URGENT", _iso(day))
        .when(pr == "2-HIGH", F.date_format(day, "M/d/yy"))
        .when(pr == "3-MEDIUM", F.date_format(day, "M/d/yyyy"))
        .when(pr == "5-LOW", _iso(day, ""))
    )
    return select_as(df, schemas.resource_schema("Condition"), {
        "id": c("o_orderkey"),
        "resourceType": "Condition",
        "meta": {"lastUpdated": _iso(F.date_add(day, 2).cast("timestamp")), "profile": ["urn:profile", pr]},
        "isDelete": False,
        "subject": _ref("Patient/", c("o_custkey")),
        "encounter": _ref("Encounter/", c("o_orderkey")),
        "clinicalStatus": _concept(
            ("urn:clinical", _case(c("o_orderstatus"), {"F": "active", "O": "recurrence", "P": "resolved"}), "ignored")
        ),
        "verificationStatus": _concept(("urn:verify", _case(pr, {"5-LOW": "provisional"}, "confirmed"))),
        "severity": (pr == "1-URGENT", _concept((codes.SNOMED, "24484000", "Severe"))),
        "code": {"coding": c("codings"), "text": c("name")},
        "category": [_concept(("urn:category", "encounter-diagnosis", "Diagnosis"), ("urn:category", None), text="Diagnosis")],
        "bodySite": (c("o_orderstatus") == "F", [_concept((codes.SNOMED, "41216001", "Prostate"), text="Prostate")]),
        "onsetDateTime": onset,
        "abatementDateTime": (c("o_orderstatus") == "P", _iso(F.date_add(day, 30).cast("timestamp"))),
        "recordedDate": _iso(F.date_add(day, 1).cast("timestamp")),
        "note": [
            {"text": _text('Note "', c("o_orderkey"), '"\tfor \\', pr), "authorReference": _ref("Practitioner/", _digit(pr)),
             "time": _iso(day, "+00:00")},
            {"time": "no text"},
        ],
        "stage": [{"assessment": _ref("Observation/stage-", _digit(pr))}, {"summary": _concept(("urn:stage", "II"))}],
        "evidence": [{"code": _concept(("urn:evidence", _digit(pr), "ignored"))}],
        "extension": [
            {"url": "urn:note", "valueString": pr},
            {"url": "urn:count", "valueInteger": _digit(pr)},
            {"url": "urn:group", "extension": _text(
                '[{"url":"urn:inner","valueBoolean":true},{"url":"urn:two","extension":[{"url":"urn:three","valueCode":"', pr,
                '","extension":[{"url":"urn:four","extension":[{"url":"urn:five","valueInteger":', _digit(pr), '}]}]}]}]')},
        ],
    })


def observation(spark: SparkSession, folder: str) -> DataFrame:
    return observation_of(_input(spark, folder, "events"))


def observation_of(events: DataFrame, *kept: str) -> DataFrame:
    """Observations of events, with some columns of the events beside them."""
    c = F.col
    kind, ts = c("event_type"), c("ts")
    df = events.withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    ).withColumn("lab", F.floor(c("k") / 5).cast("int"))
    inferred, vital = kind == "signup", c("lab").isin(17, 18)
    name = _pick(LAB_NAMES, c("lab"))
    stamp = _text(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "Z")
    answer = (
        F.when(c("k") < 25, codes.ADT_STARTED_VALUE)
        .when(c("k") < 50, "277022003").when(c("k") < 75, "359746009").otherwise("261665006")
    )
    lab_coding = schemas.datatype(f"array<{schemas.CODING}>")

    def codings(*items):
        return F.array(*[
            F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("string").alias(n)
                       for n, v in zip(("system", "code", "display"), item)]) for item in items
        ]).cast(lab_coding)

    return select_as(df, schemas.resource_schema("Observation"), {
        "id": _text(F.when(inferred, codes.AI_ID_PREFIX).otherwise("obs-"), c("event_id")),
        "resourceType": "Observation",
        "meta": {
            "lastUpdated": stamp,
            "security": (inferred, [{"system": "urn:security", "code": codes.AI_SECURITY_CODE}]),
        },
        "isDelete": (kind == "click") & (c("value") > 100),
        "status": _case(kind, {"error": "entered-in-error", "click": "amended"}, "final"),
        "subject": _ref("Patient/", c("user_id")),
        "encounter": (kind == "click", _ref("Encounter/", c("event_id"))),
        "specimen": (kind == "view", _ref("Specimen/S", c("k"))),
        "code": {
            "text": F.when(inferred, "Inferred finding").otherwise(name),
            "coding": F.when(inferred, codings((codes.SNOMED, codes.ADT_CODE, "Androgen deprivation"))).otherwise(
                codings(("urn:local", _text('"L', c("lab"), '"'), name), (codes.SNOMED, _text("S", c("lab")), name),
                        (codes.LOINC, _pick(LAB_CODES, c("lab")), name))),
        },
        "category": [
            _concept((codes.OBSERVATION_CATEGORY, F.when(vital, "vital-signs").otherwise("laboratory"),
                      F.when(vital, "Vital Signs").otherwise("Laboratory")), text="Main"),
            {"coding": (kind == "view", [{"system": "urn:local", "code": '"exam"'}])},
        ],
        "valueString": (kind == "click", _text("k=", c("k"))),
        "valueQuantity": (kind.isin("view", "purchase", "error"),
                          {"value": F.round(c("value"), 2), "unit": _pick(LAB_UNITS, c("lab")), "system": "urn:ucum"}),
        "valueCodeableConcept": (inferred, {
            "coding": codings((codes.SNOMED, answer, "Answer")), "text": "Answer"}),
        "dataAbsentReason": (inferred, _concept(("urn:absent", "unknown", "Unknown"))),
        "effectiveDateTime": stamp,
        "effectivePeriod": (kind == "view", {"start": F.date_format(ts, "M/d/yyyy")}),
        "issued": _iso(ts + F.expr("interval 1 hour")),
        "interpretation": (kind == "purchase", [_concept(("urn:flag", '"H"', "High"), text="High")]),
        "referenceRange": (kind.isin("view", "click"), [
            {"low": {"value": 0.5, "unit": "u"}, "high": (kind == "view", {"value": 4, "unit": "u"}),
             "type": _concept(("urn:range", "normal")), "text": (kind == "view", F.lit("0.5-4"))},
            {"type": {"text": "empty"}},
        ]),
        "component": F.when(inferred, F.array(
            _component(("urn:result", F.when(c("k") < 25, codes.ADT_START_COMPONENT).otherwise(codes.LATEST_MEASUREMENT), "Result date"),
                       "Date", valueDateTime=stamp),
            _component(("urn:analysis", codes.ANALYSIS_NOTE, "Note"), "Analysis", valueString=_text("k=", c("k"))),
        )).when(kind == "purchase", F.array(
            _component((codes.LOINC, "8480-6", "Systolic"), "Systolic", valueQuantity={"value": c("k"), "unit": "mmHg"}),
            _component((codes.LOINC, '"8462-4"', "Diastolic"), "Diastolic",
                       valueCodeableConcept=_concept((codes.SNOMED, "N", "Normal")),
                       dataAbsentReason=_concept(("urn:absent", "error", "Error"))),
        )),
        "note": (kind.isin("error", "click", "signup"), [{"text": _text('note "', c("k"), '"')}, {}]),
        "performer": [_ref("Practitioner/", c("k")), _ref("Organization/1"), _ref("malformed")],
        "hasMember": (kind == "purchase", [_ref("Observation/obs-", c("event_id")), _ref("Observation/")]),
        "derivedFrom": (inferred, [
            {"reference": _text("DocumentReference/", c("k")), "display": "Source", "extension": [
                {"url": "urn:AI-evidence:quote", "valueString": _text("q", c("k")),
                 "extension": _text('[{"url":"page","valueInteger":', c("k"), ',"extension":[{"url":"line","extension":[{"url":"column","valueString":"q',
                                    c("k"), '"}]}]}]')},
                {"url": "urn:other", "valueString": "skip"}]},
            {"reference": "Observation/obs-1", "type": "Observation"},
        ]),
    }, *kept)


def _component(coding, text, **values) -> Column:
    from carelake.sources.nested import shape

    dtype = schemas.resource_schema("Observation")["component"].dataType.elementType
    return shape(dtype, {"code": _concept(coding, text=text), **values})


def diagnostic_report(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    pr, day = c("o_orderpriority"), c("o_orderdate")
    code = _case(pr, {k: v[0] for k, v in REPORTS.items()})
    display = _case(pr, {k: v[1] for k, v in REPORTS.items()})
    return select_as(_input(spark, folder, "orders"), schemas.resource_schema("DiagnosticReport"), {
        "id": _text("dr-", c("o_orderkey")),
        "resourceType": "DiagnosticReport",
        "meta": {"lastUpdated": _iso(F.date_add(day, 3).cast("timestamp"))},
        "isDelete": False,
        "status": _case(c("o_orderstatus"), {"F": "final", "O": "registered", "P": "cancelled"}),
        "code": _concept(("urn:report", code, display), text=_text("Report ", pr)),
        "subject": _ref("Patient/", c("o_custkey")),
        "encounter": _ref("Encounter/", c("o_orderkey")),
        "effectiveDateTime": F.date_format(day, "yyyy-MM-dd"),
        "issued": (c("o_orderstatus") != "O", _iso(F.date_add(day, 1).cast("timestamp"))),
        "category": [_concept(("urn:section", "RAD", "Radiology"), ("urn:section", _digit(pr)))],
        "performer": [_ref("Practitioner/", _digit(pr)), _ref("Organization/1"), _ref("nobody")],
        "basedOn": [_ref("ServiceRequest/", c("o_orderkey")), _ref("CarePlan/1")],
        "result": (c("o_orderstatus") == "F", [
            _ref("Observation/obs-", c("o_custkey")), _ref("Observation/obs-", c("o_custkey")), _ref("Observation/obs-x"),
        ]),
        "media": [{"link": _ref("Media/m", _digit(pr))}, {}],
        "presentedForm": [
            {"contentType": "application/pdf", "data": _text("ZGF0YQ", _digit(pr)), "title": pr}, {"title": "empty"},
        ],
        "extension": [{"url": "urn:priority", "valueString": pr}, {"url": "urn:outer", "extension": _text(
            '[{"url":"b","extension":[{"url":"c","extension":[{"url":"d","extension":[{"url":"e","valueString":"', pr, '"}]}]}]}]')}],
    })


def document_reference(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    number = F.regexp_extract("source", "([0-9]+)", 1)
    day = F.date_add(F.lit("2022-06-01").cast("date"), F.floor(c("n_chars") / 10).cast("int"))
    return select_as(_input(spark, folder, "documents"), schemas.resource_schema("DocumentReference"), {
        "id": c("doc_id"),
        "resourceType": "DocumentReference",
        "meta": {"lastUpdated": _iso(F.date_add(day, 1).cast("timestamp"))},
        "isDelete": False,
        "status": _case(c("lang"), {"de": "superseded", "es": "entered-in-error"}, "current"),
        "type": _concept((codes.LOINC, _pick(DOCUMENT_CODES, number.cast("int")), c("source"))),
        "subject": _ref("Patient/", c("doc_id")),
        "date": day.cast("string"),
        "custodian": _ref("Organization/", number),
        "description": c("text"),
        "context": {"period": {"start": _iso(day.cast("timestamp")), "end": "open"}},
        "identifier": [{"system": "urn:doc", "value": _text("D", c("doc_id"))}, {"system": "urn:none"}],
        "category": [_concept(("urn:source", c("source"), c("lang")), ("urn:lang", c("lang"), c("lang")))],
        "author": [_ref("Practitioner/", number), _ref("Organization/", number)],
        "content": [
            {"attachment": {"contentType": "text/plain", "data": c("text")}},
            {"attachment": {"contentType": "text/html", "url": _text(
                F.when(c("lang") == "en", "https://example.org/").otherwise("s3://bucket/"), c("doc_id"))}},
            {"attachment": {"contentType": "none"}},
        ],
    })


def _drug(name: Column) -> Column:
    return _case(F.split_part(name, F.lit(" "), F.lit(1)), DRUGS, None)


def medication(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return select_as(_input(spark, folder, "part"), schemas.resource_schema("Medication"), {
        "id": c("p_partkey"),
        "resourceType": "Medication",
        "meta": {"lastUpdated": _text("2024-03-", F.lpad(F.ceil(c("p_size") / 2).cast("string"), 2, "0"), "T00:00:00Z")},
        "isDelete": False,
        "code": {
            "coding": (c("p_type") != "SMALL", [{"system": "urn:rxnorm", "code": c("p_brand"), "display": c("p_type")}]),
            "text": F.coalesce(_drug(c("p_name")), c("p_name")),
        },
        "status": F.when(c("p_size") > 25, "active").otherwise("inactive"),
        "identifier": [{"system": "urn:part", "value": c("p_brand")}, {"system": "urn:none"}],
    })


def _prescriptions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (order, part): amounts and dates over its lines.

    Lines are dealt by order before they are grouped, so that they meet their order
    where they are and only the parts may need a second shuffle.
    """
    c = F.col
    lines = _input(spark, folder, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").cast("int").alias("amount"),
        F.min("l_shipdate").alias("first_day"),
        F.max("l_shipdate").alias("last_day"),
        F.max("l_returnflag").alias("flag"),
        F.max("l_linestatus").alias("line_status"),
        F.min("l_suppkey").alias("supplier"),
    )
    part = load(spark, folder, "part").select("p_partkey", "p_name")
    orders = _input(spark, folder, "orders").select("o_orderkey", "o_custkey")
    found = lines.join(orders, c("l_orderkey") == c("o_orderkey")).drop("o_orderkey")
    return found.join(part, c("l_partkey") == c("p_partkey")).drop("p_partkey")


def medication_request(rows: DataFrame) -> DataFrame:
    c = F.col
    key = _text(c("l_orderkey"), "-", c("l_partkey"))
    return select_as(rows, schemas.resource_schema("MedicationRequest"), {
        "id": key,
        "resourceType": "MedicationRequest",
        "meta": {"lastUpdated": _iso(c("last_day"))},
        "isDelete": False,
        "subject": _ref("Patient/", c("o_custkey")),
        "encounter": _ref("Encounter/", c("l_orderkey")),
        "medicationReference": _ref("Medication/", c("l_partkey"), display=F.coalesce(_drug(c("p_name")), c("p_name"))),
        "status": F.when(c("amount") > 45, "cancelled").otherwise(_case(c("flag"), {"A": "active", "N": "completed", "R": "stopped"})),
        "intent": "order",
        "reportedBoolean": c("line_status") == "O",
        "authoredOn": _iso(c("first_day")),
        "identifier": [{"system": "urn:rx", "value": key}, {}],
        "note": [{"text": _text("Quantity ", c("amount"))}, {}],
        "category": [_concept(("urn:setting", c("line_status"), "Setting"), text="Setting")],
        "dosageInstruction": [
            {"text": _text("Take ", c("amount")), "timing": {"repeat": {"frequency": c("amount"), "period": 1, "periodUnit": "d"}},
             "route": _concept((codes.SNOMED, "26643006", "Oral")),
             "doseAndRate": [{"doseQuantity": {"value": c("amount"), "unit": "mg", "system": "urn:ucum", "code": "mg"}}],
             "asNeededBoolean": c("flag") == "R"},
            {"asNeededBoolean": True},
        ],
    })


def medication_dispense(rows: DataFrame) -> DataFrame:
    c = F.col
    key = _text(c("l_orderkey"), "-", c("l_partkey"))
    return select_as(rows, schemas.resource_schema("MedicationDispense"), {
        "id": _text("md-", key),
        "resourceType": "MedicationDispense",
        "meta": {"lastUpdated": _iso(c("last_day"))},
        "isDelete": False,
        "status": _case(c("flag"), {"R": "stopped"}, "completed"),
        "subject": _ref("Patient/", c("o_custkey")),
        "medicationReference": _ref("Medication/", c("l_partkey"), display=c("p_name")),
        "type": _concept(("urn:fill", c("flag"), "Fill")),
        "quantity": {"value": c("amount"), "unit": "tablet"},
        "whenHandedOver": _iso(c("last_day")),
        "identifier": [{"system": "urn:fill", "value": key}],
        "performer": [{"actor": _ref("Practitioner/", c("supplier"))}, {}],
        "authorizingPrescription": (c("flag") != "N", [_ref("MedicationRequest/", key), _ref("Other/1")]),
        "dosageInstruction": [
            {"doseAndRate": [{"doseQuantity": {"value": c("amount"), "unit": "mg"}}]},
            {"text": "As directed", "route": {"coding": []}},
            {"timing": {"repeat": {"frequency": 1}}},
        ],
    })


def care_plan(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return select_as(_input(spark, folder, "customer"), schemas.resource_schema("CarePlan"), {
        "id": _text("cp-", c("c_custkey")),
        "resourceType": "CarePlan",
        "meta": {"lastUpdated": F.lit("2024-04-01T00:00:00Z")},
        "isDelete": False,
        "subject": _ref("Patient/", c("c_custkey")),
        "status": F.when(c("c_acctbal") < 0, "entered-in-error").otherwise("active"),
        "intent": "plan",
        "title": _text("Plan ", c("c_mktsegment")),
        "identifier": [{"system": "urn:plan", "value": _text("CP", c("c_custkey"))}],
        "category": [
            _concept(("urn:plan", "assess", "ignored"), ("urn:plan", F.lower("c_mktsegment")), text="ignored"), {"coding": []},
        ],
        "careTeam": (c("c_mktsegment") != "MACHINERY", [_ref("CareTeam/T", c("c_nationkey")), _ref("CareTeam/")]),
        "goal": [_ref("Goal/g1"), _ref("Goal/g", c("c_nationkey")), _ref("Goal/z"), _ref("Task/1")],
    })


def allergy_intolerance(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    seg = c("c_mktsegment")
    return select_as(_input(spark, folder, "customer"), schemas.resource_schema("AllergyIntolerance"), {
        "id": _text("ai-", c("c_custkey")),
        "resourceType": "AllergyIntolerance",
        "meta": {"lastUpdated": F.lit("2024-05-01T00:00:00.5Z"), "source": "urn:source", "tag": [{"code": "T"}]},
        "isDelete": False,
        "clinicalStatus": _concept(("urn:clinical", F.when(c("c_acctbal") >= 0, "active").otherwise("inactive"), "Status")),
        "verificationStatus": (seg != "MACHINERY", _concept(("urn:verify", "confirmed", "Confirmed"))),
        "type": "allergy",
        "category": ["food", F.lower("c_mktsegment")],
        "criticality": _case(seg, {"BUILDING": "high"}, "low"),
        "code": {"coding": (seg != "FURNITURE", [{"system": codes.SNOMED, "code": "227493005", "display": "Cashew"}]),
                 "text": (seg.isin("AUTOMOBILE", "BUILDING"), _text("Allergy of ", c("c_custkey")))},
        "patient": _ref("Patient/", c("c_custkey")),
        "encounter": _ref("Encounter/"),
        "onsetDateTime": F.lit("2019-01-02T03:04:05+01:00"),
        "onsetAge": {"value": c("c_nationkey"), "unit": "a"},
        "onsetPeriod": {"start": "2019-01-02T00:00:00Z", "end": "never"},
        "recordedDate": F.lit("2020-01-02T00:00:00"),
        "recorder": _ref("Practitioner/", c("c_nationkey")),
        "asserter": _ref("Patient/", c("c_custkey")),
        "note": [{"text": "n"}],
        "reaction": [{"description": "rash", "severity": "mild"}],
        "identifier": [{"use": "usual", "type": _concept(("urn:type", "MR", "Record")), "system": "urn:ai",
                        "value": _text("A", c("c_custkey")), "period": {"start": "2020-02-03", "end": "x"}}, {"use": "old"}],
    })


def procedure(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    pr, day = c("o_orderpriority"), c("o_orderdate")
    when = (
        F.when(pr == "1-URGENT", _iso(day)).when(pr == "2-HIGH", F.date_format(day, "M/d/yy"))
        .when(pr == "3-MEDIUM", F.date_format(day, "M/d/yyyy")).when(pr == "5-LOW", F.date_format(day, "yyyy-MM-dd"))
    )
    return select_as(_input(spark, folder, "orders"), schemas.resource_schema("Procedure"), {
        "id": _text("pr-", c("o_orderkey")),
        "resourceType": "Procedure",
        "meta": {"lastUpdated": _iso(day)},
        "isDelete": False,
        "status": F.when(pr == "4-NOT SPECIFIED", "not-done").otherwise(
            _case(c("o_orderstatus"), {"F": "completed", "O": "in-progress", "P": "stopped"})),
        "subject": _ref("Patient/", c("o_custkey")),
        "code": {"text": _text("Procedure ", pr), "coding": (c("o_orderstatus") != "P", [
            {"system": "urn:cpt", "code": _text("P", _digit(pr)), "display": pr},
            {"system": codes.SNOMED, "code": c("o_orderstatus"), "display": "Status"}, {"display": "none"}])},
        "performedDateTime": when,
        "identifier": [{"system": "urn:proc", "value": _text("P", c("o_orderkey"))}, {}],
    })


BUILDERS = {
    "Patient": patient,
    "Practitioner": practitioner,
    "Encounter": encounter,
    "Condition": condition,
    "Observation": observation,
    "DiagnosticReport": diagnostic_report,
    "DocumentReference": document_reference,
    "Medication": medication,
    "MedicationRequest": medication_request,
    "MedicationDispense": medication_dispense,
    "CarePlan": care_plan,
    "AllergyIntolerance": allergy_intolerance,
    "Procedure": procedure,
}


# Rows that are joined and grouped before they are nested, by a name of their own; a resource names the rows it is made of.
ROWS = {"coded_orders": _coded_orders, "prescriptions": _prescriptions}
MADE_OF = {"Condition": "coded_orders", "MedicationRequest": "prescriptions", "MedicationDispense": "prescriptions"}


def rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Joined and grouped rows, still flat."""
    configure(spark)
    return ROWS[name](spark, folder)


def resource(spark: SparkSession, folder: str, name: str, rows_of=rows) -> DataFrame:
    """Nested resource: a projection of a driver table or of the rows ``rows_of`` gives."""
    if name in MADE_OF:
        return BUILDERS[name](rows_of(spark, folder, MADE_OF[name]))
    return BUILDERS[name](spark, folder)
