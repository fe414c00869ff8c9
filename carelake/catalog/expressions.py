"""Queries of the column expressions, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.catalog import flat_sql, stage
from carelake.catalog.fact_sql import TODAY
from carelake.catalog.registry import query
from carelake.catalog.render import plain
from carelake.functions import codes
from carelake.functions import columns as C
from carelake.sources import bridge

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
col = F.col


def orders(spark, sf):
    return bridge.load(spark, sf, "orders")


def events(spark, sf):
    return bridge.load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


_EV = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


@query("expr_parse_timestamp", f"""SELECT o_orderkey, {_TS.format('''CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate - INTERVAL 2 HOUR + INTERVAL 123456 MICROSECOND
 WHEN '2-HIGH' THEN o_orderdate + INTERVAL 500 MILLISECOND WHEN '3-MEDIUM' THEN o_orderdate WHEN '4-NOT SPECIFIED' THEN o_orderdate END''')} AS iso,
 {_TS.format("CASE WHEN o_orderstatus = 'F' THEN o_orderdate END")} AS dated,
 {_TS.format('''CASE WHEN o_orderstatus = 'F' THEN o_orderdate WHEN o_orderstatus = 'O' AND year(o_orderdate) < 2000 THEN
 make_timestamp(year(o_orderdate) + 100, month(o_orderdate), day(o_orderdate), 0, 0, 0) WHEN o_orderstatus = 'O' THEN o_orderdate END''')} AS short FROM orders""")
def _(spark, sf):
    day, pr, st = col("o_orderdate"), col("o_orderpriority"), col("o_orderstatus")
    base = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(pr == "1-URGENT", F.concat(base, F.lit(".123456789+02:00"))).when(pr == "2-HIGH", F.concat(base, F.lit(".5Z")))
        .when(pr == "3-MEDIUM", F.concat(base, F.lit("Z"))).when(pr == "4-NOT SPECIFIED", base).otherwise("garbage")
    )
    dated = F.when(st == "F", F.date_format(day, "yyyy-MM-dd")).when(st == "O", F.date_format(day, "M/d/yy"))
    short = F.when(st == "F", F.date_format(day, "M/d/yyyy")).when(st == "O", F.date_format(day, "M/d/yy")).otherwise("1/2")
    return plain(orders(spark, sf).select(
        "o_orderkey", C.parse_timestamp(text).alias("iso"), C.parse_timestamp(dated, dates=True).alias("dated"),
        C.parse_timestamp(short, short=True).alias("short")))


@query("expr_reference_ids", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS patient,
 CASE o_orderstatus WHEN 'F' THEN 'Patient' WHEN 'O' THEN 'Group' ELSE 'Patient' END AS kind,
 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS any_id FROM orders""")
def _(spark, sf):
    st, key = col("o_orderstatus"), col("o_custkey").cast("string")
    ref = F.when(st == "F", F.concat(F.lit("Patient/"), key)).when(st == "O", F.concat(F.lit("Group/"), key)).otherwise("Patient/")
    return plain(orders(spark, sf).select(
        "o_orderkey", C.reference_id(ref, "Patient").alias("patient"), C.reference_type(ref).alias("kind"),
        C.reference_any_id(ref).alias("any_id")))


@query("expr_dispatch_reference", """SELECT s_suppkey, CASE WHEN s_acctbal < 3000 THEN CAST(s_nationkey AS VARCHAR) END AS practitioner,
 CASE WHEN s_acctbal >= 3000 AND s_acctbal < 6000 THEN CAST(s_nationkey AS VARCHAR) END AS role,
 CASE WHEN s_acctbal < 3000 THEN 'Practitioner' WHEN s_acctbal < 6000 THEN 'PractitionerRole' ELSE 'Unknown' END AS kind FROM supplier""")
def _(spark, sf):
    kind = F.when(col("s_acctbal") < 3000, "Practitioner/").when(col("s_acctbal") < 6000, "PractitionerRole/").otherwise("Device/")
    ids, name = C.dispatch_reference(F.concat(kind, col("s_nationkey").cast("string")), ("Practitioner", "PractitionerRole", "Organization"))
    return plain(bridge.load(spark, sf, "supplier").select(
        "s_suppkey", ids["Practitioner"].alias("practitioner"), ids["PractitionerRole"].alias("role"), name.alias("kind")))


@query("expr_first_coding", f"""SELECT oid AS id, CASE WHEN inferred THEN '{codes.ADT_CODE}' ELSE '"L' || lab || '"' END AS raw,
 CASE WHEN inferred THEN '{codes.ADT_CODE}' ELSE 'L' || lab END AS code, CASE WHEN inferred THEN 'Answer' END AS answer FROM {flat_sql.EVENTS}""")
def _(spark, sf):
    raw = C.first_coding(col("code"), "code")
    return plain(stage.resource(spark, sf, "Observation").select(
        "id", raw.alias("raw"), C.strip_quotes(raw).alias("code"), C.first_coding(col("valueCodeableConcept"), "display").alias("answer")))


@query("expr_json_text", """SELECT c_custkey, '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS object,
 '["' || c_mktsegment || '","' || c_nationkey || '"]' AS list FROM customer""")
def _(spark, sf):
    return plain(bridge.load(spark, sf, "customer").select(
        "c_custkey", C.as_json(F.struct(col("c_name").alias("name"), col("c_mktsegment").alias("segment"))).alias("object"),
        C.as_json(F.array("c_mktsegment", col("c_nationkey").cast("string"))).alias("list")))


@query("expr_join_arrays", """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name || ' ' || c_mktsegment END AS words,
 CASE WHEN c_acctbal >= 0 THEN c_name || ', ' || c_mktsegment ELSE '' END AS lines FROM customer""")
def _(spark, sf):
    words = F.when(col("c_acctbal") >= 0, F.array("c_name", "c_mktsegment"))
    return plain(bridge.load(spark, sf, "customer").select(
        "c_custkey", C.join_words(words).alias("words"), C.join_lines(words).alias("lines")))


@query("expr_dates", f"""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed,
 strftime(o_orderdate, '%Y-%m-%d') AS prefix, CAST(year({TODAY}) - year(o_orderdate) AS BIGINT) AS years,
 date_diff('day', CAST(o_orderdate AS DATE), {TODAY}) AS days, CAST(floor(o_totalprice / 1000) AS BIGINT) AS minutes, year(o_orderdate) AS y FROM orders""")
def _(spark, sf):
    day = col("o_orderdate")
    text = F.when(col("o_orderstatus") == "P", "1999-13-45").otherwise(F.date_format(day, "yyyy-MM-dd"))
    end = day + F.make_dt_interval(mins=F.floor(col("o_totalprice") / 1000).cast("int"), secs=F.lit(20))
    today = F.lit(stage.AS_OF).cast("date")
    return plain(orders(spark, sf).select(
        "o_orderkey", C.parse_date(text).alias("parsed"), C.date_prefix(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")).alias("prefix"),
        C.years_between(day, today).alias("years"), C.days_between(day, today).alias("days"),
        C.minutes_between(day, end).alias("minutes"), C.year_of(day).alias("y")))


@query("expr_defaults", """SELECT event_id, CASE WHEN value > 50 THEN 'home' ELSE event_type END AS kind, CAST(value <= 50 AS VARCHAR) AS present,
 CASE WHEN value <= 50 THEN event_type ELSE CAST(k AS VARCHAR) END AS text FROM """ + _EV)
def _(spark, sf):
    maybe = F.when(col("value") <= 50, col("event_type"))
    return plain(events(spark, sf).select(
        "event_id", C.default_value(maybe, "home").alias("kind"), C.is_present(maybe).alias("present"),
        C.first_text(maybe, col("k")).alias("text")))


@query("expr_document_class", f"""SELECT doc_id, {flat_sql.text_list([codes.DOCUMENT_CLASS.get(c, 'unknown') for c in bridge.DOCUMENT_CODES])}
 [CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) + 1] AS class FROM documents""")
def _(spark, sf):
    kind = col("type")
    return plain(stage.resource(spark, sf, "DocumentReference").select(
        col("id").cast("long").alias("doc_id"),
        C.document_class(C.first_coding(kind, "code"), C.first_coding(kind, "system")).alias("class")))


@query("expr_value_kind", "SELECT o_orderkey, CAST(u.pos AS BIGINT) AS pos, u.kind FROM orders, (VALUES (0, 'string'), (1, 'integer'), (2, 'unknown')) u(pos, kind)")
def _(spark, sf):
    df = stage.resource(spark, sf, "Condition").select(col("id").cast("long").alias("o_orderkey"), F.posexplode("extension").alias("pos", "x"))
    return plain(df.select("o_orderkey", "pos", C.value_kind(col("x")).alias("kind")))


@query("expr_numeric_value", f"SELECT event_id, CAST(CASE WHEN event_type = 'click' THEN k ELSE round(value, 2) END AS DOUBLE) AS number FROM {_EV}")
def _(spark, sf):
    text = F.when(col("event_type") == "click", F.lit("n/a")).otherwise(F.round("value", 2).cast("string"))
    return plain(events(spark, sf).select("event_id", C.numeric_value(text, col("k")).alias("number")))


@query("expr_attachment_location", """SELECT doc_id, CASE WHEN lang = 'en' THEN 'https://example.org/' || doc_id WHEN lang = 'de' THEN 'ref:content[' || n_chars || '].attachment.data' END AS location
 FROM documents""")
def _(spark, sf):
    url = F.when(col("lang") == "en", F.concat(F.lit("https://example.org/"), col("doc_id").cast("string")))
    return plain(bridge.load(spark, sf, "documents").select(
        "doc_id", C.attachment_location(url, F.when(col("lang") == "de", col("text")), col("n_chars")).alias("location")))


@query("expr_parse_concept_dump", """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_type = 'PROMO' THEN 'urn:b|' || p_brand ELSE
 'urn:a|' || p_partkey || '|' || p_name || ';urn:b|' || p_brand END AS codings, CASE WHEN p_type NOT IN ('SMALL', 'LARGE') THEN p_name END AS text FROM part""")
def _(spark, sf):
    key, kind = col("p_partkey").cast("string"), col("p_type")
    first = F.when(kind == "PROMO", F.lit("{id=null, system=null, code=null, display=null}")).otherwise(
        F.concat(F.lit("{id=null, extension=null, system=urn:a, _system=null, code="), key, F.lit(", _code=null, display="), col("p_name"), F.lit(", userSelected=null}")))
    second = F.concat(F.lit("{id=null, system=urn:b, _system=null, code="), col("p_brand"), F.lit(", _code=null, display=null, _display=null}"))
    text = F.when(kind == "LARGE", "null").otherwise(col("p_name"))
    dump = F.concat(F.lit("{id=null, coding=["), F.when(kind == "SMALL", "").otherwise(F.concat(first, F.lit(", "), second)),
                    F.lit("], text="), text, F.lit(", _text=null}"))
    parsed = bridge.load(spark, sf, "part").select("p_partkey", C.parse_concept_dump(dump).alias("c"))
    return plain(parsed.select("p_partkey", "c.coding", "c.text").withColumnRenamed("coding", "codings"))


@query("expr_inferred_evidence", f"""SELECT oid AS id, CASE WHEN inferred THEN '[{{"url":"urn:AI-evidence:quote","reference":"DocumentReference/' || k ||
 '","display":"Source","valueString":"q' || k || '","value":[{{"extension":[{{"extension":[{{"url":"column","valueString":"q' || k || '"}}],"url":"line"}}],"url":"page","valueInteger":' || k || '}}]}}]' END AS evidence FROM {flat_sql.EVENTS}""")
def _(spark, sf):
    return plain(stage.resource(spark, sf, "Observation").select(
        "id", C.inferred_evidence(col("meta"), col("derivedFrom"), "ai-evidence").alias("evidence")))


@query("expr_sanitize", """SELECT doc_id, replace(replace(replace(replace(text, chr(13), ''), chr(10), ''), chr(9), ''), '"', '') AS no_control,
 replace(replace(text, chr(92), ''), '"', '') AS no_escapes,
 replace(replace(replace(replace(replace(text, chr(13), ''), chr(10), ''), chr(9), ''), '"', ''), chr(92), chr(92) || chr(92)) AS escaped FROM documents""")
def _(spark, sf):
    text = col("text")
    return plain(bridge.load(spark, sf, "documents").select(
        "doc_id", C.strip_control(text).alias("no_control"), C.strip_escapes(text).alias("no_escapes"), C.escape_backslashes(text).alias("escaped")))


@query("expr_plain_name", "SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9 .-]', '', 'g') AS name FROM pages")
def _(spark, sf):
    return plain(bridge.load(spark, sf, "pages").select("page_id", C.plain_name(col("url")).alias("name")))


@query("expr_activity_status", f"""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'deceased' WHEN o_orderstatus = 'P' THEN 'no_encounters'
 WHEN date_diff('day', CAST(o_orderdate AS DATE), {TODAY}) <= 90 THEN 'active' WHEN date_diff('day', CAST(o_orderdate AS DATE), {TODAY}) <= 365
 THEN 'inactive_recent' ELSE 'inactive_historical' END AS status FROM orders""")
def _(spark, sf):
    seen = F.when(col("o_orderstatus") != "P", col("o_orderdate"))
    status = C.activity_status(col("o_orderpriority") == "1-URGENT", seen, F.lit(stage.AS_OF).cast("date"))
    return plain(orders(spark, sf).select("o_orderkey", status.alias("status")))


@query("expr_url_kind", "SELECT page_id, CASE WHEN url ILIKE 'http%' THEN 'HTTP' WHEN url ILIKE 's3:%' THEN 'S3' WHEN url ILIKE 'ref:%' THEN 'Reference' ELSE 'Other' END AS kind FROM pages")
def _(spark, sf):
    return plain(bridge.load(spark, sf, "pages").select("page_id", C.url_kind(col("url")).alias("kind")))


@query("expr_pattern_sets", """SELECT p_partkey, CAST(p_name ILIKE '%RING%' OR p_name ILIKE 'Blue%' AS VARCHAR) AS named,
 CAST(p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#25%' AS VARCHAR) AS branded, CAST(CASE p_type WHEN 'LARGE' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'STANDARD' THEN 3 ELSE 4 END AS BIGINT) AS priority FROM part""")
def _(spark, sf):
    return plain(bridge.load(spark, sf, "part").select(
        "p_partkey", C.matches_any(col("p_name"), ["%RING%", "Blue%"]).alias("named"),
        C.starts_with_any(col("p_brand"), ["Brand#1", "Brand#25"]).alias("branded"),
        C.system_priority(col("p_type"), ("LARGE", "%MALL%", "STANDARD")).alias("priority")))


@query("expr_audit_columns", "SELECT c_custkey, '2001-06-01 00:00:00.000000' AS created, '2001-06-01 00:00:00.000000' AS updated FROM customer")
def _(spark, sf):
    audit = C.audit_columns(stage.AS_OF)
    return plain(bridge.load(spark, sf, "customer").select(
        "c_custkey", audit["created_at"].alias("created"), audit["updated_at"].alias("updated")))
