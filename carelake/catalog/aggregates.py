"""Queries of the nesting, aggregation, window and join building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.catalog import stage
from carelake.catalog.marts import oracle
from carelake.catalog.registry import query
from carelake.catalog.render import plain
from carelake.operators import nest, series
from carelake.sources import bridge

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
col = F.col


def t(spark, sf, name):
    return bridge.load(spark, sf, name)


# Arrays are built from tables flattened from resources: a group never exceeds the
# array of the one resource row it came from.


@query("agg_nest_children", oracle("""SELECT encounter_id, string_agg(concat_ws('|', participant_type, participant_id), ';' ORDER BY participant_type, participant_id)
 AS participants FROM encounter_participants GROUP BY encounter_id"""))
def _(spark, sf):
    return plain(nest.nest_children(
        stage.table(spark, sf, "encounter_participants"), "encounter_id", "participants", kind=col("participant_type"), id=col("participant_id")))


@query("agg_nest_distinct", oracle("""SELECT diagnostic_report_id, string_agg(DISTINCT observation_id, ';' ORDER BY observation_id) AS results
 FROM diagnostic_report_results GROUP BY diagnostic_report_id"""))
def _(spark, sf):
    return plain(nest.nest_children(
        stage.table(spark, sf, "diagnostic_report_results"), "diagnostic_report_id", "results", distinct=True, id=col("observation_id")))


@query("agg_assemble", oracle("""SELECT e.encounter_id, e.status, coalesce(l.v, '') AS locations, coalesce(p.v, '') AS practitioners FROM encounters e
 LEFT JOIN (SELECT encounter_id, string_agg(location_id, ';' ORDER BY location_id) AS v FROM encounter_locations GROUP BY 1) l ON e.encounter_id = l.encounter_id
 LEFT JOIN (SELECT encounter_id, string_agg(DISTINCT participant_id, ';' ORDER BY participant_id) AS v FROM encounter_participants GROUP BY 1) p ON e.encounter_id = p.encounter_id"""))
def _(spark, sf):
    tables = stage.Tables(spark, sf)
    return plain(nest.assemble(
        tables["encounters"].select("encounter_id", "status"), "encounter_id",
        lists={"locations": nest.part(tables["encounter_locations"], "encounter_id", id=col("location_id"))},
        sets={"practitioners": nest.part(tables["encounter_participants"], "encounter_id", id=col("participant_id"))}))


@query("agg_typed_json", oracle("""SELECT observation_id, '[' || string_agg('{"code":"' || component_code || '"' || CASE WHEN component_value_quantity_value IS NOT NULL
 THEN ',"value":' || CAST(component_value_quantity_value AS BIGINT) ELSE '' END || CASE WHEN component_data_absent_reason_code IS NOT NULL THEN ',"absent":true' ELSE '' END
 || '}', ',' ORDER BY component_code) || ']' AS components FROM observation_components GROUP BY observation_id"""))
def _(spark, sf):
    nested = nest.nest_children(
        stage.table(spark, sf, "observation_components"), "observation_id", "components", code=col("component_code"),
        value=col("component_value_quantity_value").cast("long"), absent=F.when(col("component_data_absent_reason_code").isNotNull(), F.lit(True)))
    return nest.to_json_columns(nested)


@query("agg_text_list", oracle("""SELECT patient_id, string_agg(coalesce(address_text, city), ' | ' ORDER BY CASE address_use WHEN 'home' THEN 1 WHEN 'work' THEN 2 ELSE 3 END)
 AS text FROM patient_addresses GROUP BY patient_id"""))
def _(spark, sf):
    use = col("address_use")
    nested = nest.nest_children(
        stage.table(spark, sf, "patient_addresses"), "patient_id", "items",
        order=F.when(use == "home", 1).when(use == "work", 2).otherwise(3), text=F.coalesce("address_text", "city"))
    return plain(nested.select("patient_id", nest.joined_text(col("items"), lambda x: x["text"], " | ").alias("text")))


@query("agg_distinct_text", "SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def _(spark, sf):
    return plain(nest.distinct_text(t(spark, sf, "events"), ["user_id"], col("event_type"), "kinds", ", "))


@query("agg_distinct_counts", """SELECT l_suppkey, count(DISTINCT l_orderkey) AS total, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned,
 count(DISTINCT CASE WHEN l_quantity > 25 THEN l_orderkey END) AS large FROM lineitem GROUP BY l_suppkey""")
def _(spark, sf):
    return plain(nest.distinct_counts(t(spark, sf, "lineitem"), "l_suppkey", "l_orderkey", returned=col("l_returnflag") == "R", large=col("l_quantity") > 25))


@query("agg_conditional_max", "SELECT user_id, max(CASE WHEN event_type = 'view' THEN value END) AS top_view, max(CASE WHEN event_type = 'click' THEN value END) AS top_click FROM events GROUP BY user_id")
def _(spark, sf):
    top = lambda k: F.max(F.when(col("event_type") == k, col("value"))).alias(f"top_{k}")
    return t(spark, sf, "events").groupBy("user_id").agg(top("view"), top("click"))


@query("agg_collapse_row", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS n, l_partkey AS part FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
 ORDER BY l_extendedprice DESC, l_linenumber DESC, l_partkey DESC) AS r FROM lineitem) WHERE r = 1""")
def _(spark, sf):
    best = F.max_by(F.struct(col("l_linenumber").alias("n"), col("l_partkey").alias("part")), F.struct("l_extendedprice", "l_linenumber", "l_partkey"))
    return plain(t(spark, sf, "lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", "b.*"))


@query("agg_min_max_count", f"SELECT o_custkey, {_TS.format('min(o_orderdate)')} AS first, {_TS.format('max(o_orderdate)')} AS last, count(*) AS orders FROM orders GROUP BY o_custkey")
def _(spark, sf):
    return plain(t(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"), F.count("*").alias("orders")))


@query("agg_group_by_all", "SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(F.count("*").alias("n"))


@query("agg_distinct_rows", "SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem")
def _(spark, sf):
    return plain(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct())


# --- windows --------------------------------------------------------------


@query("window_best_row", f"SELECT o_custkey, o_orderkey, {_TS.format('o_orderdate')} AS o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
       "ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def _(spark, sf):
    orders = t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return plain(nest.best_row(orders, "o_custkey", col("o_orderdate").desc(), col("o_orderkey")))


@query("window_earliest_nulls_last", f"""SELECT o_custkey, o_orderkey, {_TS.format('d')} AS d FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d ASC NULLS LAST, o_orderkey) AS r
 FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d FROM orders)) WHERE r = 1""")
def _(spark, sf):
    orders = t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(col("o_orderstatus") != "P", col("o_orderdate")).alias("d"))
    return plain(nest.best_row(orders, "o_custkey", col("d").asc_nulls_last(), col("o_orderkey")))


@query("window_recency_rank", """SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY d DESC NULLS FIRST) AS recency
 FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS d FROM orders)""")
def _(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(col("o_orderpriority") != "5-LOW", col("o_orderdate")).alias("d"))
    return plain(series.recency_rank(orders, "o_custkey", "d", "recency").drop("d"))


@query("window_previous_row", f"""SELECT event_id, user_id, lag(value) OVER w AS previous_value, {_TS.format('lag(ts) OVER w')} AS previous_ts,
 date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(spark, sf):
    out = series.previous_row(t(spark, sf, "events"), "user_id", "ts", "event_id", {"value": "previous_value", "ts": "previous_ts"})
    return plain(out.select("event_id", "user_id", "previous_value", "previous_ts", F.datediff("ts", "previous_ts").alias("gap")))


@query("window_running_low", "SELECT event_id, min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM events")
def _(spark, sf):
    return plain(series.running_low(t(spark, sf, "events"), "user_id", "ts", "event_id", "value", "low").select("event_id", "low"))


@query("window_later_high", """SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) RANGE BETWEEN INTERVAL 7 DAY FOLLOWING
 AND UNBOUNDED FOLLOWING) AS high FROM events""")
def _(spark, sf):
    return plain(series.later_high(t(spark, sf, "events"), "user_id", "ts", "value", 7, "high").select("event_id", "high"))


@query("series_event_doubling", """SELECT event_id, round(CASE WHEN p > 0 AND value > p AND g > 0 THEN ln(2) * g / ln(value / p) END, 4) AS doubling_days FROM (SELECT event_id, value,
 lag(value) OVER w AS p, date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS g FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def _(spark, sf):
    out = series.doubling_time(t(spark, sf, "events"), value="value", key="user_id", ts="ts", tie="event_id")
    return plain(out.select("event_id", F.round("doubling_days", 4).alias("doubling_days")))


@query("series_event_progression", """SELECT event_id, CAST(rise AS VARCHAR) AS is_rise, CAST(rise AND coalesce(high >= low * 1.25 AND high - low > 2.0, FALSE) AS VARCHAR) AS is_confirmed
 FROM (SELECT *, coalesce(value >= low * 1.25 AND value - low > 2.0, FALSE) AS rise FROM (SELECT *,
 min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low,
 max(value) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) RANGE BETWEEN INTERVAL 21 DAY FOLLOWING AND UNBOUNDED FOLLOWING) AS high FROM events))""")
def _(spark, sf):
    out = series.progression(t(spark, sf, "events"), "user_id", "ts", "value", "event_id")
    return plain(out.select("event_id", "is_rise", "is_confirmed"))


@query("series_threshold_status", """SELECT event_id, CASE WHEN (unit = 'ng/dL' AND value < 50) OR (unit = 'nmol/L' AND value < 1.7) THEN 'Castrate' ELSE 'Non-Castrate' END AS status
 FROM (SELECT *, CASE event_type WHEN 'view' THEN 'ng/dL' WHEN 'click' THEN 'nmol/L' END AS unit FROM events)""")
def _(spark, sf):
    unit = F.when(col("event_type") == "view", "ng/dL").when(col("event_type") == "click", "nmol/L")
    return t(spark, sf, "events").select("event_id", series.threshold_status(col("value").cast("decimal(15,4)"), F.coalesce(unit, F.lit(""))).alias("status"))


# --- joins and sets -----------------------------------------------------------


@query("join_left_chain", """SELECT c_custkey, c_name, coalesce(o.n, 0) AS orders, o.top AS top_price, s.s_name FROM customer
 LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1) o ON c_custkey = o_custkey LEFT JOIN supplier s ON c_custkey = s_suppkey""")
def _(spark, sf):
    per = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("top_price"))
    df = t(spark, sf, "customer").join(per, col("c_custkey") == col("o_custkey"), "left").join(
        t(spark, sf, "supplier"), col("c_custkey") == col("s_suppkey"), "left")
    return df.select("c_custkey", "c_name", F.coalesce("orders", F.lit(0)).alias("orders"), "top_price", "s_name")


@query("join_composite", f"""SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_extendedprice, {_TS.format('l.l_shipdate')} AS l_shipdate FROM lineitem l
 JOIN (SELECT l_orderkey, max(l_shipdate) AS newest FROM lineitem GROUP BY 1) m ON l.l_orderkey = m.l_orderkey AND l.l_shipdate = m.newest""")
def _(spark, sf):
    line = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    newest = line.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("l_shipdate"))
    return plain(line.join(newest, ["l_orderkey", "l_shipdate"]))


@query("join_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, sf):
    hit = t(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return t(spark, sf, "orders").join(hit, col("o_orderkey") == col("l_orderkey"), "left_semi").select("o_orderkey")


@query("join_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, sf):
    hit = t(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return t(spark, sf, "orders").join(hit, col("o_orderkey") == col("l_orderkey"), "left_anti").select("o_orderkey")


@query("join_interval", """SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_extendedprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey
 WHERE l_shipdate >= o_orderdate - INTERVAL 90 DAY AND l_shipdate < o_orderdate + INTERVAL 30 DAY""")
def _(spark, sf):
    near = (col("l_shipdate") >= col("o_orderdate") - F.expr("interval 90 days")) & (col("l_shipdate") < col("o_orderdate") + F.expr("interval 30 days"))
    df = t(spark, sf, "orders").join(t(spark, sf, "lineitem"), (col("o_orderkey") == col("l_orderkey")) & near)
    return plain(df.select("o_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))


@query("join_raw_children", oracle("""SELECT c.observation_id, c.code_code, p.component_code, n.note_text FROM observation_codes c
 JOIN observation_components p ON c.observation_id = p.observation_id LEFT JOIN observation_notes n ON c.observation_id = n.observation_id"""))
def _(spark, sf):
    tables = stage.Tables(spark, sf)
    df = tables["observation_codes"].join(tables["observation_components"].drop("patient_id"), "observation_id").join(
        tables["observation_notes"].drop("patient_id"), "observation_id", "left")
    return df.select("observation_id", "code_code", "component_code", "note_text")


@query("union_labelled_criteria", """SELECT reason, o_custkey, count(*) AS n FROM (SELECT 'urgent' AS reason, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
 UNION ALL SELECT 'large', o_custkey FROM orders WHERE o_totalprice > 250000 UNION ALL SELECT 'pending', o_custkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1, 2""")
def _(spark, sf):
    """One pass: every row is labelled with all the criteria it meets."""
    labels = F.array_compact(F.array(
        F.when(col("o_orderpriority") == "1-URGENT", "urgent"), F.when(col("o_totalprice") > 250000, "large"), F.when(col("o_orderstatus") == "P", "pending")))
    return t(spark, sf, "orders").select("o_custkey", F.explode(labels).alias("reason")).groupBy("reason", "o_custkey").agg(F.count("*").alias("n"))


@query("sort_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(col("o_totalprice").desc(), "o_orderkey")


@query("limit_top", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("filter_predicates", """SELECT p_partkey FROM part WHERE (p_type IN ('LARGE', 'SMALL') AND p_name LIKE '%ring%') OR (p_name ILIKE 'RED%' AND p_name NOT ILIKE '%GEAR%'
 AND p_brand <> 'Brand#1') OR p_size IS NULL""")
def _(spark, sf):
    keep = (col("p_type").isin("LARGE", "SMALL") & col("p_name").like("%ring%")) | (
        col("p_name").ilike("RED%") & ~col("p_name").ilike("%GEAR%") & (col("p_brand") != "Brand#1")) | col("p_size").isNull()
    return t(spark, sf, "part").filter(keep).select("p_partkey")


@query("filter_relative_date", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '2001-06-01' - INTERVAL 3 MONTH")
def _(spark, sf):
    return t(spark, sf, "orders").filter(col("o_orderdate") >= F.add_months(F.lit(stage.AS_OF).cast("date"), -3)).select("o_orderkey")
