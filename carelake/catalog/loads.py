"""Queries of the load operators, sources and sinks.

Lines of an order serve as versions of one resource: the order is the id and the
ship date the version time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog import flat_sql, stage
from carelake.catalog.registry import query
from carelake.catalog.render import plain
from carelake.functions import columns as C
from carelake.operators import load, quality
from carelake.plans import jobs
from carelake.session import shared_folder
from carelake.sources import bridge, io

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def lines(spark, sf) -> DataFrame:
    """Versions: id, ts, payload columns and the flags."""
    return bridge.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("ts"), "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice",
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).alias("isDelete"),
        F.when(F.col("l_tax") > 0.06, "entered-in-error").otherwise("final").alias("status"),
    )


LINES = """(SELECT l_orderkey AS id, l_shipdate AS ts, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
 l_returnflag = 'R' AND l_quantity > 45 AS isDelete, CASE WHEN l_tax > 0.06 THEN 'entered-in-error' ELSE 'final' END AS status FROM lineitem)"""
_ORDER = "l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"
LATEST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, {_ORDER}) AS r FROM {LINES}) WHERE r = 1)"
_OUT = f"id, {_TS.format('ts')} AS ts, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(isDelete AS VARCHAR) AS isDelete, status"


def latest(spark, sf) -> DataFrame:
    ties = [F.col(c).desc() for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return load.latest_version(lines(spark, sf), "id", F.col("ts"), ties)


def loaded(spark, sf) -> DataFrame:
    """Rows already in the target: the orders that are not pending."""
    return bridge.load(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("id"), F.timestamp_add("DAY", F.lit(60), F.col("o_orderdate")).alias("ts"),
        F.col("o_orderpriority").alias("payload"),
    )


LOADED = "(SELECT o_orderkey AS id, o_orderdate + INTERVAL 60 DAY AS ts, o_orderpriority AS payload FROM orders WHERE o_orderstatus <> 'P')"


def incoming(spark, sf) -> DataFrame:
    """Newest line per order; its time is unknown for status F returns."""
    return latest(spark, sf).select(
        "id", F.when(F.col("l_linenumber") < 7, F.col("ts")).alias("ts"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("payload"),
    )


INCOMING = f"(SELECT id, CASE WHEN l_linenumber < 7 THEN ts END AS ts, 'part ' || l_partkey AS payload FROM {LATEST})"
_CLASSIFIED = f"""(SELECT i.*, CASE WHEN t.id IS NULL THEN 'new' WHEN i.ts IS NULL THEN 'unversioned' WHEN i.ts > t.ts THEN 'updated'
 ELSE 'skipped' END AS version_action FROM {INCOMING} i LEFT JOIN {LOADED} t ON i.id = t.id)"""
_TRIPLE = f"id, {_TS.format('ts')} AS ts, payload"


# --- sources --------------------------------------------------------------


@query("source_nested_scan", f"SELECT oid AS id, CASE WHEN inferred THEN 'Inferred finding' ELSE {flat_sql.text_list(bridge.LAB_NAMES)}[lab + 1] END AS text, "
       f"CAST(CASE WHEN inferred THEN 1 ELSE 3 END AS BIGINT) AS codings FROM {flat_sql.EVENTS}")
def _(spark, sf):
    path = stage.path_of(spark, sf, "Observation")
    df = io.read_resource(spark, "Observation", path)
    return plain(df.select("id", F.col("code.text").alias("text"), F.size("code.coding").alias("codings")))


@query("source_whole_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return plain(bridge.load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("source_newest_value", f"SELECT {_TS.format('max(ts)')} AS max_ts FROM events")
def _(spark, sf):
    return plain(io.newest(bridge.load(spark, sf, "events"), "ts"))


@query("source_conform", "SELECT c_name, c_nationkey::BIGINT AS \"C_NATIONKEY\", CAST(NULL AS VARCHAR) AS c_comment FROM customer")
def _(spark, sf):
    from carelake.sources.schemas import datatype

    return io.conform(bridge.load(spark, sf, "customer"), datatype("c_name string, C_NATIONKEY bigint, c_comment string"))


# --- high-water mark and versions -------------------------------------------


@query("load_bookmark", f"SELECT {_TS.format('max(ts) - INTERVAL 7 DAY')} AS mark FROM events")
def _(spark, sf):
    return plain(load.bookmark(bridge.load(spark, sf, "events"), "ts", 7))


@query("load_after_bookmark", f"SELECT event_id, {_TS.format('ts')} AS ts, event_type FROM events WHERE ts > (SELECT max(ts) - INTERVAL 7 DAY FROM events)")
def _(spark, sf):
    events = bridge.load(spark, sf, "events").select("event_id", "ts", "event_type")
    return plain(load.after_bookmark(events, load.bookmark(events, "ts", 7), F.col("ts")))


@query("load_drop_deleted", f"SELECT {_OUT} FROM {LINES} WHERE id NOT IN (SELECT id FROM {LINES} WHERE isDelete)")
def _(spark, sf):
    return plain(load.drop_deleted(lines(spark, sf)))


@query("load_latest_version", f"SELECT {_OUT} FROM {LATEST}")
def _(spark, sf):
    return plain(latest(spark, sf))


@query("load_latest_by_aggregate", f"SELECT id, {_TS.format('max(ts)')} AS ts, count(*) AS versions FROM {LINES} GROUP BY id")
def _(spark, sf):
    df = lines(spark, sf)
    newest = df.groupBy("id").agg(F.max("ts").alias("ts"), F.count("*").alias("versions"))
    return plain(newest)


@query("load_classify_versions", f"SELECT {_TRIPLE}, version_action FROM {_CLASSIFIED}")
def _(spark, sf):
    return plain(load.classify_versions(incoming(spark, sf), loaded(spark, sf), "id", "ts"))


@query("load_version_diff", f"SELECT {_TRIPLE} FROM {_CLASSIFIED} WHERE version_action <> 'skipped'")
def _(spark, sf):
    return plain(load.version_diff(incoming(spark, sf), loaded(spark, sf), "id", "ts"))


@query("load_version_diff_any_change", f"SELECT i.id, {_TS.format('i.ts')} AS ts, i.payload FROM {INCOMING} i LEFT JOIN {LOADED} t ON i.id = t.id "
       "WHERE t.id IS NULL OR i.ts IS DISTINCT FROM t.ts")
def _(spark, sf):
    return plain(load.version_diff(incoming(spark, sf), loaded(spark, sf), "id", "ts", any_change=True))


@query("load_unseen_timestamps", f"SELECT {_TRIPLE} FROM {INCOMING} i WHERE NOT EXISTS (SELECT 1 FROM {LOADED} t WHERE t.ts = i.ts)")
def _(spark, sf):
    return plain(load.unseen_timestamps(incoming(spark, sf), loaded(spark, sf), "ts"))


@query("load_keys_to_replace", f"SELECT DISTINCT id FROM {LINES} WHERE id IN (SELECT id FROM {LOADED})")
def _(spark, sf):
    return plain(load.keys_to_replace(lines(spark, sf), loaded(spark, sf), "id"))


@query("load_orphan_keys", f"SELECT id FROM {LOADED} WHERE id NOT IN (SELECT id FROM {LINES})")
def _(spark, sf):
    return plain(load.orphan_keys(loaded(spark, sf), lines(spark, sf), "id"))


# --- merges -------------------------------------------------------------------

_UPSERT = f"""SELECT * FROM {LOADED} WHERE id NOT IN (SELECT id FROM {_CLASSIFIED} WHERE version_action <> 'skipped')
 UNION ALL SELECT id, ts, payload FROM {_CLASSIFIED} WHERE version_action <> 'skipped'"""


@query("load_upsert", f"SELECT {_TRIPLE} FROM ({_UPSERT})")
def _(spark, sf):
    return plain(load.upsert(loaded(spark, sf), incoming(spark, sf), "id", "ts"))


@query("load_upsert_twice", f"SELECT {_TRIPLE} FROM ({_UPSERT})")
def _(spark, sf):
    """A second run over the result of the first changes nothing.

    The incoming rows and the result of the first run are written, as by a load: in one
    plan the newest lines would be sorted again for each of their uses, all in one task.
    """
    path = _folder(spark, "upsert")
    io.full_refresh(incoming(spark, sf), f"{path}/incoming")
    new = spark.read.parquet(f"{path}/incoming")
    io.full_refresh(load.upsert(loaded(spark, sf), new, "id", "ts"), f"{path}/first")
    return plain(load.upsert(spark.read.parquet(f"{path}/first"), new, "id", "ts"))


@query("load_replace_children", f"""SELECT id, child FROM (SELECT o_orderkey AS id, 'old ' || o_orderstatus AS child FROM orders)
 WHERE id NOT IN (SELECT id FROM {_CLASSIFIED} WHERE version_action <> 'skipped') UNION ALL
 SELECT l.id, 'line ' || l.l_linenumber AS child FROM {LINES} l WHERE l.id IN (SELECT id FROM {_CLASSIFIED} WHERE version_action <> 'skipped')""")
def _(spark, sf):
    old = bridge.load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("old "), F.col("o_orderstatus")).alias("child"))
    new = lines(spark, sf).select("id", F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("child"))
    accepted = load.version_diff(incoming(spark, sf), loaded(spark, sf), "id", "ts")
    return plain(load.replace_children(old, new, accepted, "id"))


@query("load_entered_in_error", f"SELECT DISTINCT id FROM {LINES} WHERE status = 'entered-in-error'")
def _(spark, sf):
    return plain(load.entered_in_error(lines(spark, sf)))


@query("load_retract", f"""SELECT 'orders' AS table_name, count(*) AS rows FROM orders WHERE o_orderkey NOT IN (SELECT id FROM {LINES} WHERE status = 'entered-in-error')
 UNION ALL SELECT 'lines', count(*) FROM {LINES} WHERE id NOT IN (SELECT id FROM {LINES} WHERE status = 'entered-in-error')""")
def _(spark, sf):
    rows = lines(spark, sf)
    tables = {"orders": bridge.load(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"), "lines": rows}
    return plain(quality.row_counts(load.retract(tables, load.entered_in_error(rows), "id")))


# --- sinks ----------------------------------------------------------------


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/carelake/sinks/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query("sink_full_refresh", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf):
    path = _folder(spark, "full")
    io.full_refresh(bridge.load(spark, sf, "customer").select("c_custkey", "c_name"), path)
    io.full_refresh(bridge.load(spark, sf, "supplier").select("s_suppkey", "s_name"), path)
    return spark.read.parquet(path)


@query("sink_append", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf):
    path = _folder(spark, "append")
    io.append(bridge.load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), path)
    io.append(bridge.load(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), path)
    return spark.read.parquet(path)


@query("sink_bookmark", f"SELECT event_id, {_TS.format('ts')} AS ts FROM events")
def _(spark, sf):
    """First load overwrites, the increment past its mark is appended: all rows once."""
    path = _folder(spark, "bookmark")
    events = bridge.load(spark, sf, "events").select("event_id", "ts")
    middle = events.agg(F.timestamp_micros(
        ((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2).cast("long")).alias("mark"))
    io.bookmark_sink(events.filter(F.col("ts") <= middle.scalar()), path, has_mark=False)
    mark = load.bookmark(spark.read.parquet(path), "ts")
    io.bookmark_sink(load.after_bookmark(events, mark, F.col("ts")), path, has_mark=True)
    return plain(spark.read.parquet(path))


@query("sink_json_lines", "SELECT CAST(c_custkey AS VARCHAR) AS patient, c_name AS official_name, CAST(c_acctbal >= 0 AS VARCHAR) AS active FROM customer")
def _(spark, sf):
    path = _folder(spark, "json")
    io.write_json_lines(stage.resource(spark, sf, "Patient"), path, {"id": "patient", "name": "names", "active": "active"})
    back = spark.read.schema("patient string, names array<struct<text:string>>, active boolean").json(path)
    return plain(back.select("patient", F.get("names", F.lit(0))["text"].alias("official_name"), "active"))


@query("sink_bucketed", "SELECT o_orderpriority, count(*) AS orders, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(spark, sf):
    """Line items and orders bucketed on the order key, joined without a shuffle of either."""
    tag = uuid.uuid4().hex[:12]
    left, right = f"bucketed_lines_{tag}", f"bucketed_orders_{tag}"
    io.save_bucketed(bridge.load(spark, sf, "lineitem").select("l_orderkey", "l_quantity"), left, "l_orderkey", [], 8)
    io.save_bucketed(bridge.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), right, "o_orderkey", [], 8)
    joined = spark.table(left).join(spark.table(right), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("load_sample_rows", "SELECT least(count(*), 500) AS rows FROM events")
def _(spark, sf):
    return io.sample_rows(bridge.load(spark, sf, "events"), 500).agg(F.count("*").alias("rows"))


@query("load_dry_run", "SELECT c_mktsegment, count(*) AS rows FROM customer GROUP BY 1")
def _(spark, sf):
    path = _folder(spark, "dry")
    df = io.full_refresh(bridge.load(spark, sf, "customer"), path, dry_run=True)
    return df.groupBy("c_mktsegment").agg(F.count("*").alias("rows"))


# --- whole job ----------------------------------------------------------------

_KEPT = "(SELECT * FROM {0} WHERE oid NOT IN (SELECT oid FROM {0} WHERE event_type = 'click' AND value > 100 OR event_type = 'error'))".format(flat_sql.EVENTS)


@query("job_load_observations", f"""SELECT 'observations' AS table_name, count(*) AS rows FROM {_KEPT}
 UNION ALL SELECT 'observation_codes', sum(CASE WHEN inferred THEN 1 ELSE 3 END)::BIGINT FROM {_KEPT}
 UNION ALL SELECT 'observation_components', sum(CASE WHEN event_type IN ('signup', 'purchase') THEN 2 ELSE 0 END)::BIGINT FROM {_KEPT}
 UNION ALL SELECT 'observation_notes', sum(CASE WHEN event_type IN ('click', 'signup') THEN 1 ELSE 0 END)::BIGINT FROM {_KEPT}""")
def _(spark, sf):
    """Observations deleted or retracted in this load leave no rows in main and child tables."""
    source = stage.resource(spark, sf, "Observation")
    result = jobs.load_resource(
        "Observation", source, jobs.empty_tables(spark, "Observation"), stage.AS_OF,
        stage=jobs.written_stage(spark, f"observations-{uuid.uuid4().hex}"))
    names = ("observations", "observation_codes", "observation_components", "observation_notes")
    return quality.row_counts({n: result.tables[n] for n in names})


@query("job_load_unreadable_time", """SELECT 'first' AS load, CAST(o_orderkey AS VARCHAR) AS encounter_id FROM orders
 UNION ALL SELECT 'later', CAST(o_orderkey AS VARCHAR) FROM orders""")
def _(spark, sf):
    """Encounters without a readable time are loaded, whether they come in a first or in a later load."""
    source = stage.resource(spark, sf, "Encounter")
    blurred = source.withColumn("meta", F.when(F.col("class.code") == "emergency", F.col("meta").withField(
        "lastUpdated", F.lit("unknown"))).otherwise(F.col("meta")))
    both = jobs.load_resource("Encounter", blurred, jobs.empty_tables(spark, "Encounter"), stage.AS_OF)
    readable = jobs.load_resource("Encounter", source.filter("class.code <> 'emergency'"), jobs.empty_tables(spark, "Encounter"), stage.AS_OF)
    path = _folder(spark, "unreadable")
    jobs.write_load(readable, path)
    rest = blurred.filter("class.code = 'emergency'")
    later = jobs.load_resource("Encounter", rest, jobs.read_tables(spark, "Encounter", path), stage.AS_OF)
    return plain(both.tables["encounters"].select(F.lit("first").alias("load"), "encounter_id").unionByName(
        later.tables["encounters"].select(F.lit("later").alias("load"), "encounter_id")))


@query("job_sample_keeps_deletes", "SELECT count(*) AS rows FROM (SELECT 1 FROM events LIMIT 0)")
def _(spark, sf):
    """A sample is taken of what deletion leaves: of ids that all carry the flag nothing is loaded."""
    source = stage.resource(spark, sf, "Observation").withColumn("isDelete", F.lit(False))
    flagged = source.unionByName(source.withColumn("isDelete", F.lit(True)))
    result = jobs.load_resource("Observation", flagged, jobs.empty_tables(spark, "Observation"), stage.AS_OF, sample=5)
    return result.tables["observations"].agg(F.count("*").alias("rows"))


@query("job_second_increment", """SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
 CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress' ELSE 'cancelled' END || CASE WHEN o_orderpriority = '1-URGENT' THEN ' (revised)' ELSE '' END AS status FROM orders""")
def _(spark, sf):
    """Urgent encounters arrive again, a day newer; the rest stays as loaded."""
    source = stage.resource(spark, sf, "Encounter")
    first = jobs.load_resource("Encounter", source, jobs.empty_tables(spark, "Encounter"), stage.AS_OF)
    path = _folder(spark, "encounters")
    jobs.write_load(first, path)
    later = F.timestamp_add("DAY", F.lit(1), C.parse_timestamp(F.col("meta.lastUpdated")))
    again = source.filter(F.col("class.code") == "emergency").withColumns({
        "status": F.concat("status", F.lit(" (revised)")),
        "meta": F.col("meta").withField("lastUpdated", F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
    })
    second = jobs.load_resource(
        "Encounter", again, jobs.read_tables(spark, "Encounter", path), stage.AS_OF, backdate_days=None)
    return plain(second.tables["encounters"].select("encounter_id", "status"))
