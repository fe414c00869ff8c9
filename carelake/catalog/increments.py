"""Queries of increments: loads into a store, and what is live after them.

Observations are loaded in four steps, once per session:

1. all but those whose number ends in nine;
2. the rest; purchases a day newer, corrected and with a note; an old copy of every view;
3. every fourth view as entered in error, two days newer;
4. signups three days newer, with their first component, last two performers and last source only, without notes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.catalog import flat_sql, stage
from carelake.catalog.registry import query, register
from carelake.catalog.render import plain
from carelake.functions import columns as C
from carelake.operators.flatten import tables_of
from carelake.operators.generations import Store
from carelake.plans import jobs
from carelake.session import shared_folder
from carelake.sources import bridge

_MAIN, _CHILDREN = tables_of("Observation")
_stores: dict[tuple[str, str], Store] = {}


def _shifted(days: int) -> Column:
    later = F.timestamp_add("DAY", F.lit(days), C.parse_timestamp(F.col("meta.lastUpdated")))
    return F.col("meta").withField("lastUpdated", F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Observations with the number of their event and its kind, which meet them while they are flat."""
    events = bridge.load(spark, sf, "events")
    kinds = events.select(F.col("event_id").alias("number"), F.col("event_type").alias("kind"))
    number = F.regexp_extract(F.col("event_id").cast("string"), "([0-9]+)$", 1).cast("long")
    return bridge.observation_of(events.withColumn("number", number).join(kinds, "number"), "number", "kind")


def increments(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The sources of the four loads."""
    rows = _kinds(spark, sf)
    columns = [c for c in rows.columns if c not in ("number", "kind")]
    note = rows.schema["note"].dataType.elementType
    rechecked = F.array(F.struct(*[(F.lit("rechecked") if f.name == "text" else F.lit(None)).cast(f.dataType).alias(f.name) for f in note]))
    late = F.col("number") % 10 == 9
    purchases = rows.filter("kind = 'purchase'").withColumns({"meta": _shifted(1), "status": F.lit("corrected"), "note": rechecked})
    copies = rows.filter("kind = 'view'").filter(~late).withColumns({"meta": _shifted(-1), "status": F.lit("old copy")})
    errors = rows.filter("kind = 'view' AND number % 4 = 0").withColumns({"meta": _shifted(2), "status": F.lit("entered-in-error")})
    cut = rows.filter("kind = 'signup'").withColumns({
        "meta": _shifted(3), "component": F.slice("component", 1, 1), "performer": F.slice("performer", 2, 2),
        "derivedFrom": F.slice("derivedFrom", 2, 1), "note": F.lit(None).cast(rows.schema["note"].dataType)})
    second = rows.filter(late & (F.col("kind") != "purchase")).unionByName(purchases).unionByName(copies)
    return [df.select(*columns) for df in (rows.filter(~late), second, errors, cut)]


def store_after(spark: SparkSession, sf: str) -> Store:
    """Store after the four loads, made once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        root = f"{shared_folder(spark)}/carelake/stores/{uuid.uuid4().hex}"
        target = jobs.store(spark, "Observation", root, buckets=8).create()
        for source in increments(spark, sf):
            jobs.load_increment("Observation", source, target, stage.AS_OF, backdate_days=None)
        _stores[key] = target
    return _stores[key]


# --- oracles: the tables of the events that are left ---------------------------------

_LEFT = f"""(SELECT * FROM {flat_sql.EVENTS} WHERE NOT (event_type = 'click' AND value > 100) AND event_type <> 'error'
 AND NOT (event_type = 'view' AND event_id % 4 = 0))"""
_STAMP = "CASE event_type WHEN 'purchase' THEN ts + INTERVAL 1 DAY WHEN 'signup' THEN ts + INTERVAL 3 DAY ELSE ts END"


def _left(table: str) -> str:
    return flat_sql.RAW[table].replace(flat_sql.EVENTS, _LEFT)


_FINAL = {t: _left(t) for t in (_MAIN, *_CHILDREN)}
_FINAL["observations"] = f"""SELECT r.* REPLACE (CASE e.event_type WHEN 'purchase' THEN 'corrected' ELSE r.status END AS status,
 {_STAMP.replace("event_type", "e.event_type")} AS meta_last_updated, CASE WHEN e.inferred THEN 'Observation/obs-1|Observation' END AS derived_from)
 FROM ({_left("observations")}) r JOIN {_LEFT} e ON e.oid = r.observation_id"""
_FINAL["observation_components"] = " UNION ALL ".join(
    part for k, part in enumerate(_left("observation_components").split(" UNION ALL ")) if k != 1)
_FINAL["observation_notes"] = flat_sql.rows_of(
    "observation_notes", _LEFT,
    {"observation_id": "oid", "patient_id": "user_id", "note_text": """'note "' || k || '"'""", "_where": "event_type = 'click'"},
    {"observation_id": "oid", "patient_id": "user_id", "note_text": "'rechecked'", "_where": "event_type = 'purchase'"})
_FINAL["observation_performers"] = flat_sql.rows_of(
    "observation_performers", _LEFT,
    {"observation_id": "oid", "patient_id": "user_id", "performer_type": "'Practitioner'", "performer_id": "k", "_where": "NOT inferred"},
    {"observation_id": "oid", "patient_id": "user_id", "performer_type": "'Organization'", "performer_id": "'1'"})
_FINAL["observation_derived_from"] = _left("observation_derived_from").split(" UNION ALL ")[1]

for _table, _sql in _FINAL.items():
    register(
        f"load_three_increments_{_table}",
        lambda spark, sf, t=_table: plain(store_after(spark, sf).read(t)),
        flat_sql.table_oracle(_table, _sql),
    )


@query("load_generations", f"""WITH e AS (SELECT *, event_type = 'click' AND value > 100 AS gone, event_id % 10 = 9 AS late FROM {flat_sql.EVENTS}),
 named AS (SELECT CASE WHEN late OR event_type = 'purchase' THEN 2 ELSE 1 END AS gen, * FROM e WHERE NOT gone)
 SELECT 1::BIGINT AS gen, 0::BIGINT AS keys, (SELECT count(*) FROM e WHERE NOT gone AND NOT late AND event_type <> 'error') AS rows
 UNION ALL SELECT 2, (SELECT count(*) FROM named WHERE gen = 2), (SELECT count(*) FROM named WHERE gen = 2 AND event_type <> 'error')
 UNION ALL SELECT 3, (SELECT count(*) FROM e WHERE event_type = 'view' AND event_id % 4 = 0), 0
 UNION ALL SELECT 4, (SELECT count(*) FROM e WHERE event_type = 'signup'), (SELECT count(*) FROM e WHERE event_type = 'signup')""")
def _(spark, sf):
    """Keys named and main rows written by each generation: those of the increment, not of the target."""
    target = store_after(spark, sf)
    rows = target.scan(f"rows/{_MAIN}", target.tables[_MAIN]).groupBy("_gen").agg(F.count("*").alias("rows"))
    keys = target.scan("keys", target.tables[_MAIN]).groupBy("_gen").agg(F.count("*").alias("keys"))
    gens = spark.range(1, 5).withColumn("_gen", F.col("id").cast("int"))
    out = gens.join(rows, "_gen", "left").join(keys, "_gen", "left")
    return out.select(F.col("id").alias("gen"), F.coalesce("keys", F.lit(0)).alias("keys"), F.coalesce("rows", F.lit(0)).alias("rows"))


@query("load_compacted", flat_sql.table_oracle(_MAIN, _FINAL[_MAIN]))
def _(spark, sf):
    """A store that is compacted after each of two loads holds the same rows."""
    root = f"{shared_folder(spark)}/carelake/stores/{uuid.uuid4().hex}"
    main = store_after(spark, sf).tables[_MAIN]
    target = Store(spark, root, {_MAIN: main}, "observation_id", 8).create()
    whole = store_after(spark, sf)
    for gen in (1, 2, 3, 4):
        at = target.commits()[-1]["gen"] + 1
        target.write_rows(at, _MAIN, whole.written(gen, _MAIN))
        target.write_keys(at, whole.scan("keys", main).where(F.col("_gen") == gen))
        target.commit(at)
        if gen in (2, 4):
            target.compact([0, 3, 5] if gen == 2 else None)
    return plain(target.read(_MAIN))


# --- statistics ----------------------------------------------------------------------

# The first load of the query below; the second one arrives over it with every kind of row a load can meet.
_FIRST = f"(SELECT * FROM {flat_sql.EVENTS} WHERE event_id % 10 <> 9 AND NOT (event_type = 'click' AND value > 100) AND event_type <> 'error')"
_SECOND = f"""(SELECT oid AS id, ts, event_type, false AS retracted FROM {flat_sql.EVENTS} WHERE event_type IN ('view', 'signup')
 UNION ALL SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE oid END, ts + INTERVAL 1 DAY, event_type, false FROM {flat_sql.EVENTS} WHERE event_type = 'purchase'
 UNION ALL SELECT oid, ts, event_type, false FROM {flat_sql.EVENTS} WHERE event_type = 'purchase' AND event_id % 50 <> 0
 UNION ALL SELECT oid, NULL, event_type, false FROM {flat_sql.EVENTS} WHERE event_type = 'click' AND value <= 100
 UNION ALL SELECT oid, ts, event_type, true FROM {flat_sql.EVENTS} WHERE event_type = 'error')"""
_CHILD_ROWS = "(CASE event_type WHEN 'purchase' THEN 10 WHEN 'signup' THEN 9 ELSE 8 END)"


@query("job_load_statistics", f"""WITH loaded AS {_FIRST}, arriving AS {_SECOND},
 past AS (SELECT * FROM arriving WHERE ts IS NULL OR ts > (SELECT max(ts) - INTERVAL 30 DAY FROM loaded)),
 newest AS (SELECT * FROM past QUALIFY row_number() OVER (PARTITION BY id ORDER BY coalesce(ts, TIMESTAMP '1970-01-01') DESC) = 1),
 valid AS (SELECT n.*, CASE WHEN l.oid IS NULL THEN 'new' WHEN n.ts IS NULL THEN 'unversioned' WHEN n.ts > l.ts THEN 'updated' ELSE 'skipped' END AS action
  FROM newest n LEFT JOIN loaded l ON l.oid = n.id WHERE NOT n.retracted AND n.id IS NOT NULL),
 kept AS (SELECT count(*) AS kept, sum({_CHILD_ROWS})::BIGINT AS child_rows FROM valid WHERE action <> 'skipped')
 SELECT (SELECT count(*) FROM arriving) AS source_rows, (SELECT count(*) FROM arriving) - (SELECT count(*) FROM past) AS behind_mark,
 (SELECT count(*) FROM newest) AS distinct_rows, (SELECT count(*) FROM past) - (SELECT count(*) FROM newest) AS duplicates_removed,
 (SELECT count(*) FROM newest WHERE retracted) AS retracted, (SELECT count(*) FROM newest WHERE NOT retracted AND id IS NULL) AS invalid, kept,
 (SELECT count(*) FROM valid WHERE action = 'new') AS new, (SELECT count(*) FROM valid WHERE action = 'updated') AS updated,
 (SELECT count(*) FROM valid WHERE action = 'unversioned') AS unversioned, (SELECT count(*) FROM valid WHERE action = 'skipped') AS skipped,
 child_rows, (kept + child_rows) / kept AS expansion_ratio FROM kept""")
def _(spark, sf):
    """Statistics of a load over a loaded store, observed while it writes."""
    rows = _kinds(spark, sf)
    columns = [c for c in rows.columns if c not in ("number", "kind")]
    target = jobs.store(spark, "Observation", f"{shared_folder(spark)}/carelake/stores/{uuid.uuid4().hex}", buckets=8).create()
    jobs.load_increment("Observation", rows.filter("number % 10 <> 9").select(*columns), target, stage.AS_OF)
    purchases = rows.filter("kind = 'purchase'")
    nameless = F.when(F.col("number") % 50 != 0, F.col("id"))
    unknown = F.col("meta").withField("lastUpdated", F.lit("unknown"))
    second = rows.filter("kind IN ('view', 'signup', 'error')").unionByName(
        purchases.withColumns({"id": nameless, "meta": _shifted(1)})).unionByName(
        purchases.filter("number % 50 <> 0")).unionByName(rows.filter("kind = 'click'").withColumn("meta", unknown))
    statistics = jobs.load_increment("Observation", second.select(*columns), target, stage.AS_OF, backdate_days=30)
    kept = json.loads(target.commits()[-1]["statistics"])
    assert kept == statistics
    types = {k: "double" if k == "expansion_ratio" else "long" for k in statistics}
    return spark.createDataFrame([tuple(statistics.values())], ", ".join(f"{k} {t}" for k, t in types.items()))
