"""Incremental load of one resource into its main and child tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.operators import load, quality
from carelake.operators.flatten import RULES, flatten, makes_row, tables_of
from carelake.plans import resources  # noqa: F401  (registers the rules)
from carelake.operators.generations import Store
from carelake.session import shared_broadcasts, shared_folder
from carelake.sources import io, schemas


@dataclass
class Load:
    """Outcome of a load: the new content of every table, and its statistics."""

    tables: dict[str, DataFrame]
    statistics: DataFrame


def written_stage(spark: SparkSession, name: str) -> Callable[[DataFrame, str], DataFrame]:
    """Stage that writes a frame to the shared folder and reads it back.

    Main and child tables then scan their own columns of the deduplicated input
    instead of each repeating its shuffle and the version comparison, and a lost
    executor does not bring the lineage back.
    """

    def stage(df: DataFrame, part: str) -> DataFrame:
        path = f"{shared_folder(spark)}/carelake/stage/{spark.sparkContext.applicationId}/{name}/{part}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return stage


def load_resource(
    resource: str,
    source: DataFrame,
    existing: dict[str, DataFrame],
    as_of=None,
    backdate_days: int | None = 0,
    delete_flag: str = "isDelete",
    sample: int | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Load:
    """New tables of ``resource`` after loading ``source`` over ``existing``.

    Steps: drop deleted ids, sample, keep rows past the high-water mark (rewound
    by ``backdate_days``; None: no mark), newest version per id, set retracted ids
    aside, flatten, compare versions, replace the accepted rows and the children
    of accepted parents as groups, and take retracted ids out of every table.
    An id that was loaded before and is flagged as deleted later stays loaded.
    """
    main, children = tables_of(resource)
    key = RULES[main].key
    live = io.sample_rows(load.drop_deleted(source, "id", delete_flag), sample)
    mark = None if backdate_days is None else load.bookmark(existing[main], "meta_last_updated", backdate_days)
    rows = load.after_bookmark(live, mark, keep_unreadable=True)
    newest = load.latest_version(rows, "id", C.parse_timestamp(F.col("meta.lastUpdated")))
    if stage is not None:
        newest = stage(newest, "accepted-input")
    has_status = "status" in source.columns
    wrong = load.entered_in_error(newest) if has_status else None
    good = newest.join(wrong, "id", "left_anti") if has_status else newest

    classified = load.classify_versions(flatten(good, main, as_of), existing[main], key, "meta_last_updated")
    accepted = classified.filter("version_action <> 'skipped'").drop("version_action")
    keys = accepted.select(key).distinct()
    if stage is not None:
        keys = stage(keys, "accepted-keys")
    incoming = {t: flatten(good, t, as_of) for t in children}
    tables = {main: load.replace_rows(existing[main], accepted, keys, key)}
    for table, rows_in in incoming.items():
        tables[table] = load.replace_children(existing[table], rows_in, keys, key)
    if has_status:
        tables = load.retract(tables, wrong.select(F.col("id").alias(key)), key)
    return Load(tables, quality.load_statistics(live, rows, newest, wrong, classified, incoming))


def write_load(result: Load, root: str, dry_run: bool = False) -> dict[str, str]:
    """Write every table of a load below a new ``root``; returns the paths."""
    paths = {t: f"{root}/{t}" for t in result.tables}
    for table, df in result.tables.items():
        io.full_refresh(df, paths[table], dry_run)
    return paths


def empty_tables(spark: SparkSession, resource: str) -> dict[str, DataFrame]:
    main, children = tables_of(resource)
    return {t: io.empty_table(spark, t) for t in (main, *children)}


def read_tables(spark: SparkSession, resource: str, root: str) -> dict[str, DataFrame]:
    main, children = tables_of(resource)
    return {t: io.read_table(spark, t, f"{root}/{t}") for t in (main, *children)}


# --- increments ------------------------------------------------------------------

ACTIONS = ("new", "updated", "unversioned", "skipped")


def store(spark: SparkSession, resource: str, root: str, buckets: int = 64) -> Store:
    """Log-structured store of the tables of a resource."""
    main, children = tables_of(resource)
    return Store(spark, root, {t: schemas.table_schema(t) for t in (main, *children)}, RULES[main].key, buckets)


def at_once(spark: SparkSession, run: Callable[[str], None], names: Iterable[str], most: int = 8) -> None:
    """Submit independent Spark jobs at the same time, so that small ones do not wait for each other."""
    names = list(names)
    with shared_broadcasts(spark, min(most, len(names))), ThreadPoolExecutor(most) as pool:
        list(pool.map(inheritable_thread_target(spark)(run), names))


@contextmanager
def _whole_plans(spark: SparkSession) -> Iterator[None]:
    """Adaptive plans keep branches that turn out empty: what was observed below them would be lost."""
    name, rule = "spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ",".join(filter(None, (before, rule))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def load_increment(
    resource: str,
    source: DataFrame,
    target: Store,
    as_of=None,
    backdate_days: int | None = 0,
    delete_flag: str = "isDelete",
    sample: int | None = None,
    batch: int | None = None,
) -> dict | None:
    """Load ``source`` into a store as its next generation; returns the statistics.

    The steps are those of :func:`load_resource`, but only accepted rows, their
    children and the replaced or retracted keys are written.  The newest versions
    are written once below the store and read back by main and child tables.  Nested rows
    whose id comes once are their newest version and are not shuffled: the ids that
    come more than once are found first, from the ids alone.  Only versions
    of incoming keys are looked up: the target is reduced to them before it is
    shuffled.  A ``batch`` that was committed before changes nothing and gives None.

    The statistics are observed on the frames while they are written, so no step
    runs again to be counted; ``child_rows`` and ``expansion_ratio`` are those of
    accepted rows.
    """
    spark, key = target.spark, target.key
    main, children = tables_of(resource)
    commits = target.commits()
    if batch is not None and any(c["batch"] == batch for c in commits):
        return None
    gen = commits[-1]["gen"] + 1
    existing = target.read(main)
    count = F.count(F.lit(1))
    wrong = F.lit(False)
    if "status" in source.columns:
        wrong = F.coalesce(F.col("status") == "entered-in-error", F.lit(False))

    seen = {name: Observation(f"{name}-{gen}") for name in ("newest", "main", *children)}
    mark = None if backdate_days is None else load.bookmark(existing, "meta_last_updated", backdate_days)
    time, path = C.parse_timestamp(F.col("meta.lastUpdated")), f"{target.root}/input/gen={gen}"

    def counted(part: str, live: DataFrame) -> DataFrame:
        seen[f"live-{part}"], seen[f"past_mark-{part}"] = Observation(f"live-{part}-{gen}"), Observation(f"past_mark-{part}-{gen}")
        live = live.observe(seen[f"live-{part}"], count.alias("n"))
        return load.after_bookmark(live, mark, keep_unreadable=True).observe(seen[f"past_mark-{part}"], count.alias("n"))

    if sample is None:
        ids, repeated_path = load.repeated_keys(source, "id", delete_flag), f"{target.root}/input/repeated/gen={gen}"
        io.full_refresh(ids, repeated_path)
        alone, several, nameless = load.split_repeated(source, spark.read.schema(ids.schema).parquet(repeated_path), "id", delete_flag)
        parts = [load.latest_version(counted(n, df), "id", time) for n, df in (("several", several), ("nameless", nameless))]
        newest = reduce(DataFrame.unionByName, parts, counted("alone", alone))
    else:
        newest = load.latest_version(counted("all", io.sample_rows(load.drop_deleted(source, "id", delete_flag), sample)), "id", time)
    newest = newest.observe(seen["newest"], count.alias("n"), F.count_if(wrong).alias("retracted"))
    with _whole_plans(spark):
        io.full_refresh(newest, path)
        newest = spark.read.schema(newest.schema).parquet(path)
        good = newest.filter(~wrong)

        flat = flatten(good, main, as_of)
        known = existing.select(key, "meta_last_updated").join(flat.select(key), key, "left_semi")
        classified = load.classify_versions(flat, known, key, "meta_last_updated").observe(
            seen["main"], count.alias("valid"), *[F.count_if(F.col("version_action") == a).alias(a) for a in ACTIONS])
        target.write_rows(gen, main, classified.filter("version_action <> 'skipped'"))
        accepted = target.written(gen, main).select(key)
        if gen > 1:  # nothing lies below the first generation
            target.write_keys(gen, accepted.unionByName(newest.filter(wrong).select(F.col("id").alias(key))))

        def write_child(table: str) -> None:
            if gen > 1:
                incoming = flatten(good, table, as_of).join(accepted, key, "left_semi")
            else:  # every row of the main table was accepted
                incoming = flatten(good.filter(makes_row(main)), table, as_of)
            target.write_rows(gen, table, incoming.observe(seen[table], count.alias("n")))

        at_once(spark, write_child, children)

    main_counts, newest_counts = seen["main"].get, seen["newest"].get
    kept = main_counts["valid"] - main_counts["skipped"]
    child_rows = sum(seen[t].get["n"] for t in children)
    live, past_mark = (sum(seen[n].get["n"] for n in seen if n.startswith(step)) for step in ("live-", "past_mark-"))
    statistics = {
        "source_rows": live, "behind_mark": live - past_mark,
        "distinct_rows": newest_counts["n"], "duplicates_removed": past_mark - newest_counts["n"],
        "retracted": newest_counts["retracted"], "invalid": newest_counts["n"] - newest_counts["retracted"] - main_counts["valid"],
        "kept": kept, **{a: main_counts[a] for a in ACTIONS}, "child_rows": child_rows,
        "expansion_ratio": (kept + child_rows) / kept if kept else None,
    }
    target.commit(gen, batch, statistics=json.dumps(statistics))
    return statistics
