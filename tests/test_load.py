from datetime import datetime

from conftest import dicts
from pyspark.sql import functions as F

from carelake.operators import load
from carelake.operators.flatten import tables_of
from carelake.operators.generations import Store
from carelake.plans import jobs

T = [datetime(2024, 1, d) for d in range(1, 10)]
DDL = "id string, ts timestamp, v string"


def frame(spark, *rows, ddl=DDL):
    return spark.createDataFrame(list(rows), ddl)


def content(df):
    return sorted(((r["id"], r["ts"], r["v"]) for r in df.collect()), key=str)


def test_deleted_id_drops_all_its_versions(spark):
    df = frame(spark, ("a", True), ("a", False), ("b", False), ("c", None), ddl="id string, isDelete boolean")
    assert sorted(r["id"] for r in load.drop_deleted(df).collect()) == ["b", "c"]


def test_latest_version_ties_and_unreadable_times(spark):
    df = frame(spark, ("a", T[0], "old"), ("a", T[2], "x"), ("a", T[2], "y"), ("a", None, "none"), ("b", None, "only"))
    got = {r["id"]: r["v"] for r in load.latest_version(df, "id", F.col("ts"), [F.col("v").desc()]).collect()}
    assert got == {"a": "y", "b": "only"}
    again = [content(load.latest_version(d, "id", F.col("ts"))) for d in (df, df.repartition(7), df.coalesce(1))]
    assert again[0] == again[1] == again[2]


def test_latest_version_is_limited_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.when(F.col("id") >= 0, "hot").alias("id"), F.timestamp_seconds("id").alias("ts"))
    out = load.latest_version(df, "id", F.col("ts"))
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1


def test_five_in_three_processed_two_skipped(spark):
    existing = frame(spark, ("1", T[0], "a"), ("2", T[4], "b"), ("3", T[2], "c"))
    incoming = frame(spark, ("1", T[3], "newer"), ("2", T[4], "equal"), ("3", T[1], "older"), ("4", T[0], "new"), ("5", None, "no time"))
    marked = {r["id"]: r["version_action"] for r in load.classify_versions(incoming, existing, "id", "ts").collect()}
    assert marked == {"1": "updated", "2": "skipped", "3": "skipped", "4": "new", "5": "new"}
    kept = load.version_diff(incoming, existing, "id", "ts").count()
    assert kept == 3 and kept + 2 == incoming.count()


def test_null_keys_and_null_times_are_kept(spark):
    existing = frame(spark, ("1", T[0], "a"), ("2", None, "b"))
    incoming = frame(spark, (None, T[0], "x"), ("1", None, "y"), ("2", T[0], "z"))
    assert load.version_diff(incoming, existing, "id", "ts").count() == 3


def test_any_change_takes_older_rows_too(spark):
    existing = frame(spark, ("1", T[3], "a"), ("2", T[3], "b"))
    incoming = frame(spark, ("1", T[1], "older"), ("2", T[3], "equal"))
    assert [r["v"] for r in load.version_diff(incoming, existing, "id", "ts", any_change=True).collect()] == ["older"]


def test_upsert_is_idempotent_and_keeps_untouched_rows(spark):
    target = frame(spark, ("1", T[0], "a"), ("2", T[0], "b"))
    incoming = frame(spark, ("2", T[1], "B"), ("3", T[0], "c"))
    once = load.upsert(target, incoming, "id", "ts")
    assert content(once) == [("1", T[0], "a"), ("2", T[1], "B"), ("3", T[0], "c")]
    assert content(load.upsert(once, incoming, "id", "ts")) == content(once)


def test_upsert_of_very_many_keys_loses_nothing(spark):
    target = spark.range(30_000).select(F.col("id").cast("string"), F.lit(T[0]).alias("ts"), F.lit("old").alias("v"))
    incoming = spark.range(12_000).select(F.col("id").cast("string"), F.lit(T[1]).alias("ts"), F.lit("new").alias("v"))
    got = {r["v"]: r["count"] for r in load.upsert(target, incoming, "id", "ts").groupBy("v").count().collect()}
    assert got == {"old": 18_000, "new": 12_000}


def test_children_are_replaced_as_groups(spark):
    ddl = "id string, child string"
    target = frame(spark, ("1", "x"), ("1", "y"), ("1", "z"), ("2", "k"), ddl=ddl)
    incoming = frame(spark, ("1", "only"), ("2", "ignored"), ddl=ddl)
    accepted = frame(spark, ("1",), ddl="id string")
    got = sorted((r["id"], r["child"]) for r in load.replace_children(target, incoming, accepted, "id").collect())
    assert got == [("1", "only"), ("2", "k")]


def test_key_sets(spark):
    a, b = frame(spark, ("1", T[0], ""), ("2", T[0], "")), frame(spark, ("2", T[1], ""), ("3", T[0], ""))
    assert [r["id"] for r in load.keys_to_replace(a, b, "id").collect()] == ["2"]
    assert [r["id"] for r in load.orphan_keys(b, a, "id").collect()] == ["3"]
    assert [r["id"] for r in load.unseen_timestamps(b, a, "ts").collect()] == ["2"]


def test_bookmark(spark):
    empty, some = frame(spark), frame(spark, ("1", T[4], ""), ("2", None, ""))
    df = frame(spark, ("a", T[2], ""), ("b", T[4], ""), ("c", T[5], ""), ("d", None, ""))
    ids = lambda mark: sorted(r["id"] for r in load.after_bookmark(df, mark, F.col("ts")).collect())
    assert ids(load.bookmark(empty, "ts")) == ["a", "b", "c", "d"]
    assert ids(load.bookmark(some, "ts")) == ["c"]
    assert ids(load.bookmark(some, "ts", backdate_days=3)) == ["a", "b", "c"]


# --- the whole job ------------------------------------------------------------


def observation(i, day, status="final", notes=1, **more):
    return {"id": str(i), "status": status, "subject": {"reference": "Patient/1"}, "meta": {"lastUpdated": f"2024-01-{day:02d}T00:00:00Z"},
            "note": [{"text": f"n{k}"} for k in range(notes)], "code": {"coding": [{"code": "c"}]}, **more}


def settle(spark, result, path):
    jobs.write_load(result, str(path))
    return jobs.read_tables(spark, "Observation", str(path))


def count(tables, table, key=None):
    df = tables[table]
    return (df.filter(F.col("observation_id") == key) if key else df).count()


def test_observation_loads(spark, resource_rows, tmp_path):
    stage = lambda name: jobs.written_stage(spark, name)
    first = jobs.load_resource("Observation", resource_rows(
        "Observation", observation(1, 1, notes=3), observation(1, 2, notes=2), observation(2, 1), observation(3, 1, isDelete=True),
        observation(3, 5), observation(4, 1, "entered-in-error"), observation(5, 1)),
        jobs.empty_tables(spark, "Observation"), "2024-02-01", stage=stage("t1"))
    stats = dicts(first.statistics)[0]
    assert [stats[c] for c in ("source_rows", "behind_mark", "distinct_rows", "duplicates_removed", "retracted", "invalid", "kept")] == [
        5, 0, 4, 1, 1, 0, 3]
    tables = settle(spark, first, tmp_path / "1")
    assert count(tables, "observations") == 3 and count(tables, "observation_notes", "1") == 2

    batch = resource_rows("Observation", observation(1, 6, notes=1), observation(2, 6, "entered-in-error"), observation(6, 6))
    second = jobs.load_resource("Observation", batch, tables, "2024-02-01", stage=stage("t2"))
    tables = settle(spark, second, tmp_path / "2")
    assert sorted(r["observation_id"] for r in dicts(tables["observations"])) == ["1", "5", "6"]
    assert count(tables, "observation_notes", "1") == 1
    main, children = tables_of("Observation")
    assert all(count(tables, t, "2") == 0 for t in (main, *children))

    third = jobs.load_resource("Observation", batch, tables, "2024-02-01", backdate_days=30, stage=stage("t3"))
    for table, df in third.tables.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, tables[table].collect())), table


def test_dry_run_and_sample(spark, resource_rows, tmp_path):
    source = resource_rows("Medication", *[{"id": str(i), "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}} for i in range(5)])
    result = jobs.load_resource("Medication", source, jobs.empty_tables(spark, "Medication"), sample=2)
    jobs.write_load(result, str(tmp_path / "dry"), dry_run=True)
    assert not (tmp_path / "dry").exists() and result.tables["medications"].count() == 2


def test_unreadable_time_is_loaded_in_any_batch(spark, resource_rows, tmp_path):
    unreadable = observation(9, 1)
    unreadable["meta"] = {"lastUpdated": "unknown"}
    first = jobs.load_resource("Observation", resource_rows("Observation", unreadable, observation(1, 5)), jobs.empty_tables(spark, "Observation"))
    assert count(first.tables, "observations") == 2
    tables = settle(spark, jobs.load_resource("Observation", resource_rows("Observation", observation(1, 5)), jobs.empty_tables(spark, "Observation")),
                    tmp_path / "1")
    later = jobs.load_resource("Observation", resource_rows("Observation", unreadable, observation(2, 3)), tables)
    assert sorted(r["observation_id"] for r in dicts(later.tables["observations"])) == ["1", "9"]
    assert dicts(later.statistics)[0]["behind_mark"] == 1


def test_sample_is_taken_after_deletion(spark, resource_rows):
    source = resource_rows("Observation", observation(5, 1), observation(5, 2, isDelete=True))
    result = jobs.load_resource("Observation", source, jobs.empty_tables(spark, "Observation"), sample=1)
    assert count(result.tables, "observations") == 0


# --- increments -----------------------------------------------------------------


def test_increments_equal_rewritten_tables(spark, resource_rows, tmp_path):
    target = jobs.store(spark, "Observation", str(tmp_path / "store"), buckets=4).create()
    unreadable = observation(5, 1, notes=2)
    unreadable["meta"] = {"lastUpdated": "unknown"}
    steps = [
        [*[observation(i, 2, notes=3) for i in range(20)], observation(30, 2, "entered-in-error")],
        # the described example: 5 arrive, 3 are processed, 2 skipped, 1 cleaned up
        [observation(1, 5, notes=1), observation(2, 1), observation(3, 2), observation(40, 5), observation(41, 5)],
        [observation(4, 6, "entered-in-error"), observation(1, 6, notes=0), observation(99, 6, "entered-in-error"), unreadable],
    ]
    tables, statistics = jobs.empty_tables(spark, "Observation"), []
    for step, rows in enumerate(steps):
        source = resource_rows("Observation", *rows)
        whole = jobs.load_resource("Observation", source, tables, "2024-02-01", backdate_days=30)
        jobs.write_load(whole, str(tmp_path / f"{step}"))
        tables = jobs.read_tables(spark, "Observation", str(tmp_path / f"{step}"))
        statistics.append(jobs.load_increment("Observation", source, target, "2024-02-01", backdate_days=30))
    for table, df in target.read_all().items():
        assert sorted(map(str, df.collect())) == sorted(map(str, tables[table].select(*df.columns).collect())), table
    assert [statistics[1][c] for c in ("source_rows", "kept", "skipped", "new", "updated")] == [5, 3, 2, 2, 1]
    assert [statistics[2][c] for c in ("retracted", "unversioned", "child_rows")] == [2, 1, 4]
    assert target.read("observations").filter("observation_id IN ('4', '99')").count() == 0
    # an earlier state is still there
    assert target.read("observation_notes", upto=1).filter("observation_id = '1'").count() == 3


def test_rows_of_keys_that_come_once_are_split_off(spark, tmp_path):
    """The parts are the rows without deleted ids, whatever repeats, is flagged or has no id, also if the repeated ids are many."""
    ddl = "id string, isDelete boolean, v int"
    rows = [("a", False, 1), ("b", True, 2), ("c", False, 3), ("c", None, 3), ("d", False, 4), ("d", True, 5), ("e", None, 6), (None, True, 7), (None, False, 8), (None, None, 8)]
    source = frame(spark, *rows, ddl=ddl)
    for threshold in ("64k", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        parts = load.split_repeated(source, load.repeated_keys(source))
        found = [sorted(map(tuple, df.collect()), key=str) for df in parts]
        assert found == [[("a", False, 1), ("e", None, 6)], [("c", False, 3), ("c", None, 3)], [(None, False, 8), (None, None, 8), (None, True, 7)]]
        assert sorted(sum(found, []), key=str) == sorted(map(tuple, load.drop_deleted(source).collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")


def test_increments_meet_their_events_while_they_are_flat(spark):
    from conftest import SF

    from carelake.catalog import increments, load_all

    load_all()
    plan = increments.increments(spark, SF)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "referenceRange" not in plan.split("Join", 1)[1]


def test_compaction_keeps_the_live_rows(spark, tmp_path):
    ddl = "id string, v int"
    target = Store(spark, str(tmp_path / "store"), {"main": frame(spark, ddl=ddl).schema, "child": frame(spark, ddl=ddl).schema}, "id", 4).create()

    def arrive(gen, ids, children, gone=()):
        target.write_rows(gen, "main", frame(spark, *[(str(i), gen) for i in ids], ddl=ddl))
        target.write_rows(gen, "child", frame(spark, *[(str(i), gen * 100 + k) for i in ids for k in range(children)], ddl=ddl))
        target.write_keys(gen, frame(spark, *[(str(i),) for i in (*ids, *gone)], ddl="id string"))
        target.commit(gen)

    state = lambda: {t: sorted(map(tuple, df.collect())) for t, df in target.read_all().items()}
    arrive(1, range(40), 2)
    arrive(2, range(5), 1)
    arrive(3, [], 0, gone=[7])
    before = state()
    assert len(before["main"]) == 39 and len(before["child"]) == 5 + 34 * 2
    assert target.compact([0, 2]) == 4 and state() == before
    assert {b for _, b in target.obsolete()} == {0, 2} and max(g for g, _ in target.obsolete()) == 3
    arrive(5, range(3), 0)
    after = state()
    assert len(after["child"]) == 2 + 34 * 2
    assert target.compact() == 6 and state() == after


def test_a_broken_load_is_not_seen_and_is_overwritten(spark, tmp_path):
    ddl = "id string, v int"
    target = Store(spark, str(tmp_path / "store"), {"main": frame(spark, ddl=ddl).schema}, "id", 8).create()
    target.write_rows(1, "main", frame(spark, *[(str(k), 1) for k in range(30)], ddl=ddl))
    assert target.read("main").count() == 0
    target.write_rows(1, "main", frame(spark, ("a", 2), ddl=ddl))
    target.commit(1)
    assert [tuple(r) for r in target.read("main").collect()] == [("a", 2)]


def test_bytes_written_follow_the_increment(spark, resource_rows, tmp_path):
    def written(gen):
        return sum(p.stat().st_size for p in (tmp_path / "store").glob(f"**/*gen={gen}/**/*.parquet") if "input" not in p.parts)

    target = jobs.store(spark, "Observation", str(tmp_path / "store"), buckets=4).create()
    jobs.load_increment("Observation", resource_rows("Observation", *[observation(i, 2, notes=5) for i in range(3000)]), target, "2024-02-01")
    jobs.load_increment("Observation", resource_rows("Observation", observation(8, 3), observation(9, 3)), target, "2024-02-01")
    jobs.load_increment("Observation", resource_rows("Observation", observation(9, 4)), target, "2024-02-01")
    assert written(3) <= written(2) < written(1) / 2
    rows = {g: sum(target.written(g, t).count() for t in target.tables) for g in (1, 2, 3)}
    assert rows[2] == 2 * rows[3] and rows[1] > 1000 * rows[2]


def test_a_second_run_reads_what_the_first_wrote(spark):
    """The newest lines are sorted once, not once for each use in the plan of the second run."""
    from conftest import SF

    from carelake.catalog import load_all
    from carelake.catalog.registry import QUERIES

    load_all()
    twice = QUERIES["load_upsert_twice"](spark, SF)
    plan = twice._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "l_orderkey" not in plan
    assert twice.exceptAll(QUERIES["load_upsert"](spark, SF)).isEmpty() and twice.count() == QUERIES["load_upsert"](spark, SF).count()
