"""Models, scans, token files, mixing and decontamination: brute force, round trips and held-out accuracy."""

import math
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_helpers import SF, make_docs, rows_of  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from carelake.llm import decontaminate, language, licenses, lm, mixing, queries, token_frames, toxicity
from check_queries import TABLES, compare

MIDDLE = "/root/testdata/sf0.01"


def held(doc_id, n, r):
    return zlib.crc32(str(doc_id).encode()) % n == r


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op4_license_scan", "op7_decontaminate", "op9_mix_sources"])
def test_query_equals_its_sql(spark, con, name):
    message, good = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good, message


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


# --- language model -------------------------------------------------------


def test_base_scores_are_exact_and_the_model_beats_them(spark):
    got = queries.op2_lm_score(spark, MIDDLE).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [None] for r in queries.table(spark, MIDDLE, "documents").collect()}
    counts = Counter()
    for i, words in docs.items():
        if not held(i, 7, 2):
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        words = docs[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(r["doc_id"], 7, 2), len(words), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in words) and r["base_score"] == pytest.approx(base, rel=1e-9)
    out = [r for r in got if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in out)
    assert sum(r["score"] for r in out) / tokens > sum(r["base_score"] for r in out) / tokens + 0.03


def small_vocabulary(counts, texts):
    """Vocabulary of (word, count) in the order of ranks."""
    start = np.concatenate([lm.class_starts(len(counts)), len(counts) + 1 + np.arange(lm.LETTERS)])
    size = np.diff(np.append(start, len(counts) + 1 + lm.LETTERS))
    return lm.Vocabulary(lm.Ids((w, 1 + k) for k, (w, _) in enumerate(counts)), np.array([texts, *[c for _, c in counts]]),
                         np.repeat(np.arange(len(start)), size), start, size, texts + sum(c for _, c in counts), len(counts) + 1, texts)


def test_classes_cover_every_word_and_grow_with_the_vocabulary():
    for words in [*range(12), 100, 1000, 50_000]:
        start = lm.class_starts(words)
        assert start[0] == 0 and (np.diff(start) > 0).all() and start[-1] <= words and len(start) <= 2 + 1.1 * math.sqrt(words) + 1
    assert len(lm.class_starts(50_000)) > 6 * len(lm.class_starts(1000)) > 36


def trained(words=90, texts=40):
    vocab = small_vocabulary([(b"w%d" % k, 200 - k) for k in range(words)], texts)
    model, chance = lm.first_model(vocab, np.full(lm.LETTERS, 3.0), dim=8)
    trainer = lm.Trainer(model, vocab, chance)
    rng = np.random.default_rng(1)
    rows = [np.append((rng.integers(0, 5) + np.arange(rng.integers(1, 60))) % (words + 3) + 1, 0).astype(np.int32) for _ in range(texts)]
    ids, wanted = lm._sequence(rows)
    for _ in range(60):
        trainer.batch(ids, wanted)
    return vocab, model, trainer, rows, ids, wanted


def test_chances_of_the_whole_vocabulary_add_up_to_one():
    vocab, _, trainer, rows, _, _ = trained()
    longest = max(rows, key=len)
    for before in (np.zeros(lm.ORDER, np.int32), longest[:lm.ORDER]):
        chances = [10 ** lm.log_chances(trainer.model, vocab, np.append(before, k))[0] for k in range(len(vocab.classes))]
        assert sum(chances) == pytest.approx(1, abs=1e-5)


def test_training_raises_the_chance_of_what_follows_and_pieces_do_not_matter():
    vocab, model, trainer, rows, ids, wanted = trained()
    before, after = (lm.log_chances(m, vocab, ids)[wanted] for m in (model, trainer.model))
    assert after.sum() > before.sum() + 0.2 * len(after)
    alone = np.concatenate([lm.log_chances(trainer.model, vocab, np.append(np.zeros(lm.ORDER, np.int32), r)) for r in rows])
    small = lm.log_chances(trainer.model, vocab, ids, rows=7, piece=50)[wanted]
    assert after == pytest.approx(alone, abs=1e-4) and after == pytest.approx(small, abs=1e-4)


def test_every_position_is_learnt_from(spark):
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 20, n).astype("<i4") for n in (0, 1, 5, 6, 1023, 1024, 5000, *range(300))]
    vocab = small_vocabulary([(b"w%d" % k, 50) for k in range(20)], len(texts))
    model, chance = lm.first_model(vocab, np.ones(lm.LETTERS))
    frame = spark.createDataFrame([(np.append(t, 0).astype("<i4").tobytes(),) for t in texts], "ids binary").repartition(3)
    _, seen = lm.train(frame, vocab, chance, model)
    assert seen == sum(len(t) + 1 for t in texts)


def test_language_model_of_odd_rows(spark, make_docs):
    rows = [(k, "the cat sat . the dog sat ." * 20) for k in range(20)] + [(30, None), (31, ""), (31, "zzz zzz"), (None, "the")]
    got = lm.score(make_docs(*rows, clashing=True), queries.crc_mod("doc_id", 7) == 2)
    found = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(rows) and found[30]["n_tokens"] == 1 and all(math.isfinite(r["score"]) for r in got.collect())
    assert lm.score(make_docs(), queries.crc_mod("doc_id", 7) == 2).count() == 0


# --- language and toxicity ------------------------------------------------


def test_language_of_held_out_texts(spark):
    truth = {r["doc_id"]: r["lang"] for r in queries.table(spark, MIDDLE, "documents").collect()}
    got = queries.op3_language_id(spark, MIDDLE).collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in got) and len(got) == len(truth)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.99 * len(out)
    assert sum(r["accepted"] for r in got) >= 0.99 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(make_docs):
    rows = [(k, "the quick brown fox and the lazy dog" * 3, "s", "en") for k in range(30)]
    rows += [(100 + k, "der schnelle braune fuchs und der faule hund" * 3, "s", "de") for k in range(30)]
    docs = make_docs(*rows, (200, None, "s", None), (201, "12 34 !?", "s", "en"), (202, "Der Fuchs", "s", None), (202, "Der Fuchs"), clashing=True)
    model = language.fit(docs)
    got = docs.select("doc_id", language.predictions(model, docs["text"]).alias("p")).select("doc_id", "p.*").collect()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[200]["lang_pred"] == by_id[201]["lang_pred"] == "und" and not by_id[200]["accepted"] and by_id[200]["score"] == 0
    assert by_id[202]["lang_pred"] == "de" and len(got) == len(rows) + 4
    assert language.fit(make_docs()) is None and language.predict(None, "text") == ("und", 0.0)
    whole = language.predict(model, "der Fuchs " * 300_000)
    assert whole[0] == "de"


def test_toxicity_of_held_out_texts(spark):
    truth = {r["doc_id"]: r["toxic"] for r in queries.table(spark, MIDDLE, "labels").collect()}
    got = queries.op8_toxicity(spark, MIDDLE).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    out = [r for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 0.9 * len(out)


def test_matches_are_folded_weighed_and_excepted():
    matcher = toxicity.Matcher({" idiot ": 3.0, " trash ": 2.0, " idio": 1.0}, ("trash can",))
    assert matcher.measure("You 1d10t!")[0] == matcher.measure("an іdiоt, so")[0] == pytest.approx(math.log1p(3))
    assert matcher.measure("the trash can, the idioms")[0] == pytest.approx(math.log1p(1))
    assert matcher.measure(None) == (0.0, 0.0) and matcher.measure("idiot")[1] > matcher.measure("idiot " + "word " * 500)[1]
    assert toxicity.fold("room 101, B2B") == " room 101 b2b " or toxicity.fold("room 101, B2B").startswith(" room 101 ")


def test_toxicity_of_odd_rows(spark, make_docs):
    rng, rows = random.Random(1), []
    for k in range(300):
        words = rng.choices("sun moon sky tree river stone cloud rain wind sea".split(), k=30)
        if k % 3 == 0:
            words[rng.randrange(30)] = "moron"
        rows.append((k, " ".join(words)))
    docs = make_docs(*rows, (900, None), (901, ""), (None, "a moron here"), clashing=True).withColumn("toxic", (queries.F.col("doc_id") % 3 == 0).cast("int"))
    model = toxicity.fit(docs)
    got = {r[0]: r[1] for r in docs.select("doc_id", toxicity.score(model, docs["text"])).collect()}
    assert all((got[k] >= 0.5) == (k % 3 == 0) for k in range(300)) and got[900] < 0.5 and got[901] < 0.5 and got[None] >= 0.5
    empty = toxicity.fit(docs.limit(0))
    assert docs.select(toxicity.score(empty, docs["text"]).alias("s")).agg({"s": "max"}).first()[0] < 0.5


# --- licences -------------------------------------------------------------


def test_license_scan_of_odd_rows(spark, make_docs):
    notice = licenses.NOTICES[1].text
    docs = make_docs((1, None), (2, ""), (3, "MIT license, mit-License"), (4, "the Apache License"), (5, "mit licenses"), (6, notice.upper()),
                     (7, "x " * 20_000 + "GNU general public license"), (7, "mit license"), (None, "cc by nc 4 0"),
                     (8, notice.replace("version", "edition")), (9, "MİT LICENSE Kelvin mit license"), clashing=True)
    got = rows_of(licenses.labelled(licenses.scan(docs)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    assert (1, 0, 0, None, None, "", "") in got and (3, 4, 2, 0, 2, "mit", "mit") in got and (4, 3, 1, 1, 1, "apache", "apache") in got
    assert (5, 2, 0, None, None, "", "") in got and (6, 8, 1, 3, 3, "apache", "apache") in got
    assert (7, 20_004, 1, 20_001, 20_001, "gpl", "gpl") in got and (8, 8, 1, 3, 3, "apache", "apache") in got
    assert (9, 5, 1, 3, 3, "mit", "mit") in got and len(got) == 11
    assert licenses.scan(make_docs()).count() == 0


# --- token files ----------------------------------------------------------


def test_token_files_of_odd_rows(spark, make_docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    rows = [(5, "Hello, World! It's 12.5% é ÉTÉ"), (3, None), (4, ""), (5, "again"), (9, "word " * 60_000), (None, "no id"),
            (7, "İ ﬁ <|endoftext|> a\x1cb x"), (-2, "''s !!'s 'tis don't")]
    manifest = token_frames.write_shards(make_docs(*rows, clashing=True), path)
    got = token_frames.digests(manifest).collect()
    tokenizer = Tokenizer.from_file(path)
    want = sorted((-10**9 if i is None else i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows)
    assert sorted((-10**9 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    at, order = 0, sorted(got, key=lambda r: r["start"])
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in order] == [None, -2, 3, 4, 5, 5, 7, 9]
    for shard in manifest.collect():
        reader = token_frames.ShardReader(shard["path"])
        for k, i in enumerate(reader.ids):
            assert tuple(reader.document(k).tolist()) in {x for j, x in want if j == (-10**9 if i is None else i)}
    assert token_frames.digests(token_frames.write_shards(make_docs(), path)).count() == 0


def test_damaged_frame_is_noticed_and_other_documents_are_read(tmp_path):
    path = tmp_path / "shard.zst"
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 49_000, n).astype("<u2") for n in (10, 70_000, 0, 90_000, 3)]
    with open(path, "wb") as file:
        writer = token_frames.ShardWriter(file, "<u2")
        for k, ids in enumerate(docs):
            writer.add(k, ids.tobytes())
        assert writer.close() == sum(map(len, docs))
    reader = token_frames.ShardReader(str(path))
    assert all((reader.document(k) == ids).all() for k, ids in enumerate(docs)) and (next(reader.find(1)) == docs[1]).all()
    data = bytearray(path.read_bytes())
    data[int(reader.offsets[1]) + 500] ^= 1
    path.write_bytes(bytes(data))
    reader = token_frames.ShardReader(str(path))
    assert (reader.document(0) == docs[0]).all() and (reader.document(4) == docs[4]).all()
    with pytest.raises(Exception):
        reader.document(1)


# --- mixing and decontamination -------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, out, free = sum(sizes.values()), {}, set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def test_mix_meets_targets(spark, make_docs):
    rng, rows = random.Random(2), []
    for k in range(1500):
        source = rng.choice(["hot"] * 6 + ["a", "b", None, "Z", "é"])
        rows.append((k, "w " * rng.randrange(0, 60), source))
    rows += [(2000, None, "a"), (None, "one two", "b"), (3, "again again", "hot"), (2001, "", "void")]
    got = mixing.mix(make_docs(*rows, clashing=True)).collect()
    sizes = Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
    want = brute_targets(sizes)
    largest, taken = {}, Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    again = mixing.mix(make_docs(*reversed(rows))).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in again) == sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in got)
    mixed = mixing.take(make_docs(*rows))
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) >= 0.9 * sum(want.values())
    assert mixing.mix(make_docs()).count() == 0 and mixing.take(make_docs()).count() == 0


def test_contained_items_are_found_in_long_documents(spark, make_docs):
    rng = random.Random(4)
    word = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(word, k=n))) for k, n in enumerate((5, 6, 12, 30, 60, 200))] + [(6, "Tiny one"), (7, None), (None, "q w e r t y")]
    rows = [(k, " ".join(rng.choices(word, k=9000)) + " | " + t.upper() + ", " + " ".join(rng.choices(word, k=9000))) for k, t in items[:6]]
    edited = items[4][1].split()
    edited[20] = "zz"
    rows += [(10, " ".join(edited)), (11, " ".join(items[3][1].split()[:15])), (12, "tiny, ONE"), (13, "a tiny one here"), (14, None), (15, ""),
             (None, items[2][1]), (2, "clean text of its own here"), (16, "x q w e r t y z")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(*rows, clashing=True)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, frame).collect()}
    assert got == {(k, k) for k in range(6)} | {(10, 4), (12, 6), (13, 6), (None, 2), (16, None)}
    kept = decontaminate.drop_contaminated(docs, frame)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 11, 14, 15]
    assert decontaminate.find(docs, frame.limit(0)).count() == 0 and decontaminate.find(make_docs(), frame).count() == 0


def test_items_of_fewer_words_than_a_shingle_are_found(spark, make_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "one, two"), (3, "x"), (4, "alpha beta gamma"), (5, "")], "item_id long, text string")
    docs = make_docs((1, "x y alpha beta gamma delta z q"), (2, "One two"), (3, "two one"), (4, "alpha beta gamma"), (5, "w " * 5000 + "one two " + "w " * 5000),
                     (6, "alpha gamma beta delta alpha"), (7, None))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, items).collect()}
    assert got == {(1, 1), (1, 3), (1, 4), (2, 2), (4, 4), (5, 2)}
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()) == [3, 6, 7]


def test_mix_takes_rows_by_id_and_source(spark, make_docs):
    rows = [(k, "w " * 10, source) for source in "ab" for k in range(30)]
    docs = make_docs(*rows, (None, "w w", None), (None, "w w", None))
    want, got = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    for r in mixing.take(docs).collect():
        got[r["doc_id"], r["source"]] += 1
    assert got == +want and len({want[k, "a"] - want[k, "b"] for k in range(30)}) > 1


def test_pipeline_stages_take_effect(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    columns, sizes = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.Scratch(spark, "test").save(stage(spark, docs, SF))
        assert docs.columns == columns
        sizes.append(docs.count())
    from carelake.llm import simhash

    assert sizes[1] < sizes[0] and sizes[2] < sizes[1]
    before = corpus_pipeline.table(spark, SF, "documents")
    copies = {r["doc_id"] for r in simhash.groups(before).where("doc_id <> component_id").collect()}
    assert not copies & {r["doc_id"] for r in docs.collect()}
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == sizes[-1] and got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "carelake")):
        if "llm" not in folder:
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as file:
                        assert "llm" not in file.read(), name
