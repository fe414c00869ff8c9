"""SimHash, repeated passages and embeddings against brute force."""

import random

import numpy as np
import xxhash
from llm_helpers import SF, make_docs, rows_of  # noqa: F401
from pyspark.sql import functions as F

from carelake.llm import common, embed_dedup, passages, queries, simhash

WORDS = [f"w{k}" for k in range(400)]


def text_of(seed, n=120):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if linked[i][j] and label[j] < label[i]:
                    label[i], changed = label[j], True
    low = {}
    for i, c in enumerate(label):
        low[c] = min(low.get(c, ids[i]), ids[i])
    return [low[c] for c in label]


def test_simhash_equals_brute_force_on_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    prints = [brute_print(t) for _, t in rows]
    linked = [[(a ^ b).bit_count() <= 4 for b in prints] for a in prints]
    want = sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, components([i for i, _ in rows], linked)))
    assert sorted(map(tuple, queries.op1_simhash(spark, SF).collect())) == want


def test_simhash_of_odd_rows(spark, make_docs):
    long = text_of(1, 30_000)
    docs = make_docs((7, None), (5, ""), (None, " \n"), (3, "Ab c"), (9, "aB C"), (9, "aB C"), (2, long), (4, long + " tail"), clashing=True)
    got = rows_of(simhash.groups(docs), "doc_id", "fingerprint", "component_id")
    zero, short = "0" * 16, f"{brute_print('ab c'):016x}"
    assert (7, zero, 5) in got and (None, zero, 5) in got and got.count((9, short, 3)) == 2
    assert {c for i, _, c in got if i in (2, 4)} == {2}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    assert simhash.drop_near_duplicates(make_docs((None, "x y"), (None, "x y"))).count() == 1
    assert simhash.groups(make_docs()).count() == 0


def test_near_copies_stage_equals_brute_force(spark, make_docs):
    """Pairs on both sides of similarity 0.8, exact copies, odd rows."""
    import corpus_pipeline

    rng, texts = random.Random(8), [None, "", "A b", "a B", "a c"]
    for k in range(40):
        words = text_of(8000 + k, 150).split()
        texts.append(" ".join(words))
        for edits in (1, 2, 3, 5):
            changed = list(words)
            for at in rng.sample(range(10, 140), edits):
                changed[at] = "new"
            texts.append(" ".join(changed))
    texts.append(texts[5].upper())
    sets = []
    for t in texts:
        words = (t or "").lower().split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    linked = [[a == b or len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    want = sorted(set(components(list(range(len(texts))), linked)))
    docs = make_docs(*enumerate(texts), clashing=True)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()) == want
    assert corpus_pipeline.drop_near_copies(spark, make_docs((None, "x y"), (None, "x y")), SF).count() == 1


def test_near_copies_stage_takes_links_of_simhash(spark, make_docs):
    """Copies that share no band are found by their fingerprints, also under one id, and unlike texts stay."""
    import corpus_pipeline
    from carelake.llm import near_copies

    texts = [text_of(9000 + k, 400) for k in range(6)]
    rows = [*enumerate(texts), (100, texts[0] + " more"), (1, texts[1] + " more"), (None, texts[2] + " more"), (200, ""), (201, None)]
    docs, options = make_docs(*rows, clashing=True), {"bands": 1, "rows": 4000}
    alone = near_copies.drop(docs, **options).count()
    kept = near_copies.drop(docs, candidates=corpus_pipeline.simhash_keys(docs), **options)
    assert (alone, sorted(r["doc_id"] for r in kept.collect())) == (10, [0, 1, 2, 3, 4, 5, 200])
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).select("doc_id").orderBy("doc_id").collect()] == [0, 1, 2, 3, 4, 5, 200]


def test_near_copies_reach_python_in_small_batches(spark, monkeypatch):
    import corpus_pipeline
    import pandas as pd
    from carelake.llm import near_copies

    text = F.expr("concat_ws(' ', transform(sequence(1, 6), x -> concat(x, '-', id % 700)))")
    docs = spark.range(0, 1500, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, signatures, prints = spark.conf.get(setting), near_copies._signatures, simhash.fingerprint_of

    def bounded(*args):
        run = signatures(*args)

        def checked(batches):
            for batch in batches:
                if batch.num_rows > 512:
                    raise ValueError(f"{batch.num_rows} rows at once")
                yield from run([batch])

        return checked

    def column(text, width=4):
        def run(texts: pd.Series) -> pd.Series:
            if len(texts) > 512:
                raise ValueError(f"{len(texts)} rows at once")
            return pd.Series(np.array([prints(t, width) for t in texts], np.uint64).view(np.int64))

        return F.pandas_udf(run, "long")(text.cast("binary"))

    monkeypatch.setattr(near_copies, "_signatures", bounded)
    monkeypatch.setattr(simhash, "fingerprint", column)
    assert near_copies.drop(docs, candidates=corpus_pipeline.simhash_keys(docs)).count() == 700
    assert spark.conf.get(setting) == before


def test_near_copies_of_hot_keys_and_odd_rows(spark, make_docs):
    """Texts that share a key with the first class but are not like it, over several blocks; very long, repeated and clashing rows."""
    from carelake.llm import near_copies

    base = text_of(77, 400).split()
    rows = [(1, "same id one two three four five"), (1, "same id but another text altogether here"), (2, "twice told tale of old"), (2, "twice told tale of old")]
    for family in range(12):  # families of one base: near within, not across
        words = list(base)
        for k in range(family * 3, 400, 60):
            words[k] = f"f{family}k{k}"
        for copy in range(5):
            changed = list(words)
            changed[40 + copy] = f"c{copy}"
            rows.append((100 + family * 10 + copy, " ".join(changed)))
    long = text_of(5, 20_000)
    rows += [(900, long), (901, long + " end"), (None, "twice told tale of old"), (None, "only nameless rows in here"), (None, "Only nameless rows in here")]
    sets, ids = [], []
    for i, t in rows:
        words = t.lower().split()
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))})
        ids.append(i)
    linked = [[a == b or len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    label = components(list(range(len(rows))), linked)
    want = []
    for root in sorted(set(label)):
        members = [ids[k] for k in range(len(rows)) if label[k] == root]
        want.append(min((m for m in members if m is not None), default=None))
    docs = make_docs(*rows, clashing=True)
    for chunk in (4, 256):
        got = [r["doc_id"] for r in near_copies.drop(docs, chunk=chunk).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert near_copies.drop(make_docs()).count() == 0
    assert near_copies.drop(docs).columns == docs.columns


def test_hot_block_keeps_all_links(spark):
    """A dense group over several chunks is one component, found without its pairs."""
    rng = np.random.default_rng(0)
    base, prints = 0x1234_5678_9ABC_DEF0, set()
    while len(prints) < 900:
        flips = rng.choice(64, rng.integers(1, 4), replace=False)
        prints.add(base ^ sum(1 << int(b) for b in flips))
    values = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints]
    frame = spark.createDataFrame(values, "fp long")
    edges = simhash.linked_prints(frame, common.Scratch(spark, "test"), chunk=100)
    assert edges.count() < 35 * 900 * 12
    roots = common.component_roots(edges, common.Scratch(spark, "test"))
    array = np.array(sorted(prints), np.uint64)
    label = common.smallest_labels(len(array), lambda lo, hi: np.bitwise_count(array[lo:hi, None] ^ array[None, :]) <= 4)
    assert roots.select("root").distinct().count() == len(set(label.tolist())) - (len(array) - roots.count())


def test_components_of_a_long_chain(spark):
    order = list(range(600))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(700, 701), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in common.component_roots(edges, common.Scratch(spark, "test")).collect()}
    assert {got[k] for k in order} == {0} and got[701] == 700


def brute_links(rows):
    unit = [None if v is None or l is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v)
            else np.array(v, float) / np.linalg.norm(v) for _, v, l in rows]
    return [[i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
             and float(unit[i] @ unit[j]) >= 0.93 for j in range(len(rows))] for i in range(len(rows))]


def check_links(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("copies", F.lit("x"))
    linked = brute_links(rows)
    ids = [r[0] for r in rows]
    want = sorted((i, sum(x), c, i == c) for i, x, c in zip(ids, linked, components(ids, linked)))
    got = sorted(map(tuple, embed_dedup.links(frame, **options).select("vec_id", "n_links", "component_id", "kept").collect()))
    return got, want


def test_embeddings_equal_brute_force(spark):
    rng, rows = np.random.default_rng(5), []
    for k in range(60):
        centre = rng.standard_normal(32)
        for _ in range(int(rng.integers(1, 5))):
            v = centre + rng.standard_normal(32) * rng.choice([0.0, 0.1, 0.3])
            rows.append((len(rows), [float(x) for x in np.float32(v)], int(k % 3)))
    for odd in (None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0]):
        rows.append((len(rows), odd, 1))
    rows += [(len(rows) + k, rows[0][1], None) for k in range(2)]
    got, want = check_links(spark, rows)
    assert got == want


def test_hot_bucket_of_embeddings_over_chunks(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    rows = [(k, [float(x) for x in np.float32(centre + 0.12 * rng.standard_normal(32))], 1) for k in range(150)]
    rows += [(1000 + k, rows[0][1], 1) for k in range(40)]
    got, want = check_links(spark, rows, chunk=32)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want))
    assert [g[2:] for g in got] == [w[2:] for w in want]


def test_vectors_that_repeat_an_id(spark):
    def near(k):
        return [1.0 if i == k else 0.1 if i == (k + 1) % 8 else 0.0 for i in range(8)]

    rows = [(1, near(0), 1), (1, near(3), 1), (5, [1.0] + [0.0] * 7, 1), (7, [0.0] * 3 + [1.0] + [0.0] * 4, 1), (9, near(6), 1), (9, near(6), 1), (0, near(6), 2)]
    got, want = check_links(spark, rows)
    assert got == want and got.count((1, 1, 1, True)) == 2 and got.count((9, 1, 9, True)) == 2


def test_empty_embeddings(spark):
    assert embed_dedup.links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(7)
    unit = rng.standard_normal((400, 64))
    unit[200:] = unit[:200] + 0.4 * rng.standard_normal((200, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rotated, codes, factors = embed_dedup.encode(unit)
    estimate, bound = embed_dedup.upper_bounds(codes, factors, rotated, 4.0)
    exact = unit @ unit.T
    off = ~np.eye(400, dtype=bool)
    assert (exact <= bound)[off].mean() > 0.9999 and abs((estimate - exact)[off].mean()) < 0.01


def exact_places(docs, n=50):
    """(doc, first word) of every run of n words that another document holds too."""
    held = {}
    for doc, text in docs:
        words = (text or "").encode().lower().split()
        for k in range(len(words) - n + 1):
            held.setdefault(tuple(words[k:k + n]), set()).add((doc, k))
    return {p for places in held.values() if len({d for d, _ in places}) > 1 for p in places}


def covered(found, place, n=50):
    return any(d == place[0] and s <= place[1] and place[1] + n <= e for d, s, e in found)


def test_repeated_passages_cover_every_exact_repeat(spark):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = [tuple(r) for r in queries.op5_substring_dedup(spark, SF).select("doc_id", "start_word", "end_word").collect()]
    places = exact_places(docs)
    assert places and all(covered(found, p) for p in places)


def test_passages_of_odd_rows(spark, make_docs):
    passage, line = text_of(100, 60), text_of(101, 12)
    changed = passage.split()
    changed[30] = "other"
    rows = [(k, f"{text_of(k)} {line} {passage} {text_of(50 + k)}") for k in range(8)]
    rows += [(20, f"{text_of(20)} {line} {text_of(21)}"), (21, None), (22, ""), (23, " ".join(["a"] * 5000)), (24, text_of(24, 40)),
             (25, text_of(24, 40)), (26, f"{text_of(26)} {' '.join(changed * 2)}"), (0, rows[0][1]), (None, f"{passage} {text_of(60)}")]
    got = passages.repeated(make_docs(*rows, clashing=True)).collect()
    spans = {}
    for r in got:
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    assert set(spans) >= set(range(8)) | {None} and not set(spans) & {20, 21, 22, 23, 24, 25}
    for k in range(8):
        (s, e), = spans[k]
        assert s <= 132 and e >= 192 and e - s < 90
    assert all(r["similarity"] >= 0.8 for r in got)
    assert passages.repeated(make_docs()).count() == 0


def test_passages_of_a_common_line_meet_their_own_partners(spark, make_docs):
    """One line in every document; a passage around it shared by two documents in the middle of the group."""
    line, passages_ = text_of(300, 40), [text_of(310 + k, 5) for k in range(20)]
    rows = [(k, f"{text_of(400 + k)} {passages_[k // 2]} {line} {passages_[19 - k // 2]} {text_of(500 + k)}") for k in range(20)]
    rows += [(100 + k, f"{text_of(600 + k)} {line} {text_of(700 + k)}") for k in range(60)]
    found = {r["doc_id"] for r in passages.repeated(make_docs(*rows), least_words=50).select("doc_id").collect()}
    assert set(range(20)) <= found


def edited(words, kind, rng):
    at = int(rng.integers(5, len(words) - 5))
    return words[:at] + {"change": ["new"] , "insert": ["new"], "delete": []}[kind] + words[at + (kind != "insert"):]


def test_planted_edits_are_found(spark, make_docs):
    """One word changed, inserted or deleted in passages of 50 and 60 words, in a group of unlike documents."""
    rng, rows, want = np.random.default_rng(9), [], {}
    for k in range(300):
        kind = ("change", "insert", "delete")[k % 3]
        words = text_of(2000 + k, 50 if k % 2 else 60).split()
        for side, held in enumerate((words, edited(words, kind, rng))):
            rows.append((2 * k + side, f"{text_of(3000 + 2 * k + side, 80)} {' '.join(held)} {text_of(5000 + 2 * k + side, 80)}"))
            want.setdefault(kind, set()).add((2 * k + side, len(held)))
    spans = {}
    for r in passages.repeated(make_docs(*rows)).collect():
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    for kind, cases in want.items():
        hit = [any(s <= 80 + 10 and e >= 80 + n - 10 for s, e in spans.get(d, [])) for d, n in cases]
        print(kind, sum(hit), len(hit))
        assert sum(hit) >= 0.97 * len(hit), kind


def test_aligned_passes_over_an_insertion():
    a = np.arange(100, 146, dtype=np.uint64)
    b = np.concatenate([a[:21], np.arange(900, 905, dtype=np.uint64), a[25:]])
    (start, end, start_b, end_b, like), = passages.aligned(a, b, 0, 0, 20, 46, 0.8)
    assert (start, end, start_b, end_b) == (0, 45, 0, 46) and 0.8 <= like < 1


def test_compact_windows_are_the_wide_nodes_of_the_tree():
    rng = np.random.default_rng(1)
    for n in (0, 5, 60, 200):
        hashes = rng.permutation(n).astype(np.uint64)
        found = passages.compact_windows(hashes, 20)
        held = {}
        for lo, at, hi in found:
            for s in range(lo, at + 1):
                for e in range(max(at, s + 19), hi + 1):
                    assert (s, e) not in held
                    held[s, e] = at
        assert held == {(s, e): int(hashes[s:e + 1].argmin()) + s for s in range(n) for e in range(s + 19, n)}
