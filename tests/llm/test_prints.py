"""Collocations, edit fingerprints and vector codes against brute force and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_helpers import SF, make_docs, rows_of  # noqa: F401
from pyspark.sql import functions as F

from carelake.catalog.registry import ORACLES
from carelake.llm import collocations, edit_prints, queries, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


# --- collocations -----------------------------------------------------------------


def brute_collocations(rows, longest=4, least=30, covered=80, top=2000):
    totals, counts = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang or "und", tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    kept = {k: f for k, f in counts.items() if f >= least and len(k[1]) > 1}
    out = {}
    for (lang, g), a in kept.items():
        around = [f for (other, h), f in kept.items() if other == lang and len(h) > len(g)
                  and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if any(100 * f >= covered * a for f in around):
            continue
        cuts = [(2000000 * a // (counts[lang, g[:k]] + counts[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, l, rr, totals[lang], -s)
                  for lang, found in out.items() for r, (s, a, p, l, rr) in enumerate(sorted(found)[:top]))


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrase_rows(seed, n=60):
    random_ = random.Random(seed)
    rows = []
    for k in range(n):
        words = random_.choices(["New", "york", "city", "the", "über", "a", "x y", "of"], k=random_.randrange(40))
        text = "".join(w + random_.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for w in words)
        rows.append((text, random_.choice(["en", "de", None, "und"])))
    return [*rows, ("", "en"), (None, "fr"), ("New York City", "en"), ("New York City", "en"), ("..,;", None)]


@pytest.mark.parametrize("bits", [64, 4])
def test_collocations_equal_brute_force_also_when_fingerprints_collide(spark, make_docs, bits):
    rows = phrase_rows(3)
    docs = make_docs(*[(k, text, "s", lang) for k, (text, lang) in enumerate(rows)], clashing=True)
    for least, covered in ((2, 80), (3, 50)):
        got = rows_of(collocations.collocations(docs, least=least, covered=covered, bits=bits), *COLUMNS)
        assert got == sorted(brute_collocations(rows, least=least, covered=covered), key=str) and got


def test_collocations_of_buffers_and_top(spark, make_docs, monkeypatch):
    monkeypatch.setattr(collocations, "BUFFER", 50)
    monkeypatch.setattr(collocations, "MERGED", 200)
    rows = phrase_rows(5)
    docs = make_docs(*[(k, text, "s", lang) for k, (text, lang) in enumerate(rows)])
    got = rows_of(collocations.collocations(docs, least=2, top=3), *COLUMNS)
    assert got == sorted(brute_collocations(rows, least=2, top=3), key=str)


def test_collocations_of_nothing(spark, make_docs):
    assert collocations.collocations(make_docs((1, "x y")).where("doc_id > 1")).count() == 0
    assert collocations.collocations(make_docs((1, None), (None, " . "))).count() == 0


def test_scores_do_not_overflow(spark, make_docs):
    long = make_docs((1, "ab cd " * 40_000 + ". ef gh"))
    got = rows_of(collocations.collocations(long), *COLUMNS)
    assert got == sorted(brute_collocations([("ab cd " * 40_000 + ". ef gh", "en")]), key=str)


def test_collocations_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op11_collocations']})").fetchall()
    assert rows_of(queries.op11_collocations(spark, SF), *COLUMNS) == sorted(want, key=str)


# --- edit fingerprints --------------------------------------------------------------


def brute_print(text, embedding):
    """The walk step by step, and the place of every slot by trying all its lows."""
    shown = []
    for c in text:
        row = (ord(c) * 0x9E3779B1 >> 13) % edit_prints.ROWS
        shown += [ord(c)] * embedding.jumps[row][len(shown) % edit_prints.PERIOD]
    out = []
    for own in embedding.lows:
        place = max((int(p) for p in own if p < len(shown)), default=None)
        out.append(0 if place is None else (((place * 0x9E3779B97F4A7C15 % 2**64) ^ shown[place]) * 0xC2B2AE3D27D4EB4F % 2**64) >> 56)
    return bytes(out)


def edit_results(rows, embedding):
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        a, b, c = (brute_print(t, embedding) for t in (text, edited, following))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(),
                    edit_prints.likeness(a, b), edit_prints.likeness(a, c)))
    return sorted(out, key=str)


RESULTS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_edit_prints_equal_brute_force_on_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.op12_edit_prints(spark, SF)
    assert rows_of(got, *RESULTS) == edit_results(rows, edit_prints.Embedding())
    near = [(r["near_edited"], r["near_next"]) for r in got.collect()]
    assert np.mean([a > b for a, b in near]) > 0.99


def test_edit_prints_of_odd_rows(spark, make_docs):
    long = "".join(random.Random(1).choices("abcde ñ😀", k=200_000))
    rows = [(7, None), (5, ""), (3, "a"), (2, long), (9, "ab😀d"), (8, "ab😀d"), (1, "xyz" * 50)]
    got = rows_of(edit_prints.digests(make_docs(*rows, clashing=True)), *RESULTS)
    assert got == edit_results(rows, edit_prints.Embedding())
    one = edit_prints.digests(make_docs((4, "abcdef"))).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0
    assert edit_prints.digests(make_docs((4, "x")).where("doc_id > 4")).count() == 0
    repeated = edit_prints.digests(make_docs((1, "b"), (1, "b"), (None, "abc"), (1, "cde"), (2, "q")))
    assert sorted(r["n_chars"] for r in repeated.collect()) == [1, 1, 1, 3, 3]
    # the row without id comes last, so the first of the others follows it
    assert [r["edited_sha256"] for r in repeated.where("doc_id IS NULL").collect()] == [hashlib.sha256(b"abq").hexdigest()]


def test_copies_and_edits_are_found(spark, make_docs):
    random_ = random.Random(2)
    texts = ["".join(random_.choices("abcdefghij ", k=400)) for _ in range(30)]
    edited = []
    for t in texts:
        at = random_.randrange(350)
        edited.append(t[:at] + "zz" + t[at + 3:])
    rows = [*enumerate(texts), *((100 + k, t) for k, t in enumerate(edited)), (200, texts[0]), (201, ""), (202, None)]
    docs = make_docs(*rows)
    found = {tuple(r) for r in edit_prints.search(docs, docs.where("doc_id < 30 OR doc_id = 201")).select("query", "doc_id", "edits").collect()}
    assert {(k, 100 + k) for k in range(30)} <= {f[:2] for f in found} and all(f[2] <= 3 for f in found)
    assert (0, 200, 0) in found and (201, 202, 0) in found and len(found) == 32


# --- vector codes -------------------------------------------------------------------


def brute_codes(rows, parts, entries, rounds):
    """Full search; rows (id, vector) in the order of the contract."""
    own = np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64).reshape(len(rows), parts, -1)
    book = own[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        square = np.stack([((own[:, p, None] - book[p][None]) ** 2).sum(axis=2) for p in range(parts)], axis=1)
        best = square.argmin(axis=2)
        if k < rounds:
            for p in range(parts):
                for e in set(best[:, p].tolist()):
                    mine = own[best[:, p] == e, p]
                    book[p, e] = mine.sum(axis=0) // len(mine)
    return [best[i].astype(np.uint8).tobytes().hex() for i in range(len(rows))], square.min(axis=2).sum(axis=1).tolist(), book


@pytest.mark.parametrize("entries,stored,rounds", [(64, 16, 2), (64, 2, 4), (16, 8, 3), (5, 16, 1), (32, 4, 0)])
def test_codes_equal_full_search(spark, entries, stored, rounds):
    random_ = np.random.default_rng(entries)
    values = (random_.integers(0, 6, (700, 32)) / 8 + random_.normal(0, 0.02, (700, 32)) * (random_.random((700, 1)) < 0.5)).astype(np.float32)
    rows = [(k, v.tolist(), None if k % 5 == 0 else k % 3) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    codes, errors, book = brute_codes([(k, v) for k, v, _ in rows], 16, entries, rounds)
    found = vector_codes.encode(df, entries=entries, stored=stored, rounds=rounds)
    assert rows_of(found.rows, "id", "code", "error") == sorted(zip(range(700), codes, errors), key=str)
    assert (found.codebooks == book).all()
    sums = Counter()
    for (_, _, label), e in zip(rows, errors):
        sums[label] += e
    got = vector_codes.digests(df, entries=entries, stored=stored, rounds=rounds)
    assert rows_of(got, "vec_id", "label_error") == sorted(((k, sums[label]) for k, _, label in rows), key=str)


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v, w = [0.5] * 16, [-0.25] * 16
    rows = [(4, v, 1), (2, w, None), (2, w, None), (None, v, 1), (1, None, 1), (3, [None, *v[1:]], 2), (5, [nan, *v[1:]], 2),
            (6, [inf, *v[1:]], 2), (7, v * 2, 2), (8, [], 2), (9, [1e30, *v[1:]], 3)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("id", "ints", "code", "needs", "of")})
    got = rows_of(vector_codes.digests(df), "vec_id", "code", "error", "label_error")
    # entries in order of ids: w, w, v, the clipped vector, v without an id
    assert got == sorted([(2, "00" * 16, 0, 0), (2, "00" * 16, 0, 0), (4, "02" * 16, 0, 0), (None, "02" * 16, 0, 0),
                          (9, "03" + "02" * 15, 0, 0)], key=str)
    assert vector_codes.digests(df.where("vec_id = 1")).count() == 0


def test_bounds_spare_most_comparisons():
    random_ = np.random.default_rng(1)
    own = random_.integers(-200, 200, (2000, 4))
    book = own[:64].copy()
    order, bounds, outer, _ = vector_codes.full_search(own, book, 16)
    new = book + random_.integers(-3, 4, book.shape)
    moved = np.sqrt(((new - book) ** 2).sum(axis=1)) + 1e-6
    state = [vector_codes.rounded_down(x).astype(float) for x in (bounds, outer)]
    order, bounds, outer, best, needs = vector_codes.bounded_search(own, new, moved, order, *state)
    square = vector_codes.distances(own, new)
    assert (order[:, 0] == square.argmin(axis=1)).all() and (best == square.min(axis=1)).all()
    assert (needs == 1).mean() > 0.5 and (needs > 16).mean() < 0.01
    root = np.sqrt(np.take_along_axis(square, order, axis=1))
    assert (bounds <= root + 1e-9).all() and (np.diff(bounds, axis=1) >= 0).all()


def test_codes_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op13_vector_codes']})").fetchall()
    assert rows_of(queries.op13_vector_codes(spark, SF), *columns) == sorted(want, key=str)
