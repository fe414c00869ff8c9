"""Passages that repeat across documents, found by compact windows.

A document's tokens are its shingles of five words (A-Z lower-cased, cut at ASCII
white space).  Under a hash function the stretches that share their smallest token
form one compact window (left end, place, right end): a node of the Cartesian tree
over the hashes.  Two documents that hold a near-duplicate passage have, under each
of ``functions`` hash functions with the probability of their similarity, windows
with the same smallest token, which is the key of a window.

Windows of equal keys form a group, whose members are classed by the text around
the place.  Members of one class meet the first and the last of it.  One member of
each class meets those of all other classes of the group, in bounded blocks, on
the tokens around the place: a meeting is reported if it covers a stretch of the
member that no reported meeting covers yet, so every stretch with a partner in the
group is reported with one, and the rows stay linear in the group.

Meetings of two documents on one diagonal become one segment, which is verified on
the texts: runs of equal tokens are chained across diagonals, so words may be
changed, inserted or deleted, and stretches of which one side has ``least`` tokens
are reported from a Jaccard similarity of ``similarity``.  An exact repeat of
``least`` tokens always has windows of one key.

Only windows whose key may occur twice, by a bitmap of at most 2^27 bits, are
dealt out again; it has no false negatives.

Defined results: null, empty and short texts hold no passage; rows equal in id and
text are one; a row without id can repeat others but is reported with a null id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, chunk_pairs, sorted_groups

WIDTH = 5
MOST_BITS = 27


def tokens(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Hash of every shingle of ``width`` words."""
    words = text.lower().split()
    if len(words) < width:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e]) for s, e in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())], np.uint64)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes."""
    x = (x ^ np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def compact_windows(hashes: np.ndarray, least: int, repeats: bool = True) -> list[tuple[int, int, int]]:
    """(left, place, right) of every node of the Cartesian tree that is at least ``least`` wide.

    With ``repeats``, the middle one of equal smallest hashes is the place, which
    keeps the tree flat on monotonous texts.
    """
    out, waiting = [], [(0, len(hashes) - 1)]
    while waiting:
        lo, hi = waiting.pop()
        if hi - lo + 1 < least:
            continue
        part = hashes[lo:hi + 1]
        at = int(part.argmin())
        if repeats:
            same = np.flatnonzero(part == part[at])
            at = int(same[len(same) // 2])
        at += lo
        out.append((lo, at, hi))
        waiting.append((lo, at - 1))
        waiting.append((at + 1, hi))
    return out


def around(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch start:end of tokens."""
    odd = 0x9FB21C651E98DF25
    power, inverse = np.full(len(hashes) + 1, odd, np.uint64), np.full(len(hashes) + 1, pow(odd, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1])])
    return (total[end] - total[start]) * inverse[start]


def _windows(shortest: int, reach: int, functions: int):
    def keys_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Columns document, key, place, class of texts laid end to end.

        The class is a hash of the tokens up to ``reach`` from the place.
        """
        out = []
        spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        repeats = [len(np.unique(hashes[s:e])) < e - s for s, e in spans]
        for f in range(functions):
            own = mixed(hashes, f)
            found = [compact_windows(own[s:e], shortest, r) for (s, e), r in zip(spans, repeats)]
            doc = np.repeat(np.arange(len(spans)), [len(x) for x in found])
            at = np.array([w[1] for x in found for w in x], np.int64)
            place, size = at + bounds[doc], np.diff(bounds)[doc]
            before, after = np.minimum(at, reach), np.minimum(size - 1 - at, reach)
            kind = mixed(around(hashes, place - before, place + after + 1) + before.astype(np.uint64), 99).view(np.int64)
            out.append(np.stack([doc, mixed(own[place], f).view(np.int64), at, kind]))
        return np.concatenate(out, axis=1)

    def make(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                made = [(row, tokens(text)) for row, text in zip(part["row_key"].to_pylist(), part["text"].to_pylist())]
                made = [(row, hashes) for row, hashes in made if len(hashes) >= shortest]
                if made:
                    bounds = np.cumsum([0, *[len(h) for _, h in made]])
                    doc, key, at, kind = keys_of(np.concatenate([h for _, h in made]), bounds)
                    rows = np.array([row for row, _ in made], np.int64)[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows), pa.array(key), pa.array(at.astype(np.int32)), pa.array(kind)],
                        names=["row_key", "key", "at", "kind"])

    return make


def _surroundings(reach: int):
    """Tokens (four bytes each, zero outside) around the places of a document."""
    names = ["key", "kind", "row_key", "at", "mate", "mate_at"]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                hashes = tokens(batch["text"][k].as_py()).astype(np.uint32) | np.uint32(1)
                padded = np.concatenate([np.zeros(reach, np.uint32), hashes, np.zeros(reach, np.uint32)])
                part = pa.Table.from_batches([pa.RecordBatch.from_struct_array(batch["places"][k].values)])
                for small in part.to_batches(max_chunksize=2000):
                    cut = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1)[small["at"].to_numpy()]
                    yield pa.RecordBatch.from_arrays(
                        [*[small[c] for c in names], pa.array([x.tobytes() for x in cut], pa.binary())], names=[*names, "tokens"])

    return run


def numbered(held: np.ndarray) -> np.ndarray:
    """Rows of tokens in which the n-th repeat of a token on a side of the middle has its own name."""
    held = held.copy()
    middle = held.shape[1] // 2
    ordered = np.sort(held, axis=1)
    for k in np.flatnonzero(((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] != 0)).any(axis=1)):
        for side, salt in ((range(middle, held.shape[1]), 2), (range(middle - 1, -1, -1), 3)):
            seen: dict[int, int] = {}
            for i in side:
                if value := int(held[k, i]):
                    seen[value] = seen.get(value, 0) + 1
                    held[k, i] = (value + 0x9E3779B1 * salt * (seen[value] - 1) & 0xFFFFFFFF) | 1
    return held


def _similar(where: np.ndarray, inside: np.ndarray, least: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row and stretch of ``least`` tokens over the middle: similar or not, first and last place on the other side.

    ``where`` has the place on the other side of each token, -1 for none.
    """
    first = where.shape[1] // 2 - least + 1
    part = where[:, first:first + 2 * least - 1]
    seen = np.lib.stride_tricks.sliding_window_view(part, least, axis=1)
    shared = (seen >= 0).sum(axis=2)
    to = seen.max(axis=2)
    start = np.where(seen >= 0, seen, 1 << 20).min(axis=2)
    inside = inside[:, first:first + least] & inside[:, first + least - 1:first + 2 * least - 1]
    return inside & (shared >= similarity * (least + to - start + 1 - shared)) & (shared > 0), start, to


def meetings(held: np.ndarray, alone: np.ndarray, row: np.ndarray, other: np.ndarray, least: int, similarity: float) -> list[tuple[int, int]]:
    """Pairs (x, y) of classes that cover every stretch of x with its like in another document, each with one pair."""
    out, width = [], held.shape[1]
    held, first = numbered(held), width // 2 - least + 1
    flat = held.ravel()
    order = np.argsort(flat, kind="stable")
    ordered, owner = flat[order], order // width
    for x in np.flatnonzero(alone).tolist():  # copies in other documents cover all of the others
        own = np.unique(held[x][held[x] != 0])
        lo, hi = np.searchsorted(ordered, own), np.searchsorted(ordered, own, "right")
        shared = np.bincount(np.concatenate([owner[s:e] for s, e in zip(lo.tolist(), hi.tolist())]), minlength=len(held))
        shared[x] = 0
        near = np.flatnonzero((shared >= similarity * least) & ((row != row[x]) | (other != row[x])))
        near = near[np.argsort(-shared[near], kind="stable")]
        covered, by_place = np.zeros(least, bool), np.argsort(held[x], kind="stable")
        inside = held[x] != 0
        whole = inside[first:first + least] & inside[first + least - 1:first + 2 * least - 1]
        for at, upto in ((0, 1), (1, 16), *((k, k + 256) for k in range(16, len(near), 256))):
            part = near[at:upto]
            if not len(part) or whole.any() and not (whole & ~covered).any():
                break
            theirs = held[part]
            spot = by_place[np.minimum(np.searchsorted(held[x][by_place], theirs), width - 1)]
            back = np.where((theirs != 0) & (held[x][spot] == theirs), spot, -1)  # places in x of their tokens
            where = np.full(theirs.shape, -1)
            k, i = np.nonzero(back >= 0)
            where[k, back[k, i]] = i
            ok, _, _ = _similar(where, np.broadcast_to(inside, where.shape), least, similarity)
            while (new := (ok & ~covered).sum(axis=1)).any():
                best = int(new.argmax())
                covered |= ok[best]
                out.append((x, int(part[best])))
            # shorter stretches of x that are like a whole one of the other side
            ok, start, to = _similar(back, theirs != 0, least, similarity)
            ends = np.flatnonzero(covered) + first
            ok &= ~((ends[None, None, :] <= start[:, :, None]) & (to[:, :, None] < ends[None, None, :] + least)).any(axis=2)
            shorter: set[tuple[int, int]] = set()
            for k in np.flatnonzero(ok.any(axis=1)).tolist():
                new = set(zip(start[k][ok[k]].tolist(), to[k][ok[k]].tolist()))
                new = {n for n in new if not any(s <= n[0] and n[1] <= e for s, e in shorter)}
                if new:
                    shorter |= new
                    out.append((x, int(part[k])))
    return out


def _meet(least: int, similarity: float):
    names = ["row_key", "at", "other", "other_at"]

    def run(batches):
        for rows, bounds in sorted_groups(batches, ["key", "i", "j"]):
            row, at, mate, mate_at = (rows[c].to_numpy() for c in ("row_key", "at", "mate", "mate_at"))
            out = []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if e - s < 2:
                    continue
                held = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in rows["tokens"].slice(s, e - s)])
                for x, y in meetings(held, row[s:e] == mate[s:e], row[s:e], mate[s:e], least, similarity):
                    x, y = x + s, y + s
                    out.append((row[x], at[x], row[y], at[y]) if row[y] != row[x] else (row[x], at[x], mate[y], mate_at[y]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], pa.int64() if k % 2 == 0 else pa.int32()) for k in range(4)], names=names)

    return run


def _maybe_twice(bits: np.ndarray, log_bits: int):
    shift = np.uint64(64 - log_bits)

    def keep(batches):
        for batch in batches:
            where = batch["key"].to_numpy().view(np.uint64) >> shift
            yield batch.filter(pa.array((bits[where >> np.uint64(3)] >> (where & np.uint64(7)).astype(np.uint8) & 1).astype(bool)))

    return keep


def _bitmap(keys: DataFrame, column: str, log_bits: int, log_block: int = 13) -> np.ndarray:
    """Bits of 64-bit keys as bytes, made in blocks by the tasks; its bounded size passes the driver."""

    def blocks(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch["key"].to_numpy().view(np.uint64) >> np.uint64(64 - log_bits)
            block = (place >> np.uint64(log_block)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            names, starts = np.unique(block[order], return_index=True)
            for name, where in zip(names.tolist(), np.split(place[order], starts[1:])):
                bits = held.setdefault(name, np.zeros(1 << log_block, bool))
                bits[where & np.uint64((1 << log_block) - 1)] = True
            if len(held) >= 2048:
                yield packed(held)
                held = {}
        if held:
            yield packed(held)

    def packed(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(
            [np.packbits(b, bitorder="little").tobytes() for b in held.values()], pa.binary())], names=["block", "bits"])

    dealt = keys.select(F.col(column).alias("key")).repartition(F.shiftrightunsigned(F.col("key"), 64 - log_bits + log_block))
    out = np.zeros(1 << (log_bits - 3), np.uint8)
    size = 1 << (log_block - 3)
    for row in dealt.mapInArrow(blocks, "block long, bits binary").toLocalIterator():
        at = row["block"] * size
        out[at:at + size] |= np.frombuffer(row["bits"], np.uint8)
    return out


def _size(count: int) -> int:
    return min(MOST_BITS, max(13, count.bit_length() + 4))


def _blocks(a: np.ndarray, b: np.ndarray, diagonal: int) -> np.ndarray:
    """Rows (start in a, start in b, length): runs of tokens of a with their equals in b, of equal ones those nearest the diagonal."""
    names, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    size = len(a) + len(b) + 1
    places = np.sort(code[len(a):] * size + np.arange(len(b)))
    wanted = code[:len(a)] * size + np.clip(np.arange(len(a)) - diagonal, 0, size - 1)
    up = np.searchsorted(places, wanted)
    best, far = np.full(len(a), -1), np.full(len(a), size)
    for at in (up, up - 1):
        found = places[np.clip(at, 0, len(places) - 1)]
        gap = np.where((found // size == code[:len(a)]) & (at >= 0) & (at < len(places)), np.abs(found - wanted), size)
        best, far = np.where(gap < far, found % size, best), np.minimum(gap, far)
    i = np.flatnonzero(best >= 0)
    cut = np.flatnonzero((np.diff(i) != 1) | (np.diff(best[i]) != 1)) + 1
    starts = np.concatenate([[0], cut]).astype(int)
    return np.stack([i[starts], best[i[starts]], np.diff(np.append(starts, len(i)))], axis=1) if len(i) else np.zeros((0, 3), int)


def aligned(a: np.ndarray, b: np.ndarray, diagonal: int, lo: int, hi: int, least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """Similar stretches (first, last token of a, first, last token of b, similarity) around the places lo..hi of a on ``diagonal``.

    Runs of equal tokens are chained from the longest one at lo..hi on, the nearest
    next; every longest part of the chain that is similar enough is a stretch.  e
    equal tokens in stretches of m and n have the Jaccard similarity e / (m + n - e).
    """
    at, to, size = _blocks(a, b, diagonal).T
    seeds = np.flatnonzero((at <= hi) & (at + size > lo) & (at - to == diagonal))
    seeds = seeds[np.argsort(-size[seeds], kind="stable")].tolist()
    worth, far, out, used = (1 - similarity) / similarity, len(a) + len(b), [], set()
    most = worth * min(len(a), len(b))
    for seed in seeds:
        if seed in used:
            continue
        chain = [seed]
        for forward in (True, False):
            now = seed
            while True:
                if forward:
                    gap_a, gap_b = at - at[now] - size[now], to - to[now] - size[now]
                else:
                    gap_a, gap_b = at[now] - at - size, to[now] - to - size
                gap = np.where((gap_a >= 0) & (gap_b >= 0), gap_a + gap_b, far)
                gap[now] = far
                now = int(gap.argmin())
                if gap[now] > most:
                    break
                chain.append(now)
        used.update(chain)
        chain = np.array(sorted(chain, key=lambda k: at[k]))
        start, end, start_b, end_b = at[chain], (at + size)[chain], to[chain], (to + size)[chain]
        equal, upto = np.concatenate([[0], np.cumsum(size[chain])]), -1
        for k in range(len(chain)):
            m, n, e = end[k:] - start[k], end_b[k:] - start_b[k], equal[k + 1:] - equal[k]
            ok = np.flatnonzero((e >= similarity * (m + n - e)) & (np.maximum(m, n) >= least))
            if len(ok) and k + ok[-1] > upto:
                x = ok[-1]
                upto = k + x
                out.append((int(start[k]), int(end[upto]) - 1, int(start_b[k]), int(end_b[upto]) - 1, float(e[x] / (m[x] + n[x] - e[x]))))
    return out


def _verify(least: int, similarity: float):
    def run(batches):
        for batch in batches:
            out = []
            seen: dict[int, np.ndarray] = {}

            def of(key: int, text: bytes, seen=seen) -> np.ndarray:
                if key not in seen:
                    if len(seen) > 64:
                        seen.clear()
                    seen[key] = tokens(text)
                return seen[key]

            for a, b, diagonal, lo, hi, x, y in zip(*[batch[c].to_pylist() for c in ("a", "b", "diagonal", "lo", "hi", "text_a", "text_b")]):
                for start, end, start_b, end_b, like in aligned(of(a, x), of(b, y), diagonal, lo, hi, least, similarity):
                    out.append((a, start, end + WIDTH, b, like))
                    out.append((b, start_b, end_b + WIDTH, a, like))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                names=["row_key", "start", "end", "other", "similarity"])

    return run


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50, similarity: float = 0.8,
             functions: int = 3, chunk: int = 2048) -> DataFrame:
    """One row per repeated passage of a document: id, ``start_word``, ``end_word`` (exclusive), ``other_id``, ``similarity``.

    ``other_id`` is the smallest id among the documents that the passage was
    verified against; overlapping passages of a document are one.
    """
    scratch, least = Scratch(docs.sparkSession, "passages"), least_words - WIDTH + 1
    shortest, reach = math.ceil(similarity * least), least + math.ceil(least / 4)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"))

    def texts_of(parties: DataFrame, column: str) -> DataFrame:
        """Columns key, id, text of the rows that ``parties`` names, and of few others."""
        bits = _size(parties.count())
        named = rows.withColumnRenamed("row_key", "key").select("key", "id", "text")
        named = named.mapInArrow(_maybe_twice(_bitmap(parties, column, bits), bits), f"key long, id {dict(rows.dtypes)['id']}, text binary")
        return named.dropDuplicates(["key"])

    windows = scratch.save(rows.select("row_key", "text").mapInArrow(
        _windows(shortest, reach, functions), "row_key long, key long, at int, kind long"), "windows")
    twice = scratch.save(windows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys")
    log_bits = _size(twice.count())
    near = windows.mapInArrow(_maybe_twice(_bitmap(twice, "key", log_bits), log_bits), windows.schema)
    near = scratch.save(near.join(twice, "key"), "members")
    place = F.struct("row_key", "at")
    classes = near.groupBy("key", "kind").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    classes = scratch.save(classes, "classes")
    several = classes.where("first.row_key <> last.row_key")
    alike = near.join(several, ["key", "kind"]).withColumn("other", F.explode(F.array("first", "last")))
    alike = alike.where(F.col("row_key") != F.col("other.row_key")).select("row_key", "at", F.col("other.row_key").alias("other"), F.col("other.at").alias("other_at"))

    uneven = scratch.save(classes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    unlike = classes.join(uneven.select("key"), "key").select(
        F.col("first.row_key").alias("doc"), F.struct("key", "kind", F.col("first.row_key").alias("row_key"), F.col("first.at").alias("at"),
        F.col("last.row_key").alias("mate"), F.col("last.at").alias("mate_at")).alias("x"))
    unlike = scratch.save(unlike.groupBy("doc").agg(F.collect_list("x").alias("places")), "places")
    texts = texts_of(unlike, "doc").select(F.col("key").alias("doc"), "text")
    held = unlike.join(texts, "doc").select("places", "text").mapInArrow(
        _surroundings(reach), "key long, kind long, row_key long, at int, mate long, mate_at int, tokens binary")
    blocked = chunk_pairs(held.join(uneven, "key"), F.col("kind"), chunk)
    blocked = blocked.select("key", "i", "j", "kind", "row_key", "at", "mate", "mate_at", "tokens")
    unlike = blocked.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _meet(least, similarity), "row_key long, at int, other long, other_at int")
    met = alike.unionByName(unlike).select("row_key", "at", F.struct(F.col("other").alias("row_key"), F.col("other_at").alias("at")).alias("other"))
    flip = F.col("row_key") > F.col("other.row_key")
    met = met.select(
        F.least("row_key", "other.row_key").alias("a"), F.greatest("row_key", "other.row_key").alias("b"),
        F.when(flip, F.col("other.at")).otherwise(F.col("at")).alias("at"),
        F.when(flip, F.col("other.at") - F.col("at")).otherwise(F.col("at") - F.col("other.at")).alias("diagonal"))
    segments = scratch.save(met.groupBy("a", "b", "diagonal").agg(F.min("at").alias("lo"), F.max("at").alias("hi")), "segments")

    parties = segments.select(F.explode(F.array("a", "b")).alias("row_key")).distinct()
    parties = scratch.save(parties, "parties")
    held = scratch.save(texts_of(parties, "row_key"), "texts")
    texts = held.select("key", "text")
    pairs = segments.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    pairs = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    found = pairs.select("a", "b", "diagonal", "lo", "hi", "text_a", "text_b").mapInArrow(
        _verify(least, similarity), "row_key long, start long, end long, other long, similarity double")
    # at most one row per word of a document from here on, however many share it
    ids = held.select("key", "id")
    found = found.join(ids.select(F.col("key").alias("other"), F.col("id").alias("other_id")), "other")
    found = found.groupBy("row_key", "start").agg(F.max("end").alias("end"), F.min("other_id").alias("other_id"), F.max("similarity").alias("similarity"))
    found = scratch.save(found, "found")
    spans = found.groupBy("row_key").agg(F.collect_list(F.struct("start", "end", "other_id", "similarity")).alias("spans"))

    def join_spans(batches):
        for batch in batches:
            out = []
            for key, spans in zip(batch["row_key"], batch["spans"]):
                merged: list[list] = []
                for s in sorted((s["start"], s["end"], s["other_id"], s["similarity"]) for s in spans):
                    if merged and s[0] < merged[-1][1]:
                        m = merged[-1]
                        m[1], m[3] = max(m[1], s[1]), max(m[3], s[3])
                        m[2] = s[2] if m[2] is None else m[2] if s[2] is None else min(m[2], s[2])
                    else:
                        merged.append(list(s))
                out += [(key, *m) for m in merged]
            yield pd.DataFrame(out, columns=["key", "start_word", "end_word", "other_id", "similarity"])

    kind = dict(rows.dtypes)["id"]
    merged = spans.mapInPandas(join_spans, f"key long, start_word long, end_word long, other_id {kind}, similarity double")
    return merged.join(ids, "key").select(F.col("id").alias(id_col), "start_word", "end_word", "other_id", "similarity")
