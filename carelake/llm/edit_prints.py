"""Fingerprints of documents by a randomised edit embedding.

A text is embedded by a random walk over its characters: step i shows the
character the walk stands at and moves on by r(i, character), a random bit that
all texts share.  After an edit two walks soon fall into step again, so a small
edit distance becomes a small Hamming distance of the embeddings.  r has a period
of ``PERIOD`` steps; characters share 256 rows of it.

A fingerprint samples the embedding in ``slots`` places.  A slot takes the place
below the length of the walk whose random rank is the lowest, so texts of n and m
steps agree on a place with probability min(n, m) / max(n, m), whatever their
lengths; a slot holds 8 bits of (place, character).  The likeness of two
fingerprints is the share of equal slots.  All characters are walked over.

``neighbours`` compares each document with the one that follows in descending id
and with its own edited text, in one shuffle: rows are range-partitioned and
sorted, tasks pass over them once, and only the last row of a partition waits for
the first of the next.  ``search`` finds the near copies of given queries: texts
whose fingerprints share a band of sampled slots are verified by edit distance.

Defined results: null texts are empty; an empty text has a fingerprint of zeros.
Rows without id come last, rows that repeat an id in an order of their texts'
hashes; a single row follows itself.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch

PERIOD, ROWS, SLOTS, PIECE = 1024, 256, 128, 1 << 16
LONGEST = 1 << 40


def _jumps(seed: int) -> list[list[int]]:
    """Steps that the walk spends on a character of row c from step s on (mod the period)."""
    bits = np.random.default_rng(seed).integers(0, 2, (ROWS, PERIOD)).astype(bool)
    bits[:, -1] = True  # every walk moves on
    place = np.where(np.hstack([bits, bits]), np.arange(2 * PERIOD), 4 * PERIOD)
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
    return (following - np.arange(PERIOD) + 1).tolist()


def _lows(seed: int, slots: int) -> np.ndarray:
    """Per slot the places that rank lower than all before them, padded with ``LONGEST``."""
    random, found = np.random.default_rng([seed, 1]), []
    for _ in range(slots):
        at, low, own = 0, random.random(), []
        while at < LONGEST:
            own.append(int(at))
            gap = np.log(max(random.random(), 1e-300)) / np.log1p(-low)
            at, low = at + 1 + min(np.floor(gap), LONGEST), max(low * random.random(), 1e-15)
        found.append(own)
    width = max(map(len, found))
    return np.array([own + [LONGEST] * (width - len(own)) for own in found], np.int64)


class Embedding:
    """Walks and samples under one seed."""

    def __init__(self, seed: int = 11, slots: int = SLOTS):
        self.jumps, self.lows = _jumps(seed), _lows(seed, slots)

    def walk(self, points: np.ndarray, at: int = 0) -> np.ndarray:
        """Step after each character of ``points``, from step ``at`` on."""
        rows = ((points.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(13)) & np.uint64(ROWS - 1)).astype(np.uint8).tobytes()
        ends, jumps, mask = np.empty(len(rows), np.int64), self.jumps, PERIOD - 1
        for lo in range(0, len(rows), PIECE):
            piece = []
            add = piece.append
            for row in rows[lo:lo + PIECE]:
                at += jumps[row][at & mask]
                add(at)
            ends[lo:lo + len(piece)] = piece
        return ends

    def sample(self, points: np.ndarray, ends: np.ndarray) -> bytes:
        """Fingerprint of a text from its characters and its walk."""
        if not len(points):
            return bytes(len(self.lows))
        place = self.lows[np.arange(len(self.lows)), (self.lows < ends[-1]).sum(axis=1) - 1]
        shown = points[np.searchsorted(ends, place, side="right")].astype(np.uint64)
        with np.errstate(over="ignore"):
            mixed = (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ shown) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(56)).astype(np.uint8).tobytes()


def points_of(text: str | None) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def text_of(points: np.ndarray) -> bytes:
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal slots."""
    return float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())


class _Text:
    def __init__(self, embedding: Embedding, text: str | None):
        self.points = points_of(text)
        self.ends = embedding.walk(self.points)
        self.print = embedding.sample(self.points, self.ends)


def _beside(embedding: Embedding, own: _Text, following: _Text) -> tuple:
    """Results of a text beside its edited text and the following one."""
    cut = len(own.points) - len(own.points) // 3
    tail = following.points[: len(own.points) // 3]
    # the walk over what the edit leaves is the same
    ends = np.concatenate([own.ends[:cut], embedding.walk(tail, int(own.ends[cut - 1]) if cut else 0)])
    points = np.concatenate([own.points[:cut], tail])
    edited = embedding.sample(points, ends)
    return (len(own.points), hashlib.sha256(text_of(points)).digest(), own.print, edited,
            likeness(own.print, edited), likeness(own.print, following.print))


RESULT = "n_chars long, edited binary, print binary, edited_print binary, near_edited double, near_next double"
_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_NAMES = ["n_chars", "edited", "print", "edited_print", "near_edited", "near_next"]


def _pass_over(embedding_of):
    """One pass over sorted rows: results, and the first (kind 1) and the last row (kind 2) of the partition."""

    def run(batches):
        embedding, part = embedding_of(), TaskContext.get().partitionId()
        last, last_id, last_text = None, None, None

        def out(ids, results, kind, texts):
            n = len(ids)
            columns = list(zip(*results)) if results else [[None] * n] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(texts, pa.string()),
                 *[pa.array(c, t) for c, t in zip(columns, _TYPES)]], names=["id", "kind", "part", "text", *_NAMES])

        for batch in batches:
            id_type, found = batch["id"].type, ([], [])
            for at in range(batch.num_rows):
                key, text = batch["id"][at].as_py(), batch["text"][at].as_py()
                own = _Text(embedding, text)
                if last is None:
                    yield out([key], None, 1, [text])
                else:
                    found[0].append(last_id)
                    found[1].append(_beside(embedding, last, own))
                last, last_id, last_text = own, key, text
            if found[0]:
                yield out(found[0], found[1], 0, [None] * len(found[0]))
        if last is not None:
            yield out([last_id], None, 2, [last_text])

    return run


def _close(embedding_of):
    """Results of the last rows of partitions beside the first rows of the next ones."""

    def run(batches):
        embedding = embedding_of()
        for batch in batches:
            results = [_beside(embedding, _Text(embedding, a), _Text(embedding, b))
                       for a, b in zip(batch["text"].to_pylist(), batch["following"].to_pylist())]
            columns = list(zip(*results)) if results else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch["id"], *[pa.array(c, t) for c, t in zip(columns, _TYPES)]], names=["id", *_NAMES])

    return run


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 11, slots: int = SLOTS) -> DataFrame:
    """Per document: id and ``RESULT``, with binary digests and fingerprints."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "edit-prints")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows with equal id and text are alike, so any place tells them apart
    rows = rows.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.col("id").desc_nulls_last(), F.col("hash"), F.col("place")]
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)

    def embedding_of():
        return Embedding(seed, slots)

    id_type = dict(rows.dtypes)["id"]
    passed = ranged.select("id", "text").mapInArrow(_pass_over(embedding_of), f"id {id_type}, kind int, part int, text string, {RESULT}")
    passed = scratch.save(passed, "passed")
    parts = sorted(r["part"] for r in passed.where("kind = 1").select("part").collect())  # one row a partition
    pairs = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    heads = passed.where("kind = 1").select(F.col("part").alias("next"), F.col("text").alias("following"))
    ends = passed.where("kind = 2").select("id", "part", "text").join(pairs, "part").join(heads, "next").select("id", "text", "following")
    closed = ends.mapInArrow(_close(embedding_of), f"id {id_type}, {RESULT}")
    return passed.where("kind = 0").select("id", *_NAMES).unionByName(closed).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``neighbours`` with digests and fingerprints in lower-case hex."""
    return neighbours(docs, id_col, **options).select(
        id_col, "n_chars", F.lower(F.hex("edited")).alias("edited_sha256"), F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next")


# --- search -----------------------------------------------------------------------


def _banded(embedding_of, width: int):
    def run(batches):
        embedding = embedding_of()
        for batch in batches:
            prints = [_Text(embedding, t).print for t in batch["text"].to_pylist()]
            keys = [[xxhash.xxh64_intdigest(p[at:at + width], at) - (1 << 63) for at in range(0, len(p), width)] for p in prints]
            yield pa.RecordBatch.from_arrays(
                [batch["hash"], pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["hash", "print", "keys"])

    return run


def search(docs: DataFrame, queries: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", seed: int = 11,
           slots: int = SLOTS, width: int = 4) -> DataFrame:
    """(query, id, edits) of all documents at edit distance of at most (1 - similarity) of the longer text.

    ``queries`` are rows like ``docs``.  Candidates share a band of ``width``
    sampled slots (128 slots: 32 bands; texts whose fingerprints agree in 0.6 of
    the slots meet with probability 0.99); equal texts are one row before that, and the
    exact distance is computed with a bound.  A row does not find itself; other
    rows with its text are found with 0 edits.
    """
    scratch = Scratch(docs.sparkSession, "edit-search")

    def embedding_of():
        return Embedding(seed, slots)

    def named(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        return rows.withColumn("hash", F.xxhash64("text"))

    def bands(rows: DataFrame, name: str) -> DataFrame:
        once = rows.select("hash", "text").dropDuplicates(["hash"])
        return scratch.save(once.mapInArrow(_banded(embedding_of, width), "hash long, print binary, keys array<long>"), name)

    rows, asked = scratch.save(named(docs), "rows"), scratch.save(named(queries), "queries")
    own, theirs = bands(rows, "bands"), bands(asked, "query-bands")
    left = theirs.select(F.col("hash").alias("query_hash"), F.explode("keys").alias("key"))
    met = left.join(own.select("hash", F.explode("keys").alias("key")), "key").select("query_hash", "hash").distinct()
    met = scratch.save(met, "candidates")
    texts = rows.select("hash", "text").dropDuplicates(["hash"])
    asked_texts = asked.select(F.col("hash").alias("query_hash"), F.col("text").alias("query_text")).dropDuplicates(["query_hash"])
    both = met.join(texts, "hash").join(asked_texts, "query_hash")
    most = F.floor(F.greatest(F.length("text"), F.length("query_text")) * (1 - similarity) + 1e-9).cast("int")
    near = both.where(F.abs(F.length("text") - F.length("query_text")) <= most)
    edits = F.levenshtein("text", "query_text")
    near = scratch.save(near.select("query_hash", "hash", edits.alias("edits"), most.alias("most")).where("edits <= most"), "near")
    pairs = near.join(asked.select(F.col("id").alias("query"), F.col("hash").alias("query_hash")), "query_hash")
    pairs = pairs.join(rows.select("id", "hash"), "hash")
    return pairs.where(~F.col("query").eqNullSafe(F.col("id"))).select("query", F.col("id").alias(id_col), "edits")
