"""Near copies of documents by MinHash bands and exact similarity of their shingles.

Texts are cut as in ``passages``: shingles of five words, A-Z lower-cased; fewer
words are one shingle, the whole sequence.  Documents with equal shingle sets are
one class.  A class has ``bands`` keys of ``rows`` minima each: two classes of
Jaccard similarity 0.8 share one with probability 1 - (1 - 0.8^4)^16 = 0.9998.

Each class of a key is compared with the first class of the key, which joins most
groups of copies by one comparison a member.  Only keys whose classes are not yet
one component go on: their classes meet in bounded blocks, where classes of
different components are compared and a spanning forest of the links is reported,
never their pairs.  A link is an exact similarity of ``similarity`` or more.  Near
copies are the components of the links.  Shingle sets are built for one row of a
class that shares a key, and written once.

Defined results: null and empty texts are one class; rows with a null id belong to
their group but never name it, and of a group without any id one row stays.  Rows
equal in id and text are one row; rows that repeat an id with other texts are rows
of their own.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, chunk_pairs, component_roots, small_batches, sorted_groups
from carelake.llm.passages import WIDTH, _bitmap, _maybe_twice, _size, mixed, tokens

PIECE = 256  # rows of texts or sets held as Python objects at once


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = (text or b"").lower().split()
    if 0 < len(words) < WIDTH:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    return np.unique(tokens(text or b""))


def class_of(own: np.ndarray) -> int:
    """Signed 64-bit name of a shingle set."""
    value = xxhash.xxh64_intdigest(own.tobytes(), 7)
    return value - (1 << 64) if value >= 1 << 63 else value


def _pieces(batches, size: int = PIECE):
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _signatures(bands: int, rows: int):
    def keys(own: np.ndarray) -> list[int]:
        if not len(own):
            return []
        low = np.array([mixed(own, 1000 + k).min() for k in range(bands * rows)], np.uint64).reshape(bands, rows)
        return [xxhash.xxh64_intdigest(x.tobytes(), k) - (1 << 63) for k, x in enumerate(low)]

    def run(batches):
        for part in _pieces(batches):
            sets = [shingles(t) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["row_key"], pa.array([class_of(s) for s in sets], pa.int64()),
                 pa.array([keys(s) for s in sets], pa.list_(pa.int64()))], names=["id", "row_key", "fp", "keys"])

    return run


def _sets(bits: np.ndarray, log_bits: int):
    """Shingle sets of the rows whose key the bitmap may hold, each row of a batch once."""
    wanted = _maybe_twice(bits, log_bits)

    def run(batches):
        for batch in wanted(batches):
            _, first = np.unique(batch["key"].to_numpy(), return_index=True)
            for part in _pieces([batch.take(pa.array(np.sort(first)))]):
                sets = [shingles(t).tobytes() for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["key"], pa.array(sets, pa.binary())], names=["row_key", "shingles"])

    return run


def _similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= similarity * (len(a) + len(b) - shared)


def _edges(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _verified(similarity: float):
    """Pairs (a, b) whose sets are similar."""
    def run(batches):
        for part in _pieces(batches):
            pairs = zip(*(part[c].to_pylist() for c in ("a", "b", "set_a", "set_b")))
            yield _edges([(a, b) for a, b, x, y in pairs if _similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity)])

    return run


def _links(similarity: float):
    """Links between components in a block, as many as join them."""
    def run(batches):
        for rows, bounds in sorted_groups(_pieces(batches), ["key", "i", "j"]):
            names, known, out = rows["fp"].to_pylist(), rows["root"].to_numpy(), []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                sets = [np.frombuffer(x.as_py(), np.uint64) for x in rows["shingles"].slice(s, e - s)]
                size, root = np.array([len(x) for x in sets]), known[s:e].copy()
                for x in range(1, e - s):
                    fit = np.minimum(size[:x], size[x]) >= similarity * np.maximum(size[:x], size[x])
                    for y in np.flatnonzero(fit & (root[:x] != root[x])).tolist():
                        if root[x] != root[y] and _similar(sets[x], sets[y], similarity):
                            root[root == root[x]] = root[y]
                            out.append((names[s + x], names[s + y]))
            yield _edges(out)

    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, bands: int = 16, rows: int = 4,
           chunk: int = 256, candidates: DataFrame | None = None) -> DataFrame:
    """One row per document: id, ``row_key``, ``fp`` (class of its shingles), ``root``, ``component_id`` (smallest id of its near copies),
    ``chosen`` (the ``row_key`` that stays of them).

    ``candidates`` (``row_key``, ``key``) adds keys found by another method; classes that share one are compared like those of a band."""
    with small_batches(docs.sparkSession):
        return _groups(docs, id_col, text_col, similarity, bands, rows, chunk, candidates)


def _groups(docs: DataFrame, id_col: str, text_col: str, similarity: float, bands: int, rows: int, chunk: int,
            candidates: DataFrame | None) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "near-copies")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), text.cast("binary").alias("text"))
    own = scratch.save(texts.mapInArrow(
        _signatures(bands, rows), f"id {dict(texts.dtypes)['id']}, row_key long, fp long, keys array<long>"), "signatures")
    first = F.struct(F.col("id").isNull().alias("nameless"), "id", "row_key")
    classes = scratch.save(own.groupBy("fp").agg(F.min(first).alias("first"), F.first("keys").alias("keys")), "classes")
    keyed = classes.select("fp", F.explode("keys").alias("key"))
    if candidates is not None:
        others = own.where(F.size("keys") > 0).select("fp", "row_key").join(candidates.select("row_key", "key"), "row_key")
        keyed = scratch.save(keyed.unionByName(others.select("fp", "key").distinct()), "keyed")
    counts = scratch.save(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("low")).where("n > 1"), "counts")
    shared = scratch.save(keyed.join(counts, "key"), "shared")
    parties = classes.join(shared.select("fp").distinct(), "fp", "left_semi").select("fp", F.col("first.row_key").alias("row_key"))
    parties = scratch.save(parties, "parties")
    bits = _size(parties.count())
    made = texts.select(F.col("row_key").alias("key"), "text").mapInArrow(
        _sets(_bitmap(parties, "row_key", bits), bits), "row_key long, shingles binary")
    sets = scratch.save(made.join(parties, "row_key").dropDuplicates(["row_key"]).select("fp", "shingles"), "sets")

    pairs = shared.where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    pairs = pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("set_a")), "a")
    pairs = pairs.join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("set_b")), "b")
    edges = scratch.save(pairs.select("a", "b", "set_a", "set_b").mapInArrow(_verified(similarity), "a long, b long"), "first-links")
    known = component_roots(edges, scratch).withColumnRenamed("node", "fp")
    placed = scratch.save(shared.join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    # a set of classes that several keys share is looked at under one of them
    same = [F.bit_xor(F.xxhash64("fp", F.lit(k))).alias(f"same{k}") for k in (0, 1)]
    apart = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("from"), F.max("root").alias("to"), *same)
    apart = apart.where("`from` < `to`").groupBy("n", "same0", "same1").agg(F.min("key").alias("key"))
    apart = scratch.save(apart.select("key"), "apart")
    blocked = chunk_pairs(placed.join(apart, "key", "left_semi").drop("low"), F.xxhash64("fp"), chunk)
    blocked = blocked.select("key", "i", "j", "fp", "root").join(sets, "fp").select("key", "i", "j", "fp", "root", "shingles")
    blocked = blocked.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    later = scratch.save(blocked.mapInArrow(_links(similarity), "a long, b long"), "later-links")
    roots = component_roots(edges.unionByName(later), scratch).withColumnRenamed("node", "fp")
    members = classes.select("fp", "first").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = scratch.save(members.groupBy("root").agg(F.min("first").alias("first")), "lows")
    members = members.select("fp", "root").join(
        lows.select("root", F.col("first.id").alias("component_id"), F.col("first.row_key").alias("chosen")), "root")
    members = scratch.save(members, "members")
    return own.select("id", "row_key", "fp").join(members, "fp").withColumnRenamed("id", id_col)


def row_key(id_col: str, text_col: str) -> Column:
    """Name of a row by id and text; null and empty texts are alike."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def drop(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each group, with all its columns; of a group without any id one row."""
    found = groups(docs, id_col, text_col, **options)
    keep = found.where("row_key = chosen").select(F.col("row_key").alias("__row")).distinct()
    kept = docs.withColumn("__row", row_key(id_col, text_col)).join(keep, "__row", "left_semi")
    own = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    ranked = kept.withColumn("__copy", F.row_number().over(Window.partitionBy("__row").orderBy(F.xxhash64(*own))))
    return ranked.where("__copy = 1").drop("__row", "__copy")
