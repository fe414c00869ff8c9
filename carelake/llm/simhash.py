"""Near-duplicate groups of documents by SimHash and pigeonhole blocks.

A document is lower-cased (A-Z), cut into words at ASCII white space and into
shingles of ``width`` words (fewer words: the whole sequence; none: fingerprint
zero).  A fingerprint bit is set when it is set in over half of the XXH64 hashes
(seed 42) of the shingles, repeats included.

Fingerprints are split into ``blocks`` blocks.  Two that differ in at most
``distance`` bits agree on at least ``blocks - distance`` whole blocks, so each
choice of that many blocks is a join key.  Rows that share a key are verified by
Hamming distance.  Exact copies are one row before that; a group that is hot all
the same is cut into bounded blocks that meet pairwise, and each block reports a
spanning forest (fewer edges than rows), never its pairs.  ``blocks`` trades
replication for selectivity: 7 gives 35 keys of about 27 bits, 8 gives 70 of 32.

Defined results: null and empty texts have fingerprint zero and link like any
other; rows with a null id belong to their group but never name it (component
null if the group has no id); repeated rows come back as often as they came.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, chunk_pairs, component_roots, small_batches, smallest_labels, sorted_groups

PIECE = 1 << 16


def fingerprint_of(text: bytes | None, width: int = 4) -> int:
    """Unsigned 64-bit fingerprint of one text, in bounded memory beside the text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        spans = zip(starts[at:at + PIECE].tolist(), ends[at:at + PIECE].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = 4) -> Column:
    """Fingerprint column (long; the same 64 bits, signed)."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint_of(t, width) for t in texts], np.uint64)
        return pd.Series(prints.view(np.int64))

    return run(F.coalesce(text, F.lit("")).cast("binary"))


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks (signed longs) of the choices of blocks on which close pairs agree."""
    bounds = np.linspace(0, 64, blocks + 1).astype(int)
    masks = [sum(1 << b for b in range(bounds[k], bounds[k + 1])) for k in range(blocks)]
    sums = [sum(choice) for choice in combinations(masks, blocks - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in sums]


def _forest(distance: int):
    def run(batches):
        for rows, bounds in sorted_groups(batches, ["key", "i", "j"]):
            prints = rows["fp"].to_numpy().view(np.uint64)
            sizes = np.diff(np.append(bounds, rows.num_rows)) if bounds[-1] < rows.num_rows else np.diff(bounds)
            starts = bounds[: len(sizes)]
            two = starts[sizes == 2]
            close = np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance
            a, b = [prints[two][close]], [prints[two + 1][close]]
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
                own = prints[start:start + size]
                label = smallest_labels(
                    size, lambda lo, hi, own=own: np.bitwise_count(own[lo:hi, None] ^ own[None, :]) <= distance
                )
                moved = label != np.arange(size)
                a.append(own[moved])
                b.append(own[label[moved]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    return run


def linked_prints(prints: DataFrame, scratch: Scratch, distance: int = 4, blocks: int = 7, chunk: int = 4096) -> DataFrame:
    """Edges (a, b) that connect the distinct ``fp`` values exactly as the links within ``distance`` bits do."""
    masks = block_masks(blocks, distance)
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(keys).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(scratch.save(counts, "counts"), "key")
    blocked = chunk_pairs(shared, F.xxhash64("fp"), chunk).select("key", "i", "j", "fp")
    ordered = blocked.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(_forest(distance), "a long, b long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, width: int = 4,
           blocks: int = 7) -> DataFrame:
    """One row per document: id, ``fingerprint`` (hex), ``component_id``, ``root`` (a fingerprint naming the group)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    with small_batches(docs.sparkSession):
        own = scratch.save(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), width).alias("fp")), "prints")
    prints = scratch.save(own.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    edges = linked_prints(prints, scratch, distance, blocks)
    roots = component_roots(edges, scratch).withColumnRenamed("node", "fp")
    classes = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = scratch.save(classes.select("fp", "root").join(scratch.save(lows, "lows"), "root"), "members")
    return own.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Repeated rows of that id count as copies: one stays.  Of a group without any
    id one row stays.
    """
    found = groups(docs, id_col, text_col, **options)
    keep = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col)).distinct()
    named = docs.join(keep, id_col, "left_semi").dropDuplicates([id_col])
    roots = found.where(F.col("component_id").isNull()).select(F.col("root").alias("__root"), F.conv("fingerprint", 16, -10).cast("long").alias("__fp"))
    nameless = docs.where(F.col(id_col).isNull()).withColumn("__fp", fingerprint(F.col(text_col), options.get("width", 4)))
    nameless = nameless.join(roots.distinct(), "__fp")
    return named.unionByName(nameless.dropDuplicates(["__root"]).select(*docs.columns))
