"""Helpers shared by the operators: written stages, grouped streams, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import shared_folder

SPACE = r"[^\x20\x09-\x0D]+"


class Scratch:
    """A fresh folder in the shared checkpoint folder, holding written stages.

    Reading a stage back cuts the lineage: a lost executor costs a re-read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def save(self, df: DataFrame, name: str = "stage") -> DataFrame:
        """Write a frame and read it back."""
        path = f"{self.path}/{self.count:02d}-{name}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Hand rows that hold whole texts or sets to Python in batches of at most ``rows``.

    A batch is held several times: in the JVM's buffers and by every Python worker.
    """
    before = spark.conf.get(BATCH_ROWS)
    held = int(before)
    spark.conf.set(BATCH_ROWS, str(min(held, rows) if held > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(column: str, n: int) -> Column:
    """crc32(id as text) mod n; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def component_roots(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of an undirected edge list (a, b) of longs.

    Rounds of contraction: a node points to the smallest of itself and its
    neighbours, one pointer jump follows, and edges are renamed and made
    distinct, until none is left.  Hubs cost nothing special: the minimum is
    combined before the shuffle, and the joins read written tables, which Spark
    may broadcast when small or split when skewed.  Nothing is collected.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    left = scratch.save(ordered.distinct(), "edges")
    maps = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        parent = scratch.save(parent.select("node", F.least("node", "low").alias("up")), "parents")
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("root"))
        jumped = scratch.save(parent.join(above, "up").select("node", "root"), "jumped")
        maps.append(jumped)
        for_a = jumped.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        for_b = jumped.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        renamed = left.join(for_a, "a").join(for_b, "b").where("root_a <> root_b")
        left = scratch.save(
            renamed.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "edges"
        )
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = maps.pop()
    while maps:
        later = labels.select(F.col("node").alias("root"), F.col("root").alias("later"))
        labels = maps.pop().join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return scratch.save(labels, "roots")


def chunk_pairs(rows: DataFrame, spread: Column, size: int) -> DataFrame:
    """Split groups of ``n`` rows (a column of ``rows``) into bounded blocks.

    A group of m chunks becomes blocks (i, j), i < j, that hold chunks i and j
    together, so every pair of a hot group meets in some block although no task
    holds the group; a group of one chunk is the block (0, 0).  Adds ``i``,
    ``j`` and the row's own chunk ``c``.
    """
    m = F.ceil(F.col("n") / size).cast("int")
    rows = rows.withColumn("m", m).withColumn("c", F.pmod(spread, F.col("m")).cast("int"))
    others = F.expr("CASE WHEN m = 1 THEN array(0) ELSE filter(sequence(0, m - 1), x -> x <> c) END")
    rows = rows.withColumn("other", F.explode(others))
    return rows.select(
        *[x for x in rows.columns if x not in ("m", "n", "other")],
        F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"),
    )


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a stream sorted by integer ``keys``.

    Yields (rows, bounds) with bounds[k]:bounds[k + 1] a group; only an
    unfinished last group is carried from batch to batch.
    """
    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        starts = _starts(table, keys)
        last = starts[-1]
        if last:
            yield table.slice(0, last).combine_chunks(), starts
        carry = table.slice(last)
    if carry is not None and carry.num_rows:
        yield carry.combine_chunks(), np.array([0, carry.num_rows])


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def smallest_labels(n: int, near, rows: int = 1024) -> np.ndarray:
    """Connected components of n local items: label = smallest member index.

    ``near(lo, hi)`` gives the boolean rows lo:hi of the adjacency matrix, so
    that memory is bounded by ``rows`` * n.
    """
    label = np.arange(n)
    while True:
        before = label.copy()
        for lo in range(0, n, rows):
            hi = min(n, lo + rows)
            found = np.where(near(lo, hi), label[None, :], n).min(axis=1)
            label[lo:hi] = np.minimum(label[lo:hi], found)
        np.minimum.at(label, before, label)  # the old root follows its members
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            return label
