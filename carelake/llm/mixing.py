"""Mixing sources to target weights with hash-threshold histograms.

The size of a document is its number of words (null text: 0).  Sources in code
point order, null last, weigh 1, 2, 3, repeating (or by ``weights``), and share
the size of all; a target stops at ``most`` times the size of its source, and
the excess is shared again by weight until no target is above.

A target is whole copies of the source plus a rest.  For the rest each document
has a hash of its id; sizes are summed by source and hash bucket, the bucket in
which the rest runs out is found, and only that bucket is summed again in finer
buckets, until one hash value is left.  Documents below the cut are taken once
more; the value at the cut is taken if that comes nearer to the target.  Nothing
is sorted: each level is one sum combined before its shuffle, whose result has at
most 2048 rows a source.

Defined results: documents that repeat an id share its hash and are taken or left
together; a null id hashes like an empty one; no documents, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import SPACE, Scratch

BITS = (10, 11, 11)


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE)).cast("long")


def hash_value(column: str, seed: int) -> Column:
    """32-bit hash of an id, the same in any engine: first digits of md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``target`` to one row per source (``no_source``, ``src``, ``source_size``).

    Sources are few beside documents: the windows over all of them hold one row
    each.  Taken by ``most * size / weight``, a source is capped exactly if its
    cap is below its share of what the sources before it leave.
    """
    order = Window.orderBy("no_source", "src")
    rank = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), rank.cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * most)
    rows = rows.withColumn("turn", F.col("cap").cast("double") / F.col("weight"))
    before = Window.orderBy("turn", "no_source", "src").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("left_size", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    rows = rows.withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("capped", F.col("turn") < F.col("left_size").cast("double") / F.col("left_weight"))
    free_size = F.sum("source_size").over(every) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every)
    free_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    share = free_size.cast("double") * F.col("weight") / F.nullif(free_weight, F.lit(0))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return rows.withColumn("target", target).select("no_source", "src", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = 3,
        weights: tuple[int, ...] = (1, 2, 3), seed: int = 0) -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``."""
    scratch = Scratch(docs.sparkSession, "mix")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"), words(F.col(text_col)).alias("size"),
        hash_value(id_col, seed).alias("u"),
    )
    rows = scratch.save(rows, "sizes")
    key = ["no_source", "src"]
    sizes = rows.groupBy(*key).agg(F.sum("size").alias("source_size"))
    plan = targets(scratch.save(sizes, "sources"), most, weights)
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    plan = plan.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = scratch.save(plan, "targets")

    cut, done, width = plan.select(*key, "rest", F.lit(0).cast("long").alias("prefix")), 0, sum(BITS)
    for bits in BITS:
        shift = width - done - bits
        inside = rows.join(cut.select(*key, "prefix"), key).where(F.shiftright("u", width - done) == F.col("prefix")) if done else rows
        sums = inside.groupBy(*key, F.shiftright("u", shift).alias("bucket")).agg(F.sum("size").alias("size"))
        upto = Window.partitionBy(*key).orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("size").over(upto)).join(cut.select(*key, "rest"), key).where("upto > rest")
        first = sums.groupBy(*key).agg(F.min_by(F.struct("bucket", "size", "upto", "rest"), "bucket").alias("x"))
        cut = first.select(*key, F.col("x.bucket").alias("prefix"), F.col("x.size").alias("size"),
                           (F.col("x.rest") - (F.col("x.upto") - F.col("x.size"))).alias("rest"))
        cut = scratch.save(cut, "cut")
        done += bits
    # rest: what is left below the value at the cut; size: what that value holds
    cut = cut.select(*key, F.col("prefix").alias("value"), (F.col("size") - F.col("rest") < F.col("rest")).alias("with_value"))
    plan = scratch.save(plan.join(cut, key, "left"), "plan")
    below = (F.col("u") < F.col("value")) | ((F.col("u") == F.col("value")) & F.col("with_value"))
    copies = F.least(F.col("whole") + F.coalesce(below, F.lit(True)).cast("long"), F.lit(most)).cast("long")
    return rows.join(plan, key).withColumn("copies", copies).select(
        F.col("id").alias(id_col), F.when(~F.col("no_source"), F.col("src")).alias(source_col), "size", "source_size", "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def take(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns.

    Rows are told apart by id and source; those that repeat both are taken alike.
    """
    taken = mix(docs, id_col, source_col=source_col, **options).select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("copies").alias("__copies"))
    taken = taken.where("__copies > 0").distinct()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).cast("string").eqNullSafe(F.col("__source"))
    return docs.join(taken, same).withColumn("__copy", F.explode(F.expr("sequence(1L, __copies)"))).select(*docs.columns)
