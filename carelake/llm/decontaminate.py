"""Benchmark decontamination by size-partitioned MinHash containment search.

Texts are lower-cased, cut into words (runs of letters, digits and characters
beyond ASCII) and into shingles of ``width`` words (fewer words: the whole
sequence).  A benchmark item is in a document if at least ``threshold`` of its
distinct shingles are.  An item of fewer words is looked for at its own length: documents
also have the shingles of each length below ``width`` that an item has.

Documents are partitioned by size (powers of two of their shingles).  The MinHash
sketch of a document is one minimum per bin of the hash range, with ``bins`` bins
per shingle of the partition's upper bound, so a short item keeps its chance to
match however long the document is: a shared shingle survives with probability
over 1 - 1 / bins.  An item has one sketch per partition; a shared minimum makes
a candidate.  Items of under four shingles, for which that leaves a chance to be
missed, are candidates by any shared shingle.  Candidates are verified on the
shingles' texts, so results are exact.

Only minima that can be an item's reach the shuffle: a bitmap of the items'
hashes (a literal of at most 2^23 bits, whatever the input) is tested inside the
scan.  It has no false negatives; beyond about a million benchmark shingles it
lets more through, which the joins then drop.

Defined results: null and empty texts hold no shingle and match nothing; an item of
fewer than ``width`` words is one shingle, its whole sequence; repeated rows and repeated items are reported once per pair of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SMALL = 4
MOST_BITS = 23


def _shingles(df: DataFrame, text: Column, width: int) -> DataFrame:
    """Add ``words``, ``n`` (shingles) and their ``hashes``, repeats included."""
    df = df.withColumn("words", F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)))
    df = df.withColumn("n", F.when(F.size("words") > 0, F.greatest(F.size("words") - (width - 1), F.lit(1))).otherwise(0))
    starts = F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n"))).otherwise(F.array().cast("array<int>"))
    return df.withColumn("hashes", F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, width))))


def _partition(n: Column, bins: int) -> Column:
    """log2 of the bins of a size partition."""
    return F.least(F.ceil(F.log2(F.greatest(n, F.lit(1)))) + (bins - 1).bit_length(), F.lit(40)).cast("int")


def _bin(value: Column, log_bins: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, F.lit(64) - log_bins)


def _bitmap(hashes: DataFrame, log_bits: int) -> Column:
    """Literal array of longs with the bits of all hashes set; its 2^(log_bits - 6) slots pass the driver."""
    at = F.shiftrightunsigned("h", 64 - log_bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    slots = hashes.groupBy(F.shiftright(at, 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).collect()
    values = ["0"] * (1 << (log_bits - 6))
    for row in slots:
        values[row["slot"]] = str(row["bits"])
    return F.split(F.lit(",".join(values)), ",").cast("array<bigint>")


def _may_hit(h: Column, bitmap: Column, log_bits: int) -> Column:
    at = F.shiftrightunsigned(h, 64 - log_bits)
    return F.call_function("bit_get", F.get(bitmap, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", width: int = 5, threshold: float = 0.8, bins: int = 64) -> DataFrame:
    """Pairs (document id, item id) with ``shared``, ``item_shingles``, ``containment`` and ``row_key`` of the document row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    own = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text"))
    own = _shingles(own.withColumn("item", F.xxhash64("item_id", "item_text")), F.col("item_text"), width)
    own = own.select("item", "item_id", F.explode(F.arrays_zip(
        F.transform("hashes", lambda h, i: F.array_join(F.slice("words", i + 1, width), " ")).alias("shingle"),
        F.col("hashes").alias("h"))).alias("x")).select("item", "item_id", "x.shingle", "x.h").distinct()
    own = scratch.save(own, "items")
    sizes = scratch.save(own.groupBy("item", "item_id").agg(F.count("*").alias("item_shingles")), "item_sizes")
    log_bits = min(MOST_BITS, max(10, own.count().bit_length() + 8))
    length = F.size(F.split("shingle", " "))
    short = sorted(r["m"] for r in own.select(length.alias("m")).where(F.col("m") < width).distinct().collect())  # width - 1 at most
    hashes = own.select("h").distinct()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _shingles(rows.withColumn("row_key", F.xxhash64("id", "text")), F.col("text"), width)
    rows = rows.withColumn("log_bins", _partition(F.col("n"), bins)).withColumn("ordered", F.sort_array("hashes"))
    bitmap = _bitmap(hashes, log_bits)

    def is_minimum(x: Column, i: Column) -> Column:
        before = F.get("ordered", i - 1)
        first = (i == 0) | (_bin(x, F.col("log_bins")) != _bin(before, F.col("log_bins")))
        return _may_hit(x, bitmap, log_bits) & first

    starts = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.array().cast("array<int>"))
    hit = F.filter(starts, lambda i: _may_hit(F.get("hashes", i), bitmap, log_bits))

    def texts(starts: Column, m: int) -> Column:
        return F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, m), " "))

    def hits_of(m: int) -> Column:
        places = F.when(F.size("words") >= m, F.sequence(F.lit(0), F.size("words") - m)).otherwise(F.array().cast("array<int>"))
        return texts(F.filter(places, lambda i: _may_hit(F.xxhash64(F.slice("words", i + 1, m)), bitmap, log_bits)), m)

    hits = [texts(hit, width), *map(hits_of, short)]
    rows = rows.select(
        "id", "row_key", "log_bins", F.filter("ordered", is_minimum).alias("minima"), F.array_distinct(F.concat(*hits)).alias("hits"))
    # written before it is filtered: a filter would be pushed below the projections and repeat them per element
    rows = scratch.save(rows, "sketches")
    rows = scratch.save(rows.where(F.size("hits") > 0).dropDuplicates(["row_key"]), "documents")

    each = own.withColumn("log_bins", F.explode(F.sequence(_partition(F.lit(1), bins), F.lit(40))))
    minima = each.groupBy("item", "log_bins", _bin(F.col("h"), F.col("log_bins")).alias("bin")).agg(F.min("h").alias("h"))
    minima = scratch.save(minima.select("item", "log_bins", "h"), "item_minima")
    by_sketch = rows.select("row_key", "log_bins", F.explode("minima").alias("h")).join(minima, ["log_bins", "h"])
    found = rows.select("row_key", F.explode("hits").alias("shingle"))
    small = scratch.save(own.join(sizes.where(F.col("item_shingles") < SMALL), "item").select("item", "shingle"), "small_items")
    candidates = by_sketch.select("row_key", "item").unionByName(found.join(small, "shingle").select("row_key", "item"))
    candidates = scratch.save(candidates.distinct(), "candidates")

    shared = found.join(candidates, "row_key").join(own.select("item", "shingle"), ["item", "shingle"])
    shared = shared.groupBy("row_key", "item").agg(F.count("*").alias("shared"))
    shared = scratch.save(shared.join(sizes, "item").where(F.col("shared") >= F.col("item_shingles") * threshold), "verified")
    return shared.join(rows.select("row_key", "id"), "row_key").select(
        F.col("id").alias(id_col), F.col("item_id").alias(item_col), "shared", "item_shingles",
        (F.col("shared") / F.col("item_shingles")).alias("containment"), "row_key",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that hold no benchmark item, with all their columns."""
    leaks = find(docs, items, id_col, text_col, **options).select("row_key").distinct()
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.join(leaks.withColumnRenamed("row_key", "__leak"), key == F.col("__leak"), "left_anti")
