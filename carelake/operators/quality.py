"""Data-quality profiles, load statistics, schema checks and freshness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, NULLs and NULL rate per column, from a single pass."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)]
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("null_count")) for i, c in enumerate(columns)
    ])
    rate = F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows"))
    return counts.select("rows", F.inline(pairs)).select("column_name", "rows", "null_count", rate.alias("null_rate"))


def load_statistics(live: DataFrame, past_mark: DataFrame, newest: DataFrame, retracted: DataFrame | None,
                    classified: DataFrame, children: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row: what each step of a load took out, and what it made of the rest.

    ``live`` are the source rows without deleted ids, ``past_mark`` those the
    high-water mark lets through, ``newest`` their newest versions, ``retracted``
    the ids set aside as entered in error, ``classified`` the valid ones with their
    ``version_action``.  ``expansion_ratio`` is rows in all tables per valid row.
    """

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    actions = classified.agg(
        F.count("*").alias("valid"),
        *[F.count_if(F.col("version_action") == a).alias(a) for a in ("new", "updated", "unversioned", "skipped")],
    )
    child_counts = [df.agg(F.count("*").alias("rows")) for df in (children or {}).values()]
    total = F.lit(0).cast("long")
    if child_counts:
        total = reduce(lambda a, b: a.unionByName(b), child_counts).agg(F.sum("rows")).scalar()
    wrong = F.lit(0).cast("long") if retracted is None else rows(retracted, "n").scalar()
    out = actions.select(
        "*", rows(live, "n").scalar().alias("source_rows"), rows(past_mark, "n").scalar().alias("past_mark"),
        rows(newest, "n").scalar().alias("distinct_rows"), wrong.alias("retracted"), total.alias("child_rows"))
    return out.select(
        "source_rows", (F.col("source_rows") - F.col("past_mark")).alias("behind_mark"), "distinct_rows",
        (F.col("past_mark") - F.col("distinct_rows")).alias("duplicates_removed"), "retracted",
        (F.col("distinct_rows") - F.col("retracted") - F.col("valid")).alias("invalid"),
        (F.col("valid") - F.col("skipped")).alias("kept"), "new", "updated", "unversioned", "skipped", "child_rows",
        ((F.col("valid") + F.col("child_rows")) / F.nullif(F.col("valid"), F.lit(0))).alias("expansion_ratio"),
    )


def coding_coverage(df: DataFrame, concept: Column) -> DataFrame:
    """How many rows have the concept, a coding array, and a non-empty one."""
    coding = concept["coding"]
    return df.agg(
        F.count("*").alias("total"),
        F.count(concept).alias("code_not_null"),
        F.count(coding).alias("coding_not_null"),
        F.count_if(F.size(coding) > 0).alias("coding_has_elements"),
    )


def codes_per_entity(codes: DataFrame, key: str) -> DataFrame:
    """How many entities have how many codes."""
    per_entity = codes.groupBy(key).agg(F.count("*").alias("code_count"))
    return per_entity.groupBy("code_count").agg(F.count("*").alias("entities"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness(marts: dict[str, DataFrame], updated: str = "etl_updated_at") -> DataFrame:
    """Row count and newest update of every mart."""
    parts = []
    for name, df in marts.items():
        newest = F.max(updated) if updated in df.columns else F.lit(None).cast("timestamp")
        parts.append(df.agg(F.count("*").alias("rows"), newest.alias("last_updated")).select(
            F.lit(name).alias("mart"), "rows", "last_updated"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- schemas --------------------------------------------------------------


def schema_drift(spark: SparkSession, expected: StructType, actual: StructType) -> DataFrame:
    """Every column of either side with its types and ``match``, ``type_differs``,
    ``missing`` or ``unexpected``."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}

    def status(name: str) -> str:
        if name not in have:
            return "missing"
        if name not in want:
            return "unexpected"
        return "match" if want[name] == have[name] else "type_differs"

    rows = [(n, want.get(n), have.get(n), status(n)) for n in dict.fromkeys([*want, *have])]
    return spark.createDataFrame(rows, "column_name string, expected_type string, actual_type string, status string")


def schema_report(df: DataFrame, expected: StructType) -> DataFrame:
    """Schema drift of a live table with the filled values of each column."""
    drift = schema_drift(df.sparkSession, expected, df.schema)
    profile = null_profile(df, df.columns).select(
        "column_name", (F.col("rows") - F.col("null_count")).alias("filled_rows")
    )
    return drift.join(profile, "column_name", "left")


def missing_tables(spark: SparkSession, expected: list[str], database: str = "default") -> list[str]:
    """Expected catalog tables that do not exist."""
    return [t for t in expected if not spark.catalog.tableExists(f"{database}.{t}")]


def require_tables(spark: SparkSession, expected: list[str], database: str = "default") -> None:
    missing = missing_tables(spark, expected, database)
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")
