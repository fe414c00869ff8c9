"""Log-structured tables: a load adds a generation, a reader resolves the newest one per key.

A store holds the tables of one resource, which share a key:

    rows/<table>/gen=N/bucket=B   rows that load N accepted
    keys/gen=N/bucket=B           keys that load N replaced or retracted
    commits/gen=N                 one row, written last: generation N counts from now on

A row is live unless a later generation names its key.  So a load writes what it
brings and nothing else, whatever the size of the target; a key that comes with
fewer children, or none, loses the others; and a load that was broken off leaves
only files that no commit covers, which the next attempt overwrites.  A commit
may carry the number of the batch it came from, which makes a repeated batch
recognisable.

Reading is an anti join of the rows with the keys of later generations.  Those of the
first generation and of compacted buckets are not even read, so a large target
with small increments is scanned without a shuffle (Spark broadcasts the keys when
they are few and sort-merges them otherwise).  ``compact`` rewrites the live rows of some
buckets into a generation of their own, apart from loads; the files below it are
no longer listed by readers (``obsolete``) and may go when no reader uses them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

COMMITS = "gen int, batch long, buckets array<int>, statistics string"
GEN, BUCKET = "_gen", "_bucket"


@dataclass(frozen=True)
class Store:
    """Tables (schemas by name) with one key column below ``root``."""

    spark: SparkSession
    root: str
    tables: dict[str, StructType]
    key: str
    buckets: int = 64

    # --- layout -----------------------------------------------------------------

    def _write(self, df: DataFrame, path: str, spread: bool = True) -> None:
        if spread:
            df = df.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
            # one file a bucket, more only where a bucket is large
            df = df.hint("rebalance", BUCKET)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(BUCKET) if spread else writer).parquet(path)

    def scan(self, folder: str, schema: StructType) -> DataFrame:
        """All rows below a folder with their generation and bucket, live or not."""
        fields = [*schema.fields, StructField(GEN, IntegerType()), StructField(BUCKET, IntegerType())]
        return self.spark.read.schema(StructType(fields)).parquet(f"{self.root}/{folder}")

    def create(self) -> Store:
        """Make an empty store; generation 0 has no rows."""
        key = self.tables[next(iter(self.tables))][self.key]
        for name, schema in self.tables.items():
            self._write(self.spark.createDataFrame([], schema), f"{self.root}/rows/{name}/{GEN}=0")
        self._write(self.spark.createDataFrame([], StructType([key])), f"{self.root}/keys/{GEN}=0")
        self.commit(0)
        return self

    # --- commits ----------------------------------------------------------------

    def commits(self) -> list[Row]:
        """All commits in order: one small row for each load or compaction."""
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits/*").orderBy("gen").collect()

    def commit(self, gen: int, batch: int | None = None, buckets: list[int] | None = None, statistics: str | None = None) -> None:
        row = self.spark.createDataFrame([(gen, batch, buckets, statistics)], COMMITS)
        self._write(row.coalesce(1), f"{self.root}/commits/gen={gen}", spread=False)

    # --- writing ----------------------------------------------------------------

    def write_rows(self, gen: int, table: str, df: DataFrame) -> None:
        self._write(df.select(*self.tables[table].fieldNames()), f"{self.root}/rows/{table}/{GEN}={gen}")

    def write_keys(self, gen: int, keys: DataFrame) -> None:
        self._write(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), f"{self.root}/keys/{GEN}={gen}")

    def written(self, gen: int, table: str) -> DataFrame:
        """Rows of one generation, committed or not."""
        return self.scan(f"rows/{table}", self.tables[table]).where(F.col(GEN) == gen).drop(GEN, BUCKET)

    # --- reading ----------------------------------------------------------------

    def _floors(self, commits: list[Row]) -> dict[int, int]:
        """Oldest generation of each bucket that still counts."""
        floors = dict.fromkeys(range(self.buckets), 1)
        for row in commits:
            floors.update(dict.fromkeys(row["buckets"] or [], row["gen"]))
        return floors

    def _floor(self, commits: list[Row]) -> Column:
        floors = self._floors(commits)
        if len(set(floors.values())) == 1:
            return F.lit(floors[0])
        return F.element_at(F.array(*[F.lit(floors[b]) for b in range(self.buckets)]), F.col(BUCKET) + 1)

    def _live(self, table: str, upto: int | None) -> DataFrame:
        commits = [c for c in self.commits() if upto is None or c["gen"] <= upto]
        newest, floor = commits[-1]["gen"], self._floor(commits)
        rows = self.scan(f"rows/{table}", self.tables[table]).where((F.col(GEN) <= newest) & (F.col(GEN) >= floor))
        keys = self.scan("keys", StructType([self.tables[table][self.key]])).where((F.col(GEN) <= newest) & (F.col(GEN) > floor))
        later = keys.groupBy(F.col(self.key).alias("_key")).agg(F.max(GEN).alias("_later"))
        return rows.join(later, (F.col(self.key) == F.col("_key")) & (F.col(GEN) < F.col("_later")), "left_anti")

    def read(self, table: str, upto: int | None = None) -> DataFrame:
        """Live rows of a table, as of generation ``upto`` (None: the newest)."""
        return self._live(table, upto).drop(GEN, BUCKET)

    def read_all(self, upto: int | None = None) -> dict[str, DataFrame]:
        return {name: self.read(name, upto) for name in self.tables}

    # --- compaction ---------------------------------------------------------------

    def compact(self, buckets: list[int] | None = None) -> int:
        """Rewrite the live rows of some buckets (None: all) as one generation; returns its number."""
        chosen = sorted(set(range(self.buckets) if buckets is None else buckets))
        gen = self.commits()[-1]["gen"] + 1
        for name in self.tables:
            live = self._live(name, None).where(F.col(BUCKET).isin(chosen)).drop(GEN, BUCKET)
            self.write_rows(gen, name, live)
        self.commit(gen, buckets=chosen)
        return gen

    def obsolete(self) -> list[tuple[int, int]]:
        """(generation, bucket) pairs whose files no reader of the newest state needs."""
        return [(gen, bucket) for bucket, floor in sorted(self._floors(self.commits()).items()) for gen in range(1, floor)]
