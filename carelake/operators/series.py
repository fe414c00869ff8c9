"""Ordered series per key, laid out so that one very long series still spreads.

A window over a whole key would put all rows of a hot key in one task.  Here
rows are windowed inside (key, hour), and what earlier or later hours contribute
comes from an hourly summary, whose windows hold at most one row per hour of the
calendar and key.  Results equal those of the plain window, for the NULL key as well.
Where rows without a time are ordered by a tie alone, those of one key share a slot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions import codes

KEY, SLOT, SHARE = "_key", "_slot", "_share"
SHARES = 64
OLDEST, NEWEST = "0001-01-01 00:00:00", "9999-12-31 23:00:00"


def _with_slot(df: DataFrame, key: str, ts: str, unknown: str, unit: str = "hour") -> DataFrame:
    """Add the key as a struct and the slot of a row; rows with no time get the ``unknown`` slot."""
    slot = F.coalesce(F.date_trunc(unit, F.col(ts)), F.lit(unknown).cast("timestamp"))
    return df.withColumns({KEY: F.struct(key), SLOT: slot})


def _attach(df: DataFrame, summary: DataFrame, *more: str) -> DataFrame:
    """Join a per-(key, slot) summary on the partitioning the rows already have.

    The join compares the key wrapped in a struct, which is equal to itself also
    when the key is NULL, and keeps that partitioning.  The summary is spread by
    (key, slot) explicitly: its own window left it clustered by key alone, and the
    rows must not follow it there.
    """
    by = (KEY, SLOT, *more)
    summary = summary.withColumnsRenamed({c: f"{c}_of" for c in by}).repartition(*[f"{c}_of" for c in by])
    same = reduce(Column.__and__, [F.col(c) == F.col(f"{c}_of") for c in by])
    return df.join(summary, same, "left").drop(*by, *[f"{c}_of" for c in by])


def recency_rank(df: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    """``rank()`` per key, newest first, rows without time before all others."""
    own = df.columns
    df = _with_slot(df, key, ts, NEWEST)
    # Rows without a time are peers, so they need not meet: they are dealt into shares.
    df = df.withColumn(SHARE, F.when(F.col(ts).isNull(), F.pmod(F.xxhash64(*own), F.lit(SHARES))).otherwise(0))
    inside = F.rank().over(Window.partitionBy(KEY, SLOT, SHARE).orderBy(F.col(ts).desc_nulls_first()))
    newer = Window.partitionBy(KEY).orderBy(F.unix_seconds(SLOT).desc()).rangeBetween(Window.unboundedPreceding, -1)
    offset = (
        df.groupBy(KEY, SLOT, SHARE).agg(F.count("*").alias("_rows"))
        .select(KEY, SLOT, SHARE, F.coalesce(F.sum("_rows").over(newer), F.lit(0)).alias("_newer"))
    )
    out = _attach(df.withColumn("_inside", inside), offset, SHARE)
    return out.withColumn(name, (F.col("_inside") + F.col("_newer")).cast("int")).drop("_inside", "_newer")


def previous_row(df: DataFrame, key: str, ts: str, tie: str, carry: dict[str, str]) -> DataFrame:
    """Columns of the preceding row of the key: ``lag`` over (ts, tie).

    ``carry`` maps source columns to the names of the lagged columns.
    """
    df = _with_slot(df, key, ts, OLDEST)
    values = F.struct(*[F.col(c).alias(n) for c, n in carry.items()])
    order = F.struct(F.col(ts), F.col(tie))
    inside = Window.partitionBy(KEY, SLOT).orderBy(F.col(ts).asc_nulls_first(), F.col(tie))
    by_slot = Window.partitionBy(KEY).orderBy(F.col(SLOT))
    last = (
        df.groupBy(KEY, SLOT).agg(F.max_by(values, order).alias("_last"))
        .select(KEY, SLOT, F.lag("_last").over(by_slot).alias("_before"))
    )
    df = df.withColumns({"_lag": F.lag(values).over(inside), "_nth": F.row_number().over(inside)})
    out = _attach(df, last)
    previous = F.when(F.col("_nth") > 1, F.col("_lag")).otherwise(F.col("_before"))
    return out.withColumns({n: previous[n] for n in carry.values()}).drop("_lag", "_nth", "_before")


def running_low(df: DataFrame, key: str, ts: str, tie: str, value: str, name: str) -> DataFrame:
    """Lowest value among the preceding rows of the key."""
    df = _with_slot(df, key, ts, OLDEST)
    inside = (
        Window.partitionBy(KEY, SLOT).orderBy(F.col(ts).asc_nulls_first(), F.col(tie))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.partitionBy(KEY).orderBy(F.col(SLOT)).rowsBetween(Window.unboundedPreceding, -1)
    lows = (
        df.groupBy(KEY, SLOT).agg(F.min(value).alias("_low"))
        .select(KEY, SLOT, F.min("_low").over(earlier).alias("_earlier"))
    )
    out = _attach(df.withColumn("_inside", F.min(value).over(inside)), lows)
    return out.withColumn(name, F.least("_inside", "_earlier")).drop("_inside", "_earlier")


def later_high(df: DataFrame, key: str, ts: str, value: str, days: int, name: str) -> DataFrame:
    """Highest value of the key dated at least ``days`` later."""
    df = _with_slot(df, key, ts, OLDEST, "day")
    later = (
        Window.partitionBy(KEY).orderBy("_number").rangeBetween(days, Window.unboundedFollowing)
    )
    highs = (
        df.filter(F.col(ts).isNotNull()).groupBy(KEY, SLOT).agg(F.max(value).alias("_high"))
        .withColumn("_number", F.unix_date(F.col(SLOT).cast("date")))
        .select(KEY, SLOT, F.max("_high").over(later).alias(name))
    )
    return _attach(df, highs).withColumn(name, F.when(F.col(ts).isNotNull(), F.col(name)))


# --- laboratory series ----------------------------------------------------------


def trend(df: DataFrame, key: str = "patient_id", ts: str = "effective_datetime",
          value: str = "value_quantity_value", tie: str = "observation_id") -> DataFrame:
    """Previous value, previous time and day gap of every measurement."""
    out = previous_row(df, key, ts, tie, {value: "previous_value", ts: "previous_datetime"})
    return out.withColumn("days_between", F.datediff(F.col(ts), F.col("previous_datetime")))


def doubling_time(df: DataFrame, value: str = "value_quantity_value", **columns) -> DataFrame:
    """Days to double between consecutive measurements, and the risk flag.

    Set only where both values are positive, the value rises and a day or more
    lies between them.
    """
    out = trend(df, value=value, **columns)
    old, new = F.col("previous_value").cast("double"), F.col(value).cast("double")
    rises = (old > 0) & (new > old) & (F.col("days_between") > 0)
    days = F.when(rises, F.ln(F.lit(2.0)) * F.col("days_between") / F.ln(new / old))
    return out.withColumn("doubling_days", days).withColumn(
        "is_high_risk", F.col("doubling_days") < codes.DOUBLING_RISK_MONTHS * 365.25 / 12
    )


def progression(df: DataFrame, key: str = "patient_id", ts: str = "effective_datetime",
                value: str = "value_quantity_value", tie: str = "observation_id") -> DataFrame:
    """Rise over the nadir so far, and whether a later value confirms it.

    A rise is at least 25 % and more than 2.0 above the nadir of all earlier
    values; it is confirmed when a value dated 21 or more days later also is.
    """
    out = running_low(df.filter(F.col(value).isNotNull()), key, ts, tie, value, "nadir")
    out = later_high(out, key, ts, value, codes.CONFIRM_DAYS, "later_high")

    def above(x: Column) -> Column:
        ratio, rise = F.lit(codes.PROGRESSION_RATIO).cast("double"), F.lit(codes.PROGRESSION_RISE).cast("double")
        nadir, x = F.col("nadir").cast("double"), x.cast("double")
        return (x >= nadir * ratio) & (x - nadir > rise)

    out = out.withColumn("is_rise", F.coalesce(above(F.col(value)), F.lit(False)))
    confirmed = F.col("is_rise") & F.coalesce(above(F.col("later_high")), F.lit(False))
    return out.withColumn("is_confirmed", confirmed)


def threshold_status(value: Column, unit: Column) -> Column:
    """``Castrate`` below the limit of the unit, else ``Non-Castrate``."""
    low = F.lit(False)
    for name, limit in codes.CASTRATE_LIMITS.items():
        low = low | ((unit == name) & (value < F.lit(limit).cast("decimal(15,4)")))
    return F.when(low, F.lit("Castrate")).otherwise(F.lit("Non-Castrate"))
