"""Periods between two consecutive valuations, and what happened in each.

A player's valuations and appearances are first brought to one row per day
(and value). After that a window over one player is bounded by the calendar,
whatever share of all rows that player has.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def consecutive_pairs(df: DataFrame, key: str = "player_id", ts: str = "date", value: str = "market_value_in_eur") -> DataFrame:
    """Pair every row with the next one of its key: ``t0, t1, v0, v1``.

    Order is by time, then value. Rows on the same day give periods of zero
    length. Steps: copies collapse to a count; the next value of the same day
    comes from a window over that day; the last value of a day takes the first
    value of the next day from a one-row-per-day table.
    """
    counted = df.groupBy(key, ts, value).agg(F.count(F.lit(1)).alias("n"))
    in_day = Window.partitionBy(key, ts).orderBy(value)
    rows = counted.withColumn("next_value", F.lead(value).over(in_day))

    over_days = Window.partitionBy(key).orderBy(ts)
    days = df.groupBy(key, ts).agg(F.min(value).alias("first_value")).select(
        key, ts,
        F.lead(ts).over(over_days).alias("next_day"),
        F.lead("first_value").over(over_days).alias("next_first"),
    )
    same_day = F.col("next_value").isNotNull()
    joined = rows.join(days, [key, ts]).withColumns({
        "t1": F.when(same_day, F.col(ts)).otherwise(F.col("next_day")),
        "v1": F.when(same_day, F.col("next_value")).otherwise(F.col("next_first")),
    })
    # n copies: n - 1 pairs of equal rows, and one pair with the next row.
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    last = F.col("copy") == F.col("n")
    return copies.select(
        key,
        F.col(ts).alias("t0"),
        F.when(last, F.col("t1")).otherwise(F.col(ts)).alias("t1"),
        F.col(value).alias("v0"),
        F.when(last, F.col("v1")).otherwise(F.col(value)).alias("v1"),
    ).filter(F.col("t1").isNotNull())


def interval_join(
    points: DataFrame,
    periods: DataFrame,
    sums: Mapping[str, str],
    count: str = "n_points",
    key: str = "player_id",
    ts: str = "date",
    empty_periods: bool = True,
) -> DataFrame:
    """Periods with the sums of the points in ``[t0, t1)``; zeros when empty.

    Periods of one key must not overlap. Points are summed per key and day and
    laid on one time line with the starts and ends of the periods. A running
    total over the line, taken at both ends of a period, gives its sums: linear
    in the input, with one shuffle, and no pair of point and period is formed.
    On one day an end comes first, then a start, then the points.

    Pass ``empty_periods=False`` when none has zero length: they may be many
    for one key, so they bypass the line in a branch of their own.
    """
    names = [count, *sums.values()]
    per_day = points.groupBy(key, ts).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(c).alias(out) for c, out in sums.items()]
    )
    end, start, point = 0, 1, 2
    columns = [c for c in periods.columns if c != key]
    marks = F.explode(F.array(
        F.struct(F.col("t0").alias("at"), F.lit(start).alias("kind"), F.struct(*columns).alias("period")),
        F.struct(F.col("t1").alias("at"), F.lit(end).alias("kind"), F.lit(None).alias("period")),
    ))
    line = periods.filter(F.col("t0") < F.col("t1")).select(key, marks.alias("m")).select(key, "m.*").unionByName(
        per_day.withColumnRenamed(ts, "at").withColumn("kind", F.lit(point)), allowMissingColumns=True
    )
    upwards = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    downwards = Window.partitionBy(key).orderBy(F.desc("at"), F.desc("kind")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    totals = F.struct(*[F.coalesce(F.sum(c).over(upwards), F.lit(0)).alias(c) for c in names])
    ends = line.select(key, "at", "kind", "period", totals.alias("total")).filter(F.col("kind") != point)
    next_end = F.last(F.when(F.col("kind") == end, F.col("total")), ignorenulls=True).over(downwards)
    filled = ends.withColumn("upto", next_end).filter(F.col("kind") == start).select(
        key, "period.*", *[(F.col(f"upto.{c}") - F.col(f"total.{c}")).alias(c) for c in names]
    )
    if not empty_periods:
        return filled
    empty = periods.filter(F.col("t0") == F.col("t1"))
    return filled.unionByName(empty.withColumns({c: F.lit(0).cast("bigint") for c in names}))


def overlap_join(
    points: DataFrame,
    periods: DataFrame,
    sums: Mapping[str, str],
    count: str = "n_points",
    key: str = "player_id",
    ts: str = "date",
    bin_days: int = 128,
) -> DataFrame:
    """Periods with the sums of the points in ``[t0, t1)``, where periods of a key may overlap.

    Time is cut into bins of ``bin_days``. Points are summed per key and day, the
    days of a bin, ``bin_days`` at most, are put together with their sum, and the
    bins of a key, bounded by the calendar, are one row. A period meets that row
    by an equi-join on the key and adds up the bins it touches: a bin wholly
    inside gives its sum, only the two at the ends compare days. No pair of
    period and day or bin is made, so each period is moved once; of a hot key
    the periods may be split over tasks, as one row answers all of them.
    """
    names = [count, *sums.values()]
    columns = periods.columns
    bin_of = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / bin_days)
    per_day = points.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, ts).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(c).alias(out) for c, out in sums.items()])
    types = {f.name: f.dataType for f in per_day.schema if f.name in names}
    nothing = F.struct(*[F.lit(0).cast(types[c]).alias(c) for c in names])

    def summed(items, of=lambda x: x):
        return F.aggregate(items, nothing, lambda acc, x: F.struct(*[
            (acc[c] + F.coalesce(of(x)[c], F.lit(0))).cast(types[c]).alias(c) for c in names]))

    day = F.struct(F.col(ts).alias("at"), *names)
    per_bin = per_day.repartition(key).groupBy(key, bin_of(F.col(ts)).alias("bin")).agg(F.collect_list(day).alias("days"))
    per_key = per_bin.withColumn("all", summed("days")).groupBy(key).agg(F.collect_list(F.struct("bin", "days", "all")).alias("_bins"))

    t0, t1 = F.col("t0"), F.col("t1")
    first_day = lambda b: F.date_from_unix_date((b * bin_days).cast("int"))
    touched = F.filter("_bins", lambda b: b["bin"].between(bin_of(t0), bin_of(F.date_sub(t1, 1))))
    met = summed(touched, lambda b: F.when((first_day(b["bin"]) >= t0) & (first_day(b["bin"] + 1) <= t1), b["all"]).otherwise(
        summed(F.filter(b["days"], lambda d: (d["at"] >= t0) & (d["at"] < t1)))))
    out = periods.join(per_key, key, "left").withColumn("_met", F.coalesce(met, nothing))
    return out.select(*columns, *[F.col(f"_met.{c}").alias(c) for c in names])
