"""Counts, profiles, quantiles and tests."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.functions.columns import col
from touchline.session import cut_lineage


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value, and the share with one."""
    n, known = F.count(F.lit(1)), F.count(column)
    return df.agg(
        known.alias("matched"), (n - known).alias("unmatched"), n.alias("total"),
        F.round(known * F.lit(100.0) / F.nullif(n, F.lit(0)), 1).alias("matched_pct"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def profile(df: DataFrame, nulls: Sequence[str], keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """Missing values and distinct keys in one pass.

    Exact distinct counts shuffle every distinct key; ``approximate`` keeps a
    sketch per column instead.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in nulls],
        *[distinct(F.col(c)).alias(f"{c}_distinct") for c in keys],
    )


def profile_sketches(df: DataFrame, by: Sequence[str], nulls: Sequence[str] = (), keys: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """A profile that can be added up: per ``by`` the rows, missing values, and sketches of keys and numbers.

    Distinct keys are held by HyperLogLog sketches, numbers by KLL sketches; a
    group is one row of some kilobytes. Stored by the columns a refresh replaces,
    only the groups that changed are ever read again.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in nulls],
        *[F.hll_sketch_agg(F.col(c)).alias(f"{c}_hll") for c in keys],
        *[F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"{c}_kll") for c in numbers],
    )


def merged_profile(sketches: DataFrame, by: Sequence[str] = (), quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """The profile of several groups together, out of their sketches and nothing else.

    Row and null counts are exact. Distinct counts are within 2 % or so (12 bits
    of HyperLogLog, standard error 1.6 %); each quantile is that of a rank at
    most 1.33 % (single-sided, 99 % sure) from the one asked for.
    """
    names = sketches.columns
    quantiles = quantiles or {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    plain = [F.sum(c).alias(c) for c in names if c == "n_rows" or c.endswith("_nulls")]
    distinct = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c.removesuffix('_hll')}_distinct") for c in names if c.endswith("_hll")]
    spread = [F.kll_merge_agg_double(c).alias(c) for c in names if c.endswith("_kll")]
    out = sketches.groupBy(*by).agg(*plain, *distinct, *spread)
    asked = {
        f"{c.removesuffix('_kll')}_{q}": F.kll_sketch_get_quantile_double(F.col(c), F.lit(float(p)))
        for c in names if c.endswith("_kll") for q, p in quantiles.items()}
    return out.withColumns(asked).drop(*[c for c in names if c.endswith("_kll")]) if asked else out


def date_span(df: DataFrame, date: str = "date", season: str = "season") -> DataFrame:
    """First and last day, and the sorted seasons."""
    return df.agg(
        F.min(date).alias("first_day"), F.max(date).alias("last_day"),
        F.array_sort(F.collect_set(season)).alias("seasons"),
    )


# Different values that may be put in order to find a rank; more are narrowed down first.
ORDERED = 100_000


def exact_quantiles(df: DataFrame, column: str, probabilities: Mapping[str, float], accuracy: int = 10_000, ordered: int = ORDERED) -> DataFrame:
    """One row: the exact interpolated quantile of a column for each name.

    Approximate percentiles a little below and above each rank, with a proven
    rank error of 1 / ``accuracy``, enclose it. While an enclosure holds more
    than ``ordered`` values, the same is done with the values inside, so each
    round leaves a few thousandths of a thousandth of the last. At the end rows
    below collapse to a count and their largest value in every map task, rows
    above to a count and their smallest, equal values between to a count; only
    those few are ordered, whatever the size and the tail of the column.
    """
    v = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    total, limits = _enclosures(v, probabilities, accuracy, ordered)
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q"), F.lit(low).cast("double").alias("low"), F.lit(high).cast("double").alias("high"))
        for (name, q), (low, high) in zip(probabilities.items(), limits)
    ]))
    rows = v.select("v", F.lit(total).cast("bigint").alias("total"), wanted.alias("w"))
    zone = F.when(F.col("v") < F.col("w.low"), -1).when(F.col("v") > F.col("w.high"), 1).otherwise(0)
    rows = rows.select("v", "total", "w.name", "w.q", zone.alias("zone"), F.when(zone == 0, F.col("v")).alias("place"))
    counts = rows.groupBy("name", "q", "total", "zone", "place").agg(
        F.count(F.lit(1)).alias("n"), F.when(F.col("zone") > 0, F.min("v")).otherwise(F.max("v")).alias("v"))
    upto = Window.partitionBy("name").orderBy("zone", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("last", F.sum("n").over(upto)).withColumn("at", (F.col("total") - 1) * F.col("q"))
    ranks = counts.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
    hit = ranks.filter((F.col("rank") < F.col("last")) & (F.col("rank") >= F.col("last") - F.col("n")))
    share = F.lit(1.0) - F.abs(F.col("at") - F.col("rank"))
    found = [F.sum(F.when(F.col("name") == name, F.col("v") * share)).alias(name) for name in probabilities]
    return hit.agg(*found)


def _enclosures(v: DataFrame, probabilities: Mapping[str, float], accuracy: int, ordered: int) -> tuple[int, list[tuple[float, float]]]:
    """Number of values, and for each rank two values it lies between, or one neighbour beyond, with few values inside."""
    slack = 2.0 / accuracy
    edges = [p for q in probabilities.values() for p in (max(0.0, q - slack), min(1.0, q + slack))]
    total, found = v.agg(F.count(F.lit(1)), F.approx_percentile("v", edges, accuracy)).first()
    if not total:
        return 0, [(0.0, 0.0)] * len(probabilities)
    limits = list(zip(found[::2], found[1::2]))
    while True:
        inside = [(F.col("v") >= low) & (F.col("v") <= high) for low, high in limits]
        look = v.agg(*[F.count_if(F.col("v") < low) for low, _ in limits], *[F.count_if(i) for i in inside],
                     *[F.approx_count_distinct(F.when(i, F.col("v"))) for i in inside]).first()
        below, held, different = (look[k * len(limits):(k + 1) * len(limits)] for k in range(3))
        wide = [k for k, n in enumerate(different) if n > ordered]
        if not wide:
            return total, limits
        ask = []
        for k, q in enumerate(probabilities.values()):
            rank = min(1.0, max(0.0, ((total - 1) * q - below[k]) / held[k]))
            ask.append(F.approx_percentile(F.when(inside[k], F.col("v")), [max(0.0, rank - slack), min(1.0, rank + slack)], accuracy))
        narrower = v.agg(*ask).first()
        new = [tuple(narrower[k]) if k in wide else limits[k] for k in range(len(limits))]
        if new == limits:  # no narrower than this
            return total, limits
        limits = new


def describe(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Count, mean, deviation, extremes and exact interpolated quartiles, one row.

    The column is written to the checkpoint folder once and read from there.
    """
    v = cut_lineage(df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL"))
    quartiles = exact_quantiles(v, "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    quartiles = quartiles.select(F.struct(*[F.round(q, digits).alias(q) for q in quartiles.columns]))
    basic = v.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), digits).alias("mean"),
        F.round(F.stddev_samp("v"), digits).alias("std"), F.min("v").alias("min"), F.max("v").alias("max"),
    )
    return basic.withColumn("quartiles", quartiles.scalar()).select(*basic.columns, "quartiles.*")


def evaluation_mix(predictions: DataFrame) -> DataFrame:
    """Per position: players, share under, fairly and over valued, mean gap."""
    def share(label):
        return F.round(F.avg((F.col("evaluation") == label).cast("double")) * F.lit(100.0), 1)

    gap = F.sum(F.col("difference_pct").cast("decimal(18,1)")) / F.nullif(F.count("difference_pct"), F.lit(0))
    return predictions.groupBy("position").agg(
        F.count("player_id").alias("nb_joueurs"),
        share(C.UNDER).alias("pct_sous_evalues"),
        share(C.FAIR).alias("pct_bien_evalues"),
        share(C.OVER).alias("pct_surevalues"),
        F.round(gap, 1).cast("double").alias("ecart_moyen_pct"),
    ).orderBy(F.col("pct_sous_evalues").desc(), "position")


def t_p_value(t: Column, df: Column, steps: int = 1000) -> Column:
    """Two-sided p-value of Student's t: the regularised incomplete beta function at df / (df + t²).

    Its continued fraction is evaluated by Lentz's method with a fixed number of
    steps, far more than it takes to settle up to millions of degrees of freedom.
    The beta function comes from the asymptotic series of a ratio of gamma
    functions, taken 30 steps further out where it is exact to the last digits.
    """
    a = df / F.lit(2.0)
    k = F.sequence(F.lit(0), F.lit(29))
    shift = F.aggregate(k, F.lit(1.0), lambda p, i: p * (a + i) / (a + i + F.lit(0.5)))
    z = a + F.lit(30.0)
    series = F.lit(0.5) * F.log(z) - F.lit(1 / 8) / z + F.lit(1 / 192) / F.pow(z, 3) - F.lit(1 / 640) / F.pow(z, 5)
    inverse_beta = shift * F.exp(series) / F.sqrt(F.lit(math.pi))  # 1 / B(a, 1/2)
    below = F.exp(-a * F.log1p(t * t / df)) * F.sqrt(t * t / (df + t * t)) * inverse_beta  # x^a (1-x)^(1/2) / B

    def fraction(p: Column, q: Column, x: Column) -> Column:
        start = F.lit(1.0) / (F.lit(1.0) - (p + q) * x / (p + 1))

        def step(s: Column, m: Column) -> Column:
            even = m * (q - m) * x / ((p + 2 * m - 1) * (p + 2 * m))
            d1, c1 = F.lit(1.0) / (F.lit(1.0) + even * s["d"]), F.lit(1.0) + even / s["c"]
            odd = -(p + m) * (p + q + m) * x / ((p + 2 * m) * (p + 2 * m + 1))
            d2, c2 = F.lit(1.0) / (F.lit(1.0) + odd * d1), F.lit(1.0) + odd / c1
            return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d1 * c1 * d2 * c2).alias("h"))

        first = F.struct(F.lit(1.0).alias("c"), start.alias("d"), start.alias("h"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, step, lambda s: s["h"])

    half, x = F.lit(0.5), df / (df + t * t)
    direct = below * fraction(a, half, x) / a
    other = F.lit(1.0) - below * fraction(half, a, F.lit(1.0) - x) / half
    return F.when(x < (a + 1) / (a + F.lit(2.5)), direct).otherwise(other)


def paired_t_test(df: DataFrame, a: str = "home_goals", b: str = "away_goals", alpha: float = 0.05) -> DataFrame:
    """Paired t-test of two columns and the share of rows where ``a`` is larger."""
    d = col(a) - col(b)
    pairs = df.filter(col(a).isNotNull() & col(b).isNotNull())
    base = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"),
        F.avg(d).alias("gap"), F.stddev_samp(d).alias("sd"), F.avg((d > 0).cast("int")).alias("won"),
    )
    t = F.col("gap") / F.nullif(F.col("sd") / F.sqrt("n"), F.lit(0.0))
    return base.select(
        "n", F.round("mean_a", 3).alias("mean_a"), F.round("mean_b", 3).alias("mean_b"),
        F.round("gap", 3).alias("gap"), F.round(t, 4).alias("t_stat"),
        t_p_value(t, (F.col("n") - 1).cast("double")).alias("p_value"),
        F.round(F.col("won") * F.lit(100.0), 1).alias("a_larger_pct"),
    ).withColumn("rejected", F.col("p_value") < alpha)


def table_volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
              for name, df in tables.items()]
    return reduce(DataFrame.union, counts)


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", logged: bool = True) -> DataFrame:
    """R² on the (log) scale and mean absolute error in euros, one row."""
    y, p = F.col(label), F.col(prediction)
    error = F.abs(F.expm1(y) - F.expm1(p)) if logged else F.abs(y - p)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(1.0) - F.avg((y - p) * (y - p)) / F.nullif(F.var_pop(y), F.lit(0.0))).alias("r2"),
        F.avg(error).alias("mae"),
    )
