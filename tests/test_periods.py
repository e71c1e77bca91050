"""Periods against brute force."""

import datetime
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from touchline.operators import features, periods, stats

DAY0 = datetime.date(2020, 1, 1)


def day(n):
    return DAY0 + datetime.timedelta(days=n)


rows = st.lists(st.tuples(st.integers(1, 2), st.integers(0, 6), st.integers(1, 3)), min_size=1, max_size=14)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_pairs(values):
    by_key = defaultdict(list)
    for k, d, v in values:
        by_key[k].append((d, v))
    out = []
    for k, items in by_key.items():
        items.sort()
        out += [(k, day(a[0]), day(b[0]), float(a[1]), float(b[1])) for a, b in zip(items, items[1:])]
    return out


def frame(spark, values):
    return spark.createDataFrame([(k, day(d), float(v)) for k, d, v in values], "player_id int, date date, market_value_in_eur double")


@SLOW
@given(rows)
def test_pairs(spark, values):
    assert Counter(map(tuple, periods.consecutive_pairs(frame(spark, values)).collect())) == Counter(brute_pairs(values))


@SLOW
@given(rows, rows)
def test_interval_sums(spark, values, played):
    points = spark.createDataFrame([(k, day(d), g) for k, d, g in played], "player_id int, date date, goals int")
    got = periods.interval_join(points, periods.consecutive_pairs(frame(spark, values)), {"goals": "g"}, count="n")
    want = []
    for k, t0, t1, v0, v1 in brute_pairs(values):
        own = [g for q, d, g in played if q == k and t0 <= day(d) < t1]
        want.append((k, t0, t1, v0, v1, len(own), sum(own)))
    assert Counter(tuple(r) for r in got.select("player_id", "t0", "t1", "v0", "v1", "n", "g").collect()) == Counter(want)


def test_one_player_with_a_third_of_all_rows(spark):
    values = [(1, i % 6, 1 + i % 3) for i in range(300)] + [(2 + i, i % 6, 1) for i in range(600)]
    assert Counter(map(tuple, periods.consecutive_pairs(frame(spark, values)).collect())) == Counter(brute_pairs(values))


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).lognormal(10, 3, 20_000)) + [1e18], list(range(7)), [3.0, 1.0, 2.0],
    [1.0], [1.0, 2.0], [5.0] * 40 + [1.0, 9.0], list(np.linspace(-3, 8, 101)), [0.0] * 7 + [1e6],
])
def test_quartiles(spark, values):
    r = stats.describe(spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double"), "v", digits=6).first()
    assert (r["n"], r["min"], r["max"]) == (len(values), min(values), max(values))
    for name, q in (("q25", 25), ("q50", 50), ("q75", 75)):
        assert r[name] == pytest.approx(np.percentile(values, q), abs=1e-5)
    assert r["mean"] == pytest.approx(np.mean(values), rel=1e-9, abs=1e-5)
    if len(values) > 1:
        assert r["std"] == pytest.approx(np.std(values, ddof=1), rel=1e-6, abs=1e-5)


spans = st.lists(st.tuples(st.integers(1, 2), st.integers(0, 40), st.integers(0, 40)), max_size=12)


@SLOW
@given(spans, st.lists(st.tuples(st.integers(1, 3), st.integers(0, 40), st.integers(0, 5)), max_size=30), st.sampled_from([1, 3, 7, 128]))
def test_overlapping_periods(spark, periods_, played, bin_days):
    rows = [(k, day(a), day(b), i % 3) for i, (k, a, b) in enumerate(periods_)]
    rows += rows[:2] + [(None, day(0), day(9), 0), (1, None, day(9), 0), (1, day(3), None, 0)]  # repeated, and without key or ends
    df = spark.createDataFrame(rows, "player_id int, t0 date, t1 date, tag int")
    points = spark.createDataFrame([(k, day(d), g) for k, d, g in played] + [(None, day(1), 1), (1, None, 1)], "player_id int, date date, goals int")
    got = periods.overlap_join(points, df, {"goals": "g"}, count="n", bin_days=bin_days)
    want = []
    for k, t0, t1, tag in rows:
        own = [g for q, d, g in played if q == k and t0 and t1 and t0 <= day(d) < t1]
        want.append((k, t0, t1, tag, len(own), sum(own)))
    assert Counter(map(tuple, got.collect())) == Counter(want)


@settings(SLOW, max_examples=4)
@given(rows, rows)
def test_both_joins_agree_on_disjoint_periods(spark, values, played):
    points = spark.createDataFrame([(k, day(d), g) for k, d, g in played], "player_id int, date date, goals int")
    pairs = periods.consecutive_pairs(frame(spark, values))
    a = periods.interval_join(points, pairs, {"goals": "g"}, count="n")
    b = periods.overlap_join(points, pairs, {"goals": "g"}, count="n", bin_days=2)
    assert Counter(map(tuple, a.select(*b.columns).collect())) == Counter(map(tuple, b.collect()))


@pytest.mark.parametrize("ordered", [5, 1000])
def test_quantiles_in_rounds(spark, ordered):
    rng = np.random.default_rng(3)
    for values in (rng.lognormal(10, 4, 20_001), rng.integers(0, 5000, 25_000).astype(float)):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        asked = {"low": 0.0, "q01": 0.01, "q25": 0.25, "q50": 0.5, "q999": 0.999, "high": 1.0}
        # a coarse enclosure, so that several rounds are needed
        got = stats.exact_quantiles(df, "v", asked, accuracy=50, ordered=ordered).first()
        for name, q in asked.items():
            assert got[name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12)
        v = df.select("v")
        _, limits = stats._enclosures(v, asked, 50, ordered)
        inside = [len(np.unique(values[(values >= a) & (values <= b)])) for a, b in limits]
        assert max(inside) <= max(2 * ordered, 12)


def test_merged_sketches(spark):
    df = spark.range(60_000).selectExpr(
        "id % 12 as month", "id % 3 as league", "case when id % 10 > 0 then id % 7001 end as player", "cast(id * 7919 % 10007 as double) as minutes", "if(id % 4 = 0, null, 1) as goals")
    stored = stats.profile_sketches(df, ["league", "month"], ["goals"], ["player"], ["minutes"])
    whole = stats.merged_profile(stats.profile_sketches(df, [], ["goals"], ["player"], ["minutes"]))
    merged = stats.merged_profile(stored)
    a, b = whole.first(), merged.first()
    assert a["n_rows"] == b["n_rows"] == 60_000 and a["goals_nulls"] == b["goals_nulls"] == 15_000
    assert a["player_distinct"] == b["player_distinct"]  # merging loses nothing of a HyperLogLog sketch
    exact = df.select("player").na.drop().distinct().count()
    assert abs(b["player_distinct"] - exact) <= 0.05 * exact
    for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        for r in (a, b):
            rank = df.filter(F.col("minutes") <= r[f"minutes_{name}"]).count() / 60_000
            assert abs(rank - q) <= 0.03
    by_league = stats.merged_profile(stored, ["league"]).collect()
    assert sorted((r["league"], r["n_rows"]) for r in by_league) == [(0, 20_000), (1, 20_000), (2, 20_000)]


def test_dictionary(spark):
    words = [f"w{i * 37 % 500:03d}" for i in range(900)] + [None, "", "é"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, word string")
    codes = {w: k for k, w in enumerate(sorted({w for w in words if w is not None}))}
    got = features.code_by_join(df, "word", "code").collect()
    assert {(r["id"], r["code"]) for r in got} == {(i, codes.get(w)) for i, w in enumerate(words)} and len(got) == len(words)
    small = features.dictionary(df.filter("id < 10"), "word")
    assert features.code_by_join(df, "word", "code", small).filter("code is null").count() == sum(w not in words[:10] for w in words)
    assert features.dictionary(df.limit(0), "word").count() == 0
    with pytest.raises(ValueError, match="too many"):
        features.vocabularies(df, ["word"], most=400)
    assert len(features.vocabularies(df, ["word"])["word"]) == len(codes)
