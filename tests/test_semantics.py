"""Rules the derived tables cannot show, on small hand-made frames."""

import datetime
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from touchline.functions import columns as X
from touchline.operators import clean, dedup, names, quality, stats
from touchline.operators import matches as M
from touchline.operators import players as P

D = datetime.date


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("born,at,years", [
    (D(2000, 2, 29), D(2001, 2, 28), 0), (D(2000, 2, 29), D(2001, 3, 1), 1),
    (D(2000, 6, 15), D(2016, 6, 14), 15), (D(2000, 6, 15), D(2016, 6, 15), 16),
])
def test_calendar_age(spark, born, at, years):
    assert one(spark, X.age_calendar("b", "a"), b=("date", born), a=("date", at)) == years


@pytest.mark.parametrize("code,year", [("9900", 1999), ("3031", 2030), ("3132", 1931), ("2425", 2024), ("0001", 2000)])
def test_season_code(spark, code, year):
    assert one(spark, X.season_start_year("p"), p=("string", f"/x/la_liga/season-{code}.csv")) == year


@pytest.mark.parametrize("text,day", [
    ("15/08/2020", D(2020, 8, 15)), ("15/08/20", D(2020, 8, 15)), ("3/4/2021", D(2021, 4, 3)), ("15/08/95", D(1995, 8, 15)),
    ("01/01/69", D(1969, 1, 1)), ("01/01/68", D(2068, 1, 1)), ("2020-08-15", D(2020, 8, 15)),
    ("31/02/2020", None), ("postponed", None), ("", None), (None, None),
])
def test_day_first_date(spark, text, day):
    assert one(spark, X.day_first_date("d"), d=("string", text)) == day


@pytest.mark.parametrize("text,number", [("180", 180), ("180.0", 180), ("n/a", None), ("", None), ("-3", -3), ("1e3", 1000)])
def test_to_int(spark, text, number):
    assert one(spark, X.to_int("t"), t=("string", text)) == number


def test_ids_beyond_double_precision_survive(spark):
    assert one(spark, X.to_long("t"), t=("string", "9007199254740993")) == 9007199254740993


def test_negative_and_missing(spark):
    df = spark.createDataFrame([(-1,), (None,), (2,)], "v int")
    out = df.select(X.neg_to_null("v").alias("n"), X.neg_to_zero("v").alias("z")).collect()
    assert [tuple(r) for r in out] == [(None, 0), (None, 0), (2, 2)]


@pytest.mark.parametrize("h,a,result", [(2, 1, "home"), (1, 2, "away"), (1, 1, "draw"), (None, 1, "unknown"), (None, None, "unknown")])
def test_match_result(spark, h, a, result):
    assert one(spark, X.match_result("h", "a"), h=("int", h), a=("int", a)) == result


def test_match_id_is_the_md5_prefix(spark):
    text = "2024-08-17_PL_Arsenal_Wolves"
    got = one(spark, X.match_id("d", "h", "a", "c"), d=("date", D(2024, 8, 17)), h=("string", "Arsenal"), a=("string", "Wolves"), c=("string", "PL"))
    assert got == hashlib.md5(text.encode()).hexdigest()[:16]


@pytest.mark.parametrize("v", [0.0, 1.0, 12_345_678.0])
def test_log_round_trip(spark, v):
    assert one(spark, X.unlog_value(X.log_value("v")), v=("double", v)) == pytest.approx(v, rel=1e-9)


@pytest.mark.parametrize("v,text", [
    (1_250_000.0, "1.2 M€"), (1_350_000.0, "1.4 M€"), (120_000_000.0, "120.0 M€"), (1_234_000_000.0, "1234.0 M€"),
    (999_499.0, "999 K€"), (2_500.0, "2 K€"), (3_500.0, "4 K€"), (0.0, "0 K€"),
])
def test_money_text(spark, v, text):
    assert one(spark, X.money_text("v"), v=("double", v)) == text


@pytest.mark.parametrize("age", range(14, 26))
def test_peak_age_rounds_half_to_even(spark, age):
    assert one(spark, X.peak_age_min("a"), a=("int", age)) == round(24 - (age - 14) * (2 / 7))


def test_progression_of_an_unknown_value(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (6.0, 4.0)], "p double, c double")
    out = df.select(X.progression_pct("p", "c").alias("a"), X.progression_pct("p", "c", None).alias("b")).collect()
    assert [tuple(r) for r in out] == [(0.0, None), (0.0, None), (50.0, 50.0)]


def test_per90_without_minutes(spark):
    df = spark.createDataFrame([(3, 0), (1, 90)], "g int, m int")
    out = df.select(X.per90("g", "m", 3).alias("a"), X.per90_or_zero("g", "m", 3).alias("b")).collect()
    assert [tuple(r) for r in out] == [(None, 0.0), (1.0, 1.0)]


ALIASES = [("Arsenal FC", "Arsenal"), ("Arsenal", "Arsenal")]


def test_team_names(spark):
    df = spark.createDataFrame([(" arsenal fc ",), ("ARSENAL",), (" Unknown Town ",), (None,)], "n string")
    out = names.normalize_team(df, spark.createDataFrame(ALIASES, "alias string, canonical string"), ["n"])
    assert {r["n"] for r in out.collect()} == {"Arsenal", "Unknown Town", None}
    assert out.filter("n = 'Arsenal'").count() == 2


def test_alias_conflicts(spark):
    df = spark.createDataFrame([*ALIASES, ("ARSENAL", "Other")], "alias string, canonical string")
    assert [r["alias_key"] for r in names.alias_conflicts(df).collect()] == ["arsenal"]


SIDE = "match_id string, source string, competition string, date date, season int, round int, home_team string, away_team string, home_goals int, away_goals int"


def side(spark, source, hg, ag, mid="m"):
    return spark.createDataFrame([(mid, source, "PL", D(2020, 1, 1), 2019, 1, "A", "B", hg, ag)], SIDE)


def test_feed_row_without_score_displaces_the_season_row(spark):
    out = M.unify_matches(side(spark, "api", None, 1), side(spark, "football_datasets", 2, 1))
    assert out.count() == 0


def test_impossible_score_is_dropped(spark):
    assert M.unify_matches(side(spark, "api", 25, 1), side(spark, "football_datasets", 2, 1, "n")).count() == 1


def test_feed_wins(spark):
    out = M.unify_matches(side(spark, "api", 3, 1), side(spark, "football_datasets", 2, 1)).collect()
    assert [(r["source"], r["home_goals"]) for r in out] == [("api", 3)]


def test_keep_first_does_not_depend_on_input_order(spark):
    rows = [(1, "b", None), (1, "a", 2), (1, "a", 1), (2, None, 5)]
    for order in (rows, rows[::-1]):
        out = dedup.keep_first(spark.createDataFrame(order, "k int, s string, v int"), ["k"])
        assert sorted(map(tuple, out.collect())) == [(1, "a", 1), (2, None, 5)]


def test_dedup_shrinks_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 2).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_standings_invariants(spark, sf):
    from touchline.catalog.match_queries import league_table
    sums = league_table(spark, sf).groupBy("competition", "season").agg(
        *[F.sum(c).alias(c) for c in ("victoires", "defaites", "nuls", "buts_marques", "buts_encaisses", "diff_buts")]).collect()
    assert sums
    for r in sums:
        assert r["victoires"] == r["defaites"] and r["nuls"] % 2 == 0
        assert r["buts_marques"] == r["buts_encaisses"] and r["diff_buts"] == 0


def test_hot_player_is_summed_before_the_join(spark):
    a = spark.createDataFrame([("x", 1, "n", "C", 1, 0, 90, 0, 0)], "appearance_id string, player_id bigint, player_name string, competition_id string, goals int, assists int, minutes_played int, yellow_cards int, red_cards int")
    p = spark.createDataFrame([(1, "Attack", 2e6)], "player_id bigint, position string, market_value_in_eur double")
    plan = P.player_performance(a, p)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # the aggregate lies below the join
    assert P.player_performance(a, p).first()["value_efficiency"] == 0.5


def test_unseen_result_range_checks(spark):
    df = spark.createDataFrame([(-1,), (121,), (90,), (None,)], "minutes_played int")
    out = quality.check_violations(df, {"minutes_played": (0, 120)}, "t").first()
    assert out["violations"] == 2


@pytest.mark.parametrize("new,old,verdict", [(29, 100, "refused"), (30, 100, "warning"), (89, 100, "warning"), (90, 100, "ok"), (5, 0, "first")])
def test_volume_ratio(spark, new, old, verdict):
    assert quality.check_volume_ratio(spark.range(new), spark.range(old), "t").first()["verdict"] == verdict


@pytest.mark.parametrize("n,refused", [(9, True), (10, False)])
def test_min_rows(spark, n, refused):
    assert quality.check_min_rows(spark.range(n)).first()["refused"] is refused


def test_required_columns(spark):
    out = quality.check_required_columns(spark.createDataFrame([], "a int, b int"), ["a", "c"], "t").first()
    assert out["missing"] == ["c"] and out["refused"]


def test_conform_and_rejects(spark):
    df = spark.createDataFrame([("1", "2020-02-31"), ("x", None)], "id string, d string")
    types = {"id": "int", "d": "date"}
    assert [tuple(r) for r in clean.conform(df, types).collect()] == [(1, None), (None, None)]
    assert tuple(clean.cast_rejects(df, types).first()) == (1, 1)


def test_t_test_against_known_values(spark):
    # differences 1..10: mean 5.5, sd 3.02765, t 5.7446, p 0.000278
    df = spark.createDataFrame([(float(i), 0.0) for i in range(1, 11)], "home_goals double, away_goals double")
    r = stats.paired_t_test(df).first()
    assert r["t_stat"] == pytest.approx(5.7446, abs=1e-4) and r["rejected"]
    assert r["p_value"] == pytest.approx(0.000278, rel=1e-2)
    critical = [(2.2281388519649385, 10), (12.706204736432095, 1), (2.0085591121007611, 50), (1.9623390808264078, 1000)]  # two-sided 5 %
    rows = spark.createDataFrame([(t, float(n)) for t, n in critical] + [(0.0, 7.0), (0.5, 1.0)], "t double, df double")
    got = [x[0] for x in rows.select(stats.t_p_value(F.col("t"), F.col("df"))).collect()]
    assert got == pytest.approx([0.05] * 4 + [1.0, 1 - 2 * math.atan(0.5) / math.pi], abs=1e-8)


def test_join_coverage_equals_the_join(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "player_id int")
    b = spark.createDataFrame([(1,), (1,), (2,), (4,), (None,)], "player_id int")
    assert quality.join_coverage(a, b).first()[0] == a.join(b, "player_id").count() == 5
