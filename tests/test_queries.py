"""Every query with check SQL gives the rows DuckDB gives."""

import __spark_entry__ as entry
import pytest
from compare import difference
from pyspark.sql import DataFrame
from touchline import constants as C
from touchline.catalog import QUERIES as OWN

QUERIES = {name: run for name, run in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Python" not in plan
    assert difference(df, con, SQL[name]) is None


# Two hundred trees of each kind take minutes each: here these queries run with a few.
SLOW = {"compared_models", "temporal_predictions", "temporal_evaluation_mix", "market_value_models", "cross_validation"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


@pytest.fixture
def few_trees(monkeypatch):
    from touchline.operators import models

    boosted, kinds = models.boosted_trees, models.candidates_for_comparison
    monkeypatch.setattr(models, "boosted_trees", lambda spark, trees=4, depth=3, rate=0.1: boosted(spark, 4, min(depth, 3), rate))
    monkeypatch.setattr(models, "candidates_for_comparison", lambda spark: kinds(spark, trees=4, depth=4, boosted_depth=3))


@pytest.mark.parametrize("name", ["compared_models", "market_value_models"])
def test_comparisons_mark_the_smallest_error(name, spark, sf, few_trees):
    rows = QUERIES[name](spark, sf).collect()
    assert {r["model"] for r in rows} == {"linear_regression", "random_forest", "gradient_boosting"}
    assert len({r["n_test"] for r in rows}) == 1 and all(r["r2"] <= 1 and r["mae"] >= 0 for r in rows)
    assert [r["model"] for r in rows if r["best"]] == [min(rows, key=lambda r: r["mae"])["model"]]


def test_the_winner_predicts_every_period(spark, sf, few_trees):
    periods = QUERIES["temporal_features"](spark, sf)
    rows = QUERIES["temporal_predictions"](spark, sf).collect()
    assert 0 < len(rows) <= periods.count()
    assert all(r["predicted_value"] >= -1 and r["residual"] == pytest.approx(r["actual_value"] - r["predicted_value"], abs=1) for r in rows)
    mix = QUERIES["temporal_evaluation_mix"](spark, sf).collect()
    assert sum(r["nb_joueurs"] for r in mix) == len(rows)
    assert all(r["pct_sous_evalues"] + r["pct_bien_evalues"] + r["pct_surevalues"] == pytest.approx(100, abs=0.2) for r in mix)


def test_five_folds(spark, sf, few_trees):
    row = QUERIES["cross_validation"](spark, sf).first()
    assert row["folds"] == 5 and row["r2_mean"] <= 1 and row["r2_std"] >= 0 and row["stable"] == (row["r2_std"] < C.STABLE_CV_STD)


def test_entry(spark):
    out = entry.entry(spark)
    assert isinstance(out, DataFrame) and out.count() > 0


def test_every_inventory_id_is_covered():
    from touchline.catalog import QUERIES as registered
    wanted = {f"{p}-{i}" for p, n in {
        "SRC": 6, "SNK": 4, "PRJ": 8, "FLT": 10, "JN": 11, "AG": 15, "WN": 3, "TK": 7, "ST": 5, "SC": 20,
        "FE": 7, "ML": 11, "DQ": 14, "BI": 3, "SS": 1}.items() for i in range(1, n + 1)}
    assert wanted - {i for q in registered.values() for i in q.covers} == set()
