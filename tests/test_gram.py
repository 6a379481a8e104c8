import numpy as np
import pandas as pd
import pytest

from tideframe.operators import gram


def ridge(x, y, alpha=1.0, scale=False):
    spread = x.std(0) if scale else np.ones(x.shape[1])
    spread = np.where(spread == 0, 1, spread)
    z = (x - x.mean(0)) / spread
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean())) / spread
    return w, y.mean() - x.mean(0) @ w


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    n = 300
    frame = pd.DataFrame({"key": rng.choice(["a", "b", None], n), "a.b": rng.normal(1e9, 3, n), "my col": rng.normal(0, 1e-3, n), "flat": 2.0})
    frame["y"] = (frame["a.b"] - 1e9) * 2 + frame["my col"] * 500 + rng.normal(0, 0.1, n)
    frame["fold"] = rng.integers(0, 4, n).astype("int32")
    frame.loc[::17, "my col"] = np.nan
    return frame


COLUMNS = ["a.b", "my col", "flat"]
SCHEMA = "key string, `a.b` double, `my col` double, flat double, y double, fold int"


def frame_of(spark, table):
    rows = [[None if v is None or v != v else v for v in row] for row in table.itertuples(index=False)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("past_only", [True, False])
def test_folds_from_sums_equal_separate_fits(spark, table, past_only):
    rows = frame_of(spark, table).selectExpr("*", f"{str(past_only).lower()} AS past_only")
    got = {r["fold"]: r for r in gram.ridge_cv(rows, COLUMNS, "y").collect()}
    whole = table.dropna(subset=["my col"])
    for fold in (1, 2, 3):
        fit_on = whole[whole["fold"] < fold] if past_only else whole[whole["fold"] != fold]
        held = whole[whole["fold"] == fold]
        w, b = ridge(fit_on[COLUMNS].to_numpy(), fit_on["y"].to_numpy())
        assert got[fold]["train_rows"] == len(fit_on) and got[fold]["valid_rows"] == len(held)
        assert got[fold]["mse"] == pytest.approx(np.mean((held["y"] - held[COLUMNS].to_numpy() @ w - b) ** 2), rel=1e-5)


def test_one_model_for_every_group_and_none_is_a_group(spark, table):
    rows = frame_of(spark, table)
    models = gram.ridge_per_group(rows, COLUMNS, ["key"], "y")
    got = {r["key"]: r for r in models.collect()}
    assert set(got) == {"a", "b", None}
    whole = table.dropna(subset=["my col"])
    for key, row in got.items():
        mine = whole[whole["key"].isna()] if key is None else whole[whole["key"] == key]
        w, b = ridge(mine[COLUMNS].to_numpy(), mine["y"].to_numpy(), scale=True)
        assert row["train_rows"] == len(mine)
        np.testing.assert_allclose(row["weights"], w, rtol=1e-4, atol=1e-9)
        np.testing.assert_allclose(row["intercept"], b, rtol=1e-4)
    scored = gram.predict_per_group(rows, models, COLUMNS, ["key"]).toPandas()
    assert len(scored) == len(table) and scored["predicted_price"].isna().sum() == table["my col"].isna().sum()


def test_groups_are_handed_on_before_they_fill_a_task(spark, table, monkeypatch):
    monkeypatch.setattr(gram, "HELD", 1)
    rows = frame_of(spark, table).coalesce(1)
    got = gram.cross_products(rows, gram.values_of(["flat"]), ["key", "fold"], np.zeros(1)).collect()
    count = table.groupby(["key", "fold"], dropna=False).size()
    assert sorted(r["products"][0] for r in got) == sorted(count.tolist())


def test_an_empty_table_has_no_models(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert gram.ridge_per_group(empty, COLUMNS, ["key"], "y").count() == 0
    assert gram.ridge_cv(empty.selectExpr("*", "true AS past_only"), COLUMNS, "y").count() == 0
