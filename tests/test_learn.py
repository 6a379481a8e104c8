import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel

from tideframe.operators import evaluate, features, learn
from tideframe.session import new_path


@pytest.fixture(scope="module")
def rows(spark, walk):
    return features.compact_features(spark.createDataFrame(walk(200, coins=("a",)))).cache()


@pytest.fixture(scope="module")
def ridge(rows):
    return learn.train_models(rows, names=["ridge"], cross_validate=True)


def test_feature_selection(spark):
    frame = spark.createDataFrame([(1, 2.0, "x", True, 3.0, 1)], "hour int, price double, symbol string, flag boolean, current_price double, id int")
    assert learn.select_features(frame) == ["hour", "price"]
    assert learn.select_features(frame, exclude_target=True) == ["hour"]
    with pytest.raises(ValueError, match="missing required features"):
        learn.require_features(frame, ["hour", "gone"])


def test_scaling_uses_population_deviation(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, flat double")
    got = learn.standard_scale(frame, ["x", "flat"]).toPandas()
    x = np.array([1.0, 2.0, 6.0])
    np.testing.assert_allclose(got["x"], (x - x.mean()) / x.std())
    assert (got["flat"] == 0).all()


@pytest.mark.parametrize("n", [5, 7, 10, 30, 31, 33, 50])
def test_split_and_folds(spark, n):
    pdf = pd.DataFrame({"coin_id": "a", "timestamp": pd.date_range("2022-01-01", periods=n, freq="h")})
    frame = spark.createDataFrame(pdf)
    split = learn.chrono_split(frame).toPandas().sort_values("timestamp")
    held = int(np.ceil(0.2 * n))
    assert split["is_test"].tolist() == [False] * (n - held) + [True] * held
    folds = learn.cv_folds(frame).toPandas().sort_values("timestamp")["fold"].tolist()
    size = n // 4
    assert folds == [0] * (n - 3 * size) + [1] * size + [2] * size + [3] * size
    folds = learn.cv_folds(frame, scheme="contiguous").toPandas().sort_values("timestamp")["fold"].tolist()
    sizes = [n // 3 + (i < n % 3) for i in range(3)]
    assert folds == [i + 1 for i, s in enumerate(sizes) for _ in range(s)]
    with pytest.raises(ValueError):
        learn.cv_folds(frame, scheme="other")


def test_ridge_equals_the_closed_form(ridge):
    data = ridge.assembled.where("NOT is_test").toPandas()
    x, y = np.vstack([v.toArray() for v in data["features"]]), data["label"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    weights = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    model = ridge.models["ridge"].stages[-1]
    np.testing.assert_allclose(model.coefficients.toArray(), weights, rtol=1e-6, atol=1e-6)
    np.testing.assert_allclose(model.intercept, y.mean() - x.mean(0) @ weights, rtol=1e-9)


def test_training_report(ridge):
    row = ridge.metrics.first()
    assert ridge.best == "ridge" and row["is_best"]
    assert 0 < row["test_rmse"] < 500 and row["test_r2"] > 0.5
    assert row["cv_rmse_mean"] > 0 and row["cv_rmse_std"] >= 0


def test_models_are_stored_with_scaler_and_columns(spark, rows, ridge):
    path = new_path(spark, "model")
    ridge.models["ridge"].write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = learn.predict_batch(ridge.models["ridge"], rows, "ridge").toPandas()
    b = learn.predict_batch(again, rows, "ridge").toPandas()
    pd.testing.assert_frame_equal(a, b)
    np.testing.assert_allclose(a["predicted_change"], a["predicted_price"] - a["current_price"])
    assert len(learn.predict_batch(again, rows, "ridge", start="2022-01-03", end="2022-01-03 05:00:00").collect()) == 6


def test_runs_are_found_again(spark, rows, ridge, tmp_path):
    base = str(tmp_path / "runs")
    learn.save_run(ridge, base, "20240101_000000", rows)
    learn.save_run(ridge, base, "20240102_000000", rows)
    model, kind, names = learn.load_model(spark, base)
    assert kind == "ridge" and names == ridge.features
    assert learn.load_model(spark, base, "ridge", "20240101_000000")[1] == "ridge"
    assert [r["model_type"] for r in learn.model_types(spark, base).collect()] == ["ridge"]
    with pytest.raises(ValueError):
        learn.load_model(spark, base, "random_forest")
    one = learn.predict_single(model, rows, kind, at="2022-01-03 05:00:00").first()
    batch = learn.predict_batch(ridge.models["ridge"], rows, "ridge", start="2022-01-03 04:00:00", end="2022-01-03 05:00:00")
    assert one == batch.where("timestamp = TIMESTAMP '2022-01-03 05:00:00'").first()


@pytest.mark.parametrize("row", ["latest", "first"])
def test_scoring_row(rows, ridge, row):
    bounds = {"price": (0.0, 1.0), "total_volume": (0.0, 1e12)}
    scored = learn.score_row(ridge.models["ridge"], rows, "ridge", bounds, ["price", "total_volume", "market_cap"], row).first()
    moments = rows.toPandas()["timestamp"]
    assert scored["timestamp"] == (moments.max() if row == "latest" else moments.min())
    assert scored["drift_ratio"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        learn.score_row(ridge.models["ridge"], rows, "ridge", bounds, ["price"], "middle")


def test_trees(spark, rows):
    run = learn.train_models(rows, names=["random_forest", "no_such_model"])
    assert list(run.models) == ["random_forest"]
    top = learn.feature_importance(run.models["random_forest"], run.features, rows, top=15).collect()
    values = [r["importance"] for r in top]
    assert len(values) == 15 and values == sorted(values, reverse=True)
    assert run.metrics.first()["train_r2"] > 0.9


def test_recursive_forecast_moves_three_columns_only(rows, ridge):
    model = ridge.models["ridge"]
    future = learn.predict_future(model, rows, 8, "ridge", cut_every=3).toPandas().sort_values("hours_ahead")
    assert future["hours_ahead"].tolist() == list(range(1, 9))
    last = rows.toPandas().sort_values("timestamp").iloc[-1].copy()
    linear, columns = model.stages[-1], ridge.features
    scaling = learn.Scaling.fit(learn.median_impute(rows, columns), columns)
    for step in range(8):
        z = np.array([(last[c] - scaling.mean[c]) / scaling.deviation[c] for c in columns])
        price = z @ linear.coefficients.toArray() + linear.intercept
        assert future["predicted_price"].iloc[step] == pytest.approx(price, rel=1e-9)
        last["price_change_1h"] = price - last["price"]
        last["price"] = price
        last["timestamp"] += pd.Timedelta(hours=1)
        assert future["timestamp"].iloc[step] == last["timestamp"]
    with pytest.raises(ValueError):
        learn.predict_future(model, rows, 0, "ridge")


def test_metrics_edges(spark):
    frame = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0), (None, 1.0)], "actual double, predicted_price double")
    row = evaluate.evaluate_forecast(frame).first()
    assert row["mape"] == float("inf") and row["sample_count"] == 2 and row["mse"] == 0.5 and row["r2"] == 0.5
    guarded = evaluate.evaluate_split(frame.selectExpr("*", "true AS is_test"), ["is_test"]).first()
    assert np.isfinite(guarded["mape"]) and guarded["mape"] > 1e15
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "actual double, predicted_price double")
    assert evaluate.evaluate_forecast(flat).first()["r2"] == float("-inf")
    assert evaluate.evaluate_forecast(flat.where("actual > 5")).count() == 0


def test_best_model_takes_the_first_of_equals(spark):
    frame = spark.createDataFrame([("a", 0, 2.0), ("b", 1, 1.0), ("c", 2, 1.0)], "model string, training_order int, test_rmse double")
    assert [r["model"] for r in evaluate.best_model(frame).where("is_best").collect()] == ["b"]


def test_model_gate(spark):
    schema = "metric string, value double"
    old = spark.createDataFrame([("rmse", 40.0), ("mae", 25.0), ("r2", 0.5)], schema)
    new = spark.createDataFrame([("rmse", 38.0), ("mae", 25.5), ("r2", 0.6)], schema)
    got = {r["metric"]: r for r in evaluate.model_gate(old, new).collect()}
    assert round(got["rmse"]["change_pct"], 2) == -5.0 and round(got["r2"]["change_pct"], 2) == 20.0
    assert [got[m]["passed"] for m in ("rmse", "mae", "r2")] == [True, False, True]
