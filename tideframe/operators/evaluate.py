"""Forecast evaluation and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.expressions import ieee_div
from tideframe.plans.ordered import HOURLY, Series, previous

# Smallest denominator of the guarded percentage error; which metrics fall as models improve.
EPSILON = 2.220446049250313e-16
LOWER_IS_BETTER = ("rmse", "mae", "mape", "mse")


def _metrics(a: str, p: str, mape_denominator: str) -> dict[str, str]:
    """Error sums in one pass; the total sum of squares comes from the population variance."""
    return {
        "mse": f"avg(({a} - {p}) * ({a} - {p}))",
        "mae": f"avg(abs({a} - {p}))",
        "mape": f"avg(abs({ieee_div(f'{a} - {p}', mape_denominator)})) * 100",
        "__total": f"var_pop({a}) * count(1)",
        "__residual": f"sum(({a} - {p}) * ({a} - {p}))",
        "sample_count": "count(1)",
    }


def _score(df: DataFrame, by: Sequence[str], a: str, p: str, mape_denominator: str) -> DataFrame:
    pairs = df.dropna("any", subset=[a, p])
    sums = [F.expr(e).alias(n) for n, e in _metrics(a, p, mape_denominator).items()]
    one = pairs.groupBy(*by).agg(*sums).where("sample_count > 0")
    r2 = f"1 - {ieee_div('__residual', '__total')} AS r2"
    return one.selectExpr(*by, "mse", "mae", "sqrt(mse) AS rmse", "mape", r2, "sample_count")


def evaluate_forecast(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted_price", by: Sequence[str] = ()
) -> DataFrame:
    """mse, mae, rmse, unguarded mape and r2 over complete pairs; no row if there is no pair."""
    return _score(df, by, actual, predicted, actual)


def evaluate_split(
    df: DataFrame, by: Sequence[str], actual: str = "actual", predicted: str = "predicted_price"
) -> DataFrame:
    """Training report metrics; the percentage error divides by at least the machine epsilon."""
    return _score(df, by, actual, predicted, f"greatest(abs({actual}), {EPSILON!r}D)")


def directional_accuracy(
    df: DataFrame, series: Series = HOURLY, actual: str = "actual", predicted: str = "predicted_price"
) -> DataFrame:
    """Per series: percentage of steps whose predicted direction equals the actual one (flat equals flat)."""
    pairs = df.dropna("any", subset=[actual, predicted])
    steps = previous(pairs, series, [actual, predicted]).where(f"prev_{actual} IS NOT NULL")
    same = f"signum({actual} - prev_{actual}) = signum({predicted} - prev_{predicted})"
    return steps.groupBy(*series.keys).agg(F.expr(f"avg(CAST({same} AS DOUBLE)) * 100").alias("directional_accuracy"))


def cv_scores(df: DataFrame, actual: str = "actual", predicted: str = "predicted_price") -> DataFrame:
    """Mean squared error per validation fold (fold 0 is never validated)."""
    error = F.expr(f"avg(({actual} - {predicted}) * ({actual} - {predicted}))")
    return df.where("fold > 0").dropna("any", subset=[actual, predicted]).groupBy("fold").agg(error.alias("mse"))


def cv_summary(scores: DataFrame) -> DataFrame:
    """Root of the mean fold error and root of the population deviation of the fold errors."""
    return scores.agg(
        F.expr("sqrt(avg(mse))").alias("cv_rmse_mean"), F.expr("sqrt(stddev_pop(mse))").alias("cv_rmse_std")
    )


def metrics_long(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Metric columns as rows (metric, value)."""
    return df.unpivot(list(by), list(metrics), "metric", "value")


def best_model(metrics: DataFrame) -> DataFrame:
    """Comparison table of trained models with the lowest test error marked; the earlier model wins a tie."""
    best = metrics.where("NOT isnan(test_rmse)").agg(F.min(F.struct("test_rmse", "training_order")).alias("b"))
    winner = best.first()["b"]  # one row per trained model stands behind this
    chosen = -1 if winner is None else winner["training_order"]
    return metrics.selectExpr("*", f"training_order = {chosen} AS is_best")


def model_gate(production: DataFrame, candidate: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric by metric comparison (metric, value) of two models; a worse candidate does not pass."""
    old = production.withColumnRenamed("value", "production")
    new = candidate.withColumnRenamed("value", "candidate")
    lower = ", ".join(f"'{m}'" for m in LOWER_IS_BETTER)
    better = f"CASE WHEN metric IN ({lower}) THEN candidate <= production ELSE candidate >= production END"
    change = f"{ieee_div('candidate - production', 'production')} * 100"
    return old.join(new, [*by, "metric"]).selectExpr(
        *by, "metric", "production", "candidate", f"{change} AS change_pct", f"{better} AS passed"
    )
