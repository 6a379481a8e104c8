"""Ordered passes, exact quantiles and ranks against pandas."""

import numpy as np
import pandas as pd
import pytest

from tideframe.functions.expressions import ieee_div
from tideframe.operators import clean, profile
from tideframe.plans.ordered import Series, forward_back_fill, forward_fill, ordinal, previous, running_total
from tideframe.plans.quantiles import average_ranks, column_facts, exact_quantiles

LEVELS = [("hour", None), ("minute", "hour"), ("second", "day")]


@pytest.fixture(scope="module")
def ticks(spark):
    """Irregular events over two days; one key holds most rows and many instants repeat."""
    rng = np.random.default_rng(3)
    n = 3000
    start = pd.Timestamp("2024-03-01")
    pdf = pd.DataFrame(
        {
            "k": np.where(rng.uniform(size=n) < 0.7, "hot", rng.choice(list("xyz"), n)),
            "ts": start + pd.to_timedelta(rng.integers(0, 2 * 86400, n), unit="s"),
            "id": np.arange(n),
            "v": np.where(rng.uniform(size=n) < 0.3, np.nan, rng.integers(0, 100, n).astype(float)),
        }
    )
    frame = spark.createDataFrame(pdf).selectExpr("k", "ts", "id", "nanvl(v, NULL) AS v").cache()
    return frame, pdf.sort_values(["ts", "id"])


def joined(got, want):
    return got.toPandas().merge(want, on="id", suffixes=("", "_want"))


@pytest.mark.parametrize("fine,coarse", LEVELS)
def test_ordinal_running_total_previous(ticks, fine, coarse):
    frame, pdf = ticks
    series = Series(("k",), "ts", ("id",), fine, coarse)
    by = pdf.groupby("k")
    want = pdf[["id"]].assign(pos=by.cumcount(), n=by["id"].transform("size"))
    both = joined(ordinal(frame, series, "p", "size"), want)
    assert (both["p"] == both["pos"]).all() and (both["size"] == both["n"]).all()

    want = pdf[["id"]].assign(total=pdf["v"].fillna(0).groupby(pdf["k"]).cumsum())
    both = joined(running_total(frame, series, "v", "t"), want)
    np.testing.assert_allclose(both["t"], both["total"])

    want = pdf[["id"]].assign(before=by["v"].shift(1), before_id=by["id"].shift(1))
    both = joined(previous(frame, series, ["v", "id"]), want)
    np.testing.assert_array_equal(both["prev_v"], both["before"])
    np.testing.assert_array_equal(both["prev_id"], both["before_id"])


@pytest.mark.parametrize("fine,coarse", LEVELS)
def test_fills(ticks, fine, coarse):
    frame, pdf = ticks
    unique = pdf.drop_duplicates(["k", "ts"])
    kept = frame.join(frame.sparkSession.createDataFrame(unique[["id"]]), "id", "left_semi")
    series = Series(("k",), "ts", (), fine, coarse)
    filled = unique.groupby("k")["v"].ffill()
    both = joined(forward_fill(kept, series, ["v"]), unique[["id"]].assign(f=filled))
    np.testing.assert_array_equal(both["v"], both["f"])
    back = filled.groupby(unique["k"]).bfill()
    both = joined(forward_back_fill(kept, series, ["v"]), unique[["id"]].assign(f=back))
    np.testing.assert_array_equal(both["v"], both["f"])


def test_no_key_is_one_series(ticks):
    frame, pdf = ticks
    both = joined(ordinal(frame, Series((), "ts", ("id",), "minute", "day"), "p"), pdf[["id"]].assign(pos=np.arange(len(pdf))))
    assert (both["p"] == both["pos"]).all()


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    n = 4001
    pdf = pd.DataFrame(
        {
            "normal": rng.normal(size=n),
            "ties": np.where(rng.uniform(size=n) < 0.4, 7.0, rng.integers(0, 9, n)),
            "wide": np.exp(rng.normal(size=n) * 20),
            "ints": rng.integers(-5, 5, n),
            "gaps": np.where(rng.uniform(size=n) < 0.5, np.nan, rng.normal(size=n)),
            "endless": np.where(rng.uniform(size=n) < 0.3, np.inf, rng.normal(size=n)),
            "least": rng.integers(0, 4, n) * 5e-324,
            "nothing": np.nan,
        }
    )
    frame = spark.createDataFrame(pdf).selectExpr(*[f"nanvl({c}, NULL) AS {c}" if c != "ints" else c for c in pdf.columns])
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(frame, pdf.columns, probs)
    assert "nothing" not in got
    for c in pdf.columns.drop("nothing"):
        want = np.quantile(pdf[c].dropna().clip(upper=1e300), probs)
        np.testing.assert_allclose(got[c], np.where(want > 1e299, np.inf, want), rtol=1e-12, err_msg=c)
    assert column_facts(frame, ["endless"])["endless"]["above"] == np.isinf(pdf["endless"]).sum()


def test_average_ranks(spark):
    rng = np.random.default_rng(6)
    values = pd.Series(np.where(rng.uniform(size=2000) < 0.35, 3.0, rng.normal(size=2000).round(2)))
    got = average_ranks(spark.createDataFrame(values.to_frame("v")), "v", range_values=20).toPandas()
    want = values.to_frame("v").assign(rank=values.rank()).drop_duplicates()
    both = got.merge(want, on="v")
    assert len(both) == len(got) == len(want)
    np.testing.assert_array_equal(both["rank_x"], both["rank_y"])


def test_correlations_and_flat_columns(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"a": rng.normal(size=500).round(1), "flat": 1.0})
    pdf["b"] = pdf["a"] ** 3 + rng.normal(size=500) * 0.1
    rows = profile.correlation_matrix(spark.createDataFrame(pdf), ["a", "b", "flat"]).collect()
    found = {(r["column_a"], r["column_b"]): r for r in rows}
    assert found["a", "b"]["pearson"] == pytest.approx(pdf["a"].corr(pdf["b"]))
    assert found["a", "b"]["spearman"] == pytest.approx(pdf["a"].rank().corr(pdf["b"].rank()))
    assert found["a", "flat"]["pearson"] is None and found["a", "flat"]["spearman"] is None


def test_median_impute_passes(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (None,)], "x double")
    assert sorted(r["x"] for r in clean.median_impute(frame, ["x"]).collect()) == [1.0, 2.0, 2.0, 2.0]
    # more infinities than numbers: the first fill is infinite itself and is replaced in the second pass
    frame = spark.createDataFrame([(1.0,), (float("inf"),), (float("inf"),), (None,)], "x double")
    assert [r["x"] for r in clean.median_impute(frame, ["x"]).collect()] == [1.0] * 4


def test_division_policy(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 0.0)], "a double, b double")
    got = [r["x"] for r in frame.selectExpr(f"{ieee_div('a', 'b')} AS x").collect()]
    assert got == [float("inf"), float("-inf"), None, 2.0, None]


def test_profile_score_caps(spark):
    frame = spark.createDataFrame([(None, 1)] * 10, "a string, b int")
    row = profile.profile_summary(frame).first()
    assert (row["missing_percentage"], row["duplicate_rows"]) == (50.0, 9)
    assert row["data_quality_score"] == 20.0  # both penalties at their caps


def test_samples_repeat(spark):
    frame = spark.range(1000).withColumnRenamed("id", "n")
    a, b = (sorted(r["n"] for r in profile.sample_rows(frame, ["n"]).where("sample = 'random'").collect()) for _ in range(2))
    assert a == b and len(a) == 10
