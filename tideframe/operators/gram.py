"""Ridge regressions solved from sums: cross products of the columns per group, taken in one pass.

A group is a fold, a series, or both. What is left out of a fit is subtracted by adding up other groups, so cross-validation
and one model for every series cost one pass over the rows however many fits there are.

Rows that miss a feature or the label, or hold an infinite one, are left out. A group without rows has no model; a constant column is only
centred. Columns are shifted by their mean over all rows before products are taken, so large values lose no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions.expressions import quoted

TARGET = "price"
FOLDS = 3
#: Doubles that a task holds before it hands its sums on.
HELD = 4_000_000


def _group_codes(columns: list[pa.Array], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A number per row, equal where all the columns are, and one row of every number."""
    codes = np.zeros(rows, np.int64)
    for column in columns:
        encoded = column.dictionary_encode(null_encoding="encode")
        codes = codes * len(encoded.dictionary) + encoded.indices.to_numpy(zero_copy_only=False)
        _, codes = np.unique(codes, return_inverse=True)
    _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
    return codes, first


def values_of(columns: Sequence[str]) -> Column:
    """The columns as one array of doubles."""
    return F.array(*[F.col(quoted(c)).cast("double") for c in columns])


def cross_products(df: DataFrame, values: Column, by: Sequence[str], shift: np.ndarray) -> DataFrame:
    """``by``..., products: for z = (1, values - shift) the sums of z_i * z_j, i <= j, row by row of the upper triangle.

    ``values`` is an array as long as ``shift``, all of a row in one column, so that plans stay small at any width.

    Every task adds up its rows and hands on one array for a group; arrays are summed place by place with partial aggregation.
    """
    width = len(shift) + 1
    upper = np.triu_indices(width)
    held = max(HELD // (width * width), 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}

        def handed() -> pa.RecordBatch:
            keys = [pa.array([k[i] for k in total], t) for i, t in enumerate(key_types)]
            return pa.RecordBatch.from_arrays([*keys, pa.array([m[upper] for m in total.values()], pa.list_(pa.float64()))], names=names)

        key_types: list[pa.DataType] = []
        for batch in batches:
            keys = [batch.column(i) for i in range(len(by))]
            key_types = [k.type for k in keys]
            z = np.ones((batch.num_rows, width))
            z[:, 1:] = batch.column(len(by)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width - 1) - shift
            whole = np.flatnonzero(np.isfinite(z).all(axis=1))
            z, keys = z[whole], [k.take(pa.array(whole)) for k in keys]
            if not len(z):
                continue
            codes, first = _group_codes(keys, len(z))
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(1, len(first) + 1))
            for g, part in enumerate(np.split(order, ends[:-1])):
                key = tuple(k[int(first[g])].as_py() for k in keys)
                product = z[part].T @ z[part]
                total[key] = total[key] + product if key in total else product
                if len(total) >= held:
                    yield handed()
                    total.clear()
        if total:
            yield handed()

    given = df.select(*[F.col(quoted(k)) for k in by], values.alias("__values"))
    names = [*by, "products"]
    schema = T.StructType([*[df.schema[k] for k in by], T.StructField("products", T.ArrayType(T.DoubleType()))])
    key = [F.col(quoted(k)) for k in by]
    cells = given.mapInArrow(sums, schema).select(*key, F.posexplode("products").alias("__place", "__product"))
    summed = cells.groupBy(*key, "__place").agg(F.sum("__product").alias("__product"))
    ordered = F.array_sort(F.collect_list(F.struct("__place", "__product")))  # as long as the triangle
    return summed.groupBy(*key).agg(F.transform(ordered, lambda x: x["__product"]).alias("products"))


def _square(products: np.ndarray, width: int) -> np.ndarray:
    full = np.zeros((width, width))
    full[np.triu_indices(width)] = products
    return full + np.triu(full, 1).T


def _line(g: np.ndarray, alpha: float, scale: bool) -> np.ndarray | None:
    """Weights and intercept of a ridge whose intercept is free; ``g`` are the products of (1, features, label)."""
    n, p = g[0, 0], len(g) - 2
    if n < 1:
        return None
    means = g[0] / n
    centred = g - n * np.outer(means, means)
    spread = np.sqrt(np.maximum(np.diag(centred)[1 : p + 1], 0) / n) if scale else np.ones(p)
    spread[spread == 0] = 1.0
    a = centred[1 : p + 1, 1 : p + 1] / np.outer(spread, spread) + alpha * np.eye(p)
    weights = np.linalg.solve(a, centred[1 : p + 1, p + 1] / spread) / spread
    return np.append(weights, means[p + 1] - means[1 : p + 1] @ weights)


def _squared_error(g: np.ndarray, line: np.ndarray) -> float:
    """Sum of squared residuals of a line, from products alone."""
    residual = np.concatenate([[-line[-1]], -line[:-1], [1.0]])
    return max(float(residual @ g @ residual), 0.0)


def _shift(df: DataFrame, values: Column, width: int) -> np.ndarray:
    """Mean of the finite values at every place."""
    cells = df.select(F.posexplode(values).alias("place", "value")).where("abs(value) < double('Infinity')")
    shift = np.zeros(width)
    for row in cells.groupBy("place").agg(F.avg("value").alias("mean")).collect():  # one row per column
        shift[row["place"]] = row["mean"]
    return shift


def ridge_cv(df: DataFrame, features: Sequence[str], label: str = TARGET, by: Sequence[str] = (), alpha: float = 1.0) -> DataFrame:
    """:func:`ridge_cv_values` of columns."""
    return ridge_cv_values(df, values_of([*features, label]), len(features) + 1, by, alpha)


def ridge_cv_values(df: DataFrame, values: Column, width: int, by: Sequence[str] = (), alpha: float = 1.0) -> DataFrame:
    """``by``..., fold, train_rows, valid_rows, mse of every fold of :func:`tideframe.operators.learn.cv_folds`.

    ``values`` holds the features and then the label. Features are taken as they are, so scale them first. Folds without rows on
    either side are left out.
    """
    sums = cross_products(df, values, [*by, "fold", "past_only"], _shift(df, values, width))

    @F.pandas_udf("array<array<double>>")
    def scores(folds: pd.Series, past: pd.Series, products: pd.Series) -> pd.Series:
        out = []
        for numbers, past_only, parts in zip(folds, past, products, strict=True):
            squares = {int(f): _square(np.asarray(x, float), width + 1) for f, x in zip(numbers, parts, strict=True)}
            rows = []
            for fold in range(1, FOLDS + 1):
                fit_on = [g for f, g in squares.items() if (f < fold if past_only else f != fold)]
                line = _line(sum(fit_on), alpha, False) if fit_on and fold in squares else None
                if line is not None:
                    n = squares[fold][0, 0]
                    rows.append([float(fold), sum(g[0, 0] for g in fit_on), n, _squared_error(squares[fold], line) / n])
            out.append(rows)
        return pd.Series(out)

    parts = F.collect_list(F.struct("fold", "products"))  # one per fold
    whole = sums.groupBy(*[F.col(quoted(k)) for k in by]).agg(parts.alias("__parts"), F.bool_and("past_only").alias("__past"))
    scored = whole.select(*by, scores(F.col("__parts.fold"), "__past", F.col("__parts.products")).alias("__scores"))
    rows = scored.select(*by, F.explode("__scores").alias("s"))
    return rows.selectExpr(*[quoted(k) for k in by], "CAST(s[0] AS INT) AS fold", "CAST(s[1] AS BIGINT) AS train_rows", "CAST(s[2] AS BIGINT) AS valid_rows", "s[3] AS mse")


def ridge_per_group(df: DataFrame, features: Sequence[str], by: Sequence[str], label: str = TARGET, alpha: float = 1.0) -> DataFrame:
    """``by``..., train_rows, intercept, weights: one ridge for every group, over z-scores of the group's own rows.

    Weights and intercept are on the scale of the columns as given.
    """
    values, width = values_of([*features, label]), len(features) + 1
    away = _shift(df, values, width)

    @F.pandas_udf("array<double>")
    def solved(products: pd.Series) -> pd.Series:
        out = []
        for part in products:
            g = _square(np.asarray(part, float), width + 1)
            line = _line(g, alpha, True)
            line[-1] += away[-1] - line[:-1] @ away[:-1]
            out.append([g[0, 0], *line])
        return pd.Series(out)

    found = cross_products(df, values, by, away).select(*by, solved("products").alias("s"))
    return found.selectExpr(
        *[quoted(k) for k in by], "CAST(s[0] AS BIGINT) AS train_rows", f"s[{len(features) + 1}] AS intercept", f"slice(s, 2, {len(features)}) AS weights"
    )


def predict_per_group(df: DataFrame, models: DataFrame, features: Sequence[str], by: Sequence[str], name: str = "predicted_price") -> DataFrame:
    """``df`` with the prediction of its group's model; null where the group has none. The models are a row per group."""
    key = lambda source: F.struct(*[source[quoted(k)] for k in by])
    lines = models.select(key(models).alias("__group"), "intercept", "weights")
    rows = df.withColumn("__group", key(df))
    terms = " + ".join(f"__line.weights[{i}] * {quoted(c)}" for i, c in enumerate(features)) or "0D"
    joined = rows.join(lines.select("__group", F.struct("intercept", "weights").alias("__line")), "__group", "left")
    return joined.selectExpr(*[quoted(c) for c in df.columns], f"__line.intercept + {terms} AS {quoted(name)}")
