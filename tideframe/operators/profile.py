"""Table profiles: summary statistics, duplicates, correlations, samples."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.numeric import numeric_columns
from tideframe.plans.quantiles import average_ranks, column_facts, exact_quantiles

STATS_SCHEMA = (
    "column_name string, count bigint, mean double, std double, min double, q25 double, median double, q75 double, max double"
)


def describe_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, range and exact quartiles per numeric column.

    The result has one row per column, so it is assembled from the fitted numbers.
    """
    columns = list(columns or numeric_columns(df))
    facts = column_facts(df, columns)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], facts=facts)
    out = []
    for c in (c for c in columns if c in facts):
        f, (q25, median, q75) = facts[c], quartiles.get(c, [None] * 3)
        out.append((c, f["count"], f["mean"], f["std"], f["min"], q25, median, q75, f["max"]))
    return df.sparkSession.createDataFrame(out, STATS_SCHEMA)


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with their number of occurrences."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def top_duplicates(df: DataFrame, limit: int = 10) -> DataFrame:
    return duplicate_groups(df).orderBy(F.desc("occurrences"), *df.columns).limit(limit)


def quality_score(missing_percentage: str, duplicate_rows: str, rows: str) -> str:
    """100 minus capped penalties for missing cells and duplicate rows, never below zero."""
    missing = f"least({missing_percentage} * 2D, 50D)"
    duplicates = f"least({duplicate_rows} / greatest({rows}, 1) * 300D, 30D)"
    return f"greatest(100D - {missing} - {duplicates}, 0D)"


def profile_summary(df: DataFrame) -> DataFrame:
    """One row: size, missing cells, duplicate rows, column types and the quality score.

    Equal rows are counted first; every other number is a sum weighted with those counts.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    numeric = len(numeric_columns(df))
    times = sum(k.startswith(("timestamp", "date")) for k in kinds.values())
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    missing = {c: f"sum(CASE WHEN {c} IS NULL THEN __n ELSE 0 END)" for c in df.columns}
    sums = {"dataset_rows": "coalesce(sum(__n), 0)", "duplicate_rows": "coalesce(sum(__n - 1), 0)"}
    sums |= {f"__missing_{c}": f"coalesce({e}, 0)" for c, e in missing.items()}
    one = counted.agg(*[F.expr(e).alias(n) for n, e in sums.items()])
    cells = " + ".join(f"__missing_{c}" for c in df.columns)
    with_missing = " + ".join(f"CAST(__missing_{c} > 0 AS BIGINT)" for c in df.columns)
    one = one.selectExpr(
        "dataset_rows",
        f"{len(kinds)}L AS dataset_columns",
        f"{numeric}L AS numeric_columns",
        f"{times}L AS datetime_columns",
        f"{len(kinds) - numeric - times}L AS other_columns",
        f"{cells} AS missing_cells",
        f"coalesce(try_divide({cells}, dataset_rows * {len(kinds)}), 0D) * 100 AS missing_percentage",
        "duplicate_rows",
        f"{with_missing} AS columns_with_missing",
    )
    return one.selectExpr("*", f"{quality_score('missing_percentage', 'duplicate_rows', 'dataset_rows')} AS data_quality_score")


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns that miss values, with count and percentage."""
    from tideframe.operators.quality import null_check

    return null_check(df).where("null_count > 0").select("column_name", "null_count", "null_percentage")


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlation per column pair in one aggregation; NULL without variation."""
    structs = []
    for a, b in combinations(columns, 2):
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        u, v = (f"CASE WHEN {both} THEN CAST({c} AS DOUBLE) END" for c in (a, b))
        r = f"try_divide(covar_samp({u}, {v}), stddev_samp({u}) * stddev_samp({v}))"
        structs.append(f"struct('{a}' AS column_a, '{b}' AS column_b, {r} AS r)")
    return df.agg(F.expr(f"array({', '.join(structs)})").alias("r")).selectExpr("inline(r)")


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of average ranks per column pair, over rows that have both values."""
    out = None
    for a, b in combinations(columns, 2):
        pairs = df.where(f"{a} IS NOT NULL AND {b} IS NOT NULL").groupBy(a, b).agg(F.count(F.lit(1)).alias("__n"))
        both = df.where(f"{a} IS NOT NULL AND {b} IS NOT NULL").select(a, b)
        for c, name in ((a, "__u"), (b, "__v")):
            pairs = pairs.join(average_ranks(both, c).withColumnRenamed("rank", name), c)
        # ranks run from 1 to n and average (n + 1) / 2, so centring first keeps the sums small
        n = pairs.agg(F.sum("__n")).first()[0] or 0
        u, v = (f"({c} - {(n + 1) / 2!r}D)" for c in ("__u", "__v"))
        r = f"try_divide(sum(__n * {u} * {v}), sqrt(sum(__n * {u} * {u})) * sqrt(sum(__n * {v} * {v})))"
        one = pairs.agg(F.expr(r).alias("r")).selectExpr(f"'{a}' AS column_a", f"'{b}' AS column_b", "r")
        out = one if out is None else out.unionByName(one)
    return out


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson and Spearman correlation of every column pair."""
    pearson = pearson_matrix(df, columns).withColumnRenamed("r", "pearson")
    return pearson.join(spearman_matrix(df, columns).withColumnRenamed("r", "spearman"), ["column_a", "column_b"])


def profile_report(df: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None, size: int = 10) -> dict[str, DataFrame]:
    """All parts of a profile: summary, statistics, missing cells, correlations, duplicates and samples."""
    columns = list(columns or numeric_columns(df))
    return {
        "summary": profile_summary(df),
        "statistics": describe_stats(df, columns),
        "missing": missing_by_column(df),
        "correlations": correlation_matrix(df, columns),
        "duplicates": top_duplicates(df, size),
        "samples": sample_rows(df, order, size),
    }


def sample_rows(df: DataFrame, order: Sequence[str], size: int = 10, seed: int = 42, random: bool = True) -> DataFrame:
    """First rows, last rows and a repeatable random sample, each a top-k that keeps ``size`` rows per task."""
    head = df.orderBy(*order).limit(size).withColumn("sample", F.lit("head"))
    tail = df.orderBy(*[F.desc(c) for c in order]).limit(size).withColumn("sample", F.lit("tail"))
    out = head.unionByName(tail)
    if random:
        drawn = df.orderBy(F.xxhash64(*order, F.lit(seed)), *order).limit(size)
        out = out.unionByName(drawn.withColumn("sample", F.lit("random")))
    return out
