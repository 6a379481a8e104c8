"""Column rules applied to whole frames.

NULL stands for a missing value, also where pandas would show NaN. Infinity stays a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.DoubleType, T.FloatType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, *FLOATING)


def numeric_columns(df: DataFrame, exclude: set[str] = frozenset()) -> list[str]:
    """Names of integer and floating columns, in order; booleans, decimals and text are not numbers here."""
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def is_infinite(c: str) -> Column:
    return F.expr(f"coalesce(abs({c}) = double('Infinity'), false)")


def null_safe_doubles(df: DataFrame) -> DataFrame:
    """NaN to NULL on every floating column; done once at ingest."""
    return df.selectExpr(
        *[f"nanvl({f.name}, NULL) AS {f.name}" if isinstance(f.dataType, FLOATING) else f.name for f in df.schema]
    )


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; used by reports that are compared across engines."""
    return df.selectExpr(
        *[
            f"round({f.name}, {digits}) + 0D AS {f.name}" if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema
        ]
    )
