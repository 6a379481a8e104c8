"""Memory of Python workers and of the driver's Python."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch: some megabytes of text, where the default of 10,000 rows is tens of them.
BATCH_ROWS = 2_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(frame: DataFrame) -> DataFrame:
    """The frame, after its session's Arrow batches are bounded; a lower setting stays."""
    conf = frame.sparkSession.conf
    if not 0 < int(conf.get(_SETTING)) <= BATCH_ROWS:
        conf.set(_SETTING, str(BATCH_ROWS))
    return frame


def column(name: str, within: str = "") -> Column:
    """The column of exactly this name, or the field of a struct, whatever characters it holds."""
    return F.col(within + "`" + name.replace("`", "``") + "`")


def packed_row(names: list[str]) -> Column:
    """The columns as one struct ``row``, so that they meet no others."""
    return F.struct(*[column(c).alias(c) for c in names]).alias("row")


def row_schema(packed: DataFrame, added: str) -> T.StructType:
    """The type of ``row`` and of added columns; types from text would not survive all names within the row."""
    return T.StructType([packed.schema["row"], *T.StructType.fromDDL(added).fields])


def hand_back() -> None:
    """Give freed memory back to the system; allocators keep it otherwise, beside a JVM that needs it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)
