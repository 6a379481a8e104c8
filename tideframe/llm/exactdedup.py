"""Exact duplicates by progressive refinement.

Texts are equal when they are identical after lower-casing A-Z only. Candidates are narrowed down before a text is read whole:

1. one scan takes the length of every text in bytes and a hash of its first ``HEAD`` characters; these few bytes a row are stored;
2. lengths that occur once are done; of the others, pairs of length and head that occur once are done too;
3. rows whose length and head recur are digested whole (SHA-256), and digests are grouped.

Lower-casing A-Z changes no length, so lengths need no normalised text. Groups are counted with partial aggregation
and joined back as one row each, so a group with a third of all rows is spread over all tasks. Texts themselves are
not shuffled while the recurring (length, head) pairs fit the session's broadcast threshold (their stored size is
known to the planner); beyond it the join moves each text once.

Defined cases: null texts are empty texts, and equal to one another; of rows that repeat both id and text exactly one
stays; rows without an id lose against any other (a group of such rows keeps one); an empty table gives no rows;
columns of any name are handed through, those named like added ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.llm.batches import in_batches
from tideframe.session import materialize

#: Characters of a text that are hashed before it is read whole.
HEAD = 128
ADDED = ("keep_id", "group_size", "kept", "text_sha256")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _refined(packed: DataFrame) -> DataFrame:
    """The packed rows with the length and the head of their text."""
    head = F.xxhash64(F.translate(F.substring("text", 1, HEAD), _UPPER, _LOWER))
    return packed.withColumns({"size": F.octet_length("text"), "head": head})


def recurring_heads(packed: DataFrame) -> DataFrame:
    """(size, head) of more than one row: lengths are grouped first, heads only among lengths that recur."""
    sketches = materialize(_refined(packed).select("size", "head"), "heads")
    sizes = materialize(sketches.groupBy("size").count().filter("count > 1").select("size"), "sizes")
    again = sketches.join(sizes, "size", "left_semi").groupBy("size", "head").count().filter("count > 1")
    return materialize(again.select("size", "head", F.lit(True).alias("open")), "heads")


def digest_rows(refined: DataFrame, every: bool) -> DataFrame:
    """row, doc_id, open, text_sha256: the digest of open rows, or of every row."""
    fields = [refined.schema[c] for c in ("row", "doc_id", "open")]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = pa.array([True] * batch.num_rows) if every else batch.column(2)
            texts = pc.ascii_lower(pc.if_else(wanted, batch.column(3), None)).cast(pa.binary())
            found = [None if not t.is_valid else hashlib.sha256(t.as_buffer()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string())], names=["row", "doc_id", "open", "text_sha256"])

    schema = T.StructType([*fields, T.StructField("text_sha256", T.StringType())])
    return in_batches(refined.select("row", "doc_id", "open", "text")).mapInArrow(digest, schema)


def duplicate_groups(docs: DataFrame, every_digest: bool = False) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256.

    The digest is null for texts that refinement shows to be the only ones of their kind, unless ``every_digest``.
    """
    names = [c for c in docs.columns if c not in ADDED]
    row = F.struct(*[docs[f"`{c.replace('`', '``')}`"] for c in names])
    packed = docs.select(row.alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    open_rows = _refined(packed).join(recurring_heads(packed), ["size", "head"], "left")
    open_rows = open_rows.withColumn("open", F.coalesce("open", F.lit(False)))
    # written once, so that the number given to a row is the same wherever it is read again
    rows = materialize(digest_rows(open_rows, every_digest).withColumn("place", F.monotonically_increasing_id()), "digests")
    candidates = rows.filter("open")
    groups = candidates.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "place")).alias("best"), F.count("*").alias("group_size"))
    groups = materialize(groups.filter("group_size > 1").select("text_sha256", "best", "group_size"), "groups")
    met = candidates.join(groups, "text_sha256", "left")
    alone = rows.filter("NOT open").withColumns({"best": F.lit(None).cast(groups.schema["best"].dataType), "group_size": F.lit(None).cast("long")})
    found = met.unionByName(alone)
    return found.select(
        "row.*",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("best").isNull() | (F.col("best.place") == F.col("place"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, one of each group of equal texts, with the columns they came with."""
    return duplicate_groups(docs).filter("kept").select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c not in ADDED])
