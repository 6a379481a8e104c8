"""The corpus pipeline: stages over ``documents``, each stored as Parquet before the next one reads it.

Every stage takes (spark, docs, sf_dir) and hands on the columns of ``docs`` as they were, whatever they are called; the last
one adds the tokens. Decisions take effect: rejected documents go, dropped lines leave the text (and
``n_chars`` follows; a document of dropped lines only goes), one document of each class of copies stays, documents that hold a benchmark item go.

Defined cases are those of the operators; in all stages null texts count as empty, repeated rows are judged
each by the same rule, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm import bpe, decontaminate, linededup, neardup, toxicity
from tideframe.llm.batches import column, packed_row
from tideframe.session import materialize


def _packed(docs: DataFrame) -> DataFrame:
    """The row as one struct beside what operators read, so that their columns meet no others."""
    return docs.select(packed_row(docs.columns).alias("document"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones, does not reject."""
    model = toxicity.fit_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(_packed(docs), model).filter("predicted = 0").select("document.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur in documents of lower id; one that has no line left goes."""
    left = linededup.drop_recurring(_packed(docs)).filter("n_dropped = 0 OR trim(text) <> ''")
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return left.select(*[new.get(c, column(c, "document.")).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of exact and near copies."""
    return neardup.drop_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and the digests of what is left."""
    encoded = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]
#: A trained classifier, order sketches and merges have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, "documents")
    return docs
