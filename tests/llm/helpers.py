"""Small tables for the operators' tests."""

from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, start=0):
    """Documents with running ids from a list of texts, or (id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (start + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def with_odd_columns(frame, *names):
    """The frame with extra columns, named like what operators add or use inside."""
    return frame.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


def by_id(frame, key="doc_id"):
    found = {}
    for row in frame.collect():
        found.setdefault(row[key], []).append(row)
    return found


def plain(row: Row) -> dict:
    return row.asDict(recursive=True)
