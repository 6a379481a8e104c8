"""Line deduplication with a log-template tree.

A line goes down a tree of fixed depth: number of words, then its first ``DEPTH`` words, where a word with a digit
is a variable. A line of which more than half are such words is all constant: rows of numbers differ by their numbers. At the leaf it has one template of all its words and, if ``FIELDS`` * 2 or more words are left and it is not such a row, one per
field: the rest of the line is cut into ``FIELDS`` parts, the first ``OPEN_WORDS`` words of a part (or all) are its field, and the
template leaves one field open, so a line never loses more than ``OPEN_WORDS`` words of its own. Lines that
differ in variables and in one field so meet in a template, without comparing lines in a leaf with one another.
A template recurs if ``LEAST_DOCS`` documents have it, that of a line of fewer than ``LEAST_LINE`` words if ``SHORT_DOCS`` have it. The document of least id keeps its line; the others lose theirs.

Lines are cut into templates once and the rows stored. Templates are counted with partial aggregation and the lines of recurring
ones are found by a join that can split hot templates, so no task gathers a leaf or a template.

Defined cases: null and empty texts have no lines to lose; lines without a word are never dropped;
repeats within one document stay; rows of one id count as one document, as do all rows without an id; blank lines
stay; a text that loses every line becomes empty; columns of any other name are handed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import column, in_batches, packed_row, row_schema
from tideframe.llm.tokens import SLICE_CHARS, _powers, hash_words, mix, sliced
from tideframe.session import materialize

DEPTH, FIELDS, OPEN_WORDS, LEAST_LINE, LEAST_DOCS, SHORT_DOCS = 3, 3, 8, 5, 2, 3
#: Stands for every variable word.
VARIABLE = np.uint64(0x5851F42D4C957F2D)
_COUNT = np.uint64(0xD6E8FEB86659FD93)
_FIELDS = np.arange(1, FIELDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)  # one per open field


def _blocks(text: str) -> Iterator[str]:
    """A text in runs of whole lines of about a slice."""
    at = 0
    while len(text) - at > SLICE_CHARS and (end := text.find("\n", at + SLICE_CHARS)) >= 0:
        yield text[at:end]
        at = end + 1
    yield text[at:]


def line_templates(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every line with a word: text number, line number in it, and templates, the exact one first.

    The third array has 1 + FIELDS columns and a mask of those that exist is returned as the fourth value; the last one
    tells lines of fewer than ``LEAST_LINE`` words.
    """
    ids, numbers, made, there, short = [], [], [], [], []
    for a, b in sliced(texts):
        whole = b - a == 1 and len(texts[a] or "") > 4 * SLICE_CHARS
        before = 0
        for part in ([[block] for block in _blocks(texts[a])] if whole else [texts[a:b]]):
            h, _, line, digits = hash_words(part, lines=True)
            counts = np.array([(t or "").count("\n") + 1 for t in part])
            text_of_line = np.repeat(np.arange(len(part)), counts)
            first_line = np.append(0, np.cumsum(counts)[:-1])
            if len(h):
                line = line.astype(np.int64)
                starts = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
                size = np.diff(np.append(starts, len(h)))
                place = np.arange(len(h)) - np.repeat(starts, size)
                constant = size - np.add.reduceat(digits.astype(np.int64), starts)
                worded = 2 * constant >= size
                h = np.where(digits & np.repeat(worded, size), VARIABLE, h)
                terms = h * _powers(int(size.max()) + 1)[1:][place]
                total = np.add.reduceat(terms, starts) + size.astype(np.uint64) * _COUNT
                rest = np.repeat(np.maximum(size - DEPTH, 1), size)
                part_of = (place - DEPTH) * FIELDS // rest
                opened = (place >= DEPTH) & (place - DEPTH + part_of * rest // -FIELDS < OPEN_WORDS)
                field = np.where(opened, part_of, -1)
                templates = [mix(total)]
                for f in range(FIELDS):
                    open_field = np.add.reduceat(np.where(field == f, terms, np.uint64(0)), starts)
                    templates.append(mix(total - open_field + _FIELDS[f]))
                own = line[starts]
                ids.append(text_of_line[own] + a)
                numbers.append(own - first_line[text_of_line[own]] + before)
                made.append(np.stack(templates, axis=1))
                there.append(np.stack([size >= 0] + [worded & (size >= DEPTH + 2 * FIELDS)] * FIELDS, axis=1))
                short.append(size < LEAST_LINE)
            before += int(counts.sum()) if whole else 0
    if not ids:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 1 + FIELDS), np.uint64), np.empty((0, 1 + FIELDS), bool), np.empty(0, bool)
    return np.concatenate(ids), np.concatenate(numbers), np.concatenate(made), np.concatenate(there), np.concatenate(short)


def template_rows(docs: DataFrame) -> DataFrame:
    """template, line (its exact template), doc_id, short (a line of few words): every template of every line."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                ids, _, made, there, short = line_templates(part.column(1).to_pylist())
                row, column = np.nonzero(there)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[row, column].view(np.int64)), pa.array(made[row, 0].view(np.int64)), part.column(0).take(pa.array(ids[row], pa.int64())), pa.array(short[row])],
                    names=["template", "line", "doc_id", "short"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", "text")).mapInArrow(cut, f"template bigint, line bigint, doc_id {id_type}, short boolean")


def recurring_lines(docs: DataFrame) -> DataFrame:
    """doc_id, lines: the exact templates of the lines that a document loses."""
    every = materialize(template_rows(docs), "templates")  # read three times
    rows = every.filter("NOT short")
    # different ids at least 2 <=> least and greatest differ; more are counted on (template, id)
    if LEAST_DOCS == 2:
        recurring = rows.groupBy("template").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("doc_id").alias("n"), F.count("*").alias("all_n"))
        recurring = recurring.filter("first_id <> last_id OR (n > 0 AND all_n > n)")
    else:
        recurring = rows.select("template", "doc_id").distinct().groupBy("template").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter(F.col("n") >= LEAST_DOCS)
    # on (template, id) rows without an id are one document
    few = every.filter("short").select("template", "doc_id").distinct().groupBy("template").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    recurring = recurring.select("template", "first_id").unionByName(few.filter(F.col("n") >= SHORT_DOCS).select("template", "first_id"))
    lost = every.join(recurring, "template").filter("NOT doc_id <=> first_id")
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def drop_recurring(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines`` and ``n_dropped`` (columns of these names are replaced)."""
    added = ("n_lines", "n_dropped")
    lost = materialize(recurring_lines(docs), "lines").withColumnRenamed("doc_id", "id")
    kept = [c for c in docs.columns if c not in added]
    packed = docs.select(F.col("doc_id").alias("key"), packed_row([c for c in kept if c != "text"]), F.col("text").alias("text"))
    joined = packed.join(lost, F.col("key").eqNullSafe(F.col("id")), "left").select("row", "text", "lines")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines = batch.column(1).to_pylist(), batch.column(2)
            totals = [text.count("\n") + 1 if text else 0 for text in texts]
            dropped = [0] * len(texts)
            touched = [i for i in range(len(texts)) if lines[i].is_valid and texts[i]]
            for a in range(0, len(touched), 500):
                some = touched[a : a + 500]
                ids, numbers, made, _, _ = line_templates([texts[i] for i in some])
                for k, i in enumerate(some):
                    low, high = np.searchsorted(ids, [k, k + 1])
                    lost_here = lines[i].values.to_numpy(zero_copy_only=False)
                    gone = set(numbers[low:high][np.isin(made[low:high, 0].view(np.int64), lost_here)].tolist())
                    texts[i] = "\n".join(line for n, line in enumerate(texts[i].split("\n")) if n not in gone)
                    dropped[i] = len(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "text", *added],
            )

    rebuilt = in_batches(joined).mapInArrow(rebuild, row_schema(packed, "text string, n_lines bigint, n_dropped bigint"))
    columns = [F.col("text") if c == "text" else column(c, "row.") for c in kept]
    return rebuilt.select(*columns, *added)
