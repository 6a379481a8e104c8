"""Convolutional toxicity classifier over hashed word embeddings.

A word is the sum of two embedding rows, one for its hash and one for the hash of its first bytes. Filters of widths
1 to 3 run over the words, their maxima over the text go through one logistic unit. Training (numpy, Adagrad) uses a
bounded sample of labelled rows; scoring runs in the tasks that read the texts, over whole texts and without a shuffle.
Thresholds are calibrated per language on all labelled rows that the fit did not use, whole texts of any length, counted
in tasks and weighted to the shares of all labelled rows; they are folded into the score, so that
0.5 is the border for every text. The language is guessed from the words of the text; columns other than the
text never enter a score.

Defined cases: null and empty texts get the score of a text without words; without labelled rows of both classes every
text scores 0; rows with a null id or null label are not learnt from, several labels of one id count as
their maximum; repeated and tied rows are scored each; columns of any other name are handed through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import hand_back, in_batches, packed_row, row_schema
from tideframe.llm.decontaminate import small
from tideframe.llm.tokens import hash_words, sliced

#: Bounds of the training sample: rows with label 1, rows with label 0, words of a row.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_WORDS = 4_000, 6_000, 3_000
BUCKET_BITS, SIZE, FILTERS, WIDTHS, PREFIX = 17, 8, 8, (1, 2, 3), 6
BUCKETS = 1 << BUCKET_BITS
PAD = 2 * BUCKETS
#: Words so rare in the sample say nothing about the class at the start.
LEAST_TEXTS = 4
#: Rows of each class that a threshold needs; with fewer kept out, all learnt rows calibrate the general one.
LEAST_CLASS = 10
#: Frequent words by which the language of a text is guessed.
FREQUENT = (
    ("the", "of", "and", "is", "was", "that", "for", "with"),
    ("der", "die", "und", "das", "ist", "von", "zu", "mit"),
    ("le", "les", "et", "des", "est", "une", "dans", "pour"),
    ("el", "los", "las", "del", "que", "por", "con", "una"),
)


def language_table() -> np.ndarray:
    """By bucket: 0, or 1 + the number of the language that has a frequent word there."""
    table = np.zeros(BUCKETS, dtype=np.int8)
    for k, words in enumerate(FREQUENT):
        table[(hash_words([" ".join(words)])[0] % np.uint64(BUCKETS)).astype(np.int64)] = k + 1
    return table


def word_ids(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows (word, prefix) with padding after each text, where texts start, and the guessed languages.

    The padding is as long as the widest filter, so a text without words still has one place for each filter.
    """
    words, borders, starts = hash_words(texts, prefix=PREFIX)
    n, pad = len(texts), max(WIDTHS)
    rows = (words % np.uint64(BUCKETS)).astype(np.int32)
    which = np.repeat(np.arange(n), np.diff(borders))
    place = np.arange(len(rows)) + pad * which
    by_word = np.full(len(rows) + pad * n, PAD, dtype=np.int32)
    by_start = by_word.copy()
    by_word[place] = rows
    by_start[place] = (starts % np.uint64(BUCKETS)).astype(np.int32) + BUCKETS
    seen = _LANGUAGES[rows]
    known = seen > 0
    votes = np.bincount(which[known] * len(FREQUENT) + seen[known] - 1, minlength=n * len(FREQUENT)).reshape(n, -1)
    return by_word, by_start, borders[:-1] + pad * np.arange(n), votes.argmax(axis=1)


def word_counts(by_word: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words of each text, without the padding of :func:`word_ids`."""
    return np.diff(np.append(starts, len(by_word))) - max(WIDTHS)


_LANGUAGES = language_table()


@dataclass
class ConvModel:
    """Weights; ``thresholds`` by language and ``slope`` turn the logit into a score with its border at 0.5."""

    embedding: np.ndarray
    kernels: list[np.ndarray]
    shift: np.ndarray
    out: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(FREQUENT)))
    slope: float = 1.0

    def pooled(self, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Filter values at all places, (places, filters); minus infinity where a filter would reach into the next text."""
        values = np.empty((len(vectors), FILTERS * len(WIDTHS)), dtype=np.float32)
        for k, width in enumerate(WIDTHS):
            block = vectors @ self.kernels[k][0]
            for j in range(1, width):
                block[:-j] += vectors[j:] @ self.kernels[k][j]
            values[:, k * FILTERS : (k + 1) * FILTERS] = block
        values += self.shift
        ends = np.append(starts[1:], len(vectors))
        for j in range(1, max(WIDTHS)):
            values[ends - j] = -np.inf
        return values

    def logits(self, by_word: np.ndarray, by_start: np.ndarray, starts: np.ndarray) -> np.ndarray:
        values = self.pooled(self.embedding[by_word] + self.embedding[by_start], starts)
        best = np.maximum(np.maximum.reduceat(values, starts, axis=0), 0)
        return best @ self.out + self.bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        scores = np.zeros(len(texts))
        for a, b in sliced(texts):
            by_word, by_start, starts, language = word_ids(texts[a:b])
            z = self.slope * (self.logits(by_word, by_start, starts) - self.thresholds[language])
            scores[a:b] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return scores.round(6)  # sums of floats differ in the last digits with the texts beside


def _start(by_word: np.ndarray, by_start: np.ndarray, starts: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> ConvModel:
    """First weights: two embedding columns hold how much more often a row's texts are toxic, the rest is random."""
    embedding = rng.normal(0, 0.05, (2 * BUCKETS + 1, SIZE)).astype(np.float32)
    embedding[:, :2] = 0
    base = labels.mean()
    seen = np.zeros((2, 2, len(embedding)))  # texts with the row: all, toxic; for words and for their starts
    for first in range(0, len(starts), 500):
        own = labels[first : first + 500]
        begin, end = starts[first], starts[first + 500] if first + 500 < len(starts) else len(by_word)
        text = np.repeat(np.arange(len(own)), np.diff(np.append(starts[first : first + 500], end)))
        for column, ids in enumerate((by_word, by_start)):
            pairs = np.unique(ids[begin:end].astype(np.int64) * len(own) + text)
            row, toxic = pairs // len(own), own[pairs % len(own)]
            seen[column] += np.bincount(row, minlength=len(embedding)), np.bincount(row, weights=toxic, minlength=len(embedding))
    for column, (n, toxic) in enumerate(seen):
        gain = np.log((toxic + 5 * base) / (n + 5)) - np.log(base)
        embedding[:, column] = np.where(n >= LEAST_TEXTS, np.maximum(gain, -0.5), 0)
    embedding[PAD] = 0
    kernels = [rng.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f, weights in enumerate(((1, 0), (0, 1), (0.7, 0.7))):
        kernels[0][0][:, f] = 0
        kernels[0][0][:2, f] = weights
    out = np.full(FILTERS * len(WIDTHS), 0.1, dtype=np.float32)
    out[:3] = 1
    shift = np.zeros(len(out), dtype=np.float32)
    shift[:3] = -0.5
    return ConvModel(embedding, kernels, shift, out, -2.0)


def _fit(model: ConvModel, by_word: np.ndarray, by_start: np.ndarray, starts: np.ndarray, labels: np.ndarray, rng: np.random.Generator, epochs: int, rate: float = 0.05) -> None:
    """Adagrad over batches of texts; a maximum passes its gradient on to the words under it only."""
    ends = np.append(starts[1:], len(by_word))
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    sums = {"embedding": np.full(len(model.embedding), 1e-2, dtype=np.float32)}

    def step(name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        total = sums.setdefault(name, np.full(value.shape, 1e-2, dtype=np.float32))
        total += gradient**2
        value -= rate * gradient / np.sqrt(total)

    bias = np.array([model.bias], dtype=np.float32)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 32)):
            at = np.concatenate([np.arange(starts[i], ends[i]) for i in batch])
            first = np.append(0, np.cumsum(ends[batch] - starts[batch])[:-1])
            last = np.append(first[1:], len(at))
            vectors = model.embedding[by_word[at]] + model.embedding[by_start[at]]
            values = model.pooled(vectors, first)
            best = np.stack([a + values[a:b].argmax(axis=0) for a, b in zip(first, last, strict=True)])
            top = values[best, np.arange(values.shape[1])]
            active = np.maximum(top, 0)
            z = active @ model.out + bias[0]
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
            into = error[:, None] * model.out * (top > 0)
            rows, changes = [], []
            for k, width in enumerate(WIDTHS):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                gradient = np.zeros_like(model.kernels[k])
                for j in range(width):
                    place = best[:, part] + j
                    inside = place < len(at)
                    place = np.minimum(place, len(at) - 1)
                    flow = into[:, part] * inside
                    gradient[j] = np.einsum("bf,bfd->df", flow, vectors[place])
                    moved = flow[:, :, None] * model.kernels[k][j].T[None]
                    for ids in (by_word, by_start):
                        rows.append(ids[at[place]].ravel())
                        changes.append(moved.reshape(-1, SIZE))
                step(f"kernel{k}", model.kernels[k], gradient + 1e-4 * model.kernels[k])
            step("out", model.out, error @ active + 1e-4 * model.out)
            step("shift", model.shift, into.sum(axis=0))
            step("bias", bias, np.array([error.sum()], dtype=np.float32))
            rows, where = np.unique(np.concatenate(rows), return_inverse=True)
            gradient = np.zeros((len(rows), SIZE), dtype=np.float32)
            np.add.at(gradient, where, np.concatenate(changes))
            gradient[rows == PAD] = 0
            sums["embedding"][rows] += (gradient**2).mean(axis=1)
            model.embedding[rows] -= rate * gradient / np.sqrt(sums["embedding"][rows])[:, None]
    model.bias = float(bias[0])


def best_threshold(z: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """Logit with the best F1, in the middle of the gap it falls into; every value counts ``weights`` times."""
    weights = np.ones(len(z)) if weights is None else weights
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum((weights * labels)[order])
    f1 = 2 * hits / (np.cumsum(weights[order]) + (weights * labels).sum())
    f1[:-1][z[order][:-1] == z[order][1:]] = -1  # no border between equal values
    k = int(f1.argmax())
    low = z[order][k + 1] if k + 1 < len(z) else z[order][k] - 1
    return float((z[order][k] + low) / 2)


@dataclass
class Sample:
    """Labelled texts as embedding rows, one after the other."""

    by_word: np.ndarray
    by_start: np.ndarray
    starts: np.ndarray
    language: np.ndarray
    labels: np.ndarray
    kept_out: np.ndarray

    def where(self, chosen: np.ndarray) -> "Sample":
        ends = np.append(self.starts[1:], len(self.by_word))
        sizes = (ends - self.starts)[chosen]
        words = np.repeat(chosen, ends - self.starts)
        starts = np.append(0, np.cumsum(sizes)[:-1])[: len(sizes)]
        return Sample(self.by_word[words], self.by_start[words], starts, self.language[chosen], self.labels[chosen], self.kept_out[chosen])


def _both(labels: np.ndarray, least: int = 1) -> bool:
    return min(labels.sum(), (1 - labels).sum()) >= least


def train(sample: Sample, epochs: int = 4, seed: int = 7) -> ConvModel | None:
    """Fit on the rows that are not kept out, calibrate on the others; None without both classes."""
    if not _both(sample.labels):
        return None
    fit = sample.where(~sample.kept_out)
    if not _both(fit.labels):
        fit = sample
    rng = np.random.default_rng(seed)
    model = _start(fit.by_word, fit.by_start, fit.starts, fit.labels, rng)
    _fit(model, fit.by_word, fit.by_start, fit.starts, fit.labels, rng, epochs)
    check = sample.where(sample.kept_out)
    if not _both(check.labels, LEAST_CLASS):
        check = sample
    y, language = check.labels, check.language
    z = np.concatenate([model.logits(*part) for part in _parts(check)])
    model.thresholds[:] = best_threshold(z, y)
    for k in range(len(FREQUENT)):
        own = language == k
        if _both(y[own], LEAST_CLASS):
            model.thresholds[k] = best_threshold(z[own], y[own])
    spread = np.median(np.abs(z - model.thresholds[language]))
    model.slope = float(2 / max(spread, 1e-3))
    return model


def _parts(sample: Sample, texts: int = 500) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The sample in runs of texts, which bounds the filter values held at once."""
    ends = np.append(sample.starts[1:], len(sample.by_word))
    for a in range(0, len(sample.starts), texts):
        starts = sample.starts[a : a + texts]
        words = slice(starts[0], ends[min(a + texts, len(ends)) - 1])
        yield sample.by_word[words], sample.by_start[words], starts - starts[0]


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learnt: crc32 of the id as text leaves a remainder by 5."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def kept_out(doc_id: Column) -> Column:
    """Learnable rows that the fit leaves to calibration."""
    return F.floor(F.crc32(doc_id.cast("string")) / 5) % 5 == 0


def calibrate(model: ConvModel, counts: pa.Table) -> None:
    """Thresholds and slope from counts ``n`` of (language, z, toxic, long, used).

    Rows the fit used are left out where the others suffice; the others weigh as much as all rows of their class and kind
    of length, so the shares are those of all labelled rows, whatever part of them the fit took.
    """
    language, z, y, long, used, n = (counts[c].to_numpy() for c in ("language", "z", "toxic", "long", "used", "n"))
    y = (y == 1).astype(np.float64)
    group = y.astype(np.int64) * 2 + long
    chosen = used == 0
    if min(n[chosen & (y == 1)].sum(), n[chosen & (y == 0)].sum()) < LEAST_CLASS:
        chosen = np.ones(len(n), dtype=bool)
    share = np.bincount(group, n, 4) / np.maximum(np.bincount(group[chosen], n[chosen], 4), 1)
    weights = (n * share[group])[chosen]
    language, z, y, n = language[chosen], z[chosen], y[chosen], n[chosen]
    model.thresholds[:] = best_threshold(z, y, weights)
    for k in range(len(FREQUENT)):
        own = language == k
        if min(n[own & (y == 1)].sum(), n[own & (y == 0)].sum()) >= LEAST_CLASS:
            model.thresholds[k] = best_threshold(z[own], y[own], weights[own])
    far = np.abs(z - model.thresholds[language])
    order = np.argsort(far)
    reached = np.cumsum(weights[order])
    model.slope = float(2 / max(far[order][np.searchsorted(reached, reached[-1] / 2)], 1e-3))


def calibration_counts(docs: DataFrame, known: DataFrame, chosen: DataFrame, model: ConvModel) -> pa.Table:
    """Counts of all labelled rows by (language, rounded logit, toxic, longer than a sample row, used by the fit)."""
    ids = chosen.select("doc_id", F.lit(1).alias("drawn"))
    marked = known.join(ids, "doc_id", "left").select("doc_id", "toxic", (F.col("drawn").isNotNull() & ~kept_out(F.col("doc_id"))).alias("fitted"))
    rows = docs.select("doc_id", "text").join(small(marked), "doc_id")
    rows = rows.select("text", F.col("toxic").cast("int").alias("toxic"), F.col("fitted").cast("int").alias("fitted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            z, language, long = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int32), np.zeros(len(texts), dtype=np.int32)
            for a, b in sliced(texts):
                *part, language[a:b] = word_ids(texts[a:b])
                z[a:b] = shared.value.logits(*part)
                long[a:b] = word_counts(part[0], part[2]) > SAMPLE_WORDS
            used = np.where(long == 1, 0, batch.column(2).to_numpy())
            columns = [pa.array(language), pa.array(z.round(3)), batch.column(1), pa.array(long), pa.array(used)]
            yield pa.RecordBatch.from_arrays(columns, names=["language", "z", "toxic", "long", "used"])

    found = in_batches(rows).mapInArrow(logits, "language int, z double, toxic int, long int, used int")
    return found.groupBy("language", "z", "toxic", "long", "used").agg(F.count("*").alias("n")).orderBy("z", "language", "toxic", "long", "used").toArrow()


def fit_from(docs: DataFrame, labels: DataFrame) -> ConvModel | None:
    """Model from a bounded sample of the labelled rows, those with the least hash of their id; thresholds from all others."""
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    known = labels.filter(F.col("toxic").isNotNull() & learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = (
        known.filter("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(known.filter("toxic <> 1").orderBy(*order).limit(SAMPLE_CLEAN))
    )
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2).to_pylist()
            for a, b in sliced(column):
                by_word, by_start, starts, language = word_ids(column[a:b])
                offsets = pa.array(np.append(starts, len(by_word)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(rows)) for rows in (by_word, by_start)]
                part = batch.slice(a, b - a)
                rows = pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(language.astype(np.int32)), *lists], names=["doc_id", "toxic", "language", "by_word", "by_start"]
                )
                yield rows.filter(pa.array(word_counts(by_word, starts) <= SAMPLE_WORDS))

    types = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic int, language int, by_word array<int>, by_start array<int>"
    # to the driver: at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two integers a word
    found = in_batches(texts.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")).mapInArrow(ids, types).toArrow().combine_chunks()
    model = train(_sample(found)) if found.num_rows else None
    del found
    if model is not None:
        calibrate(model, calibration_counts(docs, known, chosen, model))
    hand_back()
    return model


def _sample(found: pa.Table) -> Sample:
    """Rows by id; ids of one text stand together, so the order of arrival does not matter."""
    found = found.sort_by("doc_id").combine_chunks()
    lists = [found[c].chunk(0) for c in ("by_word", "by_start")]
    sizes = np.diff(lists[0].offsets.to_numpy())
    return Sample(
        *[column.flatten().to_numpy() for column in lists],
        np.append(0, np.cumsum(sizes)[:-1]),
        found["language"].to_numpy(),
        (found["toxic"].to_numpy() == 1).astype(np.float64),
        np.array([zlib.crc32(str(i).encode()) // 5 % 5 == 0 for i in found["doc_id"].to_pylist()], dtype=bool),
    )


def score_documents(docs: DataFrame, model: ConvModel | None) -> DataFrame:
    """Adds ``score`` and ``predicted`` to every row; a column with the name of an added one is replaced."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    packed = docs.select(packed_row(kept), F.col("text").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(batch.column(1).to_pylist()) if shared.value else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    scored = in_batches(packed).mapInArrow(score, row_schema(packed, "score double"))
    return scored.select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels and score every row."""
    return score_documents(docs, fit_from(docs, labels))
