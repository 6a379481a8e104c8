"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words of a window at the places that a fixed mask keeps; the places it ignores may hold any word,
so a hit survives substitutions there. Seeds of the items and of the documents are joined. For every hit, document
and item are compared word by word along the hit's diagonal, and the best stretch counts, with a mismatch costing as much as
``MISMATCH`` matches. A document leaks an item if that stretch has ``IDENTITY`` equal words and covers ``LEAST_WORDS`` words,
or the whole item where it is shorter; or if ``IDENTITY`` of the item's words stand on the diagonal, wherever the others are.
Items of up to ``SHORT`` words have seeds of few words besides, so that one is left whatever words are replaced.

Documents are read once; what leaves that pass are documents with a seed in a bitmap of the items' seeds. The bitmap has
a fixed size (``BITS``), whatever the tables hold: more items only let more documents through to the exact join.

Defined cases: null and empty texts and items leak nothing; items below five words are found through windows of
their whole length; items that differ in case or punctuation only are equal; repeated rows are reported each; with several
stretches, the longest one is reported, the first of equal ones; other columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import in_batches
from tideframe.llm.tokens import SLICE_CHARS, _powers, each_text, hash_words, mix, sliced
from tideframe.session import materialize

#: Fixed masks of eleven words.
MASKS = ("11101100111", "11011010111", "11100111011")
SPAN = len(MASKS[0])
LEAST_WORDS, IDENTITY, MISMATCH = 13, 0.8, 3
BITS = 1 << 23
SHORT = 25
_FACTORS = _powers(SPAN + 1)[1:]


def masks_for(n: int) -> list[str]:
    """Masks of an item of ``n`` words; up to ``SHORT`` words, one of its seeds outlasts any substitutions that leave a leak."""
    lost = n - int(np.ceil(IDENTITY * n - 1e-9))
    if not lost:
        return ["1" * n]
    if n < 10:  # of three parts two are kept: one substitution leaves two whole
        parts = [3 * p // n for p in range(n)]
        return ["".join("0" if part == left_out else "1" for part in parts) for left_out in range(3)]
    run = -(-(n - lost) // (lost + 1))  # the longest run left is no shorter
    return [*(MASKS if n >= SPAN else ()), *(["1" * run] if n <= SHORT else ())]


def seeds_of(h: np.ndarray, mask: str) -> np.ndarray:
    """One seed per window of the mask's length."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, int(mask, 2) + (len(mask) << 32), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j, keep in enumerate(mask):
        if keep == "1":
            total += h[j : j + n] * _FACTORS[j]
    return mix(total)


def bit_places(seeds: np.ndarray) -> list[np.ndarray]:
    """Four places in the bitmap."""
    return [(seeds >> np.uint64(16 * k) ^ seeds >> np.uint64(40 - 8 * k)) % np.uint64(BITS) for k in range(4)]


def item_seeds(items: DataFrame) -> DataFrame:
    """item (digest of the words), words, place, seed: one row per seed of every different item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = [], []
            for i, h in each_text(batch.column(1).to_pylist()):
                if len(h):
                    ids.append(i)
                    words.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(words, pa.list_(pa.int64()))], names=["item_id", "words"]
            )

    id_type = items.schema["item_id"].dataType.simpleString()
    return in_batches(items.select("item_id", "text")).mapInArrow(cut, f"item_id {id_type}, words array<bigint>")


def _seed_rows(words: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, seeds, places = [], [], []
            for i in range(batch.num_rows):
                h = batch.column(1)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                for mask in masks_for(len(h)):
                    found = seeds_of(h, mask)
                    keys.append(np.full(len(found), i))
                    seeds.append(found.view(np.int64))
                    places.append(np.arange(len(found), dtype=np.int32))
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (keys, seeds, places)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()), pa.array(columns[2].astype(np.int32))],
                names=["item", "seed", "place"],
            )

    return in_batches(words.select("item", "words")).mapInArrow(cut, "item string, seed bigint, place int")


def bitmap_of(seeds: DataFrame) -> np.ndarray:
    """All seeds in ``BITS`` bits; the tasks combine bits into words of 64, so at most BITS / 64 rows reach the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(np.concatenate(bit_places(batch.column(0).to_numpy().view(np.uint64)))).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found >> 6), pa.array(np.left_shift(np.uint64(1), (found & 63).astype(np.uint64)).view(np.int64))], names=["slot", "bits"]
            )

    parts = in_batches(seeds.select("seed")).mapInArrow(places, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(BITS // 64, dtype=np.uint64)
    bitmap[parts["slot"].to_numpy()] = parts["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(bool) if len(parts) else np.zeros(BITS, dtype=bool)


def best_stretch(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(first place in the document, length, equal words) of the best stretch where doc[i + diagonal] stands for item[i]."""
    first = max(0, -diagonal)
    last = min(len(item), len(doc) - diagonal)
    if last <= first:
        return 0, 0, 0
    equal = doc[first + diagonal : last + diagonal] == item[first:last]
    sums = np.append(0, np.cumsum(np.where(equal, 1, -MISMATCH)))
    gain = sums - np.minimum.accumulate(sums)
    end = len(gain) - 1 - int(gain[::-1].argmax())  # of equal stretches the longest
    start = int(sums[: end + 1].argmin())
    return first + diagonal + start, end - start, int(equal[start:end].sum())


def whole_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(first place in the document, length, equal words) of all of the item that lies inside the document."""
    first, last = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if last <= first:
        return 0, 0, 0
    return first + diagonal, last - first, int((doc[first + diagonal : last + diagonal] == item[first:last]).sum())


def document_hits(docs: DataFrame, bitmap: np.ndarray, short: list[str]) -> DataFrame:
    """doc_id, words, seeds, places of every document with a seed in the bitmap; ``short``: masks of short items."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap, bitorder="little"))
    masks = [*MASKS, *short]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value, bitorder="little").view(bool)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in sliced(texts):
                if b - a == 1 and len(texts[a] or "") > 4 * SLICE_CHARS:
                    (_, h), borders = next(each_text(texts[a:b])), None
                    borders = np.array([0, len(h)])
                else:
                    h, borders = hash_words(texts[a:b])
                of = np.repeat(np.arange(b - a), np.diff(borders))
                seeds, places = [], []
                for mask in masks:
                    found = seeds_of(h, mask)
                    at = np.flatnonzero(of[: len(found)] == of[len(mask) - 1 :]) if len(found) else np.empty(0, np.int64)
                    for k in range(4):
                        at = at[bits[bit_places(found[at])[k]]]
                    seeds.append(found[at])
                    places.append(at)
                seed, place = np.concatenate(seeds), np.concatenate(places)
                hit = np.unique(of[place])
                rows = [np.flatnonzero(of[place] == i) for i in hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(hit + a, pa.int64())),
                        pa.array([h[borders[i] : borders[i + 1]].view(np.int64) for i in hit], pa.list_(pa.int64())),
                        pa.array([seed[r].view(np.int64) for r in rows], pa.list_(pa.int64())),
                        pa.array([(place[r] - borders[i]).astype(np.int32) for i, r in zip(hit, rows, strict=True)], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "words", "seeds", "places"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    types = f"doc_id {id_type}, words array<bigint>, seeds array<bigint>, places array<int>"
    return in_batches(docs.select("doc_id", "text")).mapInArrow(search, types)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal of every item that a document holds."""
    cut = item_seeds(benchmark).withColumn("item", F.md5(F.concat_ws(",", F.col("words").cast("array<string>"))))
    named = materialize(cut, "items")
    items = named.select("item", "words").dropDuplicates(["item"])
    seeds = materialize(_seed_rows(items), "seeds")
    short = [r[0] for r in named.select(F.size("words").alias("n")).filter(F.col("n") <= SHORT).distinct().collect()]  # SHORT lengths at most
    short = {m for n in short for m in masks_for(n)} - set(MASKS)
    hits = document_hits(docs, bitmap_of(seeds), sorted(short)).withColumn("key", F.monotonically_increasing_id())
    hits = materialize(hits, "hits")  # keys stay as written
    pairs = (
        hits.select("key", F.explode(F.arrays_zip("seeds", "places")).alias("hit"))
        .select("key", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at"))
        .join(seeds, "seed")
        .groupBy("key", "item")
        .agg(F.collect_set(F.col("at") - F.col("place")).alias("diagonals"))
    )
    full = (
        pairs.join(hits.select("key", "doc_id", F.col("words").alias("doc_words")), "key")
        .join(items.withColumnRenamed("words", "item_words"), "item")
        .select("doc_id", "item", "diagonals", "doc_words", "item_words")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i in range(batch.num_rows):
                doc, item = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (3, 4))
                diagonals = sorted(batch.column(2)[i].as_py())
                stretches = [s for s in (best_stretch(doc, item, d) for d in diagonals) if s[1] >= min(LEAST_WORDS, len(item)) and s[2] >= IDENTITY * s[1]]
                if not stretches:
                    stretches = [s for s in (whole_overlap(doc, item, d) for d in diagonals) if s[2] and s[2] >= IDENTITY * len(item) - 1e-9]
                if stretches:
                    rows.append(i)
                    found.append(max(stretches, key=lambda s: (s[1], -s[0])))
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
            taken = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, *columns], names=["doc_id", "item", "first_word", "n_words", "n_equal"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    leaks = in_batches(full).mapInArrow(check, f"doc_id {id_type}, item string, first_word bigint, n_words bigint, n_equal bigint")
    return leaks.join(named.select("item", "item_id"), "item").select("doc_id", "item_id", "first_word", "n_words", "n_equal")


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item; all columns stay. Rows share the fate of other rows of their id."""
    leaks = materialize(find_leaks(docs, benchmark).select(F.col("doc_id").alias("leaking")).distinct(), "leaks")
    return docs.join(small(leaks), docs["doc_id"].eqNullSafe(leaks["leaking"]), "left_anti")


#: Rows of a two-column table that may be broadcast (some 16 MB).
BROADCAST_ROWS = 500_000


def small(frame: DataFrame) -> DataFrame:
    """A hint to broadcast a stored table of ids, if its counted rows are within the bound."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame
