"""Phrase collocations from FM-indexes over word ids, one per shard of the corpus.

1. Texts of one language are gathered into shards of about ``SHARD_CHARS`` characters: a table of the shard's words and the
   sequence of word numbers, with a border between pieces. Words are counted over all shards.
2. Every shard learns which of its words are frequent in the corpus; the others become borders. An
   index of what is left counts pairs of words. Pairs that are not frequent in the corpus become borders too, and the
   bidirectional index of what is left then, two transforms of a fraction of the words, is stored.
3. Depth by depth, every shard extends the intervals of its frequent phrases by one word on both sides at once and hands out the
   counts of phrases whose first and last part are both frequent. A phrase is named by the numbers of its first part and its last
   part, so its key is two numbers at every depth, and a hash of the key deals phrases to parts of the corpus's phrases. A shard hands out
   one packed block of sorted keys and counts for each part. The blocks of a part meet once and are summed; the phrases that reach
   ``least`` get a number, and every shard gets back what its block holds of them.
4. The table of frequent phrases holds the counts of all heads and tails, so cuts are scored row by row; a phrase within a longer one of the same
   count is within one that is one word longer, so two joins find the phrases to drop.

No phrase is missed: a phrase has no more occurrences than any of its parts. Nothing is held for the whole corpus in one task: a
shard knows its own words and phrases only, and frequent words and phrases are tables.

Defined cases: null texts count as empty and texts without a word add nothing; a null language is ``und``; repeated rows and rows without an id
count each; texts longer than a shard are cut between words with an overlap of one word less than the longest phrase,
whose counts are taken off again; ties in the score are broken by count, then by the bytes of the phrase; an empty table has no
phrases; columns other than text and language are ignored. Numbers of phrases of one length stay below 2**31.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideframe.llm.batches import hand_back, in_batches
from tideframe.llm.fmindex import BidirectionalIndex, transform
from tideframe.session import discard, materialize

#: Characters of a shard. All texts a task waits with, of any language, are at most twice as many.
SHARD_CHARS = 5_000_000
#: Words of the corpus for each part of its phrases; a part has at most one phrase of each length for each of them.
PART_WORDS = 4_000_000
#: Phrases whose keys are alike but for so many lower bits go to the same part.
NEAR = 12
#: Buckets of words for each part; words are numbered within buckets.
BUCKETS = 64
MOST_WORDS, LEAST, TOP = 5, 100, 2000
NO_LANGUAGE = "und"

_BORDER = np.zeros(256, dtype=bool)
_BORDER[list(b".,;:!?\n\x0b\x0c\r")] = True
_BETWEEN = _BORDER.copy()
_BETWEEN[[32, 9]] = True
_WORD = re.compile(r"[^ \t.,;:!?\n\x0b\x0c\r]+")

#: Numbers of shards that hold overlaps, whose counts are taken off, are negative.
#: One row per shard with its sequence, its packed words and their counts, and how many words it has; one per word of it; one with
#: the numbers of its frequent words and the sequence of these and one per block of pairs; one with its transforms and one per block of phrases.
_SHARDS = "shard bigint, lang string, sequence binary, words binary, counts binary, n bigint"
_WORDS = "shard bigint, lang string, word string, place int, n bigint"
_PAIRS = "shard bigint, ids binary, sequence binary, part bigint, block binary"
_INDEXES = "shard bigint, forward binary, reverse binary, part bigint, block binary"
_GRAMS = "shard bigint, part bigint, block binary"
#: One row per block that goes back to its shard and one per frequent phrase.
_FREQUENT = "shard bigint, block binary, first bigint, last bigint, a bigint, id bigint"
#: Rows of a batch that a task hands out.
ROWS = 50_000


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_TYPES = {schema: [(n, _ARROW[t]) for n, t in map(str.split, schema.split(", "))] for schema in (_SHARDS, _WORDS, _PAIRS, _INDEXES, _GRAMS, _FREQUENT)}


def _batch(schema: str, rows: int, *values) -> pa.RecordBatch:
    """So many rows from columns; a single value stands in every row."""
    columns = []
    for value, (_, kind) in zip(values, _TYPES[schema], strict=True):
        if isinstance(value, (np.ndarray, pa.Array)):
            columns.append(pa.array(value).cast(kind))
        else:
            columns.append(pa.repeat(pa.scalar(value, kind), rows))
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in _TYPES[schema]])


def _compressed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _expanded(data: pa.Scalar) -> pa.Buffer:
    stored = data.as_buffer()
    return pa.decompress(stored.slice(8), int.from_bytes(stored.slice(0, 8).to_pybytes(), "little"), codec="zstd")


def _packed(symbols: np.ndarray) -> bytes:
    """Symbols byte by byte, compressed."""
    return _compressed(symbols.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: pa.Scalar) -> np.ndarray:
    return np.frombuffer(_expanded(data), dtype=np.uint8).reshape(4, -1).T.copy().view("<i4")[:, 0]


def _block(*columns: np.ndarray, rising: int = 1) -> bytes:
    """Columns of numbers, the first of them rising: the steps of these and the others byte by byte, compressed. The lower halves of a
    rising column, the last parts of keys, begin anew where the upper half changes."""
    table = np.array(columns, dtype="<i8")
    for column in table[:rising]:
        upper, lower = np.diff(column >> 32, prepend=0), column & 0xFFFFFFFF
        column[:] = upper << 32 | np.where(upper == 0, np.diff(lower, prepend=0), lower) & 0xFFFFFFFF
    return _compressed(table.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes())


def _columns(block: pa.Scalar, columns: int, rising: int = 1) -> np.ndarray:
    """The so many columns of a block."""
    table = np.frombuffer(_expanded(block), dtype=np.uint8).reshape(columns, 8, -1).transpose(0, 2, 1).copy().view("<i8")[:, :, 0]
    for column in table[:rising]:
        upper, lower = column >> 32, np.cumsum(column & 0xFFFFFFFF)
        anew = np.maximum.accumulate(np.where(upper == 0, 0, np.arange(len(column))))
        column[:] = np.cumsum(upper) << 32 | (lower - np.append(0, lower)[anew]) & 0xFFFFFFFF
    return table


def _all_columns(blocks: pa.ListScalar, columns: int, rising: int = 1) -> np.ndarray:
    return np.concatenate([_columns(b, columns, rising) for b in blocks.values], axis=1)


def _closed(sequence: np.ndarray) -> np.ndarray:
    """The sequence with one border where several follow one another, and one at the end of the circle."""
    return np.append(sequence[np.append(True, (sequence[1:] > 0) | (sequence[:-1] > 0))], np.int32(0)) if len(sequence) else np.zeros(1, np.int32)


def cut_text(text: str, limit: int, overlap: int) -> Iterator[tuple[str, int]]:
    """(part, sign): the text in parts of about ``limit`` characters, and the overlaps of parts with sign -1."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        if word := _WORD.match(text, end):  # never within a word
            end = word.end()
        start, found = end, []
        while len(found) <= overlap and start > at:  # look further back until there are words enough
            start = max(at, min(2 * start - end, start - 256))
            found = [m.start() + start for m in _WORD.finditer(text[start:end])]
        if len(found) > overlap:
            again = found[-overlap]
            yield text[at:end], 1
            yield text[again:end], -1
            at = again
        elif end >= len(text):
            break
        else:  # hardly a word in the whole part: the part grows
            limit *= 2
    yield text[at:], 1


def number_words(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of the texts, how often they occur, and the sequence of word numbers from 1, 0 at borders."""
    low = pc.ascii_lower(pa.array(["\n".join(texts)], pa.large_string())).cast(pa.large_binary())
    data = np.frombuffer(low[0].as_buffer(), dtype=np.uint8)
    inner = ~_BETWEEN[data]
    before = np.zeros_like(inner)
    before[1:] = inner[:-1]
    starts = np.flatnonzero(inner & ~before)
    if not len(starts):
        return pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int32)
    piece = np.cumsum(_BORDER[data], dtype=np.int64)[starts]
    offsets = np.append((np.cumsum(inner) - 1)[starts], inner.sum()).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inner])])
    coded = words.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + np.int32(1)
    new = np.append(True, piece[1:] != piece[:-1])
    place = np.arange(len(number)) + np.cumsum(new)
    sequence = np.zeros(len(number) + int(new.sum()), dtype=np.int32)
    sequence[place] = number
    return coded.dictionary.cast(pa.string()), np.bincount(number)[1:], sequence


def by_count(words: pa.Array, counts: np.ndarray, sequence: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words by falling count and by bytes where counts are equal, numbered anew: small numbers stand often, and words of a
    count lie beside words like them, so both pack well."""
    order = pc.array_sort_indices(words).to_numpy()
    order = order[np.argsort(-counts[order], kind="stable")]
    number = np.zeros(len(counts) + 1, dtype=np.int32)
    number[order + 1] = np.arange(1, len(counts) + 1)
    return words.take(pa.array(order)), counts[order], number[sequence]


def shard_documents(docs: DataFrame, text: str, lang: str, most: int) -> DataFrame:
    """Of every shard: the sequence of its word numbers (from 1), its words by number, and their counts."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, chars, made = {}, {}, TaskContext.get().partitionId() << 33

        def rows(key: tuple[str, int]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            made += 1
            shard, lang = made * key[1], key[0]
            words, counts, sequence = by_count(*number_words(waiting.pop(key)))
            chars.pop(key)
            if len(words):  # no word holds a line break
                yield _batch(_SHARDS, 1, shard, lang, _packed(sequence), _compressed("\n".join(words.to_pylist()).encode()), _block(counts), int(counts.sum()))
            hand_back()

        for batch in batches:
            for content, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part, sign in cut_text(content, SHARD_CHARS, most - 1):
                    key = (language, sign)
                    waiting.setdefault(key, []).append(part)
                    chars[key] = chars.get(key, 0) + len(part)
                    if chars[key] >= SHARD_CHARS:
                        yield from rows(key)
            while sum(chars.values()) > 2 * SHARD_CHARS:
                yield from rows(max(chars, key=chars.get))
        for key in list(waiting):
            yield from rows(key)

    read = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"))
    return in_batches(read.filter("text <> ''")).mapInArrow(shard, _SHARDS)


def shard_words(shards: DataFrame) -> DataFrame:
    """One row per word of a shard, with its number less one and its count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, counts = pa.array(_expanded(batch.column(2)[i]).to_pybytes().decode().split("\n"), pa.string()), _columns(batch.column(3)[i], 1)[0]
                for at in range(0, len(words), ROWS):
                    some = words[at : at + ROWS]
                    yield _batch(_WORDS, len(some), batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), some, np.arange(at, at + len(some), dtype=np.int32), counts[at : at + ROWS])

    return in_batches(shards.select("shard", "lang", "words", "counts")).mapInArrow(rows, _WORDS)


def _blocks(schema: str, shard: int, parts: int, first: np.ndarray, last: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Phrases of a shard, a block of keys and columns for each part; columns that belong to the shard's one other row are null."""
    key = first << 32 | last
    # phrases of a first part whose last parts have numbers in one range meet in one part: their steps are small
    part = ((key >> NEAR).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts
    order = np.lexsort((key, part))
    part, columns = part[order], [c[order] for c in (key, *columns)]
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    blocks = [_block(*[c[at:end] for c in columns]) for at, end in zip(starts, np.append(starts, len(part))[1:], strict=True)]
    others = [None] * (len(_TYPES[schema]) - 3)
    return _batch(schema, len(starts), shard, *others, part[starts], pa.array(blocks, pa.binary()))


def frequent_words(words: DataFrame, parts: int, least: int) -> DataFrame:
    """The rows of words with ``least`` occurrences over all shards, with these as ``a`` and a small number of the word as ``id``."""
    buckets = BUCKETS * parts
    dealt = words.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets)).cast("int")).repartition("bucket")
    occurrences = F.sum(F.col("n") * F.signum("shard").cast("int")).over(Window.partitionBy("bucket", "lang", "word"))
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    frequent = dealt.withColumn("a", occurrences).filter(F.col("a") >= least)
    return materialize(frequent.withColumn("id", (place.cast("long") - 1) * buckets + F.col("bucket")).drop("bucket"), "frequent")


def frequent_blocks(blocks: DataFrame, columns: int, parts: int, least: int, returned: list[int] | None = None, rising: int = 1) -> DataFrame:
    """Of blocks (shard, part, block of so many columns: key, size, ...): the phrases with ``least`` occurrences over all shards and
    their numbers, and for each block what it holds of them: the ``returned`` ones of key, size, ..., number (all if not told, the
    first ``rising`` of them rising as the keys and the numbers do; no rows if there are none)."""
    wanted = list(range(columns + 1)) if returned is None else returned

    def meet(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        shards, part = rows["shard"].to_pylist(), key[0].as_py()
        tables = [_columns(b, columns) for b in rows["block"]]
        keys = np.concatenate([t[0] for t in tables])
        order = np.argsort(keys, kind="stable")
        new = np.append(True, np.diff(keys[order]) > 0)
        keys = keys[order][new]
        sizes = np.concatenate([t[1] if shard > 0 else -t[1] for shard, t in zip(shards, tables, strict=True)])
        a = np.add.reduceat(sizes[order], np.flatnonzero(new))
        enough = a >= least
        ids = np.where(enough, (np.cumsum(enough) - 1) * parts + part, -1)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = ids[np.cumsum(new) - 1]
        back = []
        for shard, t, n in zip(shards, tables, np.split(number, np.cumsum([t.shape[1] for t in tables])[:-1]), strict=True):
            if wanted and n.max() >= 0:
                held = [*t[:, n >= 0], n[n >= 0]]
                back.append((shard, _block(*[held[c] for c in wanted], rising=rising)))
        keys, count = keys[enough], int(enough.sum())
        found = [_batch(_FREQUENT, count, None, None, keys >> 32, keys & 0xFFFFFFFF, a[enough], ids[enough])]
        found.append(_batch(_FREQUENT, len(back), pa.array([s for s, _ in back], pa.int64()), pa.array([b for _, b in back], pa.binary()), None, None, None, None))
        hand_back()
        return pa.Table.from_batches(found)

    return in_batches(blocks).groupBy("part").applyInArrow(meet, _FREQUENT)


def count_pairs(shards: DataFrame, held: DataFrame, parts: int) -> DataFrame:
    """Of every shard: its frequent words (``held``: shard, place, id) and their sequence, and the occurrences of every pair of them."""
    numbers = F.shiftleft(F.col("place").cast("long"), 32) + F.col("id")  # one number each, not a struct of two
    known = held.groupBy("shard").agg(F.collect_list(numbers).alias("known"))
    rows = shards.select("shard", "sequence").join(known, "shard").select("shard", "sequence", "known")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, sequence = batch.column(0)[i].as_py(), _unpacked(batch.column(1)[i])
                numbers = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                place, ids = numbers >> 32, numbers & 0xFFFFFFFF
                order = np.argsort(ids)
                symbol = np.zeros(int(sequence.max()) + 1, dtype=np.int32)
                symbol[place[order] + 1] = np.arange(1, len(place) + 1)
                ids, sequence = ids[order], _closed(symbol[sequence])
                both = BidirectionalIndex.of(sequence, 2)
                first, last, _, _, size = both.extend(*both.symbols(np.arange(1, len(ids) + 1)))
                yield _batch(_PAIRS, 1, shard, _block(ids), _packed(sequence), None, None)
                yield _blocks(_PAIRS, shard, parts, ids[first], ids[last], size)
                hand_back()

    return in_batches(rows).mapInArrow(count, _PAIRS)


def index_shards(sequences: DataFrame, held: DataFrame, most: int, parts: int) -> DataFrame:
    """The transforms of every shard over its frequent pairs (``held``: shard, block), and its phrases of three words."""
    known = held.groupBy("shard").agg(F.collect_list("block").alias("known"))
    rows = sequences.join(known, "shard").select("shard", "ids", "sequence", "known")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, sequence = batch.column(0)[i].as_py(), _unpacked(batch.column(2)[i]).astype(np.int64)
                ids = _columns(batch.column(1)[i], 1)[0]
                pair, number = _all_columns(batch.column(3)[i], 2, 2)
                width = len(ids) + 1
                key = (np.searchsorted(ids, pair >> 32) + 1) * width + np.searchsorted(ids, pair & 0xFFFFFFFF) + 1
                order = np.argsort(key)
                key, number = key[order], number[order]
                met = sequence[:-1] * width + sequence[1:]
                there = key[np.minimum(np.searchsorted(key, met), len(key) - 1)] == met
                # a border wherever a pair is not frequent; words without a frequent pair go
                used = np.append(there, False) | np.append(False, there)
                place = np.flatnonzero(used)
                after = np.append(there, False)[place]
                at = np.arange(len(place)) + np.append(0, np.cumsum(~after)[:-1])
                words, word = np.unique(sequence[place], return_inverse=True)
                kept = np.zeros(len(place) + int((~after).sum()), dtype=np.int32)
                kept[at] = word + 1
                forward, reverse = transform(kept, most), transform(kept[::-1], most)
                both = BidirectionalIndex(forward, reverse)
                first, last, low, back, size = both.extend(*both.symbols(np.arange(1, len(words) + 1)))
                name = number[np.searchsorted(key, words[first] * width + words[last])]
                first, last, low, _, size = both.extend(low, back, size)
                yield _batch(_INDEXES, 1, shard, _packed(forward), _packed(reverse), None, None)
                yield _blocks(_INDEXES, shard, parts, name[first], name[last], size, low)
                hand_back()

    return in_batches(rows).mapInArrow(index, _INDEXES)


def extend_shards(indexes: DataFrame, held: DataFrame, words: int, parts: int) -> DataFrame:
    """The phrases of every shard that are one word longer than its frequent ones of so many words (``held``: shard, block)."""
    known = held.groupBy("shard").agg(F.collect_list("block").alias("known"))
    rows = indexes.join(known, "shard").select("shard", "forward", "reverse", "known")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                both = BidirectionalIndex(*(_unpacked(batch.column(c)[i]) for c in (1, 2)))
                ids, size, low = _all_columns(batch.column(3)[i], 3)
                first, last, low, _, size = both.extend(low, both.low_reverse(low, words), size)
                yield _blocks(_GRAMS, batch.column(0)[i].as_py(), parts, ids[first], ids[last], size, low)
                hand_back()

    return in_batches(rows).mapInArrow(extend, _GRAMS)


def frequent_phrases(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, sizes): all phrases of up to ``most`` words with ``least`` occurrences or more, and the words of every language.

    phrases: lang, id, first, last (ids of the parts one word shorter, null for words), words, phrase, a, heads, tails (counts of the first and last 1, 2, ... words).
    """
    shards = materialize(shard_documents(docs, text, lang, most), "shards")
    sizes = materialize(shards.groupBy("lang").agg(F.sum(F.col("n") * F.signum("shard").cast("int")).alias("n")), "sizes")
    parts = 1 + (sizes.agg(F.sum("n")).first()[0] or 0) // PART_WORDS
    held = frequent_words(shard_words(shards), parts, least)
    none = F.lit(None).cast("long")
    level = held.groupBy("id").agg(*[F.first(c).alias(c) for c in ("lang", "word", "a")]).select(
        "lang", "id", none.alias("first"), none.alias("last"), F.lit(1).alias("words"), F.col("word").alias("phrase"), F.col("word").alias("last_word"),
        "a", F.array("a").alias("heads"), F.array("a").alias("tails"),
    )
    level = materialize(level, "phrases")
    levels = [level]
    for size in range(2, most + 1):
        if size == 2:
            pairs = stored = materialize(count_pairs(shards, held, parts), "pairs")
            discard(shards, held)
            sequences = stored.filter("sequence IS NOT NULL").select("shard", "ids", "sequence")
        elif size == 3:
            stored = materialize(index_shards(sequences, held, most, parts), "indexes")
            discard(pairs, found)
            indexes = stored.filter("forward IS NOT NULL").select("shard", "forward", "reverse")
        else:
            stored = materialize(extend_shards(indexes, held, size - 1, parts), "grams")
            discard(found)
        blocks = stored.filter("block IS NOT NULL").select("shard", "part", "block")
        # shards find pairs again by key, longer phrases by their place in the index; the longest are not extended
        columns, returned, rising = (2, [0, 2], 2) if size == 2 else (3, [3, 1, 2], 1)
        found = materialize(frequent_blocks(blocks, columns, parts, least, returned if size < most else [], rising), "frequent")
        held = found.filter("block IS NOT NULL").select("shard", "block")
        summed = found.filter("first IS NOT NULL").select("id", "first", "last", "a")
        first = level.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("head"), "heads")
        last = level.select(F.col("id").alias("last"), "last_word", "tails")
        level = summed.join(first, "first").join(last, "last").select(
            "lang", "id", "first", "last", F.lit(size).alias("words"), F.concat_ws(" ", "head", "last_word").alias("phrase"), "last_word",
            "a", F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"),
        )
        level = materialize(level, "phrases")
        levels.append(level)
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return phrases.drop("last_word"), sizes


def _best_cut() -> str:
    """The cut of least score, least k: struct (score, k, l, r); decimals of 38 digits hold the products."""
    whole = "CAST(1000 AS DECIMAL(4, 0)) * (CAST(a AS DECIMAL(16, 0)) * CAST(n AS DECIMAL(16, 0)))"
    parts = "CAST(heads[k - 1] AS DECIMAL(16, 0)) * CAST(tails[words - k - 1] AS DECIMAL(16, 0))"
    return f"array_min(transform(sequence(1, words - 1), k -> struct(CAST({whole} DIV ({parts}) AS BIGINT) AS score, k, heads[k - 1] AS l, tails[words - k - 1] AS r)))"


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language."""
    phrases, sizes = frequent_phrases(docs, least, most, text, lang)
    several = phrases.filter("words > 1")
    # a part of a longer phrase that occurs as often as the part alone
    longer = several.selectExpr("words - 1 AS words", "first AS id", "a").unionByName(several.selectExpr("words - 1 AS words", "last AS id", "a"))
    longer = longer.groupBy("words", "id").agg(F.max("a").alias("most"))
    kept = several.join(longer, ["words", "id"], "left").filter("most IS NULL OR 100 * most < 100 * a")
    scored = kept.join(sizes, "lang").selectExpr("lang", "phrase", "a", "n", f"{_best_cut()} AS cut")
    scored = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
