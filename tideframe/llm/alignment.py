"""Alignment of two tokenizers over the same text, by lockstep merging.

Both tokenizers encode a text; the places where a token of each ends are cuts, and cuts make groups: the
shortest stretches that both write with whole tokens. Every token of A in a group is linked with every token of B in it.

* **Lockstep.** The documents of a batch are lanes (a long one has several, of ``LANE_BYTES`` each, so that no lane outlasts the
  others by much). One vector of pointers into the tokens of A and one into those of B advance together: a step moves whichever
  token ends first, in all lanes at once, emits a cut with the group that it closes where both end, and drops the lanes that are done.
* **Links** of a document are counted per id pair. Groups that one text never cuts are taken as different ids and how often
  they occur, by ranges of A ids, so that a group of any size needs bounded memory.
* **Corpus counts.** Documents are gathered into slices of about ``SLICE_LINKS`` id pairs; a slice is one row that holds each of its pairs
  once, with the number of its documents that have it. Pairs are summed across slices, the counts go back to the slices that
  hold the pair, and a document adds up what its links count. So a pair crosses the network once per slice, not once per document;
  nothing is broadcast but tables that the planner knows to be small. A task holds one slice with its counts at a time, whatever
  the table and its files measure; texts travel with their documents only if they are asked for.

Defined cases: null and empty texts, and texts that one tokenizer does not write back as it read them, have no tokens: zeros,
an empty ``groups_sha256``; special tokens are plain text; repeated rows count as documents each; ties for the
highest count are all best; an empty table gives no rows; columns of any name are handed through, those named like added ones are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.llm.batches import hand_back, in_batches
from tideframe.session import materialize

#: Bytes of a lane, characters encoded together, id pairs of a slice, links of a document above which groups are taken by ranges of ids.
LANE_BYTES, BATCH_CHARS, SLICE_LINKS, MANY_LINKS = 1024, 400_000, 500_000, 1_000_000
#: Documents of a slice, and characters of texts handed through with them.
SLICE_ROWS, SLICE_CHARS = 20_000, 8_000_000
#: A slice is a row of about a megabyte: the writer looks at its buffers after each, not after 100, and a group of rows stays small,
#: as readers hold it whole.
STORED = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
#: White characters in a row above which the slower of two equal libraries encodes a text.
LONG_SPACE = 20_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")
ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_of_character() -> dict[str, int]:
    """The bytes behind the characters of byte-level vocabularies: printable ones stand for themselves, others follow from U+0100."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The bytes of every token of one tokenizer, as a table and as lengths."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)

    def write(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class ByteLevel(Vocabulary):
    """A byte-level BPE vocabulary file. Where token ids follow the order of merges, ranks are ids and the faster library encodes."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of, vocabulary = byte_of_character(), model["vocab"]
        library = tokenizers.Tokenizer.from_file(path)
        tokens = [b""] * library.get_vocab_size()
        for token, number in vocabulary.items():
            tokens[number] = bytes(byte_of[c] for c in token)
        super().__init__(tokens)
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged == sorted(set(merged)) and (not merged or merged[0] == 256):
            ranks = {tokens[number]: number for number in vocabulary.values()}
            self.fast = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        else:
            self.fast = None
        library.encode_special_tokens = True
        self.library = library

    def encode(self, text: str) -> list[int]:
        # the faster library cannot split runs of about a million white characters
        if self.fast is None or (len(text) > LONG_SPACE and _LONG_SPACE.search(text)):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces(Vocabulary):
    """A sentence-piece model with bytes for what it has no piece for."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            tokens.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode())
        super().__init__(tokens)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


_LOADED: dict[tuple[str, str, str], tuple[Vocabulary, Vocabulary, list[str]]] = {}


def load(path_a: str, pattern: str, path_b: str) -> tuple[Vocabulary, Vocabulary, list[str]]:
    """Both tokenizers of this worker process and the decimal names of their ids with each separator; built once."""
    key = (path_a, pattern, path_b)
    if key not in _LOADED:
        a, b = ByteLevel(path_a, pattern), Pieces(path_b)
        most = max(len(a.tokens), len(b.tokens))
        _LOADED[key] = a, b, [f"{i}{end}" for end in (",", "|", ";", "") for i in range(most)]
    return _LOADED[key]


def unload() -> None:
    """Free the tokenizers of this worker process, which later steps do not need; it is handed the next tasks too."""
    if _LOADED:
        _LOADED.clear()
        hand_back()


def lockstep_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lane_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) at every place where both end, in order.

    Ends ascend over all lanes; a lane begins where the one before ends.
    """
    a, b = (np.searchsorted(e, np.append(0, lane_ends)[:-1], "right") for e in (ends_a, ends_b))
    last_a, last_b = (np.searchsorted(e, lane_ends, "right") for e in (ends_a, ends_b))
    cuts_a, cuts_b = [], []
    while True:
        going = (a < last_a) & (b < last_b)
        if not going.all():
            a, b, last_a, last_b = a[going], b[going], last_a[going], last_b[going]
        if not len(a):
            break
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cuts_a.append(a[both])
        cuts_b.append(b[both])
        a = a + (end_a <= end_b)
        b = b + (end_b <= end_a)
    if not cuts_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def lanes(sizes: np.ndarray) -> np.ndarray:
    """Ends of the lanes of documents of so many bytes each."""
    parts = -(-sizes // LANE_BYTES)
    start = np.repeat(np.cumsum(sizes) - sizes, parts)
    within = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.minimum(start + (within + 1) * LANE_BYTES, np.repeat(np.cumsum(sizes), parts))


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the part, and place in it, for parts of so many items."""
    part = np.repeat(np.arange(len(sizes)), sizes)
    return part, np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[start], np.add.reduceat(weights[order], start) if len(keys) else weights


def pairs_by_ranges(ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, links) of one document by ascending ranges of A ids; no pair is in two of them."""
    groups = len(sizes_a)
    key_a, often_a = np.unique(ids_a * groups + np.repeat(np.arange(groups), sizes_a), return_counts=True)
    key_b, often_b = np.unique(np.repeat(np.arange(groups), sizes_b) * width + ids_b, return_counts=True)
    id_a, group_a = np.divmod(key_a, groups)
    first_b = np.searchsorted(key_b, np.arange(groups + 1) * width)
    met = np.diff(first_b)[group_a]
    new = np.append(True, id_a[1:] != id_a[:-1])
    steps = np.flatnonzero(new)
    load_of = np.add.reduceat(met, steps)
    part = np.cumsum(load_of) // MANY_LINKS
    borders = np.append(steps[np.append(True, part[1:] != part[:-1])], len(id_a))
    for low, high in zip(borders, borders[1:], strict=False):
        entry, within = _spread(met[low:high])
        at = first_b[group_a[low:high]][entry] + within
        yield _summed(id_a[low:high][entry] * width + key_b[at] % width, often_a[low:high][entry] * often_b[at])


def align_texts(texts: list[str | None], a: Vocabulary, b: Vocabulary, names: list[str]) -> tuple[dict[str, list], list[list[tuple[np.ndarray, np.ndarray]]]]:
    """Of every text: its counts and digest, and its different (pairs, links) in one or more ranges of pairs; a pair is A id * size of B + B id."""
    width, most = len(b.tokens), len(names) // 4
    kept, all_a, all_b, sizes = [], [], [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        data = (" " + text).encode("utf-8", "surrogatepass")
        ids_a, ids_b = a.encode(" " + text), b.encode(text)
        if a.write(ids_a) == data and b.write(ids_b) == data:
            kept.append(i)
            all_a.append(ids_a)
            all_b.append(ids_b)
            sizes.append(len(data))
    facts = {name: [0] * len(texts) for name in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": [""] * len(texts)}
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
    if not kept:
        return facts, found
    count_a, count_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (all_a, all_b))
    ids_a, ids_b = (np.concatenate([np.array(x, dtype=np.int64) for x in side]) for side in (all_a, all_b))
    cut_a, cut_b = lockstep_cuts(np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b]), lanes(np.array(sizes, dtype=np.int64)))
    in_a, in_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    doc_ends = np.searchsorted(cut_a, np.cumsum(count_a))  # every document ends with a cut
    n_groups = np.diff(doc_ends, prepend=0)
    links = np.add.reduceat(in_a * in_b, doc_ends - n_groups)

    # ids in the order of groups, A before B, each with the sign that follows it
    group_a, group_b = np.repeat(np.arange(len(cut_a)), in_a), np.repeat(np.arange(len(cut_a)), in_b)
    line = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    end_a, end_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
    end_a[cut_a] = 1
    end_b[cut_b] = 2
    end_b[np.cumsum(count_b) - 1] = 3
    line[np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group_a]] = ids_a + end_a * most
    line[np.arange(len(ids_b)) + np.cumsum(in_a)[group_b]] = ids_b + end_b * most

    # links of documents with not too many of them at once
    few = links <= MANY_LINKS
    group_doc = np.repeat(np.arange(len(kept)), n_groups)
    taken = np.flatnonzero(few[group_doc])
    entry, within = _spread((in_a * in_b)[taken])
    group, left, right = taken[entry], (cut_a - in_a + 1)[taken][entry], (cut_b - in_b + 1)[taken][entry]
    step, rest = np.divmod(within, in_b[group])
    key = np.sort((group_doc[group] * len(a.tokens) + ids_a[left + step]) * width + ids_b[right + rest])
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    often = np.diff(np.append(start, len(key)))
    doc, pair = np.divmod(key[start], len(a.tokens) * width)
    borders = np.searchsorted(doc, np.arange(len(kept) + 1))

    starts_a, starts_b, starts_line = (np.cumsum(c) - c for c in (count_a, count_b, count_a + count_b))
    for k, i in enumerate(kept):
        facts["n_a"][i], facts["n_b"][i], facts["n_groups"][i], facts["n_links"][i] = int(count_a[k]), int(count_b[k]), int(n_groups[k]), int(links[k])
        codes = line[starts_line[k] : starts_line[k] + count_a[k] + count_b[k]].tolist()
        facts["groups_sha256"][i] = hashlib.sha256("".join(map(names.__getitem__, codes)).encode()).hexdigest()
        if few[k]:
            found[i] = [(pair[borders[k] : borders[k + 1]], often[borders[k] : borders[k + 1]])]
        else:
            own = slice(doc_ends[k] - n_groups[k], doc_ends[k])
            found[i] = list(pairs_by_ranges(ids_a[starts_a[k] : starts_a[k] + count_a[k]], ids_b[starts_b[k] : starts_b[k] + count_b[k]], in_a[own], in_b[own], width))
    return facts, found


def _column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _packed(values: np.ndarray, dtype: str) -> bytes:
    return pa.compress(values.astype(dtype).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: pa.Scalar, size: int, dtype: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data.as_buffer(), decompressed_size=size * np.dtype(dtype).itemsize, codec="zstd"), dtype=dtype)


_FACTS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]


class _Slice:
    """Documents of a slice, in parts: a part is a row of the slice with some of the document's pairs."""

    def __init__(self):
        self.rows, self.facts, self.whole, self.pairs, self.links, self.size, self.chars = [], [], [], [], [], 0, 0

    def full(self) -> bool:
        return self.size >= SLICE_LINKS or len(self.rows) >= SLICE_ROWS or self.chars >= SLICE_CHARS

    def add(self, row: pa.Array, facts: list, whole: int | None, pairs: np.ndarray, links: np.ndarray, chars: int) -> None:
        self.rows.append(row)
        self.facts.append(facts)
        self.whole.append(whole)
        self.pairs.append(pairs)
        self.links.append(links)
        self.size += len(pairs)
        self.chars += chars

    def batch(self, number: int, kind: pa.StructType) -> pa.RecordBatch:
        counts = np.array([len(p) for p in self.pairs], dtype=np.int64)
        every = np.concatenate(self.pairs)
        different, places, docs = np.unique(every, return_inverse=True, return_counts=True)
        # places ascend within a part; differences are small
        steps = np.diff(places, prepend=0)
        first = (np.cumsum(counts) - counts)[counts > 0]
        steps[first] = places[first]
        parts = [pa.concat_arrays(self.rows), *[pa.array([f[i] for f in self.facts], t) for i, (_, t) in enumerate(_FACTS)]]
        parts += [pa.array(self.whole, pa.int64()), pa.array(counts)]
        entries = pa.StructArray.from_arrays(parts, fields=[kind.field(i) for i in range(kind.num_fields)])
        columns = [
            pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries), pa.array([_packed(steps, "<u4")], pa.binary()),
            pa.array([_packed(np.concatenate(self.links), "<u8")], pa.binary()), pa.array([different], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64())),
            pa.array([any(w is not None for w in self.whole)]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["slice", "entries", "steps", "links", "pairs", "docs", "parted"])


def slice_documents(packed: DataFrame, vocabularies: tuple[str, str, str], keep_text: bool = True) -> DataFrame:
    """One row per slice: its documents (or parts of them), the places of their pairs, the slice's pairs and in how many documents each is.

    ``keep_text``: rows hold their texts.
    """
    row_type = packed.schema["row"].dataType
    entry = T.StructType(
        [T.StructField("row", row_type), *[T.StructField(n, T.StringType() if t == pa.string() else T.LongType()) for n, t in _FACTS]]
        + [T.StructField("whole", T.LongType()), T.StructField("n_pairs", T.LongType())]
    )
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [T.StructField("slice", T.LongType()), T.StructField("entries", T.ArrayType(entry)), T.StructField("steps", T.BinaryType()), T.StructField("links", T.BinaryType())]
        + [T.StructField("pairs", longs), T.StructField("docs", longs), T.StructField("parted", T.BooleanType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, names = load(*vocabularies)
        number = wholes = TaskContext.get().partitionId() << 33
        held, kind, nothing = _Slice(), None, np.empty(0, np.int64)
        for batch in batches:
            if kind is None:
                kind = pa.struct([("row", batch.schema.field(0).type), *_FACTS, ("whole", pa.int64()), ("n_pairs", pa.int64())])
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= BATCH_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                facts, found = align_texts(texts[at:end], a, b, names)
                for i, parts in enumerate(found):
                    mine, row = [facts[n][i] for n, _ in _FACTS], batch.column(0).slice(at + i, 1)
                    wholes += 1
                    chars = len(texts[at + i] or "") if keep_text else 0
                    for turn, (pairs, links) in enumerate(parts or [(nothing, nothing)]):
                        if turn:
                            mine, row, chars = [None] * len(_FACTS), pa.nulls(1, batch.schema.field(0).type), 0
                        held.add(row, mine, wholes if len(parts) > 1 else None, pairs, links, chars)
                        if held.full():
                            number += 1
                            yield held.batch(number, kind)
                            held = _Slice()
                            hand_back()
                at = end
        if held.rows:
            yield held.batch(number + 1, kind)

    return in_batches(packed).mapInArrow(cut, schema)


def pair_counts(slices: DataFrame, width: int) -> DataFrame:
    """pair, count (documents that hold it linked), best (no pair of its A id has more)."""
    held = slices.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    # at most as many rows of an A id as B has ids
    same = Window.partitionBy(F.expr(f"pair DIV {width}"))
    return held.select("pair", "count", (F.col("count") == F.max("count").over(same)).alias("best"))


def align_documents(docs: DataFrame, path_a: str, pattern: str, path_b: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``ADDED``: tokens, groups and links of both tokenizers, and what its links count in the corpus.

    ``path_a`` and ``pattern``: byte-level BPE file and how it splits texts; ``path_b``: sentence-piece model. Without ``keep_text``
    the texts are not handed on with the other columns (one of which there must be).
    """
    names = [c for c in docs.columns if c not in ADDED and (keep_text or c != text)]
    packed = docs.select(F.struct(*[docs[_column(c)] for c in names]).alias("row"), docs[_column(text)].alias("text"))
    slices = materialize(slice_documents(packed, (path_a, pattern, path_b), keep_text), "slices", **STORED)
    counts = materialize(pair_counts(slices, Pieces(path_b).model.get_piece_size()), "pairs")
    placed = slices.select("slice", F.posexplode("pairs").alias("place", "pair")).join(counts, "pair").select(F.col("slice").alias("of"), "place", "count", "best")
    entry = slices.schema["entries"].dataType.elementType
    schema = T.StructType([*[f for f in entry.fields if f.name != "n_pairs"], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def add_up(held: pa.Table, looked: pa.Table) -> pa.Table:
        unload()
        entries = held["entries"].combine_chunks().values
        sizes = entries.field(entries.type.num_fields - 1).to_numpy(zero_copy_only=False)
        total = int(sizes.sum())
        best, sums = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
        if total:
            steps, links = (_unpacked(held[c][0], total, t).astype(np.int64) for c, t in (("steps", "<u4"), ("links", "<u8")))
            place, count, top = (looked[c].to_numpy() for c in ("place", "count", "best"))
            count_at, top_at = np.empty(len(place), dtype=np.int64), np.empty(len(place), dtype=np.int64)
            count_at[place], top_at[place] = count, top
            filled = np.flatnonzero(sizes)
            first = (np.cumsum(sizes) - sizes)[filled]
            run = np.cumsum(steps)
            places = run - np.repeat(run[first] - steps[first], sizes[filled])
            sums[filled] = np.add.reduceat(count_at[places] * links, first)
            best[filled] = np.add.reduceat(top_at[places] * links, first)
        columns = [entries.field(k) for k in range(entries.type.num_fields - 1)]
        hand_back()
        return pa.Table.from_arrays([*columns, pa.array(best), pa.array(sums)], names=schema.names)

    # the arrays of a slice's pairs stay behind; a slice without a pair is met by nothing
    rows = in_batches(slices.select("slice", "entries", "steps", "links"))
    found = rows.groupBy("slice").cogroup(placed.groupBy("of")).applyInArrow(add_up, schema)
    if not slices.filter("parted").isEmpty():  # documents in parts: their parts are added up
        parts = found.filter("whole IS NOT NULL").groupBy("whole").agg(
            F.first("row", True).alias("row"), *[F.first(n, True).alias(n) for n, _ in _FACTS], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
        found = found.filter("whole IS NULL").unionByName(parts)
    return found.select("row.*", *ADDED)
