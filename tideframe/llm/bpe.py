"""Byte-level BPE by merge replay over a corpus of distinct words.

Instead of running the merge loop word by word, all distinct words of a slice of the corpus are laid out as one
linked list of symbols. An inverted index from token pair to positions in that list replays the merges in rank
order: a merge touches all its positions at once, and only the pairs to the left and right of them are looked up again.
Words already seen by the task come from a table that is emptied when it reaches ``KEPT_WORDS``, which bounds memory.
Nothing is shuffled: a document is encoded where it is read.

Defined cases: null and empty texts have no ids and decode to nothing; characters without a UTF-8 form (lone
surrogates) are replaced as the codec does; special tokens are plain text; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import column, in_batches, packed_row, row_schema

#: Words whose ids a task keeps; the table starts anew beyond it.
KEPT_WORDS = 200_000
#: Characters whose new words are merged together.
SLICE_CHARS = 2_000_000


class MergeTable:
    """Ranks of a vocabulary, as a lookup from (left id, right id) to the id of the merged token."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = np.empty(max(ranks.values()) + 1, dtype=object)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.keys, self.merged = table[:, 0].copy(), table[:, 1].copy()
        # tokens that can take part in a merge of lower rank than their own: only one merge per word and turn there
        early = self.merged < np.maximum(self.keys >> 32, self.keys & 0xFFFFFFFF)
        self.early = {*(self.keys[early] >> 32).tolist(), *(self.keys[early] & 0xFFFFFFFF).tolist()}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the merged token, or -1 where the pair is no merge."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == wanted), self.merged[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word as little-endian 32-bit integers."""
        symbols = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words])
        size = len(symbols)
        token = np.full(size + 1, -1, dtype=np.int64)  # the last place stands for "no neighbour"
        token[:size] = self.byte_ids[symbols]
        word = np.repeat(np.arange(len(words)), np.diff(np.append(0, ends)))
        after = np.append(np.arange(1, size + 1), size)
        after[ends - 1] = size
        before = np.append(np.arange(-1, size - 1), size)
        before[np.append(0, ends[:-1])] = size

        index: dict[int, list[np.ndarray]] = {}
        waiting: list[tuple[int, int]] = []

        def enter(places: np.ndarray) -> None:
            left, right = token[places], token[after[places]]
            rank = self.lookup(left, right)
            known = rank >= 0
            if not known.any():
                return
            places, rank, pair = places[known], rank[known], (left << 32 | right)[known]
            order = np.argsort(pair, kind="stable")
            cuts = np.flatnonzero(np.diff(pair[order])) + 1
            for group in np.split(order, cuts):
                key = int(pair[group[0]])
                if key not in index:
                    index[key] = []
                    heapq.heappush(waiting, (int(rank[group[0]]), key))
                index[key].append(places[group])

        enter(np.arange(size))
        while waiting:
            new, key = heapq.heappop(waiting)
            found = index.pop(key)
            places = np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])
            left, right = key >> 32, key & 0xFFFFFFFF
            places = places[(token[places] == left) & (token[after[places]] == right)]
            if not len(places):
                continue
            rest = places[:0]
            if new in self.early and len(places) > 1:
                first = np.append(True, word[places[1:]] != word[places[:-1]])
                places, rest = places[first], places[~first]
            elif left == right and len(places) > 1:  # overlapping runs: every second one, from the left
                head = np.append(True, after[places[:-1]] != places[1:])
                start = np.maximum.accumulate(np.where(head, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - start) % 2 == 0]
            gone = after[places]
            following = after[gone]
            token[places] = new
            token[gone] = -1
            after[places] = following
            inner = following < size
            before[following[inner]] = places[inner]
            if len(rest):
                index[key] = [rest]
                heapq.heappush(waiting, (new, key))
            earlier = before[places]
            enter(np.unique(np.concatenate([places, earlier[earlier < size]])))

        kept = token[:size] >= 0
        ids = token[:size][kept].astype("<u4").tobytes()
        counts = np.add.reduceat(kept, np.append(0, ends[:-1])) if size else np.zeros(0, int)
        cuts = np.append(0, np.cumsum(counts) * 4).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(ids, dtype="<u4")].tolist())


_TABLES: dict[tuple[str, str], MergeTable] = {}


def merge_table(path: str, pattern: str) -> MergeTable:
    """The table of this worker process; it is built once."""
    if (path, pattern) not in _TABLES:
        _TABLES[path, pattern] = MergeTable(path, pattern)
    return _TABLES[path, pattern]


def encode_texts(table: MergeTable, texts: list[str | None], known: dict[str, bytes]) -> Iterator[bytes]:
    """Ids of every text, little-endian; ``known`` carries the ids of words from slice to slice."""
    split = table.pattern.findall
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= SLICE_CHARS):
            chars += len(texts[end] or "")
            end += 1
        words = [split(text) if text else [] for text in texts[at:end]]
        new = list({w for ws in words for w in ws if w not in known})
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            new = list({w for ws in words for w in ws})
        if new:
            known.update(zip(new, table.replay([w.encode("utf-8", "replace") for w in new]), strict=True))
        for ws in words:
            yield b"".join([known[w] for w in ws])
        at = end


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = True, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int, optional), ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` to every row.

    The row itself travels as one struct, so columns of any name stay as they are; a column that has the name
    of an added one is replaced.
    """
    added = ["ids"] * keep_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [c for c in docs.columns if c not in added]
    packed = docs.select(packed_row(kept), column(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = merge_table(vocabulary, pattern), {}
        for batch in batches:
            rows, ids, counts, digests, decoded = batch.column(0), [], [], [], []
            for found in encode_texts(table, batch.column(1).to_pylist(), known):
                if keep_ids:
                    ids.append(np.frombuffer(found, dtype="<u4").astype(np.int32))
                counts.append(len(found) // 4)
                digests.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(table.decode(found)).hexdigest())
            columns = [rows, pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.insert(1, pa.array(ids, pa.list_(pa.int32())))
                names.insert(1, "ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    types = ["ids array<int>"] * keep_ids + ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    return in_batches(packed).mapInArrow(encode, row_schema(packed, ", ".join(types))).select("row.*", *added)
