"""Alignment against plain loops with the tokenizer libraries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from helpers import docs_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideframe.llm import alignment
from tideframe.session import materialize

A, PATTERN, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def groups_of(text, libraries):
    """Groups of (A ids, B ids) by walking both token lists; none where a tokenizer does not write the text back."""
    if not text:
        return []
    a, b = libraries
    byte_of, piece_of = alignment.byte_of_character(), b.id_to_piece
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(piece_of(i)[3:5], 16)]) if b.is_byte(i) else piece_of(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    found, at_a, at_b = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        to_a, to_b = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        found.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
        at_a, at_b = to_a, to_b
    return found


def by_hand(texts, libraries):
    groups = [groups_of(t, libraries) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(p for found in links for p in found)
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for g, found in zip(groups, links, strict=True):
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found.values()), sum(n for p, n in found.items() if counts[p] == best[p[0]]),
            sum(n * counts[p] for p, n in found.items()), hashlib.sha256(line.encode()).hexdigest() if g else "",
        ))
    return out


TEXTS = [
    "", None, "a", "Hello world, hello  world!", "naïve café ñandú 漢字 😀 ▁ odd", "tab\tand\nline\r\nend ", " leading", "<|endoftext|> </s> <0x41>", "x" * 900, " 　wide",
    "Hello world", "The the the", "don't we'll I'd", "1234567890 12 3", "漢" * 300, "supercalifragilistic " * 30, "àé combining", "\x00\x01zero",
]


def rows_of(frame):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect()}


@settings(max_examples=80, deadline=None)
@given(ends=st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=1, max_size=20), st.lists(st.integers(1, 5), min_size=1, max_size=20)), max_size=5), lane=st.integers(1, 30))
def test_lockstep(ends, lane):
    a, b, sizes, at = [], [], [], 0
    for x, y in ends:
        size = max(sum(x), sum(y))
        x, y = [*np.cumsum(x[:-1]).tolist(), size], [*np.cumsum(y[:-1]).tolist(), size]
        a += [at + e for e in sorted(set(x))]
        b += [at + e for e in sorted(set(y))]
        at += size
        sizes.append(size)
    old, alignment.LANE_BYTES = alignment.LANE_BYTES, lane
    try:
        cut_a, cut_b = alignment.lockstep_cuts(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), alignment.lanes(np.array(sizes, dtype=np.int64)))
    finally:
        alignment.LANE_BYTES = old
    both = sorted(set(a) & set(b))
    assert [a[i] for i in cut_a] == both and [b[i] for i in cut_b] == both


def test_documents(spark, libraries):
    found = rows_of(alignment.align_documents(docs_frame(spark, TEXTS * 2), A, PATTERN, B))
    assert [found[i] for i in range(len(TEXTS) * 2)] == by_hand(TEXTS * 2, libraries)


def test_slices_and_parts(spark, libraries, monkeypatch):
    """Small slices, and documents whose links are taken by ranges of ids."""
    monkeypatch.setattr(alignment, "SLICE_LINKS", 60)
    monkeypatch.setattr(alignment, "MANY_LINKS", 40)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 200)
    found = rows_of(alignment.align_documents(docs_frame(spark, TEXTS).repartition(3), A, PATTERN, B))
    assert [found[i] for i in range(len(TEXTS))] == by_hand(TEXTS, libraries)


def test_group_without_a_cut(spark):
    """Tokens that never end together: one group with more links than fit in memory."""
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 50, 60_000), rng.integers(0, 40, 50_000)
    total = Counter()
    for pairs, links in alignment.pairs_by_ranges(a, b, np.array([len(a)]), np.array([len(b)]), 40):
        assert not total.keys() & set(pairs.tolist())
        total.update(dict(zip(pairs.tolist(), links.tolist(), strict=True)))
    in_a, in_b = Counter(a.tolist()), Counter(b.tolist())
    assert total == {x * 40 + y: n * m for x, n in in_a.items() for y, m in in_b.items()}


def test_every_character_splits_alike(libraries):
    """The faster library cuts and encodes as the vocabulary's own does, for every character."""
    table = alignment.ByteLevel(A, PATTERN)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 40_000):
        texts = [f" a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)} .{chr(c)}" for c in points[at : at + 40_000]]
        assert [x.ids for x in libraries[0].encode_batch(texts, add_special_tokens=False)] == [table.encode(t) for t in texts]


def test_very_long_texts(spark, libraries):
    texts = [" " * 1_000_000 + "a", "\n" * 1_000_000, "x" * 300_000, "ab c, " * 100_000, "\t " * 30_000]
    table = alignment.ByteLevel(A, PATTERN)
    for text in texts:
        assert table.encode(text) == libraries[0].encode(text, add_special_tokens=False).ids
    found = rows_of(alignment.align_documents(docs_frame(spark, texts), A, PATTERN, B))
    for i, text in enumerate(texts):
        groups = groups_of(text, libraries)
        assert found[i][:4] == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(len(a) * len(b) for a, b in groups))


def test_columns_repeats_and_empty_table(spark, libraries):
    docs = docs_frame(spark, [(1, "Hello world"), (1, "Hello world"), (None, "Hello"), (None, None)])
    docs = docs.selectExpr("*", "'x' AS `my col`", "'y' AS `a.b`", "'z' AS `a:b`", "'w' AS `t``k`", "1 AS row", "2 AS whole", "3 AS n_a")
    found = alignment.align_documents(docs, A, PATTERN, B)
    assert found.columns == [*[c for c in docs.columns if c != "n_a"], *alignment.ADDED]
    rows = found.collect()
    assert sorted((r.n_a, r.count_sum) for r in rows) == sorted((x[0], x[5]) for x in by_hand(["Hello world", "Hello world", "Hello", None], libraries))
    assert {(r["my col"], r["a.b"], r["a:b"], r["t`k"], r.row) for r in rows} == {("x", "y", "z", "w", 1)}
    assert alignment.align_documents(docs.limit(0), A, PATTERN, B).count() == 0


def test_stored_slices_stay_small(spark, libraries, monkeypatch):
    """Texts are stored only if asked for, and then bound a slice; large rows are written in small groups."""
    stored = []
    monkeypatch.setattr(alignment, "materialize", lambda frame, *a, **b: stored.append(materialize(frame, *a, **b)) or stored[-1])
    docs = docs_frame(spark, TEXTS).coalesce(1)
    bare = alignment.align_documents(docs, A, PATTERN, B, keep_text=False)
    assert bare.columns == [*[c for c in docs.columns if c != "text"], *alignment.ADDED]
    assert stored[0].schema["entries"].dataType.elementType["row"].dataType.names == [c for c in docs.columns if c != "text"] and stored[0].count() == 1
    found = alignment.align_documents(docs, A, PATTERN, B)
    assert "text" in stored[2].schema["entries"].dataType.elementType["row"].dataType.names
    assert [rows_of(bare)[i] for i in range(len(TEXTS))] == [rows_of(found)[i] for i in range(len(TEXTS))] == by_hand(TEXTS, libraries)
    held, nothing = alignment._Slice(), np.empty(0, np.int64)
    held.add(pa.nulls(1), [], None, nothing, nothing, alignment.SLICE_CHARS - 1)
    assert not held.full()
    held.add(pa.nulls(1), [], None, nothing, nothing, 1)
    assert held.full()
    large = materialize(spark.range(0, 60, 1, 1).selectExpr("id", "randstr(1000000, 1) AS row"), "large", **alignment.STORED)
    sizes = [meta.row_group(i).total_byte_size for f in large.inputFiles() for meta in [pq.read_metadata(f.removeprefix("file://"))] for i in range(meta.num_row_groups)]
    assert len(sizes) > 1 and max(sizes) < 24 << 20
