"""Native fingerprints against a plain Python version."""

import hashlib
import math
import struct

import pytest
import regex
import xxhash
from helpers import docs_frame, with_odd_columns

from tideframe.llm import fingerprint as fp

MASK = (1 << fp.HASH_BITS) - 1


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def hash_all(values, seed=42):
    for v in values:
        if isinstance(v, str):
            data = v.encode()
        else:
            data = struct.pack("<i" if isinstance(v, Int) else "<q", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


class Int(int):
    pass


def brute_signature(text):
    items = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    k = fp.WORDS
    if len(items) < fp.LEAST_WORDS:
        items, k = list(text.lower()), fp.CHARS
    if not items:
        return []
    kmers = [hash_all(items[i : i + k]) & MASK for i in range(max(1, len(items) - k + 1))]
    seen, labelled = {}, []
    for place, h in enumerate(kmers):
        n = seen[h] = seen.get(h, -1) + 1
        labelled.append((h if n == 0 else hash_all([h, Int(n)]) & MASK, place))
    out = []
    for b in range(fp.BINS):
        two = sorted(x for x in labelled if x[0] >> (fp.HASH_BITS - fp.BIN_BITS) == b)[:2]
        if two:
            out.append(b << 32 | hash_all([h for h, _ in sorted(two, key=lambda x: x[1])]) & 0xFFFFFFFF)
    return out


def brute_likeness(a, b):
    filled = {x >> 32 for x in a} | {x >> 32 for x in b}
    return math.sqrt(len(set(a) & set(b)) / len(filled)) if filled else 1.0


TEXTS = ["", None, "a", "That it.", "ab ab ab ab ab", "word " * 100, " ".join(f"w{i % 37} x{i % 11}" for i in range(300)), "É ß İ 漢字 😀 " * 20, "...", "x" * 5000]


def test_against_brute_force(spark):
    docs = with_odd_columns(docs_frame(spark, [(i * 10**6 - 5 * 10**6, t) for i, t in enumerate(TEXTS)]), "sketch", "bucket", "edge")
    found = {r.doc_id: r for r in fp.fingerprint_edits(docs).collect()}
    ids = sorted(found, reverse=True)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for n, i in enumerate(ids):
        text, following = texts[i], texts[ids[(n + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, next_one = map(brute_signature, (text, edited, following))
        assert found[i].fingerprint == "".join(f"{x:010x}" for x in own)
        assert found[i].edited_fingerprint == "".join(f"{x:010x}" for x in other)
        assert found[i].near_edited == pytest.approx(brute_likeness(own, other))
        assert found[i].near_next == pytest.approx(brute_likeness(own, next_one))


@pytest.mark.parametrize("ids", [[7], [1, 2, 3], list(range(0, 3000, 3)), [0, 2**62, -(2**62), 5, None, None], [4, 4, 4, 9]])
def test_next_row(spark, monkeypatch, ids):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 16)
    monkeypatch.setattr(fp, "RANGE_BUCKETS", 4)
    rows = [(i, f"t{n:05d}") for n, i in enumerate(ids)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = {(i, t): order[(n + 1) % len(order)][1] for n, (i, t) in enumerate(order)}
    found = fp.with_next(docs_frame(spark, rows).select("doc_id", "text"), ["text"]).collect()
    assert {(r.doc_id, r.text): r.next_text for r in found} == want and len(found) == len(rows)


def test_empty_table_and_plan(spark):
    docs = docs_frame(spark, [(1, "x")])
    assert fp.fingerprint_edits(docs.limit(0)).count() == 0
    assert "Python" not in fp.fingerprint_edits(docs)._jdf.queryExecution().executedPlan().toString()
