"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import string

from helpers import docs_frame

from tideframe.llm import exactdedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(i)
    return {key: (max([i for i in ids if i is not None], default=None), len(ids)) for key, ids in groups.items()}


def check(spark, rows):
    found = exactdedup.duplicate_groups(docs_frame(spark, rows), every_digest=True).collect()
    want, kept = expected(rows), {}
    assert len(found) == len(rows)
    for r in found:
        key = (r.text or "").translate(LOWER)
        assert (r.keep_id, r.group_size) == want[key]
        assert r.text_sha256 == hashlib.sha256(key.encode()).hexdigest()
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[key] = kept.get(key, 0) + 1
    assert kept == dict.fromkeys(want, 1)


def test_groups(spark):
    head = "Same Head " * 40
    rows = [(i, t) for i, t in enumerate([head + "a", head + "b", head + "A", "x", "X", "É", "é", "", None, "yy", "ß" * 3000, "ß" * 3000])]
    check(spark, rows)


def test_repeated_rows_and_missing_ids(spark):
    check(spark, [(1, "a"), (1, "A"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, ""), (2, None), (3, "c")])


def test_large_group_and_long_text(spark):
    check(spark, [(i, "Copy") for i in range(3000)] + [(5000, "z" * 3_000_000), (5001, "Z" * 3_000_000), (5002, "z" * 2_999_999 + "y")])


def test_digests_only_where_groups_are_possible(spark):
    found = {r.text: r.text_sha256 for r in exactdedup.duplicate_groups(docs_frame(spark, ["abc", "abd", "ABC", "lonely"])).collect()}
    assert found["lonely"] is None and found["abd"] is None and found["abc"] is not None


def test_columns_and_empty_table(spark):
    docs = docs_frame(spark, ["a", "A", "b"]).selectExpr("*", "'x' AS `my col`", "'y' AS `a.b`", "'z' AS `a:b`", "'w' AS `t``k`", "1 AS row", "2 AS size", "3 AS open", "4 AS kept")
    kept = exactdedup.drop_copies(docs)
    assert kept.columns == [c for c in docs.columns if c != "kept"]
    assert sorted((r.doc_id, r["my col"], r["a.b"], r["t`k"], r.row) for r in kept.collect()) == [(1, "x", "y", "w", 1), (2, "x", "y", "w", 1)]
    assert exactdedup.duplicate_groups(docs.limit(0)).count() == 0
