"""Collocations against counting by hand; the index against plain search."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs_frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tideframe.llm import collocations
from tideframe.llm.fmindex import BidirectionalIndex


def pieces_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def by_hand(rows, least, top):
    counts = {}
    for text, lang in rows:
        found = counts.setdefault("und" if lang is None else lang, Counter())
        for words in pieces_of(text):
            for k in range(1, 6):
                found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def mined(frame, least, top):
    return sorted(tuple(r) for r in collocations.collocations(frame, least=least, top=top).collect())


@settings(max_examples=60, deadline=None)
@given(symbols=st.lists(st.integers(0, 4), max_size=60))
def test_index_counts_every_phrase(symbols):
    sequence = np.array([*symbols, 0], dtype=np.int32)
    index = BidirectionalIndex.of(sequence, 5)
    used = np.unique(sequence[sequence > 0])
    phrases, state = [(int(s),) for s in used], index.symbols(used)
    for size in range(2, 6):
        first, last, low, back, count = index.extend(*state)
        assert all(phrases[i][1:] == phrases[j][:-1] for i, j in zip(first, last, strict=True))
        phrases = [(*phrases[i], phrases[j][-1]) for i, j in zip(first, last, strict=True)]
        want = Counter(tuple(sequence[i : i + size].tolist()) for i in range(len(sequence) - size + 1))
        assert dict(zip(phrases, count.tolist(), strict=True)) == {p: c for p, c in want.items() if 0 not in p}
        state = (low, back, count)


WORDS = ["the", "The", "of", "new", "york", "city", "é", "É", "a-b", "x", "y", "hall"]


def corpus(seed, docs, langs):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.integers(1, 12)):
            parts.append("new york city hall" if rng.uniform() < 0.2 else " ".join(rng.choice(WORDS, rng.integers(1, 8))))
        rows.append((rng.choice([". ", ", ", "\n", "\t", " ", ";"]).join(parts), langs[rng.integers(len(langs))]))
    return rows


@pytest.mark.parametrize("least,top,shard", [(3, 2000, 6_000_000), (3, 7, 300)])
def test_by_hand(spark, monkeypatch, least, top, shard):
    monkeypatch.setattr(collocations, "SHARD_CHARS", shard)
    rows = [*corpus(5, 150, ["en", "de", None, "und"]), ("", "en"), (None, "fr"), (None, None), ("one", "it")]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert mined(frame, least, top) == by_hand(rows, least, top)


@pytest.mark.parametrize("limit", [40, 1000])
def test_long_text_in_parts(spark, monkeypatch, limit):
    monkeypatch.setattr(collocations, "SHARD_CHARS", limit)
    rng = np.random.default_rng(limit)
    rows = [(" ".join(rng.choice(WORDS, 900)), "en"), ("w" * 3000 + " a b c d e " * 40 + "q" * 2000, "en"), ("a b " * 300, "en")]
    assert mined(spark.createDataFrame(rows, "text string, lang string"), 5, 2000) == by_hand(rows, 5, 2000)


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([("a b " * 60_000, "en")] * 3 + [("c d. " * 1, "en")] * 120, "text string, lang string")
    assert mined(frame, 100, 2000) == by_hand([(r.text, r.lang) for r in frame.collect()], 100, 2000)
    cut = spark.sql(f"SELECT {collocations._best_cut()} AS cut FROM VALUES (3000000000000L, 9000000000000000L, 2, array(4000000000000L), array(7000000000000L)) t(a, n, words, heads, tails)").first()["cut"]
    assert cut["score"] == 1000 * 3_000_000_000_000 * 9_000_000_000_000_000 // (4_000_000_000_000 * 7_000_000_000_000)


def test_columns_and_empty_table(spark):
    docs = docs_frame(spark, ["a b a b a b"]).selectExpr("*", "1 AS words", "2 AS `my col`", "3 AS shard", "4 AS phrase")
    assert [r.phrase for r in collocations.collocations(docs, least=2).collect()] != []
    assert collocations.collocations(docs.limit(0), least=2).count() == 0


def test_phrases_travel_packed(spark):
    """A shard hands out one block per part, however many phrases it has; what comes back is what is frequent over all shards."""
    rng = np.random.default_rng(3)
    made, want = [], Counter()
    for shard in (1, 2, -3):
        pairs = np.unique(rng.integers(0, 90, (3000, 2)) * [1, 20_000_000], axis=0)
        size, low = rng.integers(1, 5, len(pairs)), rng.integers(0, 1 << 31, len(pairs))
        made.append(collocations._blocks(collocations._GRAMS, shard, 7, pairs[:, 0], pairs[:, 1], size, low))
        for (first, last), n in zip(pairs.tolist(), size.tolist(), strict=True):
            want[first, last] += n if shard > 0 else -n
        held = collocations._all_columns(pa.scalar(made[-1]["block"].to_pylist(), pa.list_(pa.binary())), 3)
        again = sorted(zip(*held.tolist(), strict=True))
        assert again == [(f << 32 | t, n, x) for (f, t), n, x in zip(pairs.tolist(), size.tolist(), low.tolist(), strict=True)]
        assert made[-1].num_rows == 7
        assert made[-1].nbytes < 11 * len(pairs)  # three numbers of 8 bytes, one of them at random
    blocks = spark.createDataFrame([tuple(r.values()) for b in made for r in b.to_pylist()], collocations._GRAMS)
    found = collocations.frequent_blocks(blocks, 3, 7, 4).collect()
    named = {(r["first"], r["last"]): r for r in found if r["block"] is None}
    assert {p: r["a"] for p, r in named.items()} == {p: a for p, a in want.items() if a >= 4}
    assert len({r["id"] for r in named.values()}) == len(named)
    back = Counter()
    for r in (r for r in found if r["block"] is not None):
        for key, n, _, number in collocations._columns(pa.scalar(bytes(r["block"]), pa.binary()), 4).T.tolist():
            assert named[key >> 32, key & 0xFFFFFFFF]["id"] == number
            back[key >> 32, key & 0xFFFFFFFF] += n if r["shard"] > 0 else -n
    assert back == {p: r["a"] for p, r in named.items()}


def test_words_are_numbered_small(spark):
    rows = [(s, "en" if w % 2 else "de", f"w{w}", w, 1 + w % 3) for s in (1, 2, 3, -4) for w in range(400)]
    words = spark.createDataFrame(rows, "shard long, lang string, word string, place int, n long").repartition(9)
    held = collocations.frequent_words(words, 2, 4).collect()
    ids = {(r["lang"], r["word"]): r["id"] for r in held}
    assert {r["word"]: r["a"] for r in held} == {f"w{w}": 2 * (1 + w % 3) for w in range(400) if w % 3}
    assert len(held) == 4 * len(ids) and len(set(ids.values())) == len(ids) and max(ids.values()) < 16 * 2 * collocations.BUCKETS


def test_rows_of_shards_do_not_follow_their_phrases(spark, monkeypatch):
    stored, most = collocations.materialize, {}

    def counted(frame, label):
        made = stored(frame, label)
        most[label] = max(most.get(label, 0), made.count())
        return made

    monkeypatch.setattr(collocations, "materialize", counted)
    frame = spark.createDataFrame(corpus(7, 60, ["en"]), "text string, lang string").repartition(2)
    assert collocations.frequent_phrases(frame, least=3)[0].filter("words = 3").count() > 20
    # a row for each of two shards and one for each of their blocks
    assert max(most["pairs"], most["indexes"], most["grams"]) <= 4


@settings(max_examples=60, deadline=None)
@given(symbols=st.lists(st.integers(0, 3), max_size=60))
def test_low_in_the_reverse_from_low(symbols):
    index = BidirectionalIndex.of(np.array([*symbols, 0], dtype=np.int32), 5)
    state = index.symbols(np.unique([s for s in symbols if s > 0]).astype(np.int64))
    for size in range(1, 5):
        low, back, count = state
        assert index.low_reverse(low, size).tolist() == back.tolist()
        state = index.extend(*state)[2:]


@pytest.mark.parametrize("kind", ["random", "one first", "equal firsts", "falling", "none"])
def test_blocks_read_back(kind):
    rng = np.random.default_rng(11)
    n = 0 if kind == "none" else 500
    key = np.sort(rng.integers(0, 1 if kind == "one first" else 9 if kind == "equal firsts" else 1 << 31, n) << 32 | rng.integers(0, 1 << 31, n))
    number, size = np.sort(rng.integers(0, 1 << 31, n)), rng.integers(1, 1 << 40, n)
    if kind == "falling":
        number = number[::-1]
    back = collocations._columns(pa.scalar(collocations._block(key, number, size, rising=2), pa.binary()), 3, 2)
    assert back.tolist() == [key.tolist(), number.tolist(), size.tolist()]


def test_bytes_of_sequences_and_pairs():
    rng = np.random.default_rng(4)
    words = np.minimum(rng.zipf(1.3, 400_000), 60_000).astype(np.int32)
    packed = collocations._packed(words)
    assert (collocations._unpacked(pa.scalar(packed, pa.binary())) == words).all()
    assert len(packed) < 1.1 * len(words)  # 1.32 as numbers of four bytes each
    ids = rng.permutation(60_001)[words].astype(np.int64)
    pairs, size = np.unique(ids[:-1] << 32 | ids[1:], return_counts=True)
    blocks = collocations._blocks(collocations._GRAMS, 1, 27, pairs >> 32, pairs & 0xFFFFFFFF, size)
    assert blocks.nbytes < 2.6 * len(pairs)  # 3 with phrases of a first part dealt at random
    assert max(b.as_buffer().size for b in blocks["block"]) < blocks.nbytes / 4  # no part has all pairs of a word


def test_shards_store_words_packed(spark):
    rows = corpus(9, 80, ["en", None]) + [("...", "it"), ("", "fr")]
    shards = collocations.shard_documents(spark.createDataFrame(rows, "text string, lang string").coalesce(1), "text", "lang", 5)
    assert sorted(r["lang"] for r in shards.collect()) == ["en", "und"]
    counts = Counter()
    for r in collocations.shard_words(shards).collect():
        counts[r["lang"], r["word"]] += r["n"]
    want = Counter((lang or "und", w) for text, lang in rows for piece in pieces_of(text) for w in piece)
    assert counts == want


def test_blocks_hand_back_what_is_read(spark):
    frame = spark.createDataFrame([("a b c d e f. " * 9, "en")], "text string, lang string")
    shards = collocations.shard_documents(frame, "text", "lang", 5).localCheckpoint()
    held = collocations.frequent_words(collocations.shard_words(shards), 1, 3)
    pairs = collocations.count_pairs(shards, held, 1).filter("block IS NOT NULL").select("shard", "part", "block")
    for returned, rising in (([0, 2], 2), ([], 1)):
        found = collocations.frequent_blocks(pairs, 2, 1, 3, returned, rising).collect()
        named = {(r["first"] << 32 | r["last"], r["id"]) for r in found if r["block"] is None}
        back = [collocations._columns(pa.scalar(bytes(r["block"]), pa.binary()), 2, 2) for r in found if r["block"] is not None]
        assert len(named) == 5 and [set(map(tuple, b.T.tolist())) for b in back] == [named] * bool(returned)


def test_word_numbers_reach_shards_as_one_number(spark):
    """Large places and numbers survive the way, and a frequent word takes eight bytes."""
    frame = spark.createDataFrame([("a b c d e f. " * 9, "en")], "text string, lang string")
    shards = collocations.shard_documents(frame, "text", "lang", 5).localCheckpoint()
    words = collocations.shard_words(shards).selectExpr("shard", "place", "2147480000L + 5 - place AS id")
    row = collocations.count_pairs(shards, words, 1).filter("sequence IS NOT NULL").first()
    assert collocations._columns(pa.scalar(bytes(row["ids"]), pa.binary()), 1)[0].tolist() == list(range(2147480000, 2147480006))
    plan = collocations.count_pairs(shards, words, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "struct(" not in plan
