"""Near-duplicate classes against brute force."""

import re

import numpy as np
import pytest
from helpers import by_id, docs_frame, with_odd_columns

from tideframe.llm import neardup
from tideframe.llm.tokens import hash_words


def distance(a, b):
    row = np.arange(len(b) + 1)
    for x in a:
        new = np.empty_like(row)
        new[0] = row[0] + 1
        for j, y in enumerate(b, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
        row = new
    return int(row[-1])


def test_edit_distance():
    rng = np.random.default_rng(0)
    for turn in range(400):
        a = rng.integers(0, 6, rng.integers(0, 30))
        b = a.copy() if turn % 2 else rng.integers(0, 6, rng.integers(0, 30))
        for _ in range(rng.integers(0, 6)):
            if len(b):
                b = np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 else np.insert(b, rng.integers(len(b)), rng.integers(0, 6))
        true = distance(a, b)
        for limit in (0, 2, 9, 40, 100):
            assert neardup.edit_distance_within(a, b, limit) == min(true, limit + 1)


def corpus(seed=1, groups=25):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(2000)]
    texts, group = [], []
    for g in range(groups):
        base = [words[i] for i in rng.integers(0, len(words), rng.integers(40, 200))]
        for _ in range(rng.integers(1, 12)):
            copy = [words[rng.integers(len(words))] if rng.random() < 0.03 else w for w in base]
            texts.append(" ".join(copy))
            group.append(g)
    return texts, group


def classes_of(spark, docs):
    return {r.doc_id: r.class_id for r in neardup.duplicate_classes(docs).collect()}


def test_planted_groups(spark):
    texts, group = corpus()
    found = classes_of(spark, docs_frame(spark, texts))
    first = {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    assert found == {i: first[g] for i, g in enumerate(group)}


@pytest.mark.parametrize("small", [2, 12])
def test_hot_passage_and_large_group(spark, monkeypatch, small):
    """Many texts share half of their words without being similar; one group is large; all links are found."""
    monkeypatch.setattr(neardup, "SMALL", small)
    rng = np.random.default_rng(4)
    shared = [f"s{i}" for i in range(40)]
    texts = [" ".join(shared + [f"u{k}x{i}" for i in range(40)]) for k in range(60)]
    base = [f"b{i}" for i in range(120)]
    texts += [" ".join("z%d" % rng.integers(10**6) if rng.random() < 0.02 else w for w in base) for _ in range(80)]
    pairs = [(k, k + 200) for k in range(0, 10)]
    docs = docs_frame(spark, [(i, t) for i, t in enumerate(texts)] + [(b, texts[a] + " extra end") for a, b in pairs])
    found = classes_of(spark, docs)
    assert all(found[i] == i for i in range(60))
    assert {found[i] for i in range(60, 140)} == {60}
    assert all(found[b] == a for a, b in pairs)


def test_links_against_brute_force(spark):
    texts, _ = corpus(seed=9, groups=12)
    words = [re.findall(r"[a-z0-9]+", t) for t in texts]
    roots = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            longer = max(len(words[i]), len(words[j]))
            if distance(words[i], words[j]) <= 0.2 * longer:
                a, b = roots[i], roots[j]
                roots = [min(a, b) if r in (a, b) else r for r in roots]
    assert classes_of(spark, docs_frame(spark, texts)) == dict(enumerate(roots))


def test_defined_cases(spark):
    texts = [None, "", "", "!!!", "one", "One!", "a b c d", "a b c x", "long " * 3000, "long " * 3000 + "tail"]
    docs = with_odd_columns(docs_frame(spark, [*texts, (5, "One!"), (None, "one")]), "node", "class_id", "bucket")
    found = by_id(neardup.duplicate_classes(docs))
    ids = {k: {r.class_id for r in rows} for k, rows in found.items()}
    assert ids[0] == ids[1] == ids[2] == {0} and ids[3] == {3}
    assert ids[4] == ids[5] == ids[None] == {4} and len(found[5]) == 2
    assert ids[6] == {6} and ids[7] == {7} and ids[8] == ids[9] == {8}
    assert neardup.duplicate_classes(docs.limit(0)).count() == 0


def test_drop_duplicates(spark):
    docs = with_odd_columns(docs_frame(spark, ["same text of some words here", "same text of some words here", "other", (2, "other")]), "root", "kept")
    kept = neardup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, "same text of some words here"), (2, "other")]


def test_sketches_follow_order_and_occurrence():
    a = hash_words(["one two three four five six seven eight nine ten " * 4])[0]
    assert len(neardup.order_sketches(a)) == neardup.SKETCHES
    assert len(set(neardup.number_occurrences(np.array([5, 5, 7, 5], dtype=np.uint64)).tolist())) == 4
    swapped = np.concatenate([a[20:], a[:20]])
    assert (neardup.order_sketches(a) == neardup.order_sketches(a.copy())).all()
    assert len(neardup.order_sketches(swapped)) == neardup.SKETCHES
    assert len(neardup.order_sketches(a[:0])) == 0


def edited(rng, words, edits):
    """The text with so many scattered words replaced."""
    out = list(words)
    for place in rng.choice(len(out), edits, replace=False):
        out[place] = "z%d" % rng.integers(10**9)
    return out


def test_recall_does_not_depend_on_the_size_of_a_group(spark):
    """Copies with 14% of scattered words replaced are links to their original, not to each other."""
    rng = np.random.default_rng(6)
    texts, sizes = [], (10, 100, 1000)
    for g, n in enumerate(sizes):
        base = [f"g{g}w{i}" for i in range(120)]
        texts += [" ".join(base)] + [" ".join(edited(rng, base, 17)) for _ in range(n)]
    found = classes_of(spark, docs_frame(spark, texts))
    at = 0
    for n in sizes:
        assert sum(found[i] == at for i in range(at + 1, at + n + 1)) >= 0.99 * n
        at += n + 1


@pytest.mark.parametrize("low, high, shares", [(6, 15, None), (30, 60, (0.1, 0.2)), (100, 300, (0.1, 0.2))])
def test_recall_near_the_threshold(spark, low, high, shares):
    """Pairs of a similarity of 0.80 to 0.90; short texts with one to three words replaced."""
    rng = np.random.default_rng(7)
    texts = []
    for i in range(300):
        base = [f"p{i}w{j}" for j in range(rng.integers(low, high))]
        most = int(0.2 * len(base) + 1e-9)
        edits = int(rng.integers(1, most + 1)) if shares is None else min(most, int(np.ceil(rng.uniform(*shares) * len(base))))
        texts += [" ".join(base), " ".join(edited(rng, base, edits))]
    found = classes_of(spark, docs_frame(spark, texts))
    assert np.mean([found[k] == found[k + 1] for k in range(0, len(texts), 2)]) >= 0.98


def test_blocks_compare_whole_buckets(spark, monkeypatch):
    """A bucket that no centre settles: pairs of classes of their own, met through one shared passage."""
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "order_sketches", lambda words, similarity: np.arange(1, dtype=np.int64))
    rng = np.random.default_rng(8)
    texts = []
    for i in range(40):
        base = [f"q{i}w{j}" for j in range(rng.integers(20, 90))]
        texts += [" ".join(base), " ".join(edited(rng, base, int(0.2 * len(base))))]
    found = classes_of(spark, docs_frame(spark, texts))
    assert found == {k: k - k % 2 for k in range(len(texts))}


def test_parities_of_links(spark):
    rng = np.random.default_rng(11)
    for n in (1, 5, 40, 900, 3000):
        a = rng.integers(0, max(2, n // 2), n).astype(np.uint64)
        b = a.copy()
        for _ in range(n // 5):
            turn, at = rng.random(), rng.integers(len(b))
            b = np.delete(b, at) if turn < 0.3 else np.insert(b, at, 2**31) if turn < 0.6 else np.append(np.delete(b, at), np.uint64(2**32 - 1 - at))
        longer, apart = max(len(a), len(b)), abs(len(a) - len(b))
        bits = [np.unpackbits(np.frombuffer(neardup.parity(x), np.uint8)) for x in (a, b)]
        assert len(bits[0]) == neardup.PARITY and (bits[0] != bits[1]).sum() <= 2 * neardup.edit_distance_within(a, b, longer) - apart


@pytest.mark.parametrize("nearest", [False, True])
def test_alike_but_no_links_make_no_pairs(spark, nearest):
    """30 texts that share three quarters of their words, and a link among them."""
    common = [f"common{i}" for i in range(240)]
    words = [[w for p in range(80) for w in (*common[3 * p : 3 * p + 3], f"own{i}x{p}")] for i in range(30)]
    words.append([*words[7][:-20], *[f"other{p}" for p in range(20)]])
    texts = [" ".join(w) for w in words]
    docs = docs_frame(spark, texts)
    hashed = neardup._words_of(neardup._texts(docs).select("node", "text"))
    nodes = neardup.sketch_documents(docs).join(hashed.select("node", "parity"), "node").persist()
    held = nodes.selectExpr("1L AS bucket", "node", "node AS root")
    found = {frozenset((r.a, r.b)) for r in neardup.block_pairs(held, nodes, neardup.SIMILARITY, nearest).collect()}
    ids = {r.doc_id: r.node for r in nodes.collect()}
    assert found == {frozenset((ids[7], ids[30]))}
    rows = neardup.duplicate_classes(docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: i for i in range(30)} | {30: 7}


@pytest.mark.parametrize("many", [0, 12])
def test_distance_of_many_edits(monkeypatch, many):
    monkeypatch.setattr(neardup, "MANY_EDITS", many)
    rng = np.random.default_rng(12)
    for n in (20, 70, 200):
        for share in (0.1, 0.3, 0.6):
            a = rng.integers(0, 3 * n, n)
            b = np.delete(np.where(rng.random(n) < share, rng.integers(0, 3 * n, n), a), rng.integers(0, n, rng.integers(0, n // 8)))
            true = distance(a, b)
            for limit in (9, n // 5, n // 2, n):
                assert neardup.edit_distance_within(a, b, limit) == min(true, limit + 1)


def crowd(spark, size=60):
    """Texts of one original, all candidates of each other and few of them links, in three buckets."""
    rng = np.random.default_rng(13)
    base = [f"c{i % 90}" for i in range(200)]
    texts = []
    for _ in range(size):
        order = base.copy()
        for _ in range(28):
            i, j = rng.integers(0, len(base), 2)
            order[i], order[j] = order[j], order[i]
        texts.append(order)
    docs = docs_frame(spark, [" ".join(t) for t in texts])
    hashed = neardup._words_of(neardup._texts(docs).select("node", "text"))
    nodes = neardup.sketch_documents(docs).join(hashed.select("node", "parity"), "node").persist()
    return nodes.selectExpr("explode(array(1L, 2L, 3L)) AS bucket", "node", "node AS root"), nodes


@pytest.mark.parametrize("block", [500, 20])
def test_candidates_meet_once_and_crowds_are_told(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    held, nodes = crowd(spark)
    rows = neardup.block_pairs(held, nodes, neardup.SIMILARITY, nearest=True).collect()
    assert len(rows) == 60 * 59 // 2 and not any(r.crowded for r in rows)  # all in one round, each from one bucket
    monkeypatch.setattr(neardup, "CROWD", 2)
    held, nodes = crowd(spark)
    rows = neardup.block_pairs(held, nodes, neardup.SIMILARITY, nearest=True).collect()
    assert all(r.crowded for r in rows) and len({(r.a, r.b) for r in rows}) < 60 * 59 // 2
    assert len(neardup.block_pairs(held, nodes, neardup.SIMILARITY).collect()) == 60 * 59 // 2


@pytest.mark.parametrize("few", [0, 20_000])
def test_contraction_of_few_and_of_many_links(spark, monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW_LINKS", few)
    rng = np.random.default_rng(14)
    names = [bytes([k // 256, k % 256]) for k in range(300)]
    roots, links = dict(zip(names, names, strict=True)), []
    for a, b in rng.integers(0, 300, (180, 2)):
        links.append((names[a], names[b]))
        low, high = sorted((roots[names[a]], roots[names[b]]))
        roots = {k: low if r == high else r for k, r in roots.items()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    half = len(links) // 2
    labels = None
    for some in (links[:half], links[half:], links[:1]):
        labels = neardup.merged(labels, spark.createDataFrame(some, "a binary, b binary"))
    rows = labels.collect()
    assert len(rows) == len(linked) and {bytes(r.node): bytes(r.root) for r in rows} == {k: roots[k] for k in linked}
