"""Spaced-seed leaks against brute force."""

import numpy as np
from helpers import docs_frame, with_odd_columns

from tideframe.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def items_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), ITEMS)


def words(rng, n, prefix="w"):
    return [f"{prefix}{i}" for i in rng.integers(0, 500, n)]


def leaks(spark, docs, items):
    return {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, items).collect()}


def test_planted_passages(spark):
    rng = np.random.default_rng(2)
    items = [words(rng, n, "b") for n in (13, 20, 40, 90, 30, 16)]
    clean = [words(rng, 150) for _ in range(20)]
    texts, want = [], set()
    for i, item in enumerate(items):
        for subs in (0, 1, len(item) // 10):
            changed = list(item)
            for place in rng.choice(len(item), subs, replace=False):
                changed[place] = "other"
            want.add((len(texts), i))
            texts.append(" ".join(clean[0][:30] + changed + clean[1][:20]).upper() + "!")
    n = len(texts)
    texts += [" ".join(c) for c in clean] + [" ".join(clean[0] + items[2][:9] + clean[3])]
    found = leaks(spark, docs_frame(spark, texts), items_frame(spark, [" ".join(i) for i in items]))
    assert found == want and all(d < n for d, _ in found)


def test_best_stretch_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        doc, item = rng.integers(0, 3, rng.integers(1, 25)), rng.integers(0, 3, rng.integers(1, 12))
        diagonal = int(rng.integers(-12, 25))
        first, length, equal = dc.best_stretch(doc, item, diagonal)
        places = [i for i in range(len(item)) if 0 <= i + diagonal < len(doc)]
        score = lambda a, b: sum(1 if doc[i + diagonal] == item[i] else -dc.MISMATCH for i in places[a:b])
        best = max([0] + [score(a, b) for a in range(len(places)) for b in range(a + 1, len(places) + 1)])
        assert (length and equal - dc.MISMATCH * (length - equal)) == best


def test_short_items_and_defined_cases(spark):
    items = ["three short words", "Three, short words!", None, "", "solo"]
    texts = ["here are three short words now", "three short other words", None, "", "the solo one", (4, "solo"), (None, "solo")]
    docs = with_odd_columns(docs_frame(spark, texts), "item", "key", "seeds")
    found = sorted(((r.doc_id, r.item_id, r.n_words) for r in dc.find_leaks(docs, items_frame(spark, items)).collect()), key=str)
    assert found == sorted([(0, 0, 3), (0, 1, 3), (4, 4, 1), (4, 4, 1), (None, 4, 1)], key=str)
    assert leaks(spark, docs.limit(0), items_frame(spark, items)) == set()
    assert leaks(spark, docs, items_frame(spark, ["x"]).limit(0)) == set()


def test_drop_leaking(spark):
    docs = with_odd_columns(docs_frame(spark, ["a solo b", "fine", None]), "leaking")
    kept = dc.drop_leaking(docs, items_frame(spark, ["solo"]))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_full_bitmap_still_exact(spark, monkeypatch):
    """Whatever the bitmap lets through, the join decides."""
    monkeypatch.setattr(dc, "bitmap_of", lambda seeds: np.ones(dc.BITS, dtype=bool))
    docs = docs_frame(spark, ["only clean words in here " * 5, "a b c d e f g h i j k l m n"])
    assert leaks(spark, docs, items_frame(spark, ["a b c d e f g h i j k l m n", "q r s t u v w x y z aa bb cc"])) == {(1, 0)}


def test_substitutions_at_every_place(spark):
    """Items of 5 to 25 words with up to three words replaced, anywhere, are leaks at 0.8 of their words; not below."""
    rng = np.random.default_rng(9)
    sizes = [5, 7, 9, 10, 11, 13, 15, 18, 20, 25]
    items, texts, want = [[f"i{k}w{j}" for j in range(n)] for k, n in enumerate(sizes)], [], set()
    for k, item in enumerate(items):
        n = len(item)
        sets = [(p,) for p in range(n)] + [tuple(rng.choice(n, s, replace=False)) for s in (2, 3) for _ in range(25)] + [tuple(range(2, n, n // 3))]
        for places in sets:
            if n - len(places) >= dc.IDENTITY * n - 1e-9:
                want.add((len(texts), k))
            elif n > 10:
                continue  # a stretch of 13 words may be left
            texts.append(" ".join(["before"] * 6 + ["other" if j in places else w for j, w in enumerate(item)] + ["after"] * 6))
    assert leaks(spark, docs_frame(spark, texts), items_frame(spark, [" ".join(i) for i in items])) == want
