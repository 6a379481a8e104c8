"""Classifier: held-out accuracy on planted words, defined cases."""

import numpy as np
from helpers import docs_frame, with_odd_columns
from pyspark.sql import functions as F

from tideframe.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def planted(n=900, seed=0):
    rng = np.random.default_rng(seed)
    plain = {"en": ["the", "of", "and", *[f"enword{i}" for i in range(300)]], "de": ["der", "und", "die", *[f"dewort{i}" for i in range(300)]]}
    bad = {"en": ["awful", "nasty", "vile"], "de": [f"schlimm{e}" for e in ("er", "es", "em", "en", "ste")]}
    texts, labels = [], []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        words = [plain[lang][j] for j in rng.integers(0, len(plain[lang]), rng.integers(10, 120))]
        toxic = rng.random() < 0.2
        for _ in range(2 * toxic):
            words.insert(rng.integers(len(words)), bad[lang][rng.integers(len(bad[lang]))])
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = planted()
    docs = with_odd_columns(docs_frame(spark, texts), "row", "score")
    frame = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], LABELS)
    scored = toxicity.classify(docs, frame).withColumn("held_out", ~toxicity.learnable(F.col("doc_id")))
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in scored.collect() if r.held_out]
    assert len(held) > 120
    assert np.mean([p == y for _, p, y in held]) > 0.95
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert all(0 <= s <= 1 and p == (s >= 0.5) for s, p, _ in held)


def test_score_reads_only_the_text():
    texts, labels = planted(300)
    sample = toxicity.Sample(*toxicity.word_ids(texts), np.array(labels, dtype=float), np.arange(300) % 5 == 0)
    model = toxicity.train(sample)
    again = model.score([texts[0], "", None, texts[0]])
    assert again[0] == again[3] and again[1] == again[2] and 0 <= again[1] < 0.5
    whole = model.score(["word " * 300_000 + "awful"])
    assert whole[0] > model.score(["word " * 300_000])[0]  # the last word of a very long text counts


def test_without_both_classes(spark):
    docs = docs_frame(spark, ["a", None, "b"])
    empty = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.classify(docs, empty).collect()] == [0.0] * 3
    one = spark.createDataFrame([(0, 1, 0), (1, 0, None), (None, 1, 1), (7, 1, 1)], LABELS)
    assert {r.predicted for r in toxicity.classify(docs, one).collect()} == {0}
    assert toxicity.classify(docs.limit(0), empty).count() == 0


def test_repeated_labels_and_rows(spark):
    texts, labels = planted(200)
    rows = [(i, 1, y) for i, y in enumerate(labels)] * 2 + [(0, 1, 0)]
    docs = docs_frame(spark, [*enumerate(texts), (0, texts[0])])
    scored = toxicity.classify(docs, spark.createDataFrame(rows, LABELS)).collect()
    assert len(scored) == 201 and len({r.score for r in scored if r.doc_id == 0}) == 1


def test_calibration_by_language():
    z = np.array([3.0, 2.0, 1.0, 0.0])
    assert toxicity.best_threshold(z, np.array([1, 1, 0, 0])) == 1.5
    assert toxicity.best_threshold(np.zeros(4), np.array([1, 0, 0, 0])) < 0
    guessed = toxicity.word_ids(["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el gato y los perros", ""])[3]
    assert guessed.tolist() == [0, 1, 2, 3, 0]


def test_thresholds_cover_all_labelled_rows(spark, monkeypatch):
    """Counts stand for every learnable row, long ones too; a capped sample does not change their shares."""
    texts, labels = planted(400)
    texts = [t + " plain" * 100 if i % 10 == 1 else t for i, t in enumerate(texts)]
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 130)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 60)
    seen = []
    real = toxicity.calibrate
    monkeypatch.setattr(toxicity, "calibrate", lambda model, counts: (seen.append(counts), real(model, counts)))
    frame = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], LABELS)
    docs = docs_frame(spark, texts)
    toxicity.fit_from(docs, frame)
    counts = seen[0].to_pandas()
    learnable = docs.filter(toxicity.learnable(F.col("doc_id"))).count()
    assert counts.n.sum() == learnable and counts[counts.long == 1].n.sum() > 20
    assert counts[(counts.used == 1) & (counts.toxic == 0)].n.sum() <= 60 and not counts[(counts.long == 1) & (counts.used == 1)].n.sum()


def test_threshold_of_weighted_values():
    z, y = np.array([3.0, 2.0, 1.0, 0.0]), np.array([1.0, 0.0, 1.0, 0.0])
    assert toxicity.best_threshold(z, y) == 0.5
    assert toxicity.best_threshold(z, y, np.array([1.0, 9.0, 1.0, 9.0])) == 2.5


def test_words_of_a_sample_row_are_those_of_the_tokenizer(spark, monkeypatch):
    texts = ["a\nb\tc,d", "", None, "one two", "x " * 30]
    by_word, _, starts, _ = toxicity.word_ids(texts)
    assert toxicity.word_counts(by_word, starts).tolist() == [4, 0, 0, 2, 30]
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 3)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda sample: seen.append(sample))
    ids = [i for i in range(200) if toxicity.zlib.crc32(str(i).encode()) % 5][:4]
    docs = spark.createDataFrame(list(zip(ids, ["a\nb\tc\nd", "one two", "bad", None], strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    assert toxicity.fit_from(docs, labels) is None
    assert len(seen[0].starts) == 3  # four words between line ends and tabs are too many
