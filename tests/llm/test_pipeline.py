"""The stages in order on a small corpus, each against a brute-force version of its rule."""

import numpy as np
import pytest
from helpers import docs_frame, with_odd_columns

import corpus_pipeline
from tideframe.llm import toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """120 clean texts, toxic ones, copies, a recurring line and a leak."""
    rng = np.random.default_rng(8)
    path = tmp_path_factory.mktemp("corpus")
    clean = [" ".join(f"c{i}w{j}" for j in rng.integers(0, 5000, 60)) for i in range(120)]
    item = " ".join(f"item{j}" for j in range(30))
    texts = list(clean)
    texts[7] += "\nthis line recurs in other documents too"
    texts += [f"awful nasty {t} vile" for t in clean[:60]]  # 120..179
    texts += [clean[3], " ".join(["changed", *clean[4].split()[1:]]), "own words of this document and then some\nthis line recurs in other documents too"]
    texts += ["before the passage " + item + " after it", None]
    docs_frame(spark, texts).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(120 <= i < 180)) for i in range(180)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), texts


def test_stages(spark, folder):
    path, texts = folder
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near duplicates", "benchmark decontamination", "byte-level BPE"]
    docs = with_odd_columns(spark.read.parquet(f"{path}/documents.parquet"), "score", "document", "key", "n_lines")
    want = set(range(len(texts))) - set(range(120, 180))
    for (name, stage), lost in zip(corpus_pipeline.STAGES[:4], [set(), {180}, {181}, {183}], strict=True):
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        want -= lost
        rows = {r.doc_id: r for r in out.collect()}
        assert set(rows) == want, name
        docs = out
    assert rows[182].text == "own words of this document and then some" and rows[182].n_chars == len(rows[182].text)
    assert rows[7].text == texts[7] and rows[184].text is None


def test_run(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns)
    assert {r.doc_id for r in out.collect()} == set(range(120)) | {182, 184}


def test_empty_tables(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxicity_rejects_by_its_rule(spark, folder):
    path, texts = folder
    model = toxicity.fit_from(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    assert {i for i, s in enumerate(model.score(texts)) if s >= 0.5} == set(range(120, 180))
