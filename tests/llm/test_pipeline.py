"""The pipeline's stages against brute force, each on its own input."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from columnlens.llm import language, pieces, toxicity
from columnlens.llm.queries import tokenizer_path

from .common import SF
from .test_decontaminate import brute as windows
from .test_forest import brute as groups


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def test_columns(written):
    for before, _, names, after in written[:-1]:
        assert after == names


def test_toxicity(spark, written):
    before, after, *_ = written[0]
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    bad = model.scores([r["text"] for r in before]) >= 0.5
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r, b in zip(before, bad) if not b}


def test_toxic_documents_go(spark):
    """At a scale with enough labels to learn from."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in pipeline.clean_of_toxicity(spark, docs, sf).select("doc_id").collect()}
    labels = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    toxic, clean = ({r["doc_id"] for r in labels if r["toxic"] == k} for k in (1, 0))
    assert len(toxic & kept) <= 0.1 * len(toxic) and len(clean - kept) <= 0.02 * len(clean)


def test_language(written):
    before, after, *_ = written[1]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if r["text"] and language._LETTER.search(r["text"])}


def test_near_duplicates(written):
    before, after, *_ = written[2]
    found = groups([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == {g for _, g, _ in found.values()}


def test_decontamination(written):
    before, after, *_ = written[3]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if not windows(r["text"], items)[3]}


def test_pieces(written):
    before, after, *_ = written[4]
    encoder = pieces.Encoder(tokenizer_path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before) and all(encoder.decode(r["ids"]) == texts[r["doc_id"]] for r in after)


def test_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeats and a column more go through all stages."""
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (3, "12 !", None, "s", 4, None), (None, "some words here", "en", None, None, "y"),
            (4, "the same text of six words", "en", "s", 1, "z"), (4, "the same text of six words", "en", "s", 1, "z"), (5, "The same text of six words.", "de", "s", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs = docs.withColumn("predicted", F.col("score")).withColumn("class", F.lit(7)).withColumn("n_hit", F.lit("n"))
    given = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        after = stage(spark, docs, SF)
        after.write.parquet(str(tmp_path / name))
        if name != "sentencepiece":
            assert all(r == given[r["doc_id"]] for r in after.collect())
        docs = spark.read.parquet(str(tmp_path / name))
    assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["4", "None"]


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0
