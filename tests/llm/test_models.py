"""Toxicity and language: held-out accuracy, defined results for odd rows."""

import zlib

import pyarrow.parquet as pq
import numpy as np
import pytest

from columnlens.llm import language, toxicity
from columnlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_toxicity_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    assert all(r["held_out"] == held_out(d) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for d, r in got.items())
    labels = [r for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if held_out(r["doc_id"])]
    right = sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in labels)
    assert right >= 0.94 * len(labels)
    order = sorted(labels, key=lambda r: got[r["doc_id"]]["score"])
    ranks = [i for i, r in enumerate(order, 1) if r["toxic"]]
    n, m = len(ranks), len(order) - len(ranks)
    assert (sum(ranks) - n * (n + 1) / 2) / (n * m) > 0.97


def test_toxicity_insult_in_long_text(spark):
    clean = ["the calm river ran on by the old mill and the town " * 4, "ein ruhiger Tag am Fluss mit Freunden " * 3] * 30
    bad = [c + " you zorgface " + c for c in clean]
    model = toxicity.train(clean + bad, [0] * len(clean) + [1] * len(bad))
    long = "the calm river ran on by the old mill and the town " * 2000
    scores = model.scores([long, long + "you zorgface " + long, "", None])
    assert scores[0] < 0.5 < scores[1] and scores[2] == scores[3]


@pytest.mark.parametrize("labels", [[], [0, 0], [1], [0, 1], [1, 0, 0, 1, 0, 0]])
def test_toxicity_few_labels(labels):
    model = toxicity.train([f"text number {i}" for i in range(len(labels))], labels)
    assert all(0 <= s <= 1 for s in model.scores(["x", "", None, "y" * 50_000]))


def test_toxicity_rows(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else f"text {i}", "s") for i in range(40)] + [(None, "x", "t"), (5, "text 5", "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2 if i != 4 else None) for i in range(40)] + [(None, 1), (77, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"] and got.count() == 42
    assert got.where("score is null or predicted is null").count() == 0
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs, labels.limit(0))).count() == 0


def test_language_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    mine = [r for r in docs if held_out(r["doc_id"])]
    assert all(got[r["doc_id"]]["held_out"] == held_out(r["doc_id"]) for r in docs)
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in mine) >= 0.97 * len(mine)


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, "the house and the river " * 5 if i % 2 else "der Fluss und das Haus " * 5, "en" if i % 2 else "de", "c") for i in range(40)]
        + [(100, None, "en", None), (101, "", "en", None), (102, "12 _ !?", None, None), (103, "das Haus " * 30_000, None, None), (None, "und der", None, None)],
        "doc_id long, text string, lang string, lang_score string")
    got = {r["doc_id"]: r for r in language.identified(docs, language.fit(docs)).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103, None, 1, 2)] == ["und", "und", "und", "de", "de", "en", "de"]
    assert got[100]["lang_score"] == 0 and all(0 <= r["lang_score"] <= 1 for r in got.values())
    nothing = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identified(docs, nothing).collect()} == {"und"}
    one = language.fit(docs.where("lang = 'de'"))
    assert {r["lang_pred"] for r in language.identified(docs.where("doc_id < 40"), one).collect()} == {"de"}


def test_landmark_kernel():
    """The features' inner products are the kernel of landmark texts themselves."""
    import numpy as np

    texts = ["abc abd", "xyz", "abc xyz", "äöü"]
    p = language.presence(texts)

    def kernel(a, b):
        grams = [{s[i : i + n] for n in language.SIZES for i in range(len(s) - n + 1)} for s in (f" {a} ", f" {b} ")]
        return len(grams[0] & grams[1]) / np.sqrt(len(grams[0]) * len(grams[1]))

    want = [[kernel(a, b) for b in texts] for a in texts]
    assert np.allclose(p @ p.T, want, atol=0.03)  # up to collisions of hashes


def test_language_learns_from_different_texts(spark, monkeypatch):
    """Copies of a text are one row of the sample, and no two landmarks of a language."""
    texts = [f"text number {i} " + "word" * (i % 7) for i in range(200)]
    rows = [(10_000 + k, t, ("de", "fr")[i % 2]) for i, t in enumerate(texts) for k in range(20 * i, 20 * i + 20)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, languages: seen.append((texts, languages)))
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 400)
    assert sorted(seen[0][0]) == sorted(texts)
    monkeypatch.undo()
    model = language.train(["a a copy that sorts first"] * 300 + texts, ["de"] * 500, landmarks=50)
    assert len(np.unique(model.landmarks, axis=1).T) == 50
