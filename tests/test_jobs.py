"""A small corpus from files to files."""

import gzip
import json

import pytest

import columnlens as cl


def rows(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(path, recursiveFileLookup=True).collect()]


@pytest.fixture
def corpus(tmp_path):
    tables = {
        "d-1": "CITY NAME\tPhone\n" + "\n".join(f"{c}\t212-555-{i:04}" for i, c in enumerate(["Albany", "albany", "Yonkers", "N/A"])),
        "d-2": "Boro\tm.n\n" + "\n".join(["Brooklin\t1", "QUEENS\t2", "x y z\t2"]),
        "d-3": "zip\n10001\n10002-1234\n",
    }
    for name, text in tables.items():
        with gzip.open(tmp_path / f"{name}.tsv.gz", "wt") as f:
            f.write(text + "\n")
    (tmp_path / "d-4.tsv.gz").write_bytes(b"\x1f\x8bbroken")
    (tmp_path / "datasets.tsv").write_text("".join(f"d-{i}\tname {i}\n" for i in range(1, 5)))
    listed = ["d-1.CITY_NAME", "d-1.Phone", "d-2.Boro", "d-2.Nope", "d-4.x", "d-3.zip", "d-2.Boro"]
    (tmp_path / "work.txt").write_text("[" + ", ".join(f"'{n}.txt.gz'" for n in listed) + "]\n")
    truth = ["city", "phone_number", "borough,other", "color", "color", "zip_code note", "borough,other", "borough"]
    (tmp_path / "truth.txt").write_text("".join(f"{i} {t}\n" for i, t in enumerate(truth)))
    return tmp_path


def test_profiles_and_report(spark, corpus):
    out = str(corpus / "out")
    failed = cl.profile_datasets(spark, str(corpus / "datasets.tsv"), out)
    assert [r["dataset"] for r in failed.collect()] == ["d-4"]
    documents = {d["dataset_name"]: d for d in rows(spark, out + "/profiles")}
    assert set(documents) == {"d-1", "d-2", "d-3"}
    assert [c["column_name"] for c in documents["d-2"]["columns"]] == ["Boro", "m.n"]
    cl.report(spark, out + "/profiles", str(corpus / "report"))
    assert rows(spark, str(corpus / "report/boroughs")) == [{"value": "queens", "n": 1}]
    assert rows(spark, str(corpus / "report/empty_labels")) == [{"value": "n/a", "n": 1}]
    assert len(rows(spark, str(corpus / "report/top_values"))) == 14


def test_keys(spark, corpus):
    out = str(corpus / "out")
    failed = cl.find_keys(spark, str(corpus / "datasets.tsv"), out)
    assert failed.count() == 1
    assert {(r["dataset"], tuple(r["key"])) for r in rows(spark, out + "/keys")} == {
        ("d-1", ("CITY NAME",)), ("d-1", ("Phone",)), ("d-2", ("Boro",)), ("d-3", ("zip",))
    }


def test_labels(spark, corpus):
    out = str(corpus / "out")
    cities = spark.createDataFrame([("city", "albany"), ("city", "yonkers")], "label string, term string")
    failed = cl.label_columns(
        spark, str(corpus / "work.txt"), str(corpus / "truth.txt"), str(corpus), out, dictionary=cities
    )
    assert {(r["dataset"], r["column"]) for r in failed.collect()} == {("d-4", None), ("d-2", "Nope")}
    documents = {(d["dataset_name"], d["column_name"]): d for d in rows(spark, out + "/documents")}
    assert documents[("d-1", "CITY_NAME")]["semantic_types"] == [{"semantic_type": "city", "count": 3}]
    assert documents[("d-2", "Boro")]["semantic_types"] == [
        {"semantic_type": "borough", "count": 2},
        {"semantic_type": "other", "count": 1, "label": ["borough", "other"]},
    ]
    scores = {r["label"]: (r["precision"], r["recall"]) for r in rows(spark, out + "/precision_recall")}
    assert scores["city"] == scores["borough"] == scores["zip_code"] == (1.0, 1.0)
    assert scores["color"] == (0.0, 0.0)
    assert [r["idx"] for r in rows(spark, out + "/unmatched_labels")] == [7]
    assert len(rows(spark, out + "/manual_labels")) == 8  # the vocabulary, and seven entries
    assert {r["idx"]: r.get("precision") for r in rows(spark, out + "/column_precision")} == {
        0: 1.0, 1: 1.0, 2: 1.0, 3: None, 4: None, 5: 1.0
    }


def test_an_older_run_is_not_added_to(spark, corpus):
    out = str(corpus / "out")
    cl.profile_datasets(spark, str(corpus / "datasets.tsv"), out)
    with pytest.raises(Exception, match="already exists"):
        cl.profile_datasets(spark, str(corpus / "datasets.tsv"), out)
