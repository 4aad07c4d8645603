"""Files in and out."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

import columnlens as cl

HEADER = "zip\tb\td\tx\tx\tm.n"
ROWS = ["01234\ttrue\t2019-01-02\t1\t2\t", '10001\tfalse\t2019-01-03\t1.5\t""\t"two\nlines"']


@pytest.fixture
def folder(tmp_path):
    text = "\n".join([HEADER, *ROWS]) + "\n"
    with gzip.open(tmp_path / "one.tsv.gz", "wt") as f:
        f.write(text)
    (tmp_path / "two.tsv").write_text(text)
    (tmp_path / "bad.tsv.gz").write_bytes(b"\x1f\x8b not a gzip file")
    (tmp_path / "datasets.tsv").write_text("one\tFirst\nbad\tBroken\nnone\tMissing\n")
    return tmp_path


def test_table_keeps_text(spark, folder):
    for name in ("one.tsv.gz", "two.tsv"):
        table = cl.read_table(spark, str(folder / name))
        assert table.columns == ["zip", "b", "d", "x3", "x4", "m.n"]
        assert [tuple(r) for r in table.orderBy("zip").collect()] == [
            ("01234", "true", "2019-01-02", "1", "2", None),
            ("10001", "false", "2019-01-03", "1.5", None, "two\nlines"),
        ]
    spread = cl.read_table(spark, str(folder / "one.tsv.gz"), partitions=4)
    assert spread.rdd.getNumPartitions() == 4 and spread.count() == 2


def test_inferred_types(spark, folder):
    table = cl.read_table(spark, str(folder / "two.tsv"), infer_schema=True)
    types = dict(table.dtypes)
    assert types["zip"] == "int" and types["b"] == "boolean" and types["d"] == "date"
    kinds = {(r["column"], r["value_type"]) for r in cl.typed_counts(table).collect()}
    assert ("d", cl.fixed_values.DATE) in kinds and ("b", cl.fixed_values.INTEGER) in kinds


def test_failures_are_set_aside(spark, folder):
    catalog = cl.read_catalog(spark, str(folder / "datasets.tsv"))
    paths = {r["dataset"]: r["path"] for r in catalog.collect()}
    assert paths["one"] == str(folder / "one.tsv.gz")
    out = str(folder / "profiles")

    def work(opened):
        tables = {d: table for (d,), table in opened.items()}
        cl.write_profiles(cl.profile_corpus(tables), out, mode="append")

    items = [(d,) for d in paths]
    failed = cl.run_each(spark, items, work, lambda item: cl.read_table(spark, paths[item[0]]))
    assert [(r["idx"], r["dataset"]) for r in failed.orderBy("idx").collect()] == [(1, "bad"), (2, "none")]
    assert [r["dataset_name"] for r in cl.read_profiles(spark, out).collect()] == ["one"]


def test_a_batch_is_halved_around_its_bad_item(spark):
    done = []

    def work(opened):
        if ("bad", "c") in opened:
            raise ValueError("broken")
        done.extend(opened)

    items = [("a", "c"), ("b", "c"), ("bad", "c"), ("d", "c"), ("e", "c")]
    failed = cl.run_each(spark, items, work, batch=5)
    assert [tuple(r) for r in failed.collect()] == [(2, "bad", "c", "ValueError: broken")]
    assert sorted(done) == sorted(set(items) - {("bad", "c")})


def test_lists(spark, tmp_path):
    (tmp_path / "work.txt").write_text("['ab-1.CITY_NAME.txt.gz', 'ab-2.Phone.txt.gz']\n")
    (tmp_path / "truth.txt").write_text("0 city\n1 phone_number,other a note, here\r\n")
    work = cl.read_worklist(spark, str(tmp_path / "work.txt"))
    truth = cl.read_truth(spark, str(tmp_path / "truth.txt"))
    assert [tuple(r) for r in work.collect()] == [(0, "ab-1", "CITY_NAME"), (1, "ab-2", "Phone")]
    assert [tuple(r) for r in truth.collect()] == [(0, ["city"]), (1, ["phone_number", "other"])]
    manual = cl.manual_labels(work, truth).filter("column_name = 'Phone'").first()
    assert [m["semantic_type"] for m in manual["manual_labels"]] == ["phone_number", "other"]
    cl.write_labels(cl.label_lines(work, truth), str(tmp_path / "labels"))
    lines = sorted((tmp_path / "labels").glob("part-*"))
    written = [json.loads(line) for file in lines for line in file.read_text().splitlines()]
    assert written[0] == {"actual_types": list(cl.fixed_values.SEMANTIC_TYPES)}
    assert len(written) == 1 + work.join(truth, "idx").count()
    assert written[1].keys() == {"dataset_name", "column_name", "manual_labels"}


def test_terms(spark, tmp_path):
    (tmp_path / "terms.txt").write_bytes(b"Crown Heights \r\nflatbush\r\nFLATBUSH\r\n\r\n")
    (tmp_path / "names.txt").write_text("SMITH\t1\t2,442\nJAMES\t2\t3\n")
    (tmp_path / "agencies.txt").write_text("3-1-1\nFire Department, City (FDNY)\n")

    def terms(frame):
        return sorted(r["term"] for r in frame.collect())

    assert terms(cl.read_terms(spark, str(tmp_path / "terms.txt"), "n")) == ["crown heights", "flatbush"]
    assert terms(cl.read_terms(spark, str(tmp_path / "names.txt"), "n", field=0, sep="\t")) == ["james", "smith"]
    both = cl.read_terms_with_abbrev(spark, str(tmp_path / "agencies.txt"), "a")
    assert terms(both) == ["3-1-1", "fdny", "fire department, city"]
    strict = cl.read_terms_with_abbrev(spark, str(tmp_path / "agencies.txt"), "a", keep_plain=False)
    assert terms(strict) == ["fdny", "fire department, city"]


def test_combined_documents(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    documents = [{"a": 1, "t": "x\ny  z"}, {"a": 2.5, "t": None, "l": [{"k": "v"}]}]
    for i, document in enumerate(documents):
        (source / f"{i}.json").write_text(json.dumps(document, indent=1 if i else None))
    cl.combine_json(spark, str(source), str(target))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(target)).collect()]
    assert sorted(lines, key=lambda d: d["a"]) == documents
    cl.combine_json(spark, str(target), str(tmp_path / "again"), whole_files=False, files=1)
    assert spark.read.text(str(tmp_path / "again")).count() == 2


def test_keys_and_metrics(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2), (2, 2)], "a int, b int")
    cl.write_keys(cl.key_candidates(frame), str(tmp_path / "keys"))
    assert spark.read.json(str(tmp_path / "keys")).first()["key"] == ["a"]
    metrics = spark.createDataFrame([("b", 1), ("a", 2)], "label string, actual int")
    cl.write_metrics(metrics, str(tmp_path / "metrics"))
    assert [r["label"] for r in spark.read.json(str(tmp_path / "metrics")).collect()] == ["a", "b"]


def test_tallies(spark):
    values = ["Bronx", " bronx", "12 Elm St", "Elm St", "a", "N/A", "None", "", "west 4 street", "bronx"]
    tally = cl.value_tally(spark.createDataFrame([(v,) for v in values], "value string"))
    assert {r["value"]: r["n"] for r in tally.collect()}["bronx"] == 3
    words = cl.without_numbers(tally)
    assert [r["value"] for r in cl.top_values(words, 2).collect()] == ["bronx", ""]
    assert {r["value"] for r in cl.empty_labels(words).collect()} == {"", "n/a", "none"}
    assert {r["value"] for r in cl.filled_values(words).collect()} == {"bronx", "elm st", "west 4 street"}
    names = spark.createDataFrame([("Bronx",), ("Queens",)], "term string")
    assert [tuple(r) for r in cl.term_mentions(tally, names).collect()] == [("bronx", 3)]
    assert [r["value"] for r in cl.pattern_mentions(tally).collect()] == ["12 elm st", "elm st", "west 4 street"]
