"""Counts, statistics and documents against plain Python."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

import columnlens as cl
from columnlens import fixed_values as fixed


@pytest.fixture
def skewed(spark):
    """One value fills a third of the rows; names need quoting."""
    rng = random.Random(3)
    rows = []
    for i in range(3_000):
        hot = i % 3 == 0
        rows.append(
            (
                "hot" if hot else rng.choice(["a", "bb", "ccc", None, f"v{i}"]),
                7 if hot else rng.randrange(-50, 50),
                float(rng.randrange(1000)) / 8,
            )
        )
    return spark.createDataFrame(rows, "`a.b` string, `x y` int, `r` double").repartition(5), rows


def test_value_counts(skewed):
    frame, rows = skewed
    got = {(r["column"], r["value"]): r["cnt"] for r in cl.value_counts(frame).collect()}
    want = {}
    for text, number, real in rows:
        for key in (("a.b", text), ("x y", str(number)), ("r", str(real))):
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_numbers_are_weighted_by_cells(skewed):
    frame, rows = skewed
    stats = {r["column"]: r for r in cl.numeric_stats(cl.typed_counts(frame), 3).collect()}
    for name, i in (("x y", 1), ("r", 2)):
        cells = [row[i] for row in rows]
        assert stats[name]["mean"] == pytest.approx(statistics.fmean(cells))
        assert stats[name]["stddev"] == pytest.approx(statistics.pstdev(cells))
        assert stats[name]["cells"] == len(cells)
    unhinted = {r["column"]: r for r in cl.numeric_stats(cl.typed_counts(frame)).collect()}
    assert {k: v["stddev"] for k, v in unhinted.items()} == pytest.approx(
        {k: v["stddev"] for k, v in stats.items()}
    )


def test_deviation_of_large_numbers_keeps_its_digits(spark):
    base = 9_000_000_000_000_000
    frame = spark.createDataFrame([(base + i % 3,) for i in range(300)], "n bigint")
    row = cl.numeric_stats(cl.typed_counts(frame)).first()
    assert row["mean"] == base + 1
    assert row["stddev"] == pytest.approx(statistics.pstdev([0, 1, 2]))


def test_text_extremes_repeat_values(strings):
    values = ["aa"] * 3 + ["b"] * 2 + ["cccc"] * 9 + ["dd", "eeee"]
    counts = cl.typed_counts(strings(values))
    row = cl.text_stats(counts).first()
    assert row["shortest_values"] == ["b", "b", "aa", "aa", "aa"]
    assert row["longest_values"] == ["cccc"] * 5
    assert row["average_length"] == pytest.approx(sum(map(len, values)) / len(values))


def test_frequent_values_break_ties_by_value(strings):
    counts = cl.value_counts(strings(["b", "a", None, "c", "c", "d", "e", "f", None]))
    got = [(r["value"], r["cnt"]) for r in cl.frequent_values(counts).orderBy("rank").collect()]
    assert got == [(None, 2), ("c", 2), ("a", 1), ("b", 1), ("d", 1)]


def test_the_rank_limit_is_applied_before_the_shuffle(spark, strings):
    frame = cl.frequent_values(cl.value_counts(strings([f"v{i}" for i in range(100)])))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # in each task, and once merged


def test_one_scan_and_one_shuffle_serve_the_whole_profile(spark):
    folder = spark.conf.get("spark.checkpoint.dir") + "/profile-input"
    spark.range(1000).select(
        F.col("id").cast("string").alias("a"), (F.col("id") % 7).cast("string").alias("b")
    ).write.mode("overwrite").parquet(folder)
    frame = cl.profile(spark.read.parquet(folder), "t")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_document(spark, skewed):
    frame, rows = skewed
    path = spark.conf.get("spark.checkpoint.dir") + "/profile-document"
    document = cl.profile(frame, "skewed")
    cl.write_profiles(document, path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert len(lines) == 1 and lines[0]["dataset_name"] == "skewed"
    by_name = {c["column_name"]: c for c in lines[0]["columns"]}
    assert [c["column_name"] for c in lines[0]["columns"]] == ["a.b", "x y", "r"]
    text = by_name["a.b"]
    assert text["number_distinct_values"] == len({r[0] for r in rows})
    assert text["number_empty_cells"] == sum(r[0] is None for r in rows)
    assert text["number_empty_cells"] + text["number_non_empty_cells"] == len(rows)
    assert text["frequent_values"][0] == "hot" and "None" in text["frequent_values"]
    assert set(text["data_types"][0]) == {
        "type", "count", "shortest_values", "longest_values", "average_length"
    }
    number = by_name["x y"]["data_types"][0]
    assert number["type"] == fixed.INTEGER
    assert (number["min_value"], number["max_value"]) == (
        min(r[1] for r in rows), max(r[1] for r in rows)
    )
    back = cl.read_profiles(spark, path)
    tally = {r["value"]: r["n"] for r in cl.value_tally(back).collect()}
    assert tally["hot"] == 1 and tally["none"] == 1


def test_dates_and_mixed_cells(strings):
    frame = strings(["1/2/2019", "2018-12-31", "5", "5.5", None, "x"])
    c = cl.profile(frame, "d").select(F.explode("columns").alias("c")).select("c.*").first()
    types = {t["type"]: t for t in c["data_types"]}
    assert [t["type"] for t in c["data_types"]] == [
        fixed.INTEGER, fixed.REAL, fixed.DATE, fixed.TEXT
    ]
    assert str(types[fixed.DATE]["min_date"]) == "2018-12-31"
    assert str(types[fixed.DATE]["max_date"]) == "2019-01-02"


def test_typed_columns(spark):
    frame = spark.sql(
        "SELECT true AS b, DATE'2020-01-02' AS d, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS t, "
        "CAST(1.5 AS DECIMAL(5,2)) AS c, array(1) AS a, CAST(NULL AS INT) AS n"
    )
    got = {r["column"]: r["value_type"] for r in cl.typed_counts(frame).collect()}
    assert got == {
        "b": fixed.INTEGER, "d": fixed.DATE, "t": fixed.DATE, "c": fixed.REAL,
        "a": fixed.TEXT, "n": None,
    }


def test_corpus_equals_single_profiles(spark, strings):
    tables = {
        "one": strings(["1", "2", "x", None], "c"),
        "two": spark.createDataFrame([(1, "a"), (2, "b")], "n int, c string"),
    }
    together = {r["dataset_name"]: r["columns"] for r in cl.profile_corpus(tables).collect()}
    for name, frame in tables.items():
        assert together[name] == cl.profile(frame, name).first()["columns"]


def test_empty_table_and_checkpoint(spark, strings):
    assert cl.profile(strings([]), "none").count() == 0
    frame = strings(["1", "a", "a"])
    assert cl.profile(frame, "x", checkpoint=True).collect() == cl.profile(frame, "x").collect()


def test_texts_are_not_broadcast_unseen(spark):
    """Frames that hold cells are joined as Spark measures them, whatever the column bound."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(20).selectExpr("concat('text ', repeat('x', 100000), id) AS t", "id AS n")
        plan = cl.profile(frame)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Join" in line and "strategy=broadcast" in line:
                assert "shortest_values" not in line and "frequent_values" not in line
        hinted = plan.count("strategy=broadcast")
        assert hinted <= 2  # means and deviations
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_extremes_in_their_own_type(spark):
    frame = spark.sql("""
        SELECT * FROM VALUES
            (CAST('9007199254740993' AS decimal(38,1)), timestamp_ntz'2020-01-01 10:00:00.000001', array(2), map(1, 2), null, 'b'),
            (CAST('9007199254740992.5' AS decimal(38,1)), timestamp_ntz'2020-01-01 10:00:00', array(10), map(1, 3), null, 'a')
        AS t(d, t, list, entries, `no.thing`, s)""")
    found = {r["column"]: (r["min_value"], r["max_value"]) for r in cl.typed_extremes(frame).collect()}
    assert found == {
        "d": ("9007199254740992.5", "9007199254740993.0"),
        "t": ("2020-01-01 10:00:00.000000", "2020-01-01 10:00:00.000001"),
        "list": ("[2]", "[10]"), "entries": (None, None), "no.thing": (None, None), "s": ("a", "b")}
    assert cl.typed_extremes(frame.limit(0)).where("min_value is null").count() == 6
    assert cl.typed_extremes(frame, ["entries"]).collect()[0]["type"] == "map<int,int>"
