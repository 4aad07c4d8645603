"""The cell-type ladder and the empty test, value by value."""

import math
import random

import pytest

import columnlens as cl
from columnlens import fixed_values as fixed

LADDER = [
    (None, None), ("", fixed.TEXT), ("-", fixed.TEXT), ("N/A", fixed.TEXT), ("0", fixed.INTEGER),
    ("17", fixed.INTEGER), ("-17", fixed.INTEGER), ("+17", fixed.INTEGER), (" 7 ", fixed.INTEGER),
    ("\t7\n", fixed.INTEGER), ("007", fixed.INTEGER), ("20190102", fixed.INTEGER),
    ("9223372036854775807", fixed.INTEGER), ("9223372036854775808", fixed.REAL),
    ("12.5", fixed.REAL), ("1e5", fixed.REAL), (".5", fixed.REAL), ("5.", fixed.REAL),
    ("-1.5E-3", fixed.REAL), ("nan", fixed.REAL), ("-NaN", fixed.REAL), ("inf", fixed.REAL),
    ("-Infinity", fixed.REAL), ("1.5f", fixed.TEXT), ("5d", fixed.TEXT), ("0x1F", fixed.TEXT),
    ("1_000", fixed.TEXT), ("1,000", fixed.TEXT), ("$5", fixed.TEXT), ("10%", fixed.TEXT),
    (".", fixed.TEXT), ("1.2.3", fixed.TEXT), ("2019-1-2", fixed.DATE), ("2019-01-02", fixed.DATE),
    ("2-1-2019", fixed.DATE), ("2019/1/2", fixed.DATE), ("1/31/2019", fixed.DATE),
    ("31/1/2019", fixed.TEXT), ("13-13-2019", fixed.TEXT), ("02/30/2019", fixed.TEXT),
    ("2019-01-02 03:04", fixed.TEXT), ("2019-01-02\n", fixed.TEXT), ("0000-01-01", fixed.TEXT),
    ("19-01-02", fixed.TEXT), ("text", fixed.TEXT),
]


def test_ladder(spark, strings):
    rows = strings([v for v, _ in LADDER]).select("value", cl.cell_type("value").alias("t"))
    assert [(r["value"], r["t"]) for r in rows.collect()] == LADDER


def test_parsed_values(spark, strings):
    cases = {
        " 7 ": (7, None, None), "-17": (-17, None, None), "5.": (None, 5.0, None),
        "1e5": (None, 1e5, None), "-inf": (None, -math.inf, None),
        "2-1-2019": (None, None, "2019-01-02"), "1/2/2019": (None, None, "2019-01-02"),
        "text": (None, None, None),
    }
    frame = cl.typed_counts(strings(list(cases)))
    for r in frame.collect():
        date = None if r["date_val"] is None else str(r["date_val"])
        assert (r["long_val"], r["double_val"], date) == cases[r["value"]], r
    nan = strings(["nan"]).select(cl.parse_double("value").alias("d")).first()["d"]
    assert math.isnan(nan)


@pytest.mark.parametrize("normalize", [True, False])
def test_empty(strings, normalize):
    values = [None, "", "-", "N/A", " n/a ", "n/a", "NULL", "0", "False", "x", "no data"]
    frame = strings(values).select(cl.is_empty("value", "profile", normalize).alias("e"))
    loose = {"N/A", " n/a ", "NULL"}
    expected = [
        v is None or v in fixed.EMPTY_PROFILE or (normalize and v in loose) for v in values
    ]
    assert [r["e"] for r in frame.collect()] == expected


def test_similarity_and_its_limit(spark):
    pairs = [("maths", "math"), ("", ""), ("a", "b"), ("manhatan", "manhattan"), ("chrysler", "chrysl")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = [r["s"] for r in frame.select(cl.similarity("a", "b").alias("s")).collect()]
    assert got == pytest.approx([0.8, 1.0, 0.0, 1 - 1 / 9, 0.75])


def test_pattern_is_tried_at_the_start(strings):
    frame = strings(["park", "the park", "parking", None])
    got = [r["m"] for r in frame.select(cl.pattern_match("value", "park").alias("m")).collect()]
    assert got == [True, False, True, None]


def test_a_long_dotted_text_does_not_overflow_the_stack(strings):
    long = "a-" * 200_000 + "a"
    frame = strings([long, long + ".com", "1 " + "a" * 50_000])
    sites = [r["m"] for r in frame.select(cl.pattern_match("value", fixed.WEBSITE).alias("m")).collect()]
    assert sites == [False, True, False]
    labels = [r["label"] for r in cl.classify(cl.value_counts(frame)).orderBy("value").collect()]
    assert labels == ["other", "other", "website"]


def test_type_counts_cover_all_cells(spark, strings):
    rng = random.Random(7)
    values = [rng.choice([v for v, _ in LADDER]) for _ in range(500)]
    counts = cl.typed_counts(strings(values))
    cells = sum(r["cells"] for r in cl.type_counts(counts).collect())
    assert cells + sum(v is None for v in values) == 500
    e = cl.empty_cells(counts).first()
    assert e["empty_cells"] + e["non_empty_cells"] == 500
