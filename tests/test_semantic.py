"""The rules, value by value, and the evaluation built on them."""

import json
import random

import pytest
from pyspark.sql import functions as F

import columnlens as cl
from columnlens.operators import matching
from columnlens.plans import semantic
from contract import fixtures as fx
from contract.queries import _rules
from tests.test_matching import similar

EXPECTED = dict(
    zip(
        fx.LABELLED_CELLS,
        "city city city_agency city_agency city_agency college_name college_name vehicle_type "
        "school_level business_name business_name business_name area_of_study color other "
        "zip_code zip_code zip_code building_classification website website lat_lon_cord "
        "lat_lon_cord other other address other phone_number phone_number phone_number "
        "school_name other school_name park_playground street_name address address borough "
        "borough car_make car_make car_make subject_in_school neighborhood neighborhood "
        "person_name other other".split(),
    )
)


def labels(spark, strings, values, rules=None, terms=None):
    rows = cl.classify(cl.value_counts(strings(values)), rules, terms)
    return {r["value"]: r["label"] for r in rows.collect()}


@pytest.mark.parametrize("large", [False, True])
def test_labelled_cells(spark, strings, monkeypatch, large):
    if large:  # as for a dictionary that must not be sent to every task
        monkeypatch.setattr(matching, "FUZZY_SCAN_TERMS", 0)
    assert len(EXPECTED) == 48
    assert labels(spark, strings, list(EXPECTED), _rules(), fx.dictionary(spark)) == EXPECTED


def test_standard_terms(spark, strings):
    expected = {
        "Station Wagon/Sport Utility Vehicle": "vehicle_type", "K-12": "school_level",
        "visual art & design": "area_of_study", "GRY": "color", "New York": "borough",
        "the bronxx": "borough", "general motor": "car_make", "social studie": "subject_in_school",
        "Sushi Bar": "business_name", "queens college": "college_name", "": "other",
        "C3-ELEVATOR": "building_classification", "c3-elevators": "building_classification",
        "8.5": "other", "74.0060": "lat_lon_cord", "-74.0060": "lat_lon_cord", "0": "lat_lon_cord",
        "180": "lat_lon_cord", "+40.7,-74": "lat_lon_cord", "212-555-1234 ext": "phone_number",
        "2125551234": "phone_number", "a.b": "other", "a.bc": "website", "x..com": "other",
        "http://www.a-b.org:80/x y": "website", "ps 12 playground": "park_playground",
        "school of rock": "other", "new school for girls": "school_name", "1 a bc": "address",
        "1a 2 3rd": "address", "12 ab": "other", "main st": "street_name", "a b c st": "other",
    }
    assert labels(spark, strings, list(expected)) == expected


def test_uncorrected_rules(spark, strings):
    values = ["555-1234", "212-555-1234", "01/02/2019", "0 elm", "180 east 5 street", "mercur", "chrysler", "mercurchrysler"]
    got = labels(spark, strings, values, cl.default_rules(corrected=False))
    assert got == {
        "555-1234": "other", "212-555-1234": "phone_number", "01/02/2019": "lat_lon_cord",
        "0 elm": "lat_lon_cord", "180 east 5 street": "lat_lon_cord", "mercur": "other",
        "chrysler": "other", "mercurchrysler": "car_make",
    }


@pytest.mark.parametrize("large", [False, True])
def test_fuzzy_rules_against_all_terms(spark, strings, monkeypatch, large):
    if large:
        monkeypatch.setattr(matching, "FUZZY_SCAN_TERMS", 0)
    rng = random.Random(2)
    rules = cl.default_rules()
    order = ["borough", "car_make", "subject_in_school"]
    base = [t for label in order for t in rules.terms[label]]
    values = set()
    while len(values) < 150:
        word = list(rng.choice(base))
        at = rng.randrange(len(word))
        word[at : at + rng.randrange(2)] = rng.choice(["", "z", "e"])
        values.add("".join(word))
    only = semantic.RuleSet(tuple(r for r in rules.rules if r.label in order), rules.terms)
    want = {
        v: next(
            (label for label in order if any(similar(v, t) for t in rules.terms[label])), "other"
        )
        for v in values
    }
    assert labels(spark, strings, sorted(values), only) == want
    assert set(want.values()) == {*order, "other"}


def test_labelling_neither_shuffles_nor_multiplies(spark, strings):
    counts = cl.value_counts(strings(["a", "b"]))
    plan = cl.classify(counts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan
    assert plan.count("BroadcastHashJoin") == 2


def test_empty_cells_are_left_out(spark, strings):
    counts = cl.value_counts(strings([None, "", "N/A", "RED", "red", "qqq"]))
    rows = cl.semantic_types(counts).orderBy("rank").collect()
    assert [(r["label"], r["cnt"], r["rank"]) for r in rows] == [("color", 2, 1), ("other", 1, 2)]


# --- evaluation --------------------------------------------------------------


@pytest.fixture
def evaluated(spark):
    sem = spark.createDataFrame(
        [
            ("d", "a", "city", 7, 1), ("d", "a", "other", 3, 2),
            ("d", "b", "other", 5, 1), ("d", "b", "borough", 5, 2), ("d", "b", "city", 1, 3),
        ],
        "dataset string, column string, label string, cnt bigint, rank int",
    )
    worklist = spark.createDataFrame(
        [(0, "d", "a"), (1, "d", "b"), (2, "d", "b"), (3, "d", "empty")],
        "idx int, dataset string, column string",
    )
    truth = spark.createDataFrame(
        [(0, ["city"]), (1, ["borough", "neighborhood"]), (2, ["borough", "neighborhood"]),
         (3, ["zip_code"]), (9, ["borough"])],
        "idx int, labels array<string>",
    )
    return sem, worklist, truth


def test_scores(spark, evaluated):
    sem, worklist, truth = evaluated
    labelled = cl.distinct_worklist(worklist, truth)
    predicted = cl.predicted_types(sem, labelled)
    assert {(r["idx"], r["label"], r["correct"]) for r in predicted.collect()} == {
        (0, "city", True), (1, "other", False), (1, "borough", True)
    }
    one = cl.predicted_types(sem, labelled, k=1)
    assert {(r["idx"], r["label"]) for r in one.collect()} == {(0, "city"), (1, "other")}
    scores = {r["label"]: r for r in cl.precision_recall(predicted, labelled).collect()}
    assert {k: (v["precision"], v["recall"]) for k, v in scores.items()} == {
        "city": (1.0, 1.0), "borough": (1.0, 1.0), "neighborhood": (0.0, 0.0), "zip_code": (0.0, 0.0)
    }
    shares = {r["idx"]: r["precision"] for r in cl.column_precision(sem, labelled).collect()}
    assert shares == {0: 0.7, 1: pytest.approx(5 / 11), 3: None}
    assert [r["idx"] for r in cl.unmatched_labels(worklist, truth).collect()] == [9]


def test_documents(spark, evaluated):
    sem, worklist, truth = evaluated
    path = spark.conf.get("spark.checkpoint.dir") + "/semantic-documents"
    cl.write_semantic(cl.semantic_profile(sem, cl.distinct_worklist(worklist, truth)), path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert {line["column_name"]: line for line in lines}["b"] == {
        "dataset_name": "d", "column_name": "b", "actual_types": ["borough", "neighborhood"],
        "semantic_types": [
            {"semantic_type": "other", "count": 5, "label": ["borough", "neighborhood"]},
            {"semantic_type": "borough", "count": 5}, {"semantic_type": "city", "count": 1},
        ],
    }


def test_resolution(spark):
    headers = ["CITY NAME", "Boro", "Neighborhood", "MY CORE SUBJECT", "Boro", "m.n"]
    heads = spark.createDataFrame(
        [("d", i, h) for i, h in enumerate(headers)], "dataset string, pos int, header string"
    )
    wanted = ["CITY_NAME", "Boro", "Neighborhod", "A_CORE_SUBJECT_B", "Missing", "m.n", "CITY_NAMES"]
    worklist = spark.createDataFrame(
        [(i, "d", w) for i, w in enumerate(wanted)], "idx int, dataset string, column string"
    )
    found = cl.resolve_columns(worklist, heads, {"CORE_SUBJECT": "CORE SUBJECT"})
    assert [(r["resolved"], r["tier"]) for r in found.orderBy("idx").collect()] == [
        ("CITY NAME", 3), ("Boro", 0), ("Neighborhood", 4), ("MY CORE SUBJECT", 2),
        (None, None), ("m.n", 0), ("CITY NAME", 4),
    ]
    assert [r["column"] for r in cl.unresolved(found).collect()] == ["Missing"]
