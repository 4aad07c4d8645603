"""What real-world thing each value is: an ordered set of rules, first hit wins.

The rules are data.  ``classify`` turns them into one CASE expression over two
lookups, whole value and value length, each with at most one row per key.  So
the value counts are labelled where they lie: no row is multiplied, and with
dictionaries of ordinary size nothing is shuffled until the labels are counted.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as fixed
from ..functions import is_empty, pattern_match
from ..operators.common import BROADCAST_ROWS, broadcast_if_small, group_keys
from ..operators.matching import (
    fuzzy_size,
    near_terms,
    scan_fuzzy,
    share_a_piece,
    terms_by_length,
)

EXACT, CONTAINS, PATTERN, FUZZY = "exact", "contains", "pattern", "fuzzy"
OTHER = "other"


@dataclass(frozen=True)
class Rule:
    """``label`` if the lower-cased value passes the test.

    ``exact`` and ``fuzzy`` look in the dictionary under ``label``; ``contains``
    carries its terms and ``pattern`` its patterns.  ``drop`` lists characters
    removed from the value before a pattern is tried.
    """

    label: str
    kind: str
    terms: tuple[str, ...] = ()
    drop: str = ""


@dataclass(frozen=True)
class RuleSet:
    """Rules in order, and the terms that come with them (label to terms)."""

    rules: tuple[Rule, ...]
    terms: dict[str, tuple[str, ...]] = field(default_factory=dict)
    threshold: float = fixed.SIMILARITY


def default_rules(corrected: bool = True) -> RuleSet:
    """The standard rules.  City, agency, neighborhood and name terms are the caller's.

    ``corrected=False`` keeps three oddities for comparison with labels made
    that way: only one of the phone patterns can match, a coordinate may be
    followed by anything, and two car makes are read as one word.
    """
    makes = fixed.CAR_MAKE_TERMS
    if not corrected:
        makes = tuple(m for m in makes if m not in fixed.CAR_MAKE_FUSED)
        makes += (fixed.CAR_MAKE_FUSED_AS,)
    rules = (
        Rule("city", EXACT),
        Rule("city_agency", EXACT),
        Rule("college_name", CONTAINS, fixed.COLLEGE_TERMS),
        Rule("vehicle_type", EXACT),
        Rule("school_level", EXACT),
        Rule("business_name", CONTAINS, fixed.BUSINESS_TERMS),
        Rule("area_of_study", EXACT),
        Rule("color", EXACT),
        Rule("zip_code", PATTERN, (fixed.ZIP_CODE,)),
        Rule("building_classification", PATTERN, (fixed.BUILDING,)),
        Rule("website", PATTERN, (fixed.WEBSITE,)),
        Rule("lat_lon_cord", PATTERN, (fixed.COORDINATE_PAIR,), drop="() "),
        Rule(
            "lat_lon_cord",
            PATTERN,
            (fixed.COORDINATE if corrected else fixed.COORDINATE_LOOSE,),
            drop="+-",
        ),
        Rule("phone_number", PATTERN, fixed.PHONES if corrected else fixed.PHONES[:1]),
        Rule("school_name", PATTERN, (fixed.SCHOOL,)),
        Rule("park_playground", PATTERN, (fixed.PARK,)),
        Rule("street_name", PATTERN, (fixed.STREET,)),
        Rule("address", PATTERN, (fixed.ADDRESS,)),
        Rule("borough", FUZZY),
        Rule("car_make", FUZZY),
        Rule("subject_in_school", FUZZY),
        Rule("neighborhood", EXACT),
        Rule("neighborhood", FUZZY),
        Rule("person_name", EXACT),
    )
    terms = {
        "vehicle_type": fixed.VEHICLE_TERMS,
        "school_level": fixed.SCHOOL_LEVEL_TERMS,
        "area_of_study": fixed.AREA_OF_STUDY_TERMS,
        "color": fixed.COLOR_TERMS,
        "borough": fixed.BOROUGH_TERMS,
        "car_make": makes,
        "subject_in_school": fixed.SUBJECT_TERMS,
    }
    return RuleSet(rules, terms)


def without_rules(rules: RuleSet, labels: Iterable[str]) -> RuleSet:
    """The same rules less those for ``labels``."""
    gone = set(labels)
    return replace(rules, rules=tuple(r for r in rules.rules if r.label not in gone))


def term_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The terms that come with the rules: ``label, term``."""
    rows = [(label, term) for label, terms in rules.terms.items() for term in terms]
    return spark.createDataFrame(rows, "label string, term string")


def classify(
    counts: DataFrame,
    rules: RuleSet | None = None,
    dictionary: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    scan_terms: int | None = None,
) -> DataFrame:
    """Add ``label`` to each value.  ``dictionary`` (``label, term``) adds to the rules' terms.

    Terms of exact rules meet the values by shuffle over ``broadcast_rows`` of them, those of
    fuzzy rules by shared pieces over ``scan_terms``.
    """
    rules = rules or default_rules()
    terms = term_table(counts.sparkSession, rules)
    if dictionary is not None:
        terms = terms.unionByName(dictionary.select("label", F.lower("term").alias("term")))
    used = {r.label for r in rules.rules if r.kind in (EXACT, FUZZY)}
    terms = terms.filter(F.col("label").isin(*used) & (F.length("term") > 0)).distinct()
    sizes = _sizes(terms, rules.threshold)

    known = counts.withColumn("probe", F.lower("value"))
    known = _with_exact(known, rules, terms, sizes, broadcast_rows)
    fuzzy_at = [i for i, r in enumerate(rules.rules) if r.kind == FUZZY]
    first_fuzzy = fuzzy_at[0] if fuzzy_at else len(rules.rules)
    known = known.withColumn("label", _first(rules, range(first_fuzzy)))
    if fuzzy_at:
        known = _with_fuzzy(known, rules, terms, sizes, fuzzy_at, scan_terms)
        rest = _first(rules, range(first_fuzzy, len(rules.rules)))
        known = known.withColumn("label", F.coalesce("label", rest))
    return known.select(
        *counts.columns, F.coalesce("label", F.lit(OTHER)).alias("label")
    )


def semantic_types(
    counts: DataFrame,
    rules: RuleSet | None = None,
    dictionary: DataFrame | None = None,
    tokens: str | Iterable[str] = "semantic",
    broadcast_rows: int = BROADCAST_ROWS,
    scan_terms: int | None = None,
) -> DataFrame:
    """Cells per column and type: ``keys..., column, label, cnt, rank``.

    Empty cells are left out.  Rank 1 is the most frequent type, equal counts by
    label.
    """
    keys = [*group_keys(counts), "column"]
    filled = counts.filter(~is_empty("value", tokens)).select(*keys, "value", "cnt")
    labelled = classify(filled, rules, dictionary, broadcast_rows, scan_terms)
    order = Window.partitionBy(*keys).orderBy(F.col("cnt").desc(), F.col("label").asc())
    return (
        labelled.groupBy(*keys, "label")
        .agg(F.sum("cnt").alias("cnt"))
        .withColumn("rank", F.row_number().over(order))  # one row per label and column
    )


def semantic_profile(semantic: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """One document per dataset and column.

    ``dataset_name, column_name, actual_types, semantic_types``.  ``truth`` has
    ``dataset, column, labels``; its labels go with the type ``other``.
    """
    keys = ["dataset", "column"]
    if truth is None:
        actual = semantic.withColumn("labels", F.lit(None).cast("array<string>"))
    else:
        actual = semantic.join(truth.select(*keys, "labels").distinct(), keys)
    entry = F.struct(
        "rank",
        F.col("label").alias("semantic_type"),
        F.col("cnt").alias("count"),
        F.when(F.col("label") == OTHER, F.col("labels")).alias("label"),
    )
    grouped = actual.groupBy(*keys, "labels").agg(
        F.sort_array(F.collect_list(entry)).alias("types")
    )
    return grouped.select(
        F.col("dataset").alias("dataset_name"),
        F.col("column").alias("column_name"),
        F.col("labels").alias("actual_types"),
        F.transform(
            "types",
            lambda t: F.struct(
                t["semantic_type"].alias("semantic_type"),
                t["count"].alias("count"),
                t["label"].alias("label"),
            ),
        ).alias("semantic_types"),
    )


# --- inside ------------------------------------------------------------------


def _sizes(terms: DataFrame, threshold: float) -> dict[str, Row]:
    """Terms per label and their bytes, by one small job: a row per label of the rules."""
    rows = terms.groupBy("label").agg(
        F.sum(F.octet_length("term")).alias("plain"), *fuzzy_size(threshold)
    )
    return {r["label"]: r for r in rows.collect()}


def _total(sizes: dict, labels: Iterable[str], octets: str) -> tuple[int, int]:
    found = [sizes[label] for label in set(labels) if label in sizes]
    return sum(r["rows"] for r in found), sum(r[octets] for r in found)


def _with_exact(
    known: DataFrame, rules: RuleSet, terms: DataFrame, sizes: dict, broadcast_rows: int
) -> DataFrame:
    labels = [r.label for r in rules.rules if r.kind == EXACT]
    if not labels:
        return known.withColumn("exact", F.array().cast("array<string>"))
    table = (
        terms.filter(F.col("label").isin(*labels))
        .groupBy(F.col("term").alias("probe"))
        .agg(F.collect_set("label").alias("exact"))
    )
    small = broadcast_if_small(table, _total(sizes, labels, "plain"), broadcast_rows)
    return known.join(small, "probe", "left")


def _with_fuzzy(
    known: DataFrame,
    rules: RuleSet,
    terms: DataFrame,
    sizes: dict,
    fuzzy_at: list[int],
    scan_terms: int | None,
) -> DataFrame:
    """Add the number of the first fuzzy rule that hits, for values without a label."""
    number = F.lit(None).cast("int")
    for i in fuzzy_at:
        number = F.when(F.col("label") == rules.rules[i].label, F.lit(i)).otherwise(number)
    numbered = (
        terms.withColumn("rule", number)
        .filter(F.col("rule").isNotNull())
        .select("rule", "term")
    )
    labels = [rules.rules[i].label for i in fuzzy_at]
    if scan_fuzzy(*_total(sizes, labels, "octets"), scan_terms):
        table = terms_by_length(numbered, rules.threshold, ["rule"])
        near = near_terms(F.col("probe"), F.col("terms"))
        first = F.array_min(F.transform(near, lambda t: t["rule"]))
        return (
            known.withColumn("value_length", F.length("probe"))
            .join(F.broadcast(table), "value_length", "left")
            .withColumn("fuzzy", F.when(F.col("label").isNull(), first))
        )
    open_values = known.filter(F.col("label").isNull()).select("probe").distinct()
    pairs = share_a_piece(open_values, numbered, "probe", "term", [], rules.threshold)
    first = pairs.groupBy("probe").agg(F.min("rule").alias("fuzzy"))
    return known.join(first, "probe", "left")


def _first(rules: RuleSet, numbers: Iterable[int]) -> Column:
    """CASE over the rules with these numbers, in order; NULL if none hits."""
    probe = F.col("probe")
    case = None
    for i in numbers:
        rule = rules.rules[i]
        if rule.kind == EXACT:
            test = F.array_contains("exact", F.lit(rule.label))
        elif rule.kind == CONTAINS:
            test = _any([F.contains(probe, F.lit(t)) for t in rule.terms])
        elif rule.kind == PATTERN:
            text = F.translate(probe, rule.drop, "") if rule.drop else probe
            test = _any([pattern_match(text, p) for p in rule.terms])
        else:
            test = F.col("fuzzy") == i
        label = F.lit(rule.label)
        case = F.when(test, label) if case is None else case.when(test, label)
    return F.lit(None).cast("string") if case is None else case


def _any(tests: list[Column]) -> Column:
    hit = tests[0]
    for test in tests[1:]:
        hit = hit | test
    return hit
