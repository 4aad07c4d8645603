"""What a whole corpus writes into its cells, from the profiles' top values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import is_empty, normalized, pattern_match
from .common import broadcast_if_small


def value_tally(profiles: DataFrame) -> DataFrame:
    """In how many columns a value is among the most frequent: ``value, n``.

    ``profiles`` holds profile documents, or one row per listed value in a
    column ``value``.  Values that differ in case or outer blanks are one.
    """
    if "columns" in profiles.columns:
        profiles = profiles.select(F.explode("columns").alias("c")).select(
            F.explode("c.frequent_values").alias("value")
        )
    return (
        profiles.select(normalized("value").alias("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def without_numbers(tally: DataFrame) -> DataFrame:
    """Leave out values that begin with a digit and those of one character."""
    keep = ~pattern_match("value", fixed.LEADING_NUMBER) & (F.length("value") != 1)
    return tally.filter(keep)


def top_values(tally: DataFrame, n: int = fixed.TOP_TALLY) -> DataFrame:
    """The ``n`` values in most columns; equal counts by value."""
    return tally.orderBy(*_ranked()).limit(n)


def empty_labels(tally: DataFrame, tokens: str | Iterable[str] = "insight") -> DataFrame:
    """How a corpus writes an empty cell."""
    return tally.filter(is_empty("value", tokens)).orderBy(*_ranked())


def filled_values(tally: DataFrame, tokens: str | Iterable[str] = "insight") -> DataFrame:
    """The complement of ``empty_labels``."""
    return tally.filter(~is_empty("value", tokens))


def term_mentions(tally: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each term is mentioned; ``terms`` has a column ``term``."""
    wanted = terms.select(F.lower("term").alias("value")).distinct()
    return tally.join(broadcast_if_small(wanted), "value", "left_semi").orderBy(*_ranked())


def pattern_mentions(
    tally: DataFrame, pattern: str = fixed.STREET_INSIGHT, n: int = fixed.TOP_STREETS
) -> DataFrame:
    """The ``n`` most mentioned values of a shape, streets by default."""
    return top_values(tally.filter(pattern_match("value", pattern)), n)


def _ranked() -> list[Column]:
    return [F.col("n").desc(), F.col("value").asc()]
