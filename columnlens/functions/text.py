"""Comparing text with text and with patterns."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .cells import _col


def similarity(a: Column | str, b: Column | str) -> Column:
    """``1 - edit distance / longer length``; 1.0 for two empty texts."""
    left, right = _col(a), _col(b)
    longer = F.greatest(F.length(left), F.length(right))
    return F.when(longer == 0, F.lit(1.0)).otherwise(
        1 - F.levenshtein(left, right) / longer
    )


def similarity_reach(longer: Column, threshold: float = fixed.SIMILARITY) -> Column:
    """Largest edit distance that keeps two texts similar, given the longer length.

    Whole-number arithmetic: 0.8 means 4/5, so a pair exactly on the limit is in.
    """
    slack = 1 - Fraction(str(threshold))
    return F.floor(longer.cast("bigint") * slack.numerator / slack.denominator).cast("int")


def pattern_match(col: Column | str, pattern: str) -> Column:
    """True if ``pattern`` matches at the start of the text (not anywhere in it)."""
    flag = "(?U)" if any(c in pattern for c in (r"\d", r"\w", r"\s")) else ""
    return _col(col).rlike(f"{flag}^(?:{pattern})")
