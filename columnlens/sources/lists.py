"""Work list, hand-made labels and dictionaries: small text formats.

Each ``read_`` function reads a file and hands its lines to the ``parse_``
function of the same name, which takes any frame with a column ``value``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """Columns to label: ``idx, dataset, column``.

    The file is one list literal of ``'<dataset>.<column>.<ending>'`` names.
    """
    return parse_worklist(spark.read.text(path, wholetext=True))


def parse_worklist(texts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    bare = F.regexp_replace(F.col("value"), r"[\[\]'\r\n]", "")
    dot = F.lit(".")
    return texts.select(
        *keys, F.posexplode(F.split(bare, ", ")).alias("idx", "entry")
    ).select(
        *keys,
        "idx",
        F.split_part(F.col("entry"), dot, F.lit(1)).alias("dataset"),
        F.split_part(F.col("entry"), dot, F.lit(2)).alias("column"),
    )


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Hand-made labels: ``idx, labels``.  A note after the labels is dropped."""
    return parse_truth(spark.read.text(path))


def parse_truth(lines: DataFrame) -> DataFrame:
    def field(n: int) -> Column:
        return F.split_part(F.rtrim(F.translate("value", "\r", " ")), F.lit(" "), F.lit(n))

    return lines.select(
        field(1).try_cast("int").alias("idx"), F.split(field(2), ",").alias("labels")
    ).filter(F.col("idx").isNotNull())


def read_terms(
    spark: SparkSession, path: str, label: str, field: int | None = None, sep: str | None = None
) -> DataFrame:
    """A dictionary with one term per line: ``label, term``, lower case.

    With ``sep``, the term is the field at position ``field`` (0 is the first).
    """
    return parse_terms(spark.read.text(path), label, field, sep)


def parse_terms(
    lines: DataFrame, label: str, field: int | None = None, sep: str | None = None
) -> DataFrame:
    text = F.col("value")
    if sep is not None:
        text = F.split_part(text, F.lit(sep), F.lit((field or 0) + 1))
    return _terms(lines.select(text.alias("term")), label)


def read_terms_with_abbrev(
    spark: SparkSession, path: str, label: str, keep_plain: bool = True
) -> DataFrame:
    """A dictionary of ``Name (ABBR)`` lines; name and abbreviation are terms.

    Lines without a bracket are terms of their own, or, with ``keep_plain``
    off, left out.
    """
    return parse_abbrev_terms(spark.read.text(path), label, keep_plain)


def parse_abbrev_terms(lines: DataFrame, label: str, keep_plain: bool = True) -> DataFrame:
    if not keep_plain:
        lines = lines.filter(F.contains("value", F.lit("(")))
    parts = lines.select(F.explode(F.split("value", r"\(")).alias("term"))
    return _terms(parts.select(F.translate("term", ")", "").alias("term")), label)


def _terms(terms: DataFrame, label: str) -> DataFrame:
    clean = F.lower(F.trim(F.translate("term", "\r\t", "  ")))
    return (
        terms.select(F.lit(label).alias("label"), clean.alias("term"))
        .filter(F.col("term") != "")
        .distinct()
    )
