"""Profile and label documents as JSON lines, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed

PROFILE_SCHEMA = """
    dataset_name string,
    columns array<struct<
        column_name: string,
        number_distinct_values: bigint,
        number_empty_cells: bigint,
        number_non_empty_cells: bigint,
        frequent_values: array<string>,
        data_types: array<struct<
            type: string,
            count: bigint,
            max_value: string,
            min_value: string,
            mean: double,
            stddev: double,
            shortest_values: array<string>,
            longest_values: array<string>,
            average_length: double
        >>
    >>
"""


def write_profiles(profiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per dataset and line."""
    profiles.select(profile_json().alias("value")).write.mode(mode).text(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profile documents in a folder and the folders in it."""
    return spark.read.schema(PROFILE_SCHEMA).option("recursiveFileLookup", True).json(path)


def profile_json() -> Column:
    """A profile row as the JSON text of its document.

    ``max_value`` and ``min_value`` are numbers for numbers and text for dates,
    so each type has a struct of its own.
    """
    def number(kind: str):
        return lambda t: F.struct(
            t["type"].alias("type"),
            t["count"].alias("count"),
            t[f"max_{kind}"].alias("max_value"),
            t[f"min_{kind}"].alias("min_value"),
            t["mean"].alias("mean"),
            t["stddev"].alias("stddev"),
        )

    def date(t: Column) -> Column:
        return F.struct(
            t["type"].alias("type"),
            t["count"].alias("count"),
            t["max_date"].cast("string").alias("max_value"),
            t["min_date"].cast("string").alias("min_value"),
        )

    def text(t: Column) -> Column:
        names = ("type", "count", "shortest_values", "longest_values", "average_length")
        return F.struct(*[t[n].alias(n) for n in names])

    def one_type(t: Column) -> Column:
        return (
            F.when(t["type"] == fixed.INTEGER, F.to_json(number("long")(t)))
            .when(t["type"] == fixed.REAL, F.to_json(number("double")(t)))
            .when(t["type"] == fixed.DATE, F.to_json(date(t)))
            .otherwise(F.to_json(text(t)))
        )

    def one_column(c: Column) -> Column:
        plain = (
            "column_name", "number_distinct_values", "number_empty_cells",
            "number_non_empty_cells", "frequent_values",
        )
        head = F.to_json(F.struct(*[c[n].alias(n) for n in plain]))
        types = F.concat_ws(", ", F.transform(c["data_types"], one_type))
        return F.concat(
            head.substr(F.lit(1), F.length(head) - 1), F.lit(', "data_types": ['), types, F.lit("]}")
        )

    name = F.to_json(F.struct("dataset_name"))
    columns = F.concat_ws(", ", F.transform("columns", one_column))
    return F.concat(
        name.substr(F.lit(1), F.length(name) - 1), F.lit(', "columns": ['), columns, F.lit("]}")
    )


def write_semantic(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Label documents, one JSON object per column and line."""
    documents.write.mode(mode).json(path)


def write_keys(keys: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Key candidates as JSON lines."""
    keys.write.mode(mode).json(path)


def write_labels(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The lines of ``label_lines`` in their order: the vocabulary begins the first file."""
    lines.orderBy("idx").select("value").write.mode(mode).text(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """An evaluation table as JSON lines, ordered by label or index."""
    by = "label" if "label" in metrics.columns else "idx"
    metrics.orderBy(by).write.mode(mode).json(path)


def combine_json(
    spark: SparkSession,
    source: str,
    target: str,
    whole_files: bool = True,
    files: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Many JSON files as one set of JSON lines.

    With ``whole_files`` each file is one object, on one line or indented;
    without, each line is one.  Inside a JSON text a line end is always written
    as an escape, so joining the lines changes no value and needs no parsing.
    ``files`` sets how many files are written; by default each task writes its
    own, and nothing passes through a single one.
    """
    lines = spark.read.text(source, wholetext=whole_files, recursiveFileLookup=True).select(
        F.trim(F.regexp_replace("value", r"\s*[\r\n]\s*", " ")).alias("value")
    )
    lines = lines.filter(F.col("value") != "")
    if files:
        lines = lines.repartition(files)
    lines.write.mode(mode).text(target)
