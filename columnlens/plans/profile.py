"""The profile document of a table.

One pass over the cells gives the value counts; everything else is an
aggregate over those, so the number of jobs does not depend on the number of
columns.  All parts read the same shuffle of the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import is_empty
from ..operators.common import group_keys
from ..operators.counts import corpus_counts, frequent_values, typed_counts, with_types
from ..operators.stats import deviations, mean, moments, sized, text_extremes
from ..sources.tables import table_headers

# order of the types in a document
_TYPE_ORDER = (fixed.INTEGER, fixed.REAL, fixed.DATE, fixed.TEXT)


def profile(
    df: DataFrame,
    dataset: str = "",
    columns: Sequence[str] | None = None,
    tokens: str | Iterable[str] = "profile",
    checkpoint: bool = False,
) -> DataFrame:
    """One row: the profile document of ``df`` under the name ``dataset``.

    ``checkpoint`` writes the counts once to ``spark.checkpoint.dir`` and works
    on from there.  Use it where the cells are costly to read again: a lost
    executor then costs its tasks, not the scan.
    """
    names = list(columns) if columns is not None else df.columns
    counts = typed_counts(df, names)
    if checkpoint:
        counts = counts.checkpoint()
    order = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.lit(i))])
    rows = profile_counts(counts, tokens, column_bound=len(names)).withColumn(
        "pos", order[F.col("column")]
    )
    return _document(rows.withColumn("dataset_name", F.lit(dataset)), ["dataset_name"])


def profile_corpus(
    tables: Mapping[str, DataFrame], tokens: str | Iterable[str] = "profile"
) -> DataFrame:
    """One profile document per table, from one job over all of them."""
    spark = next(iter(tables.values())).sparkSession
    headers = table_headers(spark, tables).select(
        "dataset", F.col("header").alias("column"), "pos"
    )
    bound = sum(len(t.columns) for t in tables.values())
    rows = profile_counts(corpus_counts(tables), tokens, bound).join(headers, ["dataset", "column"])
    return _document(rows.withColumnRenamed("dataset", "dataset_name"), ["dataset_name"])


def profile_rows(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    tokens: str | Iterable[str] = "profile",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The profile as one row per column: see ``profile_counts``."""
    names = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    bound = len(names) if not keys else None
    return profile_counts(typed_counts(df, names, keys), tokens, bound)


def profile_counts(
    counts: DataFrame,
    tokens: str | Iterable[str] = "profile",
    column_bound: int | None = None,
) -> DataFrame:
    """Profile of each column in a frame of value counts.

    ``keys..., column, number_distinct_values, number_empty_cells,
    number_non_empty_cells, frequent_values, data_types``.
    """
    counts = with_types(counts)
    keys = [*group_keys(counts), "column"]
    typed_keys = [*keys, "value_type"]
    empty = is_empty("value", tokens)
    # one aggregate by type; the totals of a column are sums of its few rows
    by_type = counts.groupBy(*typed_keys).agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.sum("cnt").alias("cells"),
        F.sum(F.when(empty, F.col("cnt")).otherwise(0)).alias("empty"),
        F.min("date_val").alias("min_date"),
        F.max("date_val").alias("max_date"),
        F.sum(F.length("value").cast("bigint") * F.col("cnt")).alias("characters"),
        *moments(),
    ).withColumn("mean", mean())
    spread = deviations(counts, by_type, column_bound).select(*typed_keys, "stddev")
    shortest = text_extremes(counts, longest=False).withColumnRenamed("cells", "shortest_values")
    longest = text_extremes(counts, longest=True).withColumnRenamed("cells", "longest_values")
    # cells have any length: frames that hold them are joined as Spark measures them
    texts = shortest.join(longest, keys).withColumn(
        "value_type", F.lit(fixed.TEXT)
    )
    top = (
        frequent_values(counts)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "value"))).alias("top"))
        .select(
            *keys,
            F.transform(
                "top", lambda t: F.coalesce(t["value"], F.lit(fixed.NULL_TEXT))
            ).alias("frequent_values"),
        )
    )
    typed = F.col("value_type").isNotNull()
    place = F.array_position(F.lit(list(_TYPE_ORDER)), F.col("value_type"))
    average = F.when(
        F.col("value_type") == fixed.TEXT, F.col("characters") / F.col("cells")
    ).alias("average_length")
    entry = F.struct(
        place.alias("place"),
        F.col("value_type").alias("type"),
        F.col("cells").alias("count"),
        "min_long", "max_long", "min_double", "max_double", "min_date", "max_date",
        "mean", "stddev", "shortest_values", "longest_values", average,
    )
    # a missing cell has no type, so its row adds to the totals only
    return (
        by_type.join(sized(spread, column_bound), typed_keys, "left")
        .join(texts, typed_keys, "left")
        .groupBy(*keys)
        .agg(
            F.sum("distinct_values").alias("number_distinct_values"),
            F.sum("empty").alias("number_empty_cells"),
            (F.sum("cells") - F.sum("empty")).alias("number_non_empty_cells"),
            F.sort_array(F.collect_list(F.when(typed, entry))).alias("data_types"),  # four at most
        )
        .join(top, keys)
        .select(
            *keys, "number_distinct_values", "number_empty_cells", "number_non_empty_cells",
            "frequent_values", "data_types",
        )
    )


def _document(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of a dataset in one row, in the order of ``pos``."""
    column = F.struct(
        "pos",
        F.col("column").alias("column_name"),
        "number_distinct_values", "number_empty_cells", "number_non_empty_cells",
        "frequent_values", "data_types",
    )
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias("columns"))
