"""Statistics per column and type, weighted by how often a value occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import fixed_values as fixed
from .common import BROADCAST_ROWS, group_keys, quoted
from .counts import with_types


def type_counts(counts: DataFrame) -> DataFrame:
    """Cells per column and type.  Missing cells have no type and are left out."""
    counts = with_types(counts)
    return (
        counts.filter(F.col("value_type").isNotNull())
        .groupBy(*group_keys(counts), "column", "value_type")
        .agg(F.sum("cnt").alias("cells"))
    )


def numeric_stats(counts: DataFrame, column_bound: int | None = None) -> DataFrame:
    """Min, max, mean and population deviation of the whole and of the real numbers.

    Two passes over the counts, mean first: the difference of two large sums of
    squares would lose its digits.  Both passes read one shuffle.  The means are
    one row per column and type; a caller who knows how many columns there are
    says so with ``column_bound`` and they are broadcast, otherwise Spark decides
    by their size.
    """
    counts = with_types(counts)
    keys = [*group_keys(counts), "column", "value_type"]
    means = (
        counts.filter(F.col("value_type").isin(fixed.INTEGER, fixed.REAL))
        .groupBy(*keys)
        .agg(F.sum("cnt").alias("cells"), *moments())
        .select(*keys, "cells", *_RANGES, mean())
    )
    return deviations(counts, means, column_bound)


def typed_extremes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Smallest and largest value of each column in its own type: ``column, type, min_value,
    max_value``, as text.

    Decimals keep all digits, instants their microseconds; nothing is converted before it is
    compared. One pass over the table, a row per task, and a row per column at the end. A
    column without values, or of a type without an order, has nulls.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    ordered = [f for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    places = {f.name: i for i, f in enumerate(ordered)}
    ends = [g(F.col(quoted(f.name))).alias(f"{n}{i}") for i, f in enumerate(ordered) for n, g in (("min", F.min), ("max", F.max))]
    none = F.lit(None).cast("string")

    def text(name: str, field: T.StructField) -> Column:
        if field.name not in places:
            return none
        value = F.col(f"{name}{places[field.name]}")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if isinstance(field.dataType, T.BinaryType):
            return F.hex(value)
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            return F.to_json(value)
        return value.cast("string")

    rows = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            text("min", f).alias("min_value"), text("max", f).alias("max_value"))
        for f in fields
    ]
    return df.agg(*(ends or [F.count(F.lit(1))])).select(F.inline(F.array(*rows)))


_RANGES = ("min_long", "max_long", "min_double", "max_double")


def moments() -> list[Column]:
    """Aggregates of the numbers in a group of value counts of one type."""
    # whole numbers are added up exactly, whatever their size
    exact = F.col("long_val").cast("decimal(19,0)") * F.col("cnt").cast("decimal(18,0)")
    return [
        F.min("long_val").alias("min_long"),
        F.max("long_val").alias("max_long"),
        F.min("double_val").alias("min_double"),
        F.max("double_val").alias("max_double"),
        F.sum(exact).alias("long_sum"),
        F.sum(F.col("double_val") * F.col("cnt")).alias("double_sum"),
    ]


def mean() -> Column:
    """The mean from ``moments`` and ``cells``; NULL where there are no numbers."""
    # the exact sum may have more digits than a double: divide first
    whole = F.expr("long_sum div cells").cast("double")
    rest = F.expr("long_sum % cells").cast("double") / F.col("cells")
    return F.coalesce(whole + rest, F.col("double_sum") / F.col("cells")).alias("mean")


def deviations(
    counts: DataFrame, means: DataFrame, column_bound: int | None = None
) -> DataFrame:
    """Second pass: ``means`` with the population deviation around each, ``stddev``."""
    keys = [*group_keys(counts), "column", "value_type"]
    number = F.coalesce(F.col("long_val").cast("double"), F.col("double_val"))
    numbers = counts.filter(F.col("value_type").isin(fixed.INTEGER, fixed.REAL)).select(
        *keys, number.alias("number"), "cnt"
    )
    off = F.col("number") - F.col("mean")
    return (
        numbers.join(sized(means, column_bound), keys)
        .groupBy(*means.columns)  # one row of means per group
        .agg(F.sqrt(F.sum(off * off * F.col("cnt")) / F.col("cells")).alias("stddev"))
    )


def sized(per_column: DataFrame, column_bound: int | None) -> DataFrame:
    """A frame of a few rows per column, to be broadcast if that is known to be small."""
    known_small = column_bound is not None and 4 * column_bound <= BROADCAST_ROWS
    return F.broadcast(per_column) if known_small else per_column


def date_stats(counts: DataFrame) -> DataFrame:
    """Earliest and latest date per column, compared as dates."""
    counts = with_types(counts)
    return (
        counts.filter(F.col("value_type") == fixed.DATE)
        .groupBy(*group_keys(counts), "column")
        .agg(
            F.sum("cnt").alias("cells"),
            F.min("date_val").alias("min_date"),
            F.max("date_val").alias("max_date"),
        )
    )


def text_lengths(counts: DataFrame) -> DataFrame:
    """Text cells per column and their average length."""
    counts = with_types(counts)
    length = F.length("value").cast("bigint")
    return (
        counts.filter(F.col("value_type") == fixed.TEXT)
        .groupBy(*group_keys(counts), "column")
        .agg(
            F.sum("cnt").alias("cells"),
            (F.sum(length * F.col("cnt")) / F.sum("cnt")).alias("average_length"),
        )
    )


def text_extremes(
    counts: DataFrame, longest: bool = False, k: int = fixed.TOP_VALUES
) -> DataFrame:
    """The ``k`` shortest (or longest) text cells per column, repeats included.

    A value that occurs ``n`` times takes ``n`` of the places.  ``k`` distinct
    values always fill ``k`` places, so only those are repeated.
    """
    counts = with_types(counts)
    keys = [*group_keys(counts), "column"]
    length = F.length("value")
    order = Window.partitionBy(*keys).orderBy(
        length.desc() if longest else length.asc(), F.col("value").asc()
    )
    best = (
        counts.filter(F.col("value_type") == fixed.TEXT)
        .select(*keys, "value", F.least(F.col("cnt"), F.lit(k)).cast("int").alias("times"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
    )
    picked = F.sort_array(F.collect_list(F.struct("place", "value", "times")))
    repeated = F.flatten(F.transform(picked, lambda v: F.array_repeat(v["value"], v["times"])))
    return best.groupBy(*keys).agg(F.slice(repeated, 1, k).alias("cells"))


def text_stats(counts: DataFrame, k: int = fixed.TOP_VALUES) -> DataFrame:
    """Cells, average length, shortest and longest text cells per column."""
    counts = with_types(counts)
    keys = [*group_keys(counts), "column"]
    shortest = text_extremes(counts, False, k).withColumnRenamed("cells", "shortest_values")
    longest = text_extremes(counts, True, k).withColumnRenamed("cells", "longest_values")
    return text_lengths(counts).join(shortest, keys).join(longest, keys)
