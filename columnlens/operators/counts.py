"""Value counts, and what follows directly from them.

``value_counts`` is the one pass over the cells of a table.  Every column goes
into one long frame, and the count is combined before the shuffle, so a value
that fills a third of a column leaves each task as a single row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import fixed_values as fixed
from ..functions import cell_type, is_empty, parsed_values
from .common import group_keys, is_text, quoted


def value_counts(
    df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """How often each value occurs: ``keys..., column, value, cnt``.

    A missing cell is a value of its own.  Columns that are no text are counted
    by their text form; ``typed_counts`` keeps their type.
    """
    names = _columns(df, columns, keys)
    cells = _long(df, names, keys, {c: F.col(quoted(c)).cast("string") for c in names})
    return count_cells(cells)


def count_cells(cells: DataFrame) -> DataFrame:
    """Value counts of cells that are already long: ``keys..., column, value``."""
    keys = [c for c in cells.columns if c not in ("column", "value")]
    return cells.groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def typed_counts(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    types: Iterable[str] | None = None,
) -> DataFrame:
    """Value counts with the type and the parsed value of each distinct value.

    ``keys..., column, value, value_type, long_val, double_val, date_val, cnt``.
    Text is classified by what is written; a column that is already a number or
    a date keeps its type and is counted as such, so a column-oriented source
    reads each column once and the shuffle carries numbers, not their text.
    Decimals, instants and nested values are counted by their exact value and
    converted after the count.  ``types`` leaves out columns whose kind cannot
    give a value of these types; text columns always may.
    """
    names = _columns(df, columns, keys)
    return _typed_union([(df, names, {})], list(keys), types)


def corpus_counts(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Typed value counts of several tables at once, with the key ``dataset``.

    The cells of all tables meet before they are counted: one job and one
    shuffle per kind of column, however many tables there are.  ``columns``
    names the columns wanted per dataset; others are not read.
    """
    wanted = [
        (table, _columns(table, columns[name] if columns else None, ()), {"dataset": name})
        for name, table in tables.items()
        if columns is None or columns.get(name)
    ]
    return _typed_union(wanted, ["dataset"])


def with_types(counts: DataFrame) -> DataFrame:
    """Add type and parsed values to text value counts (no-op if present)."""
    if "value_type" in counts.columns:
        return counts
    return _typed(counts, "text", group_keys(counts))


def distinct_counts(counts: DataFrame) -> DataFrame:
    """Distinct values per column; a missing cell counts as one value."""
    return counts.groupBy(*group_keys(counts), "column").agg(
        F.count(F.lit(1)).alias("distinct_values")
    )


def empty_cells(
    counts: DataFrame,
    tokens: str | Iterable[str] = "profile",
    normalize: bool = True,
) -> DataFrame:
    """Empty and non-empty cells per column."""
    empty = is_empty("value", tokens, normalize)
    return counts.groupBy(*group_keys(counts), "column").agg(
        F.sum(F.when(empty, F.col("cnt")).otherwise(0)).alias("empty_cells"),
        F.sum(F.when(empty, 0).otherwise(F.col("cnt"))).alias("non_empty_cells"),
    )


def frequent_values(counts: DataFrame, k: int = fixed.TOP_VALUES) -> DataFrame:
    """The ``k`` most frequent values per column, equal counts by value.

    The limit on the rank lets Spark drop all but ``k`` rows per column in each
    task before it shuffles, so a wide column does not land in one task.
    """
    keys = group_keys(counts)
    order = Window.partitionBy(*keys, "column").orderBy(
        F.col("cnt").desc(), F.col("value").asc_nulls_first()
    )
    return (
        counts.select(*keys, "column", "value", "cnt")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


# --- inside ------------------------------------------------------------------

# how a column is held while it is counted
_KINDS = {
    "text": "string",
    "long": "bigint",
    "double": "double",
    "decimal": "string",  # exact at any precision; a column has one scale
    "date": "date",
    "instant": "timestamp",  # two instants may have one local time
    "timestamp": "timestamp_ntz",
    "nested": "string",  # as JSON, which tells nested values apart
    "other": "string",
}
# kinds that can give values of a type
_GIVES = {
    fixed.INTEGER: ("text", "long"),
    fixed.REAL: ("text", "double", "decimal"),
    fixed.DATE: ("text", "date", "instant", "timestamp"),
    fixed.TEXT: ("text", "nested", "other"),
}


def _cell(name: str, data_type: T.DataType, cast: str) -> Column:
    """A cell as it is counted: different values stay different."""
    cell = F.col(quoted(name))
    if _kind(data_type) == "nested":
        return F.to_json(cell, {"ignoreNullFields": "false"})
    if isinstance(data_type, T.BinaryType):
        return F.hex(cell)
    return cell.cast(cast)


def _kind(data_type: T.DataType) -> str:
    if is_text(data_type):
        return "text"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return "long"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, T.DateType):
        return "date"
    if isinstance(data_type, T.TimestampType):
        return "instant"
    if isinstance(data_type, T.TimestampNTZType):
        return "timestamp"
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return "nested"
    return "other"


def _columns(df: DataFrame, columns: Sequence[str] | None, keys: Sequence[str]) -> list[str]:
    names = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    if not names:
        raise ValueError("no columns to count")
    return names


def _typed_union(
    tables: list[tuple], keys: list[str], types: Iterable[str] | None = None
) -> DataFrame:
    """Count the cells of ``(table, columns, constant keys)`` kind by kind."""
    parts = []
    kinds = set(_KINDS) if types is None else {k for t in types for k in _GIVES[t]}
    if not any(_kind(t.schema[c].dataType) in kinds for t, names, _ in tables for c in names):
        kinds = set(_KINDS)  # nothing fits: all columns, none of whose values has the type
    for kind, cast in _KINDS.items():
        if kind not in kinds:
            continue
        cells = []
        for table, names, constants in tables:
            of_kind = [c for c in names if _kind(table.schema[c].dataType) == kind]
            if of_kind:
                casts = {c: _cell(c, table.schema[c].dataType, cast) for c in of_kind}
                own_keys = [k for k in keys if k not in constants]
                cells.append(_long(table, of_kind, own_keys, casts, constants))
        if cells:
            counted = count_cells(reduce(DataFrame.unionByName, cells))
            parts.append(_typed(counted, kind, keys))
    return reduce(DataFrame.unionByName, parts)


def _long(
    df: DataFrame, names: list[str], keys: Sequence[str], cells: dict, constants: dict | None = None
) -> DataFrame:
    """One row per cell: ``keys..., column, value``."""
    ids = [F.col(quoted(k)) for k in keys]
    wide = df.select(*ids, *[cells[c].alias(c) for c in names])
    long = wide.unpivot(ids, [F.col(quoted(c)) for c in names], "column", "value")
    for name, constant in (constants or {}).items():
        long = long.withColumn(name, F.lit(constant))
    return long


def _typed(counted: DataFrame, kind: str, keys: Sequence[str]) -> DataFrame:
    """Add type and parsed values to counted values.

    Every count is above zero.  Saying so ties the type to the count, and keeps
    a filter on the type above the count: below it, each cell would be
    classified instead of each distinct value, and readers of the same counts
    would no longer share one shuffle.
    """
    value, count = F.col("value"), F.col("cnt")
    if kind == "text":
        typed = counted.withColumn("value_type", F.when(count > 0, cell_type("value")))
        parsed = [c.alias(n) for n, c in parsed_values("value_type", "value").items()]
        return typed.select(*keys, "column", "value", "value_type", *parsed, "cnt")
    label = next(t for t, kinds in _GIVES.items() if kind in kinds)
    return counted.select(
        *keys,
        "column",
        value.cast("string").alias("value"),
        F.when(F.when(value.isNotNull(), count) > 0, F.lit(label)).alias("value_type"),
        (value if kind == "long" else F.lit(None)).cast("bigint").alias("long_val"),
        (value if kind in ("double", "decimal") else F.lit(None)).cast("double").alias("double_val"),
        (value if label == fixed.DATE else F.lit(None)).cast("date").alias("date_val"),
        "cnt",
    )
