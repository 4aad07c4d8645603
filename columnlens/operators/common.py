"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns a value-count frame may have besides its grouping keys.
COUNT_FIELDS = {
    "column", "value", "cnt", "value_type", "long_val", "double_val", "date_val",
}

# A lookup table at or under both limits is sent to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def quoted(name: str) -> str:
    """A column name as a reference: names may hold dots, blanks and backticks."""
    return "`" + name.replace("`", "``") + "`"


def group_keys(counts: DataFrame) -> list[str]:
    """Keys carried through from the source table, such as ``dataset``."""
    return [c for c in counts.columns if c not in COUNT_FIELDS]


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def broadcast_if_small(
    table: DataFrame, size: tuple[int, int] | None = None, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Mark ``table`` for broadcast if its measured size allows it.

    Over ``limit`` rows it is joined by shuffle.
    """
    rows, octets = size or measured(table)
    if rows <= limit and octets <= BROADCAST_BYTES:
        return F.broadcast(table)
    return table.hint("merge")


def measured(table: DataFrame) -> tuple[int, int]:
    """Rows of ``table`` and bytes of its text columns, counted by one small job."""
    texts: Sequence[Column] = [
        F.coalesce(F.octet_length(F.col(quoted(f.name))).cast("bigint"), F.lit(0))
        for f in table.schema.fields
        if is_text(f.dataType)
    ]
    width = sum(texts, F.lit(0).cast("bigint"))
    row = table.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("octets")
    ).first()
    return row["rows"], row["octets"]
