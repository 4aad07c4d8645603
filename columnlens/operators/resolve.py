"""Finding the header a work list means."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .matching import share_a_piece

EXACT, ALIAS, ALIAS_INSIDE, SPACED, SIMILAR = range(5)


def resolve_columns(
    worklist: DataFrame,
    headers: DataFrame,
    aliases: Mapping[str, str] | None = None,
    threshold: float = fixed.SIMILARITY,
) -> DataFrame:
    """Header meant by each work-list entry: ``idx, dataset, column, resolved, tier``.

    ``worklist`` has ``idx, dataset, column``; ``headers`` has ``dataset, pos,
    header``.  In order: the name itself; if the name holds a key of
    ``aliases``, the alias, then the first header with the alias inside;
    otherwise the name with blanks for underscores, then the first header that
    is similar to that.  Entries without any have NULL in ``resolved``.
    """
    name = F.col("column")
    alias = F.lit(None).cast("string")
    for part, full in reversed((aliases or {}).items()):
        alias = F.when(F.contains(name, F.lit(part)), F.lit(full)).otherwise(alias)
    wanted = worklist.select("idx", "dataset", "column", alias.alias("alias")).withColumn(
        "spaced", F.when(F.col("alias").isNull(), F.translate(name, "_", " "))
    )
    # a name that occurs twice in a table means its first column
    heads = headers.groupBy("dataset", "header").agg(F.min("pos").alias("pos"))

    def tier(found: DataFrame, number: int) -> DataFrame:
        return found.select("idx", F.lit(number).alias("tier"), "pos", "header")

    def same(column: str) -> DataFrame:
        by = wanted.select("idx", "dataset", F.col(column).alias("header"))
        return by.filter(F.col("header").isNotNull()).join(heads, ["dataset", "header"])

    aliased = wanted.filter(F.col("alias").isNotNull()).select("idx", "dataset", "alias")
    inside = aliased.join(
        aliased.select("dataset", "alias")
        .distinct()
        .join(heads, "dataset")
        .filter(F.contains("header", "alias")),
        ["dataset", "alias"],
    )
    pairs = share_a_piece(
        wanted.filter(F.col("spaced").isNotNull()).select("dataset", "spaced").distinct(),
        heads,
        "spaced",
        "header",
        ["dataset"],
        threshold,
    )
    similar = wanted.select("idx", "dataset", "spaced").join(pairs, ["dataset", "spaced"])

    found = tier(same("column"), EXACT).unionByName(tier(same("spaced"), SPACED))
    found = found.unionByName(tier(similar, SIMILAR))
    if aliases:
        found = found.unionByName(tier(same("alias"), ALIAS))
        found = found.unionByName(tier(inside, ALIAS_INSIDE))
    best = found.groupBy("idx").agg(F.min(F.struct("tier", "pos", "header")).alias("best"))
    return worklist.join(best, "idx", "left").select(
        "idx",
        "dataset",
        "column",
        F.col("best.header").alias("resolved"),
        F.col("best.tier").alias("tier"),
    )


def unresolved(resolved: DataFrame) -> DataFrame:
    """Entries without a header, as quarantine rows."""
    return resolved.filter(F.col("resolved").isNull()).select(
        F.col("idx").cast("bigint").alias("idx"),
        "dataset",
        "column",
        F.lit("no such column").alias("error"),
    )
