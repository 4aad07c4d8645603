"""Delimited text with line ends inside of cells, read by many tasks.

Whether a line begins inside of a quoted cell depends on all lines before it. Each line, and each
block of a file that a task reads, is a function of that one bit: it keeps it, flips it or sets
it. Lines are summed up within their block, the blocks of a file are combined in order (a row
per block), and then every line knows how it begins. A record that is one line is parsed
where it is; only lines of longer records are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BLOCK = ["_file", "_block"]


def read_split_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """``read_table`` with all columns as text, for plain files that one task is too slow for.

    A cell is quoted if it begins with ``"`` and ends at the next one without a backslash
    before it, as the CSV source has it. Each file has a header, which is that of the first.
    """
    schema = spark.read.option("header", True).option("sep", sep).option("multiLine", True).csv(path).schema
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),  # rises with the lines of a block
    )
    records = _records(lines, sep).where(F.col("value") != "")
    options = {"sep": sep, "multiLine": "true"}
    row = F.from_csv("value", ", ".join(f"`c{i}` string" for i in range(len(schema))), options)
    return records.select(row.alias("row")).select("row.*").toDF(*schema.names)


def _records(lines: DataFrame, sep: str) -> DataFrame:
    """``value``: the records of all files but their headers."""
    begun = _with_begin(lines.withColumns({"out": _ends_inside("value", sep, False), "in": _ends_inside("value", sep, True)}))
    upto = Window.partitionBy(*_BLOCK).orderBy("_id")
    numbered = begun.withColumn("record", F.sum(F.when(F.col("begin") == 0, 1).otherwise(0)).over(upto))
    # lines before the first record of a block carry on the last record before it
    held = numbered.groupBy(*_BLOCK).agg(F.max("record").alias("record"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    holder = F.last(F.when(F.col("record") > 0, F.struct(F.col("_block").alias("block"), "record")), True).over(before)
    first = Window.partitionBy("_file").orderBy("_block")
    held = held.select(*_BLOCK, holder.alias("holder"), (F.row_number().over(first) == 1).alias("leads"))
    placed = numbered.join(held, _BLOCK).select(
        "value", "begin", "end", "_file", "_block", "_id",
        F.when(F.col("record") > 0, F.col("_block")).otherwise(F.col("holder.block")).alias("block"),
        F.when(F.col("record") > 0, F.col("record")).otherwise(F.col("holder.record")).alias("record"),
        F.col("leads"),
    )
    # a header is the first record of the first block
    header = F.col("leads") & (F.col("record") == 1) & (F.col("block") == F.col("_block"))
    single = (F.col("begin") == 0) & (F.col("end") == 0)
    whole = placed.where(single & ~header).select(_bare("value").alias("value"))
    parts = placed.where(~single).groupBy("_file", "block", "record").agg(
        F.max(header).alias("header"),
        F.array_sort(F.collect_list(F.struct("_block", "_id", "value"))).alias("lines"))
    joined = F.array_join(F.transform("lines.value", _bare), "\n")
    return whole.unionByName(parts.where(~F.col("header")).select(joined.alias("value")))


def _bare(line: Column | str) -> Column:
    """A line without the carriage return of its end."""
    return F.regexp_replace(line, "\r$", "")


def _ends_inside(line: str, sep: str, begin: bool) -> Column:
    """1 if the line ends inside of a quoted cell, when it begins inside of one or not."""
    end = "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep
    body = r'(?:[^"\\]++|\\.)*+'
    cells = rf'(?:"{body}"[^{end}]*+{end}|[^"{end}][^{end}]*+{end}|{end})*+'
    opened = rf'{cells}"{body}\\?'
    pattern = rf'^(?s:{body}\\?(?:"[^{end}]*+{end}{opened})?)$' if begin else rf"^(?s:{opened})$"
    inside = F.col(line).rlike(pattern)
    has_quote = F.col(line).contains('"')
    return F.when(has_quote, inside.cast("int")).otherwise(int(begin))


def _with_begin(lines: DataFrame) -> DataFrame:
    """``begin`` and ``end``: 1 where a line begins or ends inside of a quoted cell."""
    upto = Window.partitionBy(*_BLOCK).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    within = _states(lines, upto)
    # what a block makes of the bit: that of its last line
    last = F.max_by(F.struct(*[_then(f"from{b}").alias(f"to{b}") for b in (0, 1)]), "_id")
    blocks = within.groupBy(*_BLOCK).agg(last.alias("to")).select(*_BLOCK, F.col("to.to0").alias("out"), F.col("to.to1").alias("in"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = _states(blocks, before).select(*_BLOCK, F.col("from0").alias("start"))
    known = within.join(starts, _BLOCK).withColumn("begin", F.when(F.col("start") == 1, F.col("from1")).otherwise(F.col("from0")))
    return known.withColumn("end", _then("begin"))


def _then(begin: str) -> Column:
    return F.when(F.col(begin) == 1, F.col("in")).otherwise(F.col("out"))


def _states(rows: DataFrame, before: Window) -> DataFrame:
    """``from0, from1``: the bit before each row, if the first row of its window begins with 0 or 1.

    A row that sets the bit forgets what was before it; of those that flip it only the parity
    since counts.
    """
    flips = F.coalesce(F.sum(F.when((F.col("out") == 1) & (F.col("in") == 0), 1).otherwise(0)).over(before), F.lit(0))
    counted = rows.withColumn("flips", flips)
    level = F.when(F.col("out") == F.col("in"), (F.col("out") + F.col("flips")) % 2)
    set_to = F.last(level, True).over(before)
    return counted.withColumn("set_to", set_to).withColumns({
        f"from{b}": ((F.coalesce("set_to", F.lit(b)) + F.col("flips")) % 2).cast("int") for b in (0, 1)
    }).drop("flips", "set_to")
