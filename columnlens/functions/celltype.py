"""What a text cell holds: a whole number, a real number, a date or text.

Shapes are tested before any cast.  Casts accept more than the shapes do
(``1.5f``, ``5d``) and differ between engines; the shapes do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .cells import _col


def parse_long(col: Column | str) -> Column:
    """The cell as BIGINT, NULL unless it is a whole number of 64 bits."""
    cell = _col(col)
    return F.when(
        cell.rlike(fixed.INTEGER_SHAPE), F.trim(_blanks(cell)).try_cast("bigint")
    )


def parse_double(col: Column | str) -> Column:
    """The cell as DOUBLE, NULL unless it is written as a number."""
    cell = _col(col)
    text = F.trim(_blanks(cell))
    return (
        F.when(cell.rlike(fixed.REAL_SHAPE), text.try_cast("double"))
        .when(cell.rlike(fixed.NOT_A_NUMBER_SHAPE), F.lit(float("nan")))
        .when(cell.rlike(fixed.INFINITY_SHAPE), text.try_cast("double"))
    )


def parse_date(col: Column | str) -> Column:
    """The cell as DATE in one of four written forms, else NULL.

    Each form is rewritten year first and cast; a formatter would raise and
    catch an exception for every cell that is no date.
    """
    cell = _col(col)
    parsed = F.lit(None).cast("date")
    for shape, year_first in reversed(fixed.DATE_SHAPES):
        iso = F.regexp_replace(cell, shape, year_first)
        valid = cell.rlike(shape) & ~iso.startswith("0000")
        parsed = F.when(valid, iso.try_cast("date")).otherwise(parsed)
    return parsed


def cell_type(col: Column | str) -> Column:
    """Name of the cell's type; NULL for a missing cell, which is never reported.

    Most text is told from numbers and dates by its first and last character, so
    that shapes are only tried on cells that could have one.
    """
    cell = _col(col)
    first = F.substring(F.ltrim(cell), 1, 1).isin(*fixed.FIRST_CHARACTERS)
    last = F.substring(F.rtrim(cell), -1, 1).isin(*fixed.LAST_CHARACTERS)
    return (
        F.when(cell.isNull(), F.lit(None).cast("string"))
        .when(~(first & last), F.lit(fixed.TEXT))
        .when(parse_long(cell).isNotNull(), F.lit(fixed.INTEGER))
        .when(
            cell.rlike(fixed.REAL_SHAPE)
            | cell.rlike(fixed.NOT_A_NUMBER_SHAPE)
            | cell.rlike(fixed.INFINITY_SHAPE),
            F.lit(fixed.REAL),
        )
        .when(parse_date(cell).isNotNull(), F.lit(fixed.DATE))
        .otherwise(F.lit(fixed.TEXT))
    )


def parsed_values(kind: Column | str, col: Column | str) -> dict[str, Column]:
    """The cell as number or date, given its type: ``long_val, double_val, date_val``.

    Each is NULL for cells of another type, and only tried for cells of its own.
    """
    kind, cell = _col(kind), _col(col)
    number = F.trim(_blanks(cell)).try_cast("bigint")  # the shape is known
    return {
        "long_val": F.when(kind == fixed.INTEGER, number),
        "double_val": F.when(kind == fixed.REAL, parse_double(cell)),
        "date_val": F.when(kind == fixed.DATE, parse_date(cell)),
    }


def _blanks(cell: Column) -> Column:
    """Line ends and tabs around a number count as blanks."""
    return F.translate(cell, "\t\n\x0b\f\r", "     ")
