"""Tests on a single cell."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def normalized(col: Column | str) -> Column:
    """Lower case, without blanks at either end."""
    return F.lower(F.trim(_col(col)))


def is_empty(
    col: Column | str,
    tokens: str | Iterable[str] = "profile",
    normalize: bool = True,
) -> Column:
    """True for a missing cell and for the usual ways of writing one.

    ``tokens`` is the name of a list in ``fixed_values.EMPTY_TOKENS`` or the
    words themselves.  Never NULL, so ``~is_empty(c)`` is its complement.
    """
    words = fixed.EMPTY_TOKENS[tokens] if isinstance(tokens, str) else tokens
    cell = _col(col)
    text = normalized(cell) if normalize else cell
    return cell.isNull() | F.coalesce(text.isin(*words), F.lit(False))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
