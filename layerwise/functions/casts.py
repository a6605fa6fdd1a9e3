"""Tolerant casts.

Spark 4 runs with ANSI semantics, where a plain ``cast`` of malformed text
raises.  The cleaned layer must instead turn malformed input into NULL, so
every conversion here goes through ``try_cast`` / ``try_to_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, to: str | DataType) -> Column:
    """Cast, with malformed input becoming NULL instead of an error.  Not for numbers written as text:
    a plain cast takes no decimals, see ``truncating_int``."""
    return _col(c).try_cast(to)


def truncating_int(c: ColumnOrName) -> Column:
    """Number or numeric text → int by truncation toward zero (``1841.9`` → 1841, ``-5.7`` → -5).

    Going through double first accepts decimal text; the double → int step
    truncates, and an out-of-range value becomes NULL.
    """
    return _col(c).try_cast("double").try_cast("int")


def converted(c: ColumnOrName, to: str | DataType) -> Column:
    """``safe_cast``, but a whole number is read from decimal text as well (``'3.0'`` → 3, ``'12.5'`` → 12)."""
    return truncating_int(c) if to in ("int", "integer") else safe_cast(c, to)


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Text → date with an explicit pattern; text that does not parse becomes NULL."""
    return F.try_to_date(_col(c), fmt)


def cast_date(c: ColumnOrName) -> Column:
    """Text → date by plain cast (ISO form); malformed text becomes NULL."""
    return _col(c).try_cast("date")


def numeric(df: DataFrame, name: str, to: str | DataType = "double") -> Column:
    """A numeric column as it is; a text column (an untyped landing) converted with
    ``try_cast`` so that it compares and adds as a number and malformed values become NULL."""
    if isinstance(df.schema[name].dataType, StringType):
        return F.col(name).try_cast(to)
    return F.col(name)
