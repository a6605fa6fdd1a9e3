"""Defaults for missing values.

The order of cast and coalesce matters and both forms are kept:

* cast first  – ``coalesce(try_cast(c), d)``: NULL *and* malformed input get the default;
* coalesce first – ``try_cast(coalesce(c, d))``: only NULL gets the default,
  malformed input still becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from layerwise.functions.casts import _col, ColumnOrName, converted

# The text used for an unknown label, and for a placeholder.
UNKNOWN = "Unknown"
TO_BE_DECIDED = "TBD"


def default_cast_first(c: ColumnOrName, to: str | DataType, default) -> Column:
    return F.coalesce(converted(c, to), F.lit(default).try_cast(to))


def default_coalesce_first(c: ColumnOrName, to: str | DataType, default) -> Column:
    """``try_cast(coalesce(c, default))`` written without mixing the column's type and the
    default's: under ANSI rules ``coalesce(text, 0)`` would cast the text implicitly and fail
    on a malformed value instead of giving NULL."""
    value = _col(c)
    return F.when(value.isNull(), F.lit(default).try_cast(to)).otherwise(converted(value, to))


def unknown_if_null(c: ColumnOrName, text: str = UNKNOWN) -> Column:
    return F.coalesce(_col(c), F.lit(text))
