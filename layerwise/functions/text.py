"""Text expressions: location split, natural keys, report formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerwise.functions.casts import _col, ColumnOrName

# Pattern for "everything after the first comma" of a venue
# ("Rose Bowl, Pasadena, USA" → "Pasadena, USA"); key separator; text formats.
AFTER_FIRST_COMMA = r",\s*(.+)$"
KEY_SEPARATOR = "_"
PERCENT_DECIMAL = "decimal(18,6)"
SCORE_SEPARATOR = " - "


def first_part(c: ColumnOrName, sep: str = ",") -> Column:
    """Text before the first separator; the whole text when there is none; NULL stays NULL."""
    return F.substring_index(_col(c), sep, 1)


def after_first_comma(c: ColumnOrName) -> Column:
    """Trimmed text after the first comma; ``''`` when there is no comma; NULL stays NULL."""
    return F.trim(F.regexp_extract(_col(c), AFTER_FIRST_COMMA, 1))


def natural_key(*parts: ColumnOrName, sep: str = KEY_SEPARATOR) -> Column:
    """Join key parts with ``sep``; NULL parts are skipped (``a, NULL, b`` → ``a_b``)."""
    return F.concat_ws(sep, *[_col(p).cast("string") for p in parts])


def percent_text(c: ColumnOrName, digits: int = 1) -> Column:
    """Probability → ``'70.7%'``.  Decimal arithmetic keeps a trailing ``.0``."""
    scaled = _col(c).try_cast(PERCENT_DECIMAL) * F.lit(100)
    return F.concat(F.round(scaled, digits).cast("string"), F.lit("%"))


def score_text(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a || ' - ' || b``: NULL when either side is NULL, like SQL ``||``."""
    return F.concat(_col(a).cast("string"), F.lit(SCORE_SEPARATOR), _col(b).cast("string"))


def one_decimal(c: ColumnOrName) -> Column:
    """Number → text with one decimal, rounded half-even on the exact binary value (as C's
    and Python's ``%.1f`` do; Java's ``%.1f`` rounds 2.25 up instead).  ``format_number``
    rounds that way; its thousands separators are removed."""
    return F.regexp_replace(F.format_number(_col(c), 1), ",", "")


def score_text_1dp(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``'1.4-0.7'`` from unrounded expected scores, one decimal each."""
    return F.concat(one_decimal(a), F.lit("-"), one_decimal(b))
