"""Column expressions.  All are built-in Spark expressions (whole-stage codegen), no UDFs."""

from layerwise.functions.casts import cast_date, numeric, parse_date, safe_cast, truncating_int
from layerwise.functions.dates import calendar_date, year_start
from layerwise.functions.defaults import (
    default_cast_first,
    default_coalesce_first,
    unknown_if_null,
)
from layerwise.functions.text import (
    after_first_comma,
    first_part,
    natural_key,
    one_decimal,
    percent_text,
    score_text,
    score_text_1dp,
)
from layerwise.functions.names import first_existing, normalise, normalise_ci

__all__ = [
    "numeric",
    "calendar_date",
    "year_start",
    "one_decimal",
    "parse_date",
    "safe_cast",
    "cast_date",
    "truncating_int",
    "default_cast_first",
    "default_coalesce_first",
    "unknown_if_null",
    "after_first_comma",
    "first_part",
    "natural_key",
    "percent_text",
    "score_text",
    "score_text_1dp",
    "first_existing",
    "normalise",
    "normalise_ci",
]
