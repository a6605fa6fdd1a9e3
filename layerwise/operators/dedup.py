"""Repeatable de-duplication on a key.

``dropDuplicates`` keeps an arbitrary row (a ``first()`` aggregate).  Here the
kept row is the first in a total order over all remaining columns, so the
result does not depend on partitioning.  ``row_number() = 1`` is planned with a
partial ``WindowGroupLimit`` before the shuffle: each map task forwards at most
one row per key, so a key holding a third of the input does not land whole in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_RN = "__dedup_rn"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _orderable(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns usable as sort keys (maps have no ordering)."""
    return [n for n in names if not isinstance(df.schema[n].dataType, MapType)]


def tie_break_order(df: DataFrame, key: str | Sequence[str]) -> list[Column]:
    keys = set(_keys(key))
    rest = [c for c in df.columns if c not in keys]
    return [F.col(c).asc_nulls_last() for c in _orderable(df, rest)]


def dedup(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key; the first by ``order`` (default: every other column, ascending,
    NULLs last, so a known value beats a missing one).  NULL key values form one group, as in ``dropDuplicates``."""
    keys = _keys(key)
    # with no other column every row of a key is identical: any order will do
    ordering = order or tie_break_order(df, keys) or [F.col(k) for k in keys]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


_HASH_BITS = 56


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row as one number: NULL cells among ``columns`` in the upper bits, below them 56 bits of a hash of all
    columns of ``df``.  Its minimum is the fullest row, chosen alike in every run and partitioning."""
    nulls = reduce(add, [F.col(f"`{c}`").isNull().cast("long") for c in columns], F.lit(0).cast("long"))
    return F.shiftleft(nulls, _HASH_BITS) + F.shiftrightunsigned(
        F.xxhash64(*[F.col(f"`{c}`") for c in _orderable(df, df.columns)]), 64 - _HASH_BITS)


def null_cells(mark: str) -> Column:
    """NULL cells of the row that a fingerprint stands for."""
    return F.shiftright(F.col(mark), _HASH_BITS)


def keep_fullest(df: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the fewest NULL cells (among ``columns``, default all), of several the one with
    the smallest hash.  The order compares one number, whatever the number and width of the columns."""
    return dedup(df, key, [fingerprint(df, list(columns or df.columns)).asc(), *tie_break_order(df, key)])


def distinct_key_count(key: str | Sequence[str]) -> Column:
    """Distinct keys, with NULL key values counted as a group (struct of the key parts)."""
    return F.count_distinct(F.struct(*[F.col(k) for k in _keys(key)]))


def dedup_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: total_rows, distinct_keys, duplicate_count (= rows removed by ``dedup``)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), distinct_key_count(key).alias("distinct_keys")
    ).withColumn("duplicate_count", F.col("total_rows") - F.col("distinct_keys"))
