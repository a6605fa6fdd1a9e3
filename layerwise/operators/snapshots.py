"""Latest snapshot per entity, and rows at the global latest date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from layerwise.operators.dedup import _keys

_RN = "__latest_rn"


def when_known(df: DataFrame, column: str) -> Column:
    """``column`` for comparing: a date written as text is read as a date, so that a malformed one is NULL
    instead of coming after every real date."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.col(column).try_cast("date")
    return F.col(column)


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: str = "snapshot_date",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Row with the greatest ``order`` per key (``row_number() … = 1``); ties are broken by
    ``tie`` ascending, then by every remaining column, so the choice is repeatable; NULLs come last
    throughout, and so do malformed dates.
    Planned as partial + final ``WindowGroupLimit``: one row per key per map task is shuffled."""
    keys = _keys(key)
    used = set(keys) | {order} | set(tie)
    rest = [c for c in df.columns if c not in used]
    window = Window.partitionBy(*keys).orderBy(
        when_known(df, order).desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in tie],
        *[F.col(c).asc_nulls_last() for c in rest],
    )
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def at_global_max(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows whose ``column`` equals its overall maximum (uncorrelated scalar subquery,
    evaluated once and pushed to the scan as a data filter)."""
    known = when_known(df, column)
    return df.filter(known == df.select(F.max(known)).scalar())
