"""Data-quality profiling and constraint checks, by hash aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.operators.dedup import _keys, fingerprint, null_cells


def null_count(columns: Sequence[str]) -> Column:
    """Aggregate: number of NULL cells over ``columns`` (one pass, not one job per column)."""
    if not columns:
        return F.lit(0).cast("long")
    return reduce(add, [F.count_if(F.col(c).isNull()) for c in columns])


def invalid_count(checks: Sequence[tuple[str, str]]) -> Column:
    """Aggregate: rows where some raw value is present but its parsed value is NULL.

    ``checks`` pairs (raw column, parsed column), e.g. ``("Date", "match_date")``.
    """
    if not checks:
        return F.lit(0).cast("long")
    bad = reduce(
        lambda a, b: a | b,
        [F.col(raw).isNotNull() & F.col(parsed).isNull() for raw, parsed in checks],
    )
    return F.count_if(bad)


def profile(
    df: DataFrame,
    table_name: str,
    key: str | Sequence[str] | None = None,
    invalid: Sequence[tuple[str, str]] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Quality record of the table obtained by de-duplicating ``df`` on ``key``, the fullest row of each key being
    kept (``dedup.keep_fullest``).

    ``columns`` limits the NULL count (default: all but the raw columns of ``invalid``).

    One pass over ``df``: per key its rows, bad values and smallest fingerprint, whose upper bits are the NULL cells
    of the row it stands for; then the sums of those.  All are fixed-width counters of a hash aggregate, combined in
    each task before the shuffle, so a key that a third of the rows share costs one row a task."""
    raw_cols = {raw for raw, _ in invalid}
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in raw_cols]
    bad = invalid_count(invalid)
    if not key:
        return record(df, df, table_name, bad, columns)
    by_key = df.groupBy(*_keys(key)).agg(
        F.count(F.lit(1)).alias("rows"), bad.alias("invalid"), F.min(fingerprint(df, columns)).alias("fullest"))
    return by_key.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(null_cells("fullest")), F.lit(0)).cast("long").alias("null_count"),
        (F.coalesce(F.sum("rows"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_count"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_records"),
    ).select(F.lit(table_name).alias("table_name"), "total_records", "null_count", "duplicate_count", "invalid_records")


def record(rows: DataFrame, kept: DataFrame, table_name: str, invalid: Column, columns: Sequence[str]) -> DataFrame:
    """One row: table_name, total_records (rows ``kept``), null_count (NULL cells among ``columns`` of
    the kept rows), duplicate_count (rows removed), invalid_records (``invalid``, an aggregate over all
    ``rows``: removing a duplicate hides no bad value).

    Two hash aggregates without a key, one over the rows and one over those kept."""
    before = rows.agg(F.count(F.lit(1)).alias("rows"), invalid.alias("invalid"))
    after = kept.agg(F.count(F.lit(1)).alias("kept"), null_count(columns).alias("nulls"))
    none = F.lit(0).cast("long")
    both = before.select("rows", "invalid", none.alias("kept"), none.alias("nulls")).unionByName(
        after.select(none.alias("rows"), none.alias("invalid"), "kept", "nulls"))
    return both.agg(*[F.sum(c).alias(c) for c in ("rows", "invalid", "kept", "nulls")]).select(
        F.lit(table_name).alias("table_name"),
        F.col("kept").alias("total_records"),
        F.col("nulls").alias("null_count"),
        (F.col("rows") - F.col("kept")).alias("duplicate_count"),
        F.col("invalid").alias("invalid_records"),
    )


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Primary-key violations: key values occurring more than once, or with a NULL part.

    Returns the key columns and ``occurrences``; an empty result means the key holds.
    """
    keys = _keys(key)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter((F.col("occurrences") > 1) | any_null)
    )


def coverage(
    df: DataFrame, columns: Sequence[str], bound: float = 0.9, name: str = "coverage"
) -> DataFrame:
    """Share of rows where every one of ``columns`` is present, against a lower bound.

    One row: check_name, checked_rows, covered_rows, coverage, bound, passed.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.agg(F.count(F.lit(1)).alias("checked_rows"), F.count_if(present).alias("covered_rows"))
        .withColumn("coverage", F.try_divide(F.col("covered_rows"), F.col("checked_rows")))
        .select(
            F.lit(name).alias("check_name"),
            "checked_rows",
            "covered_rows",
            "coverage",
            F.lit(bound).alias("bound"),
            F.coalesce(F.col("coverage") > F.lit(bound), F.lit(False)).alias("passed"),
        )
    )


def row_count_check(df: DataFrame, name: str, min_rows: int = 1) -> DataFrame:
    """Volume expectation: one row check_name, observed, bound, passed."""
    return df.agg(F.count(F.lit(1)).alias("observed")).select(
        F.lit(name).alias("check_name"),
        "observed",
        F.lit(min_rows).cast("long").alias("bound"),
        (F.col("observed") >= F.lit(min_rows)).alias("passed"),
    )


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Plan-time check that ``required`` columns exist (exact names)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
