"""JDBC sources and sinks.

An unpartitioned JDBC read is a single task holding the whole table.  Here a
read is split on a numeric, date or timestamp column into ``num_partitions``
ranges; when bounds are not given they are fetched with one MIN/MAX query
executed by the database.  A read in one task must be asked for as such.

Equal widths deal a skewed column unevenly.  With ``ranges="depth"`` the database is asked for the values
at equal steps of the sorted column instead, so each range holds about as many rows; rows whose column is
NULL are a range of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


Bound = int | dt.date | dt.datetime | None


def _bound(value: Bound, after: bool = False) -> int | str:
    """A bound as Spark's JDBC reader takes it; ``after``: the one that follows, so that the range holds it."""
    if isinstance(value, dt.datetime):
        return (value + dt.timedelta(seconds=int(after))).strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(value, dt.date):
        return (value + dt.timedelta(days=int(after))).isoformat()
    return int(value) + int(after)


def partition_bounds(
    spark: SparkSession, url: str, table: str, column: str, properties: dict | None = None,
    quote: str = '"',
) -> tuple:
    """MIN and MAX of ``column``, computed by the database.  The column is quoted with
    ``quote`` (standard SQL double quotes; pass ``""`` for a raw expression)."""
    ref = f"{quote}{column}{quote}"
    bounds = spark.read.jdbc(
        url, f"(SELECT MIN({ref}) AS lo, MAX({ref}) AS hi FROM {table}) b",
        properties=properties or {},
    ).first()
    return (bounds[0], bounds[1]) if bounds else (None, None)


def _literal(value) -> str:
    """A bound as a literal; dates in the escapes that every JDBC driver translates."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def depth_predicates(
    spark: SparkSession, url: str, table: str, column: str, ranges: int, properties: dict | None = None,
    quote: str = '"',
) -> list[str]:
    """Conditions of at most ``ranges`` ranges of about equally many rows each, and one for NULL if there is any.

    The database counts the column and gives the value at each step (``OFFSET ... FETCH``, standard SQL; one query of
    one row a step, served by an index on the column where there is one).  A value that several steps hit starts one
    range: rows with equal values cannot be told apart by the column."""
    ref = f"{quote}{column}{quote}"

    def ask(query: str):
        return spark.read.jdbc(url, f"({query}) q", properties=properties or {}).first()

    rows, known = ask(f"SELECT COUNT(*) AS n, COUNT({ref}) AS k FROM {table}")
    starts = []
    for step in range(1, min(ranges, known)):
        found = ask(f"SELECT {ref} AS v FROM {table} WHERE {ref} IS NOT NULL ORDER BY {ref} "
                    f"OFFSET {known * step // ranges} ROWS FETCH NEXT 1 ROWS ONLY")[0]
        if not starts or found != starts[-1]:
            starts.append(found)
    edges = [_literal(v) for v in starts]
    conditions = [" AND ".join(filter(None, [low and f"{ref} >= {low}", high and f"{ref} < {high}"]))
                  for low, high in zip([None, *edges], [*edges, None])]
    conditions = [c or f"{ref} IS NOT NULL" for c in conditions] if known else []
    if rows > known:
        conditions.append(f"{ref} IS NULL")
    return conditions


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    *,
    partition_column: str | None = None,
    lower_bound: Bound = None,
    upper_bound: Bound = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    small: bool = False,
    ranges: str = "width",
) -> DataFrame:
    """Whole-table read in ranges of ``partition_column``, or in one task if the table is declared ``small``.

    ``ranges``: ``"width"`` for ranges of equal width, ``"depth"`` for about equally many rows in each."""
    if ranges not in ("width", "depth"):
        raise ValueError(f"ranges is 'width' or 'depth', not {ranges!r}")
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if not partition_column and not small:
        raise ValueError(f"{table}: name a partition_column, or declare the table small to read it in one task")
    if not partition_column:
        return spark.read.jdbc(url, table, properties=props)
    if ranges == "depth":
        parts = num_partitions or spark.sparkContext.defaultParallelism
        conditions = depth_predicates(spark, url, table, partition_column, max(1, int(parts)), properties)
        return spark.read.jdbc(url, table, predicates=conditions or ["1 = 0"], properties=props)
    if lower_bound is None or upper_bound is None:
        lo, hi = partition_bounds(spark, url, table, partition_column, properties)
        lower_bound = lo if lower_bound is None else lower_bound
        upper_bound = hi if upper_bound is None else upper_bound
    if lower_bound is None:  # empty table
        return spark.read.jdbc(url, table, properties=props)
    parts = num_partitions or spark.sparkContext.defaultParallelism
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=_bound(lower_bound),
        upperBound=_bound(upper_bound, after=True), numPartitions=max(1, int(parts)), **props,
    ).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    *,
    truncate: bool = True,
    mode: str = "overwrite",
    batch_size: int = 1_000,
    num_partitions: int | None = None,
) -> None:
    """Write a table.  ``truncate=True`` with overwrite keeps the target's DDL (keys,
    defaults, dependent views) and replaces only the rows; ``truncate=False`` drops and
    recreates it from the DataFrame's schema.  ``num_partitions`` caps concurrent
    connections."""
    props = {"batchsize": str(batch_size), **(properties or {})}
    if truncate:
        props["truncate"] = "true"
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=props)
