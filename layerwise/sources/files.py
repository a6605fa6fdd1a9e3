"""File sources and sinks (CSV, Parquet)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwise.sources import fs

CORRUPT_COLUMN = "_corrupt_record"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet``: columnar scan, filters and projections pushed down."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header.  With a declared ``schema`` there is no inference pass over the
    data; malformed fields become NULL (PERMISSIVE) and, with ``keep_corrupt``, the raw line
    is kept in ``_corrupt_record``.  Without a schema every column is read as text and typed
    later by the tolerant casts of the cleaning step."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        if keep_corrupt:
            if isinstance(schema, str):
                schema = StructType.fromDDL(schema)
            schema = StructType(list(schema.fields)).add(CORRUPT_COLUMN, "string")
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        reader = reader.schema(schema)
    return reader.csv(path)


def land_with_rejects(df: DataFrame, target: str, rejects: str) -> None:
    """Write what ``read_csv(..., keep_corrupt=True)`` gives in one pass over the text: good rows replace the table
    at ``target``, lines that do not fit the schema the one at ``rejects`` (column ``line``).

    The rows are written apart by a flag and the two folders moved into place.  ``_corrupt_record`` is NULL in
    every good row; ``read_landed`` leaves it out."""
    spark = df.sparkSession
    staged = f"{target}.staged-{uuid.uuid4().hex}"
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    df.withColumn("rejected", bad).write.partitionBy("rejected").parquet(staged)
    for flag, path in (("false", target), ("true", rejects)):
        part = f"{staged}/rejected={flag}"
        if fs.exists(spark, part):
            fs.move(spark, part, path)
        else:  # no such rows: an empty table of the same shape
            spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    fs.delete(spark, staged)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of a landed table."""
    return spark.read.parquet(path).drop(CORRUPT_COLUMN)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``line``: the lines of a source that did not fit its schema."""
    return spark.read.parquet(path).select(F.col(CORRUPT_COLUMN).alias("line"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path`` (landing: the whole table each run)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_keeping_schema(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Truncate-then-append: replace the rows but keep the table's declared schema, so
    dependants keep working.  A new table is simply created.  The incoming columns are
    aligned by name to the existing schema; a mismatch raises instead of silently
    changing the table's shape, and so does a value that its column cannot hold: the rows that
    would lose one are counted first, and the table is left as it is."""
    if not fs.exists(spark, path):
        write_parquet(df, path)
        return
    existing = read_landed(spark, path).schema
    missing = [f.name for f in existing.fields if f.name not in df.columns]
    extra = [c for c in df.columns if c not in existing.fieldNames()]
    if missing or extra:
        raise ValueError(f"schema change refused: missing {missing}, extra {extra}")
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = [f for f in existing.fields if types[f.name] != f.dataType]
    if changed:
        lost = [F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in changed]
        bad = df.select(F.count_if(reduce(lambda a, b: a | b, lost))).first()[0]
        if bad:
            raise ValueError(f"{bad} rows hold values that {[f.name for f in changed]} of {path} cannot take")
    aligned = df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in existing.fields])
    write_parquet(aligned, path)


# --- layouts that later reads can use -----------------------------------------------

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def write_by_date(df: DataFrame, path: str, column: str = "snapshot_date") -> None:
    """A table partitioned by a date: one folder per day.  Dates written as text are read as dates first; rows with a
    missing or malformed one go to the folder of NULL."""
    day = F.col(column).try_cast("date")
    df.withColumn(column, day).write.mode("overwrite").partitionBy(column).parquet(path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the names of the folders alone."""
    prefix = f"{column}="
    names = [name[len(prefix):] for name in fs.list_names(spark, path) if name.startswith(prefix)]
    return sorted(name for name in names if name != DEFAULT_PARTITION)


def read_latest_date(spark: SparkSession, path: str, column: str = "snapshot_date") -> DataFrame:
    """Rows of the last day of a table written by ``write_by_date``.

    The last day is the greatest folder name (dates sort as text), so no row is read to find it, and the filter on it
    leaves one partition to read."""
    days = partition_values(spark, path, column)
    table = spark.read.parquet(path)
    if not days:
        return table.filter(F.lit(False))
    return table.filter(F.col(column) == F.to_date(F.lit(days[-1])))


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """A catalogue table at ``path`` bucketed and sorted by ``keys``: tables written alike by the same keys and number
    of buckets are joined or grouped on them without a shuffle.  One file per bucket."""
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
