"""Source catalogue and landing.

A catalogue lists sources (name, path, declared schema, required?).  Landing
replaces each raw table and records one manifest row per table: rows (counted
over the written table, which Parquet answers from its footers, so that tasks
run again after a lost executor count once), lines rejected, bytes of the
source, seconds and rows per second.  Lines of a CSV source that do not fit its
declared schema are kept beside the table, under ``<out_root>/_rejects``; the
counts of rows and rejected lines add up to the lines read.  A missing optional
source is skipped with a warning; a missing required source stops the landing.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwise.sources import fs
from layerwise.sources.files import land_with_rejects, read_csv, read_landed, replace_keeping_schema
from layerwise.sources.jdbc import read_jdbc

log = logging.getLogger(__name__)

# Version stamped on a newly registered table.
DEFAULT_SCHEMA_VERSION = "1.0"

MANIFEST_SCHEMA = (
    "table_name string, source_file string, ingestion_timestamp timestamp, row_count long, "
    "schema_version string, file_size_bytes long, ingestion_seconds double, rows_per_second double, "
    "rejected_count long"
)


@dataclass(frozen=True)
class Source:
    """A raw input.  ``path`` is a file or folder for file formats (CSV: option ``header``, default
    True); for ``fmt="jdbc"`` it is the JDBC URL and ``options`` carries ``table``, connection
    ``properties`` and optional ``partition_column`` / ``num_partitions`` / ``ranges`` for a split read, or ``small`` for a table that one
    task may read."""

    name: str
    path: str
    schema: StructType | str | None = None
    required: bool = True
    fmt: str = "csv"
    options: dict = field(default_factory=dict)
    keep_schema: bool = False  # truncate-then-append: keep an existing table's schema


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    if source.fmt == "csv":
        return read_csv(spark, source.path, source.schema, header=source.options.get("header", True),
                        keep_corrupt=source.schema is not None)
    if source.fmt == "jdbc":
        opts = dict(source.options)
        return read_jdbc(
            spark, source.path, opts.pop("table"), opts.pop("properties", None),
            partition_column=opts.pop("partition_column", None),
            num_partitions=opts.pop("num_partitions", None), small=opts.pop("small", False),
            ranges=opts.pop("ranges", "width"),
        )
    reader = spark.read.format(source.fmt).options(**source.options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.load(source.path)


def available(spark: SparkSession, source: Source) -> bool:
    if source.fmt == "jdbc":
        return True  # a missing table fails the read itself
    return fs.exists(spark, source.path)


def _source_bytes(spark: SparkSession, source: Source) -> int | None:
    return None if source.fmt == "jdbc" else fs.size_bytes(spark, source.path)


def registered(table: DataFrame, name: str, source_file: str) -> DataFrame:
    """The registry entry of a table: one row table_name, source_file, row_count, schema_version."""
    return table.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), F.lit(source_file).alias("source_file"), "row_count",
        F.lit(DEFAULT_SCHEMA_VERSION).alias("schema_version"))


def rejects_path(out_root: str, name: str) -> str:
    return f"{out_root}/_rejects/{name}"


def land(
    spark: SparkSession,
    sources: list[Source],
    out_root: str,
    ingestion_time: dt.datetime | None = None,
) -> DataFrame:
    """Land every available source as ``<out_root>/<name>`` (Parquet, replaced) and return
    the manifest rows (one per landed table; a small driver-side report)."""
    stamp = ingestion_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for source in sources:
        if not available(spark, source):
            if source.required:
                raise FileNotFoundError(f"required source {source.name!r} missing: {source.path}")
            log.warning("optional source %s missing at %s; skipped", source.name, source.path)
            continue
        started = time.perf_counter()
        df = read_source(spark, source)
        target, rejects = f"{out_root}/{source.name}", rejects_path(out_root, source.name)
        rejected = 0
        if source.fmt == "csv" and source.schema is not None:
            good = f"{target}.parsed-{uuid.uuid4().hex}" if source.keep_schema else target
            land_with_rejects(df, good, rejects)
            rejected = spark.read.parquet(rejects).count()
            if source.keep_schema:
                replace_keeping_schema(spark, read_landed(spark, good), target)
                fs.delete(spark, good)
        elif source.keep_schema:
            replace_keeping_schema(spark, df, target)
        else:
            df.write.mode("overwrite").parquet(target)
        seconds = time.perf_counter() - started
        source_file = source.options.get("table") or source.path.rsplit("/", 1)[-1]
        entry = registered(spark.read.parquet(target), source.name, source_file).first()  # one row
        count = entry["row_count"]
        rows.append((
            source.name, source_file, stamp, count, entry["schema_version"], _source_bytes(spark, source),
            seconds, count / seconds if seconds > 0 else float(count), rejected,
        ))
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)
