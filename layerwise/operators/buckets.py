"""Large keyed tables: an upsert that rewrites only the buckets with incoming keys.

A table is dealt into a fixed number of buckets by a hash of its key.  A version is a manifest, one
row per bucket, that names the folder with the bucket's rows.  An upsert reads and rewrites the
buckets that hold an incoming key; the next manifest refers to the folders of all others as they
are, so the work follows the change, not the table.  Versions are claimed and committed as in
``operators.upsert``, whose rules for keys, updated columns and repeated incoming rows hold here.

Old and incoming rows meet in one shuffle by bucket, and each bucket is written by one task: choose
the number of buckets so that one is a convenient file (a hash of unique keys deals evenly).  The
manifest, at most one row per bucket, is the only thing that passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwise.operators.dedup import _keys
from layerwise.operators.upsert import (
    _one_per_key, claim_next_version, commit_version, committed_versions, require_known, version_path)
from layerwise.sources.fs import delete

BUCKETS = 256
#: Column that holds a row's bucket while it is merged.
BUCKET = "__bucket"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """``bucket, folder, buckets`` of a committed version (default: the newest); None if there is none."""
    versions = committed_versions(spark, root)
    if not versions:
        return None
    return spark.read.parquet(f"{version_path(root, version or versions[-1])}/manifest")


def _folders(rows) -> dict[int, str]:
    return {r["bucket"]: r["folder"] for r in rows if r["folder"] is not None}


def read_buckets(spark: SparkSession, root: str, key: str | Sequence[str] | None = None,
                 values: Sequence | None = None) -> DataFrame | None:
    """The table's rows; with ``key`` and ``values`` (tuples for a key of several columns) only the buckets that
    hold those keys are read."""
    current = manifest(spark, root)
    if current is None:
        return None
    rows = current.collect()  # a row per bucket
    folders, schema = _folders(rows), StructType.fromJson(_schema(rows))
    if values is not None:
        keys = _keys(key)
        wanted = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values],
                                       StructType([schema[k] for k in keys]))
        hit = {r[0] for r in wanted.select(bucket_of(keys, rows[0]["buckets"])).distinct().collect()}
        found = _read(spark, root, [folders[b] for b in sorted(hit) if b in folders], schema)
        return found.join(F.broadcast(wanted.distinct()), keys, "left_semi")  # ``values`` come from the caller
    return _read(spark, root, [folders[b] for b in sorted(folders)], schema)


def _schema(rows) -> dict:
    return json.loads(rows[0]["schema"])


def _read(spark: SparkSession, root: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{folder}" for folder in folders])


def _merged(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], listed: set[str]) -> DataFrame:
    """One row per key of old and incoming rows, with its bucket; both sides meet in one shuffle by bucket."""
    rest = [c for c in columns if c not in keys]
    row = F.struct(F.lit(True).alias("here"), *[F.col(f"`{c}`") for c in rest])
    none = F.lit(None)
    both = old.select(BUCKET, *keys, row.alias("old"), none.alias("new")).unionByName(
        new.select(BUCKET, *keys, none.alias("old"), row.alias("new")))
    one = both.repartition(BUCKET).groupBy(BUCKET, *keys).agg(
        F.first("old", ignorenulls=True).alias("old"), F.first("new", ignorenulls=True).alias("new"))

    def pick(c: str) -> Column:
        first, second = ("new", "old") if c in listed else ("old", "new")
        return F.when(F.col(first).isNotNull(), F.col(first)[c]).otherwise(F.col(second)[c]).alias(c)

    return one.select(BUCKET, *[F.col(c) if c in keys else pick(c) for c in columns])


def upsert_buckets(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    key: str | Sequence[str],
    update: Sequence[str] | None = None,
    *,
    buckets: int = BUCKETS,
    retain: int = 2,
    order: Sequence[Column] | None = None,
) -> str:
    """Upsert ``incoming`` into the bucketed table at ``root``, made with ``buckets`` buckets if it does not exist;
    returns the new version's path.  See ``change_buckets``."""
    keys = _keys(key)
    columns = incoming.columns

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return _merged(old, new, keys, [c for c in old.columns if c != BUCKET], set(columns if update is None else update))

    require_known(update, columns)
    return change_buckets(spark, root, _one_per_key(incoming, keys, order), keys, merge, buckets=buckets, retain=retain)


def change_buckets(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    key: str | Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    *,
    buckets: int = BUCKETS,
    retain: int = 2,
    tag: str | None = None,
) -> str:
    """The next version of the table at ``root``: in every bucket that holds an incoming key its rows become
    ``merge(old, new)``; the other buckets stay as they are.

    ``old`` and ``new`` have the table's columns and ``BUCKET``; ``merge`` returns the same, one row per key.
    ``tag`` names the change: a change whose tag the table has already seen is not applied again, so a job that
    runs twice counts once.  Keeps the newest ``retain`` committed versions and the folders they name.  Raises
    ``VersionTaken``, leaving the table as it is, if another writer got in between."""
    keys = _keys(key)
    seen = committed_versions(spark, root)
    rows = spark.read.parquet(f"{version_path(root, seen[-1])}/manifest").collect() if seen else []
    tags = json.loads(rows[0]["tags"]) if rows else []
    if tag is not None and tag in tags:
        return version_path(root, seen[-1])
    path = claim_next_version(spark, root)
    folders = _folders(rows)
    if rows:
        buckets, schema = rows[0]["buckets"], StructType.fromJson(_schema(rows))
        if keys != rows[0]["key"].split(","):
            raise ValueError(f"the table's key is {rows[0]['key']}, not {','.join(keys)}")
        # equal values of different types hash differently
        incoming = incoming.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    else:
        schema = incoming.schema

    # written once, so that its buckets and its rows come from one evaluation
    incoming.withColumn(BUCKET, bucket_of(keys, buckets)).write.parquet(f"{path}/incoming")
    new = spark.read.parquet(f"{path}/incoming")
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most ``buckets`` rows
    old = _read(spark, root, [folders[b] for b in touched if b in folders], schema) \
        .withColumn(BUCKET, bucket_of(keys, buckets))
    files = f"files/{path.rpartition('/')[2]}"
    merge(old, new).select(BUCKET, *schema.fieldNames()).write.partitionBy(BUCKET).parquet(f"{root}/{files}")

    folders.update({b: f"{files}/{BUCKET}={b}" for b in touched})
    text, applied = json.dumps(schema.jsonValue()), json.dumps(tags if tag is None else [*tags, tag])
    # a first row without a folder carries the description where there are no rows yet
    described = [(b, folders.get(b), buckets, ",".join(keys), text, applied) for b in sorted(folders) or [0]]
    spark.createDataFrame(described, "bucket int, folder string, buckets int, key string, schema string, tags string") \
        .coalesce(1).write.parquet(f"{path}/manifest")
    commit_version(spark, path, seen)
    delete(spark, f"{path}/incoming")
    _drop_old(spark, root, retain)
    return path


def _drop_old(spark: SparkSession, root: str, retain: int) -> None:
    """Delete versions beyond the newest ``retain`` and the folders that only they name."""
    versions = committed_versions(spark, root)
    if retain <= 0 or len(versions) <= retain:
        return
    kept: set[str] = set()
    for version in versions[-retain:]:
        kept.update(_folders(manifest(spark, root, version).collect()).values())
    for version in versions[:-retain]:
        for folder in _folders(manifest(spark, root, version).collect()).values():
            if folder not in kept:
                delete(spark, f"{root}/{folder}")
        delete(spark, version_path(root, version))
