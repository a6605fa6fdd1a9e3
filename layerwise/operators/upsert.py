"""Keyed upsert (INSERT … ON CONFLICT (key) DO UPDATE SET <listed columns>).

Columns listed in ``update`` take the incoming value whenever an incoming row
exists for the key — an incoming NULL overwrites.  Unlisted columns keep the
current value when a current row exists and take the incoming one for new keys.
One full join on the key, which reads the incoming rows once.

The result has one row per key.  Of several incoming rows of a key the first by
``order`` counts (default: by all other columns, ascending, NULLs last).  An
incoming row without a key, and an update column that does not exist, are
refused.

Parquet has no MERGE, so ``upsert_table`` writes the result as a new version
next to the current one.  A writer claims a number by creating a file that must
not exist yet, and commits by exclusively creating the one file that is named
after the version it started from.  Of two writers with the same base one
commits and the other is refused, whatever the order of their steps; readers
follow the commit files.  The path being read is never overwritten, and a job
lost half-way leaves the previous version intact.  ``operators.buckets`` keeps
large tables by the same commits, rewriting only buckets with incoming keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.operators.dedup import _keys, dedup
from layerwise.sources.fs import create_exclusively, delete, hadoop_path, read_small

_OLD, _NEW = "__upsert_old", "__upsert_new"


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    update: Sequence[str] | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    keys = _keys(key)
    columns = current.columns
    require_known(update, columns)
    incoming = _one_per_key(incoming.select(*columns), keys, order)
    listed = set(columns if update is None else update)
    old = current.select(*keys, *[F.col(c).alias(f"o_{c}") for c in columns if c not in keys],
                         F.lit(True).alias(_OLD))
    new = incoming.select(*keys, *[F.col(c).alias(f"n_{c}") for c in columns if c not in keys],
                          F.lit(True).alias(_NEW))
    merged = old.join(new, on=keys, how="full")
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c in listed:
            out.append(F.when(F.col(_NEW).isNotNull(), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            out.append(F.when(F.col(_OLD).isNotNull(), F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c))
    return merged.select(*out)


def require_known(update: Sequence[str] | None, columns: Sequence[str]) -> None:
    unknown = sorted(set(update or ()) - set(columns))
    if unknown:
        raise ValueError(f"update names columns that the table lacks: {unknown}")


def _one_per_key(incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    """One incoming row per key; a row with a NULL in its key raises."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    checked = incoming.withColumn(keys[0], F.when(
        missing, F.raise_error(F.lit(f"incoming row without a key ({', '.join(keys)})"))
        .cast(incoming.schema[keys[0]].dataType)).otherwise(F.col(keys[0])))
    return dedup(checked, keys, order)


# --- versioned tables -------------------------------------------------------

_VERSION_PREFIX = "version="
_CLAIM, _COMMITTED = "_CLAIMED", "_COMMITTED"
_COMMITS = "_commits"


class VersionTaken(RuntimeError):
    """Another writer has claimed or committed the version that this one was about to write."""


def version_path(root: str, number: int) -> str:
    return f"{root}/{_VERSION_PREFIX}{number:08d}"


def _commit_file(root: str, base: int) -> str:
    return f"{root}/{_COMMITS}/after={base:08d}"


def _successor(spark: SparkSession, root: str, base: int) -> int | None:
    """The version that was committed on top of ``base``; None while there is none."""
    text = read_small(spark, _commit_file(root, base))
    return int(text) if text else None


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions under ``root`` whose write committed, ascending.

    Folders carry a marker, set after the commit file; a version whose writer was lost in between is
    found through the commit file of the one before it."""
    versions = _versions(spark, root, _COMMITTED)
    while (following := _successor(spark, root, versions[-1] if versions else 0)) is not None:
        versions.append(following)
    return versions


def _versions(spark: SparkSession, root: str, marker: str) -> list[int]:
    fs, jroot = hadoop_path(spark, root)
    if not fs.exists(jroot):
        return []
    versions = []
    for status in fs.listStatus(jroot):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(_VERSION_PREFIX):
            if fs.exists(status.getPath().suffix(f"/{marker}")):
                versions.append(int(name[len(_VERSION_PREFIX):]))
    return sorted(versions)


def current_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest committed version."""
    versions = committed_versions(spark, root)
    return version_path(root, versions[-1]) if versions else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    versions = committed_versions(spark, root)
    if not versions:
        return None
    return spark.read.parquet(f"{version_path(root, versions[-1])}/data")


def claim_next_version(spark: SparkSession, root: str) -> str:
    """The folder of the version after the newest claimed one; raises ``VersionTaken`` if a concurrent
    writer gets it first.  An abandoned claim only leaves a gap in the numbers."""
    claimed = _versions(spark, root, _CLAIM)
    path = version_path(root, claimed[-1] + 1 if claimed else 1)
    if not create_exclusively(spark, f"{path}/{_CLAIM}"):
        raise VersionTaken(path)
    return path


def commit_version(spark: SparkSession, path: str, seen: Sequence[int]) -> None:
    """Commit a written version on top of the newest of those ``seen`` when its rows were read; raises
    ``VersionTaken`` if another one has been committed there: its rows would be lost."""
    root, _, name = path.rpartition("/")
    base = seen[-1] if seen else 0
    commit = _commit_file(root, base)
    if not create_exclusively(spark, commit, str(int(name[len(_VERSION_PREFIX):]))):
        left = "" if _successor(spark, root, base) else f" (its writer was lost while it wrote {commit}; delete that file)"
        raise VersionTaken(f"another version of {root} was committed while {path} was written{left}")
    create_exclusively(spark, f"{path}/{_COMMITTED}")


def write_version(df: DataFrame, path: str, seen: Sequence[int]) -> None:
    """Write a claimed version and commit it, see ``commit_version``."""
    df.write.parquet(f"{path}/data")
    commit_version(df.sparkSession, path, seen)


def upsert_table(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    key: str | Sequence[str],
    update: Sequence[str] | None = None,
    retain: int = 2,
    order: Sequence[Column] | None = None,
) -> str:
    """Upsert ``incoming`` into the versioned Parquet table at ``root``; returns the new
    version's path.  Keeps the newest ``retain`` committed versions.

    Raises ``VersionTaken``, leaving the table as it is, if another writer got in between."""
    seen = committed_versions(spark, root)
    path = claim_next_version(spark, root)
    require_known(update, incoming.columns)
    merged = upsert(spark.read.parquet(f"{version_path(root, seen[-1])}/data"), incoming, key, update, order) \
        if seen else _one_per_key(incoming, _keys(key), order)
    write_version(merged, path, seen)
    versions = committed_versions(spark, root)
    for old in versions[:-retain] if retain > 0 else []:
        delete(spark, version_path(root, old))
    return path
