"""File-system checks through Hadoop's FileSystem API, so they work on any storage the
cluster is configured for (HDFS, object stores), not only on the driver's local disk."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return bool(fs.exists(jpath))


def size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (a file or a directory tree)."""
    fs, jpath = hadoop_path(spark, path)
    return int(fs.getContentSummary(jpath).getLength())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it is missing."""
    fs, jpath = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``name, bytes, modified`` of every file under ``path`` (a file or a tree), ascending."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    found, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), int(status.getLen()), int(status.getModificationTime())))
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def create_exclusively(spark: SparkSession, path: str, content: str = "") -> bool:
    """Create a file that must not exist yet; False if it does."""
    fs, jpath = hadoop_path(spark, path)
    if fs.getUri().getScheme() == "file":  # where Hadoop looks first and creates then, so that two writers may succeed
        local = fs.makeQualified(jpath).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as out:
                out.write(content)
        except FileExistsError:
            return False
        return True
    if not content:
        return bool(fs.createNewFile(jpath))
    if fs.exists(jpath):
        return False
    try:
        out = fs.create(jpath, False)
    except Exception:
        if fs.exists(jpath):
            return False  # another writer was faster
        raise
    out.writeBytes(content)
    out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file; None if it is missing."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; what is at ``target`` is replaced."""
    fs, jsource = hadoop_path(spark, source)
    _, jtarget = hadoop_path(spark, target)
    fs.delete(jtarget, True)
    fs.mkdirs(jtarget.getParent())
    if not fs.rename(jsource, jtarget):
        raise OSError(f"{source} could not be renamed to {target}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``; where that is unset, which only a
    local master may leave so, under a temporary folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="layerwise-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
