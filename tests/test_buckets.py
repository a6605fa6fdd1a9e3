"""Bucketed keyed tables and the commit protocol."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from layerwise.operators import buckets, upsert
from layerwise.sources import fs


def _files(root):
    found = {}
    for folder, _, names in os.walk(f"{root}/files"):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = (os.path.getmtime(path), os.path.getsize(path))
    return found


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_only_touched_buckets_are_rewritten(spark, tmp_root):
    table = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit(1).alias("n"))
    buckets.upsert_buckets(spark, tmp_root, table, "k", buckets=16)
    before, first = _files(tmp_root), {r.bucket: r.folder for r in buckets.manifest(spark, tmp_root).collect()}
    assert len(first) == 16 and _rows(buckets.read_buckets(spark, tmp_root)) == _rows(table)

    changes = spark.createDataFrame([(3, "x", 7), (5, None, 8), (2000, "new", 9)], "k int, v string, n int")
    buckets.upsert_buckets(spark, tmp_root, changes, "k", update=["v"])
    expected = upsert.upsert(table, changes.withColumn("k", F.col("k").cast("long")), "k", update=["v"])
    assert _rows(buckets.read_buckets(spark, tmp_root).fillna("")) == _rows(expected.fillna(""))
    after, second = _files(tmp_root), {r.bucket: r.folder for r in buckets.manifest(spark, tmp_root).collect()}
    touched = {b for b in second if first[b] != second[b]}
    hit = {r[0] for r in changes.select(buckets.bucket_of(["k"], 16)).collect()} | {
        r[0] for r in changes.select(buckets.bucket_of([F.col("k").cast("long")], 16)).collect()}
    assert 1 <= len(touched) <= 3 and touched <= hit
    assert all(after[path] == stamp for path, stamp in before.items())  # every old file is still as it was


def test_reading_some_keys_reads_their_buckets(spark, tmp_root):
    table = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("part"), F.col("id").alias("v"))
    buckets.upsert_buckets(spark, tmp_root, table, ["k", "part"], buckets=8)
    found = buckets.read_buckets(spark, tmp_root, ["k", "part"], [(7, 1), (8, 1), (9, 0)])
    assert _rows(found) == [(7, 1, 7), (9, 0, 9)]
    assert len({os.path.dirname(f) for f in found.inputFiles()}) <= 3


def test_old_folders_go_with_their_versions(spark, tmp_root):
    rows = spark.createDataFrame([(i, 0) for i in range(50)], "k long, v int")
    buckets.upsert_buckets(spark, tmp_root, rows, "k", buckets=4)
    for n in (1, 2, 3):
        buckets.upsert_buckets(spark, tmp_root, spark.createDataFrame([(1, n)], "k long, v int"), "k", retain=2)
    assert upsert.committed_versions(spark, tmp_root) == [3, 4]
    named = {r.folder for v in (3, 4) for r in buckets.manifest(spark, tmp_root, v).collect()}
    kept = {os.path.relpath(os.path.dirname(p), tmp_root) for p in _files(tmp_root)}
    assert kept == named
    assert _rows(buckets.read_buckets(spark, tmp_root).filter("k < 3")) == [(0, 0), (1, 3), (2, 0)]


def test_empty_tables_and_refusals(spark, tmp_root):
    none = spark.createDataFrame([], "k long, v string")
    assert buckets.read_buckets(spark, tmp_root) is None
    buckets.upsert_buckets(spark, tmp_root, none, "k", buckets=4)
    assert buckets.read_buckets(spark, tmp_root).columns == ["k", "v"] and buckets.read_buckets(spark, tmp_root).count() == 0
    buckets.upsert_buckets(spark, tmp_root, spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), "k")
    assert _rows(buckets.read_buckets(spark, tmp_root)) == [(1, "a")]
    with pytest.raises(ValueError, match="lacks"):
        buckets.upsert_buckets(spark, tmp_root, none, "k", update=["vv"])
    with pytest.raises(ValueError, match="key"):
        buckets.upsert_buckets(spark, tmp_root, none, "v")
    with pytest.raises(Exception, match="without a key"):
        buckets.upsert_buckets(spark, tmp_root, spark.createDataFrame([(None, "a")], "k long, v string"), "k")
    assert _rows(buckets.read_buckets(spark, tmp_root)) == [(1, "a")]


def test_of_two_writers_with_one_base_one_commits(spark, tmp_root):
    def one(k):
        return spark.createDataFrame([(k, f"v{k}")], "k long, v string")

    upsert.upsert_table(spark, tmp_root, one(1), "k")
    seen = upsert.committed_versions(spark, tmp_root)
    first, second = upsert.claim_next_version(spark, tmp_root), upsert.claim_next_version(spark, tmp_root)
    for path, k in ((first, 10), (second, 20)):  # both have written before either commits
        upsert.upsert(upsert.read_current(spark, tmp_root), one(k), "k").write.parquet(f"{path}/data")
    upsert.commit_version(spark, second, seen)
    with pytest.raises(upsert.VersionTaken):
        upsert.commit_version(spark, first, seen)
    assert [r.k for r in upsert.read_current(spark, tmp_root).orderBy("k").collect()] == [1, 20]
    upsert.upsert_table(spark, tmp_root, one(10), "k")  # the refused writer starts again
    assert [r.k for r in upsert.read_current(spark, tmp_root).orderBy("k").collect()] == [1, 10, 20]


def test_commits_at_the_same_moment(spark, tmp_root):
    upsert.upsert_table(spark, tmp_root, spark.createDataFrame([(0, "v")], "k long, v string"), "k")
    seen = upsert.committed_versions(spark, tmp_root)
    paths = [upsert.claim_next_version(spark, tmp_root) for _ in range(4)]
    done = []

    def commit(path):
        try:
            upsert.commit_version(spark, path, seen)
            done.append(path)
        except upsert.VersionTaken:
            pass

    threads = [threading.Thread(target=commit, args=(p,)) for p in paths]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 1
    assert [upsert.version_path(tmp_root, v) for v in upsert.committed_versions(spark, tmp_root)[1:]] == done


def test_one_of_many_creates_a_file(spark, tmp_root):
    for content in ("", "7"):
        for i in range(20):
            made, start = [], threading.Barrier(4)

            def create(path):
                start.wait()
                made.append(fs.create_exclusively(spark, path, content))

            path = f"{tmp_root}/new{content}/{i}"
            threads = [threading.Thread(target=create, args=(path,)) for _ in range(4)]
            for t in threads:
                t.start()
            for t in threads:
                t.join()
            assert sorted(made) == [False, False, False, True]
            assert fs.read_small(spark, path) == content


def test_a_version_whose_marker_is_missing_still_counts(spark, tmp_root):
    upsert.upsert_table(spark, tmp_root, spark.createDataFrame([(1, "v")], "k long, v string"), "k")
    os.remove(f"{upsert.version_path(tmp_root, 1)}/_COMMITTED")  # its writer was lost after the commit file
    assert upsert.committed_versions(spark, tmp_root) == [1]
    upsert.upsert_table(spark, tmp_root, spark.createDataFrame([(2, "v")], "k long, v string"), "k")
    assert upsert.read_current(spark, tmp_root).count() == 2


def test_first_write_checks_updated_columns(spark, tmp_root):
    with pytest.raises(ValueError, match="lacks"):
        upsert.upsert_table(spark, tmp_root, spark.createDataFrame([(1, "v")], "k long, v string"), "k", update=["vv"])
    assert upsert.read_current(spark, tmp_root) is None
