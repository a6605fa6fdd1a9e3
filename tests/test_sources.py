"""CSV / Parquet / JDBC sources and landing."""

import os

import pytest
from pyspark.sql import functions as F

from layerwise.sources import fs
from layerwise.sources.catalog import Source, land, rejects_path
from layerwise.sources.files import read_csv, read_landed, read_rejects, replace_keeping_schema, write_parquet
from layerwise.sources.jdbc import read_jdbc, write_jdbc


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_with_declared_schema_and_corrupt_rows(spark, tmp_root):
    _write(f"{tmp_root}/a.csv", "k,v\n1,10\n2,oops\n3,30\n")
    df = read_csv(spark, f"{tmp_root}/a.csv", "k int, v int", keep_corrupt=True)
    got = sorted((r.k, r.v, r._corrupt_record) for r in df.collect())
    assert got == [(1, 10, None), (2, None, "2,oops"), (3, 30, None)]
    untyped = read_csv(spark, f"{tmp_root}/a.csv")
    assert dict(untyped.dtypes) == {"k": "string", "v": "string"}


def test_land_skips_optional_and_stops_on_required(spark, tmp_root):
    _write(f"{tmp_root}/a.csv", "k,v\n1,x\n2,y\n")
    sources = [Source("a", f"{tmp_root}/a.csv"), Source("b", f"{tmp_root}/missing.csv", required=False)]
    manifest = land(spark, sources, f"{tmp_root}/raw").collect()
    assert [(m.table_name, m.source_file, m.row_count, m.schema_version) for m in manifest] == [
        ("a", "a.csv", 2, "1.0")]
    assert manifest[0].file_size_bytes > 0
    assert spark.read.parquet(f"{tmp_root}/raw/a").count() == 2
    with pytest.raises(FileNotFoundError):
        land(spark, [Source("c", f"{tmp_root}/nope.csv")], f"{tmp_root}/raw")


def test_replace_keeping_schema(spark, tmp_root):
    path = f"{tmp_root}/t"
    write_parquet(spark.createDataFrame([(1, "a")], "id long, name string"), path)
    replace_keeping_schema(spark, spark.createDataFrame([("b", 2)], "name string, id int"), path)
    df = spark.read.parquet(path)
    assert dict(df.dtypes) == {"id": "bigint", "name": "string"} and df.collect()[0].id == 2
    with pytest.raises(ValueError):
        replace_keeping_schema(spark, spark.createDataFrame([(1,)], "other int"), path)
    assert fs.exists(spark, path) and not fs.exists(spark, f"{tmp_root}/nothing")


DERBY = "jdbc:derby:memory:layerwise_test;create=true"
DERBY_PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_roundtrip_partitioned_read_and_truncate(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("grp"))
    write_jdbc(df, DERBY, "NUMBERS", DERBY_PROPS, truncate=False)
    back = read_jdbc(spark, DERBY, "NUMBERS", DERBY_PROPS, partition_column="id", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 1000
    assert back.agg(F.sum("id")).collect()[0][0] == sum(range(1000))
    write_jdbc(df.limit(10), DERBY, "NUMBERS", DERBY_PROPS, truncate=True)
    assert read_jdbc(spark, DERBY, "NUMBERS", DERBY_PROPS, small=True).count() == 10


def test_land_from_jdbc_source(spark, tmp_root):
    df = spark.range(0, 50).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    write_jdbc(df, DERBY, "LANDME", DERBY_PROPS, truncate=False)
    source = Source("landme", DERBY, fmt="jdbc",
                    options={"table": "LANDME", "properties": DERBY_PROPS, "partition_column": "id",
                             "num_partitions": 3})
    manifest = land(spark, [source], f"{tmp_root}/raw").collect()[0]
    assert (manifest.table_name, manifest.source_file, manifest.row_count) == ("landme", "LANDME", 50)
    assert spark.read.parquet(f"{tmp_root}/raw/landme").count() == 50


def test_count_tables_excludes_registry(spark):
    from layerwise.operators.serving import count_tables

    spark.range(1).createOrReplaceTempView("metadata")
    spark.range(1).createOrReplaceTempView("some_raw_table")
    names = {t.name for t in spark.catalog.listTables("default")}
    assert count_tables(spark, "default") == len(names) - 1


def test_values_that_do_not_fit_are_refused(spark, tmp_root):
    path = f"{tmp_root}/t"
    write_parquet(spark.createDataFrame([(1,)], "id int"), path)
    with pytest.raises(ValueError, match="2 rows"):
        replace_keeping_schema(spark, spark.createDataFrame([("3000000000",), ("oops",), ("7",), (None,)], "id string"), path)
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]  # the table is as it was
    os.mkdir(f"{tmp_root}/broken")
    _write(f"{tmp_root}/broken/part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        replace_keeping_schema(spark, spark.range(1), f"{tmp_root}/broken")


def test_unsplit_jdbc_reads_are_asked_for(spark):
    with pytest.raises(ValueError, match="partition_column"):
        read_jdbc(spark, DERBY, "NUMBERS", DERBY_PROPS)


def test_jdbc_split_on_dates(spark):
    days = spark.range(0, 40).selectExpr("id", "date_add(date'2026-01-01', cast(id as int)) as day",
                                         "timestamp_seconds(1767225600 + id * 3600) as at")
    write_jdbc(days, DERBY, "DAYS", DERBY_PROPS, truncate=False)
    for column in ("DAY", "AT"):
        back = read_jdbc(spark, DERBY, "DAYS", DERBY_PROPS, partition_column=column.lower(), num_partitions=4)
        assert back.rdd.getNumPartitions() == 4 and back.count() == 40


def test_land_keeping_schema(spark, tmp_root):
    _write(f"{tmp_root}/r.csv", "country,rating\nA,1500\n")
    land(spark, [Source("r", f"{tmp_root}/r.csv", "country string, rating long")], f"{tmp_root}/raw")
    _write(f"{tmp_root}/r.csv", "rating,country\n1600,B\n1700,C\n")
    manifest = land(spark, [Source("r", f"{tmp_root}/r.csv", keep_schema=True)], f"{tmp_root}/raw").collect()
    landed = spark.read.parquet(f"{tmp_root}/raw/r")
    assert manifest[0].row_count == 2 and landed.columns == ["country", "rating"]
    assert dict(landed.dtypes)["rating"] == "bigint" and landed.count() == 2


def test_land_parquet_source(spark, tmp_root):
    spark.range(5).write.parquet(f"{tmp_root}/src.parquet")
    manifest = land(spark, [Source("nums", f"{tmp_root}/src.parquet", fmt="parquet")], f"{tmp_root}/raw").collect()
    assert (manifest[0].row_count, manifest[0].source_file) == (5, "src.parquet")
    assert spark.read.parquet(f"{tmp_root}/raw/nums").count() == 5


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_root):
    _write(f"{tmp_root}/a.csv", "a,b\n1,x\noops,y\n3000000000,z\n4,w,extra\n5\n6,v\n")
    out = f"{tmp_root}/raw"
    manifest = land(spark, [Source("a", f"{tmp_root}/a.csv", "a int, b string")], out).collect()[0]
    assert (manifest.row_count, manifest.rejected_count) == (2, 4)
    landed = read_landed(spark, f"{out}/a")
    assert sorted(tuple(r) for r in landed.collect()) == [(1, "x"), (6, "v")]
    bad = read_rejects(spark, rejects_path(out, "a"))
    assert sorted(r.line for r in bad.collect()) == ["3000000000,z", "4,w,extra", "5", "oops,y"]
    _write(f"{tmp_root}/a.csv", "a,b\n7,t\n")  # landed again: table and rejects are replaced
    manifest = land(spark, [Source("a", f"{tmp_root}/a.csv", "a int, b string")], out).collect()[0]
    assert (manifest.row_count, manifest.rejected_count) == (1, 0)
    assert read_rejects(spark, rejects_path(out, "a")).count() == 0 and read_landed(spark, f"{out}/a").count() == 1
    assert sorted(os.listdir(out)) == ["_rejects", "a"]


def test_all_or_no_lines_fit(spark, tmp_root):
    _write(f"{tmp_root}/a.csv", "a,b\nx,1\ny,2\n")
    _write(f"{tmp_root}/b.csv", "a,b\n")
    out = f"{tmp_root}/raw"
    sources = [Source(n, f"{tmp_root}/{n}.csv", "a int, b string") for n in ("a", "b")]
    assert [(m.row_count, m.rejected_count) for m in land(spark, sources, out).orderBy("table_name").collect()] == [(0, 2), (0, 0)]
    assert read_landed(spark, f"{out}/a").columns == ["a", "b"]


def test_rejects_of_a_table_that_keeps_its_schema(spark, tmp_root):
    source = Source("r", f"{tmp_root}/r.csv", "country string, rating int", keep_schema=True)
    write_parquet(spark.createDataFrame([("old", 1)], "country string, rating long"), f"{tmp_root}/raw/r")
    _write(f"{tmp_root}/r.csv", "country,rating\nA,1500\nB,many\n")
    manifest = land(spark, [source], f"{tmp_root}/raw").collect()[0]
    assert (manifest.row_count, manifest.rejected_count) == (1, 1)
    landed = spark.read.parquet(f"{tmp_root}/raw/r")
    assert [tuple(r) for r in landed.collect()] == [("A", 1500)] and dict(landed.dtypes)["rating"] == "bigint"


def test_ranges_of_equal_depth(spark):
    # a skewed key: half of the rows in a hundredth of its width, one value with a tenth of them, some without any
    df = spark.range(0, 2000).select(F.expr(
        "case when id % 20 = 0 then null when id % 10 = 1 then 77 when id % 2 = 0 then id % 100 else id * id end").alias("K"),
        F.col("id").alias("ID"))
    write_jdbc(df, DERBY, "SKEWED", DERBY_PROPS, truncate=False)
    back = read_jdbc(spark, DERBY, "SKEWED", DERBY_PROPS, partition_column="K", num_partitions=8, ranges="depth")
    sizes = back.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("K").alias("k")).collect()
    known = [r.n for r in sizes if r.k]
    assert sorted(r.ID for r in back.collect()) == list(range(2000))
    assert [r.n for r in sizes if not r.k] == [100] and max(known) < 2 * sum(known) / 8
    equal = read_jdbc(spark, DERBY, "SKEWED", DERBY_PROPS, partition_column="K", num_partitions=8)
    assert equal.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] > 2 * 2000 / 8  # equal widths do not


def test_ranges_of_equal_depth_on_dates_names_and_nothing(spark):
    df = spark.range(0, 90).selectExpr("date_add(date'2026-01-01', cast(id % 30 as int)) as D", "concat('o''n', id) as N", "id as ID")
    write_jdbc(df, DERBY, "MIXED", {**DERBY_PROPS, "createTableColumnTypes": "N VARCHAR(20)"}, truncate=False)
    for column in ("D", "N"):
        back = read_jdbc(spark, DERBY, "MIXED", DERBY_PROPS, partition_column=column, num_partitions=3, ranges="depth")
        assert back.rdd.getNumPartitions() == 3 and sorted(r.ID for r in back.collect()) == list(range(90))
    write_jdbc(df.limit(0), DERBY, "NOTHING", DERBY_PROPS, truncate=False)
    none = read_jdbc(spark, DERBY, "NOTHING", DERBY_PROPS, partition_column="ID", num_partitions=3, ranges="depth")
    assert none.count() == 0
    with pytest.raises(ValueError):
        read_jdbc(spark, DERBY, "NOTHING", DERBY_PROPS, partition_column="ID", ranges="height")


def test_latest_day_is_found_without_reading_rows(spark, tmp_root):
    from layerwise.operators.snapshots import at_global_max
    from layerwise.sources.files import read_latest_date, write_by_date

    rows = spark.createDataFrame([("a", "2026-01-02", 1), ("b", "2026-03-01", 2), ("c", "2026-03-01", 3), ("d", "n/a", 4),
                                  ("e", None, 5)], "k string, snapshot_date string, v int")
    write_by_date(rows, f"{tmp_root}/r")
    latest = read_latest_date(spark, f"{tmp_root}/r")
    assert sorted(r.k for r in latest.collect()) == sorted(r.k for r in at_global_max(rows).collect()) == ["b", "c"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert spark.read.parquet(f"{tmp_root}/r").count() == 5  # rows without a day are kept
    write_by_date(rows.filter("k = 'd'"), f"{tmp_root}/n")
    assert read_latest_date(spark, f"{tmp_root}/n").count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_root):
    from layerwise.operators.standings import rank_average, standings
    from layerwise.sources.files import write_bucketed

    contests = spark.createDataFrame([("a", "b", 2018, 1, 0), ("b", "a", 2022, 2, 2)],
                                     "home_team string, away_team string, year int, home_score int, away_score int")
    ranks = spark.createDataFrame([("a", 2018, 3), ("b", 2022, 1)], "team string, year int, rank int")
    write_bucketed(standings(contests), "bucketed_standings", f"{tmp_root}/s", ["team", "year"], 4)
    write_bucketed(rank_average(ranks, "team"), "bucketed_ranks", f"{tmp_root}/r", ["team", "year"], 4)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_standings").join(spark.table("bucketed_ranks"), ["team", "year"], "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        again = joined.groupBy("team", "year").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in again
        assert sorted((r.team, r.year, r.avg_rank) for r in joined.collect()) == [
            ("a", 2018, 3.0), ("a", 2022, None), ("b", 2018, None), ("b", 2022, 1.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.sql("DROP TABLE bucketed_standings")
        spark.sql("DROP TABLE bucketed_ranks")
