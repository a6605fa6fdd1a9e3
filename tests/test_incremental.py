"""Batch-wise state against the aggregates over everything."""

import random

import pytest
from pyspark.sql import functions as F

from layerwise.operators import buckets, incremental, standings
from layerwise.operators.snapshots import latest_per_key

CONTEST = "home_team string, away_team string, year int, home_score int, away_score int"
TEAMS = ["a", "b", "c", None]


def _contests(n, seed):
    rng = random.Random(seed)
    return [(rng.choice(TEAMS), rng.choice(TEAMS), rng.choice([2018, 2022, None]),
             rng.choice([None, 0, 1, 2, 5]), rng.choice([None, 0, 1, 3])) for _ in range(n)]


def _rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_batches_add_up(spark, tmp_root):
    rows = _contests(300, 1)
    ranks = spark.createDataFrame([("a", 2018, 3), ("a", 2018, 4), ("b", 2022, 1)], "country string, year int, rank int")
    for i in range(3):
        batch = spark.createDataFrame(rows[i::3], CONTEST)
        for _ in range(2):  # a job that runs twice counts once
            incremental.add_batch(spark, f"{tmp_root}/teams", incremental.standings_state(batch), ["team", "year"],
                                  f"batch {i}", buckets=4)
            incremental.add_batch(spark, f"{tmp_root}/seasons", incremental.season_state(batch), ["year", "goals"],
                                  f"batch {i}", buckets=4)
    whole = spark.createDataFrame(rows, CONTEST)
    got = incremental.standings_of(buckets.read_buckets(spark, f"{tmp_root}/teams"), ranks)
    assert _rows(got) == _rows(standings.standings(whole, ranks))
    assert got.columns == standings.standings(whole, ranks).columns
    seasons = incremental.season_stats_of(buckets.read_buckets(spark, f"{tmp_root}/seasons"))
    assert _rows(seasons) == _rows(standings.season_stats(whole))


def test_corrections_take_back_what_was_entered(spark, tmp_root):
    first = [("a", "b", 2018, 9, 0), ("a", "c", 2018, 1, 1), ("d", "a", 2022, 2, 0)]
    entered = spark.createDataFrame(first, CONTEST)
    fixed = spark.createDataFrame([(*first[0], -1), ("a", "b", 2018, 1, 2, 1), (*first[2], -1)], CONTEST + ", sign int")
    for name, state in (("entered", entered), ("fixed", fixed)):
        weight = "sign" if "sign" in state.columns else None
        incremental.add_batch(spark, f"{tmp_root}/t", incremental.standings_state(state, weight=weight),
                              ["team", "year"], name, buckets=2)
        incremental.add_batch(spark, f"{tmp_root}/s", incremental.season_state(state, weight=weight),
                              ["year", "goals"], name, buckets=2)
    right = spark.createDataFrame([("a", "b", 2018, 1, 2), first[1]], CONTEST)
    assert _rows(incremental.standings_of(buckets.read_buckets(spark, f"{tmp_root}/t"))) == _rows(standings.standings(right))
    # the most goals in a contest fall back with the contest that had them
    assert _rows(incremental.season_stats_of(buckets.read_buckets(spark, f"{tmp_root}/s"))) == _rows(
        standings.season_stats(right))


def test_a_batch_leaves_other_buckets_alone(spark, tmp_root):
    many = spark.range(200).selectExpr("concat('t', id) as team", "2000 as year", "id as wins")
    incremental.add_batch(spark, tmp_root, many, ["team", "year"], "all", buckets=16)
    before = {r.bucket: r.folder for r in buckets.manifest(spark, tmp_root).collect()}
    incremental.add_batch(spark, tmp_root, many.limit(1), ["team", "year"], "one")
    after = {r.bucket: r.folder for r in buckets.manifest(spark, tmp_root).collect()}
    assert sum(before[b] != after[b] for b in after) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_register_does_not_depend_on_the_order_of_batches(spark, tmp_root, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(30), rng.choice(["2026-01-01", "2026-02-01", "2026-03-01", "n/a", None]), rng.randrange(5))
            for _ in range(200)]
    batches = [rows[i::4] for i in range(4)]
    rng.shuffle(batches)
    for batch in [*batches, batches[0]]:  # late, out of order, and one of them twice
        incremental.register_latest(spark, tmp_root, spark.createDataFrame(batch, "k int, snapshot_date string, v int"),
                                    "k", buckets=4)
    whole = spark.createDataFrame(rows, "k int, snapshot_date string, v int")
    assert _rows(buckets.read_buckets(spark, tmp_root)) == _rows(latest_per_key(whole, "k"))


def test_no_rows_yet(spark, tmp_root):
    none = spark.createDataFrame([], CONTEST)
    incremental.add_batch(spark, tmp_root, incremental.standings_state(none), ["team", "year"], "none", buckets=4)
    assert incremental.standings_of(buckets.read_buckets(spark, tmp_root)).count() == 0
    assert incremental.season_stats_of(incremental.season_state(none)).count() == 0
