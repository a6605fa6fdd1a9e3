"""Aggregates and registers that follow their input batch by batch.

Standings and season statistics are kept as sums that add up: a batch is aggregated by itself and
added to the state of the keys it touches, and a contest that is corrected is taken back (weight
-1) and entered anew (weight 1).  The averages, differences and points are worked out from the
sums when they are asked for.  The largest number of goals in a contest cannot be taken back from
a maximum, so the season state counts contests per number of goals and reads the maximum off.

The register of latest snapshots merges by the order of snapshots, not of arrival: the merge is
commutative and idempotent, so late and repeated batches leave the same register.

State lives in bucketed tables (``operators.buckets``): a batch reads and rewrites only the buckets
of its own keys.  A batch of sums carries a name and is applied once, however often its job runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.functions.casts import numeric
from layerwise.operators.buckets import BUCKET, BUCKETS, change_buckets, read_buckets
from layerwise.operators.dedup import _keys
from layerwise.operators.snapshots import latest_per_key
from layerwise.operators.standings import rank_average, two_sided

_STANDING_SUMS = ["wins", "losses", "draws", "matches_played", "goals_scored", "goals_conceded",
                  "scored_known", "conceded_known"]
_SEASON_SUMS = ["matches", "home_goals", "away_goals", "home_known", "away_known", "home_wins", "away_wins", "draws"]


def _weight(contests: DataFrame, weight: str | None) -> Column:
    return F.col(weight).cast("long") if weight else F.lit(1).cast("long")


def standings_state(
    contests: DataFrame,
    *,
    home: str = "home_team",
    away: str = "away_team",
    home_score: str = "home_score",
    away_score: str = "away_score",
    season: str = "year",
    team: str = "team",
    weight: str | None = None,
) -> DataFrame:
    """Sums per (team, season) of a batch; ``weight``: 1 to enter a contest, -1 to take it back."""
    weighed = contests.withColumn("__weight", _weight(contests, weight))
    # both sides of a contest, once per weight: the weight is part of what is grouped
    sides = two_sided(weighed.withColumn("__season", F.struct(F.col(season).alias("s"), F.col("__weight").alias("w"))),
                      home, away, home_score, away_score, "__season", team)
    w = F.col("__season.w")
    known = [F.when(F.col(c).isNotNull(), w).otherwise(0) for c in ("goals_scored", "goals_conceded")]
    return sides.groupBy(F.col(team), F.col("__season.s").alias(season)).agg(
        F.sum(F.col("win") * w).alias("wins"), F.sum(F.col("loss") * w).alias("losses"),
        F.sum(F.col("draw") * w).alias("draws"), F.sum(w).alias("matches_played"),
        F.coalesce(F.sum(F.col("goals_scored") * w), F.lit(0)).alias("goals_scored"),
        F.coalesce(F.sum(F.col("goals_conceded") * w), F.lit(0)).alias("goals_conceded"),
        F.sum(known[0]).alias("scored_known"), F.sum(known[1]).alias("conceded_known"))


def standings_of(state: DataFrame, ranks: DataFrame | None = None, *, season: str = "year", team: str = "team",
                 rank_team: str = "country", rank_season: str = "year", rank: str = "rank") -> DataFrame:
    """The table of ``standings.standings`` from its state; keys whose contests were all taken back are gone."""
    scored = F.when(F.col("scored_known") != 0, F.col("goals_scored"))
    conceded = F.when(F.col("conceded_known") != 0, F.col("goals_conceded"))
    table = state.filter("matches_played != 0").select(
        team, season, "wins", "losses", "draws", "matches_played", scored.alias("goals_scored"),
        conceded.alias("goals_conceded"), (scored - conceded).alias("goal_difference"),
        (F.col("wins") * 3 + F.col("draws")).alias("points"),
        F.try_divide("goals_scored", "scored_known").alias("avg_goals_scored"),
        F.try_divide("goals_conceded", "conceded_known").alias("avg_goals_conceded"))
    if ranks is None:
        return table
    averaged = rank_average(ranks, rank_team, rank_season, rank).select(
        F.col(rank_team).alias(team), F.col(rank_season).alias(season), "avg_rank")
    return table.join(averaged, [team, season], "left").select(*table.columns, "avg_rank")


def season_state(contests: DataFrame, *, home_score: str = "home_score", away_score: str = "away_score",
                 season: str = "year", weight: str | None = None) -> DataFrame:
    """Sums per (season, goals in the contest) of a batch; ``goals`` is NULL where a score is unknown."""
    h, a, w = numeric(contests, home_score, "int"), numeric(contests, away_score, "int"), _weight(contests, weight)

    def of(condition: Column) -> Column:
        return F.sum(F.when(condition, w).otherwise(0))

    return contests.groupBy(F.col(season), (h + a).alias("goals")).agg(
        F.sum(w).alias("matches"), F.coalesce(F.sum(h * w), F.lit(0)).alias("home_goals"),
        F.coalesce(F.sum(a * w), F.lit(0)).alias("away_goals"), of(h.isNotNull()).alias("home_known"),
        of(a.isNotNull()).alias("away_known"), of(h > a).alias("home_wins"), of(h < a).alias("away_wins"),
        of(h == a).alias("draws"))


def season_stats_of(state: DataFrame, *, season: str = "year") -> DataFrame:
    """The table of ``standings.season_stats`` from its state."""
    both = F.col("goals").isNotNull()
    return state.filter("matches != 0").groupBy(season).agg(
        F.sum("matches").alias("total_matches"),
        (F.when(F.sum("home_known") != 0, F.sum("home_goals"))
         + F.when(F.sum("away_known") != 0, F.sum("away_goals"))).alias("total_goals"),
        F.try_divide(F.sum(F.col("goals") * F.col("matches")), F.sum(F.when(both, F.col("matches")))).alias("avg_goals_per_match"),
        F.max("goals").alias("max_goals_in_match"),
        F.sum("home_wins").alias("home_wins"), F.sum("away_wins").alias("away_wins"), F.sum("draws").alias("draws"))


def _added(keys: Sequence[str]):
    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        sums = [c for c in old.columns if c not in keys and c != BUCKET]
        return old.unionByName(new).repartition(BUCKET).groupBy(BUCKET, *keys).agg(*[F.sum(c).alias(c) for c in sums])

    return merge


def add_batch(spark: SparkSession, root: str, state: DataFrame, key: Sequence[str], batch: str, *,
              buckets: int = BUCKETS) -> str:
    """Add the state of a batch to the table at ``root``; a batch of the same name is added once."""
    return change_buckets(spark, root, state, key, _added(list(key)), buckets=buckets, tag=batch)


def register_latest(
    spark: SparkSession,
    root: str,
    snapshots: DataFrame,
    key: str | Sequence[str],
    order: str = "snapshot_date",
    tie: Sequence[str] = (),
    *,
    buckets: int = BUCKETS,
) -> str:
    """Merge snapshots into the register at ``root``: one row per key, the one that ``latest_per_key`` would choose
    among all snapshots ever merged.  Batches may come late, overlap or be repeated."""
    keys = _keys(key)

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return latest_per_key(old.unionByName(new).repartition(BUCKET), [BUCKET, *keys], order, tie)

    return change_buckets(spark, root, latest_per_key(snapshots, keys, order, tie), keys, merge, buckets=buckets)


__all__ = ["add_batch", "read_buckets", "register_latest", "season_state", "season_stats_of", "standings_of",
           "standings_state"]
