"""Two-sided standings and per-season statistics.

Each contest is seen once from each side.  Instead of selecting the table twice
and unioning (which Catalyst does not merge: two scans and two upstream joins),
every row is expanded in place with ``inline(array(struct, struct))``; partial
aggregation then shrinks the doubled stream to teams × seasons per task before
the shuffle, so even a team that plays a third of all contests costs one row
per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.functions.casts import numeric


def _flag(cond: Column) -> Column:
    # NULL scores compare as unknown and count as 0, like CASE WHEN … ELSE 0.
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def two_sided(
    contests: DataFrame,
    home: str = "home_team",
    away: str = "away_team",
    home_score: str = "home_score",
    away_score: str = "away_score",
    season: str = "year",
    team: str = "team",
) -> DataFrame:
    """(team, season, goals_scored, goals_conceded, win, loss, draw): two rows per contest."""

    def side(me: str, mine: str, theirs: str) -> Column:
        return F.struct(
            F.col(me).alias(team),
            F.col(mine).alias("goals_scored"),
            F.col(theirs).alias("goals_conceded"),
        )

    contests = contests.select(
        F.col(season), F.col(home), F.col(away),
        numeric(contests, home_score, "int").alias(home_score),
        numeric(contests, away_score, "int").alias(away_score),
    )
    sides = contests.select(
        F.col(season),
        F.inline(F.array(side(home, home_score, away_score), side(away, away_score, home_score))),
    )
    gs, gc = F.col("goals_scored"), F.col("goals_conceded")
    return sides.select(
        team,
        season,
        "goals_scored",
        "goals_conceded",
        _flag(gs > gc).alias("win"),
        _flag(gs < gc).alias("loss"),
        _flag(gs == gc).alias("draw"),
    )


def rank_average(
    ranks: DataFrame, team: str = "country", season: str = "year", rank: str = "rank"
) -> DataFrame:
    """Mean rank per (team, season)."""
    return ranks.groupBy(team, season).agg(F.avg(numeric(ranks, rank)).alias("avg_rank"))


def standings(
    contests: DataFrame,
    ranks: DataFrame | None = None,
    *,
    home: str = "home_team",
    away: str = "away_team",
    home_score: str = "home_score",
    away_score: str = "away_score",
    season: str = "year",
    team: str = "team",
    rank_team: str = "country",
    rank_season: str = "year",
    rank: str = "rank",
) -> DataFrame:
    """Wins, losses, draws, goals, averages, difference and points (3·W + D) per (team, season),
    with the season's mean rank when ``ranks`` is given (left join: NULL when absent)."""
    per_side = two_sided(contests, home, away, home_score, away_score, season, team)
    table = (
        per_side.groupBy(team, season)
        .agg(
            F.sum("win").alias("wins"),
            F.sum("loss").alias("losses"),
            F.sum("draw").alias("draws"),
            F.count(F.lit(1)).alias("matches_played"),
            F.sum("goals_scored").alias("goals_scored"),
            F.sum("goals_conceded").alias("goals_conceded"),
            F.avg("goals_scored").alias("avg_goals_scored"),
            F.avg("goals_conceded").alias("avg_goals_conceded"),
        )
        .withColumn("goal_difference", F.col("goals_scored") - F.col("goals_conceded"))
        .withColumn("points", F.col("wins") * F.lit(3) + F.col("draws"))
    )
    columns = [
        team, season, "wins", "losses", "draws", "matches_played", "goals_scored",
        "goals_conceded", "goal_difference", "points", "avg_goals_scored", "avg_goals_conceded",
    ]
    if ranks is None:
        return table.select(*columns)
    averaged = rank_average(ranks, rank_team, rank_season, rank).select(
        F.col(rank_team).alias(team), F.col(rank_season).alias(season), "avg_rank"
    )
    return table.join(averaged, on=[team, season], how="left").select(*columns, "avg_rank")


def season_stats(
    contests: DataFrame,
    home_score: str = "home_score",
    away_score: str = "away_score",
    season: str = "year",
) -> DataFrame:
    """Per season: contests, goals (sum(h) + sum(a), so a NULL on one side does not hide the
    other), mean and max goals per contest, home wins, away wins and draws."""
    h, a = numeric(contests, home_score, "int"), numeric(contests, away_score, "int")
    return contests.groupBy(season).agg(
        F.count(F.lit(1)).alias("total_matches"),
        (F.sum(h) + F.sum(a)).alias("total_goals"),
        F.avg(h + a).alias("avg_goals_per_match"),
        F.max(h + a).alias("max_goals_in_match"),
        F.sum(_flag(h > a)).alias("home_wins"),
        F.sum(_flag(h < a)).alias("away_wins"),
        F.sum(_flag(h == a)).alias("draws"),
    )
