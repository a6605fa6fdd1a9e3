"""Pass-through views over the aggregate tables (temporary, session-scoped)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of the two views.
TEAM_PERFORMANCE_COLUMNS = [
    "team", "year", "wins", "losses", "draws", "matches_played", "goals_scored",
    "goals_conceded", "goal_difference", "points", "avg_goals_scored", "avg_goals_conceded",
    "avg_rank",
]
TOURNAMENT_STATS_COLUMNS = [
    "year", "total_matches", "total_goals", "avg_goals_per_match", "max_goals_in_match",
    "home_wins", "away_wins", "draws",
]


def register_views(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """``v_team_performance`` and ``v_tournament_stats`` as temp views over the written tables."""
    views = {}
    for view, table, columns in (
        ("v_team_performance", "team_performance", TEAM_PERFORMANCE_COLUMNS),
        ("v_tournament_stats", "tournament_stats", TOURNAMENT_STATS_COLUMNS),
    ):
        if table in paths:
            df = spark.read.parquet(paths[table]).select(*columns)
            df.createOrReplaceTempView(view)
            views[view] = df
    return views
