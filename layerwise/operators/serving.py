"""Parameterised report queries over the aggregate tables.

Ordering follows the source system's rules: descending sorts put NULLs first,
ascending sorts put them last, and every LIMIT gets a unique tie-break so the
rows returned do not depend on partitioning.  A sort + limit plans as
``TakeOrderedAndProject`` (top-k per partition, then merge); full sorts run on
aggregated outputs only.  The prediction report holds a row per contest and is
returned unsorted; a limited reader orders it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.functions.casts import numeric
from layerwise.functions.dates import year_start
from layerwise.functions.text import percent_text, score_text
from layerwise.operators.snapshots import at_global_max

# Accepted LIMIT ranges (low, high, default) per report.
STANDINGS_LIMIT = (1, 1000, 100)
PREDICTIONS_LIMIT = (1, 500, 100)
TOP_TEAMS_LIMIT = (1, 50, 10)
TOP_RATINGS_DEFAULT = 15


def check_limit(limit: int, bounds: tuple[int, int, int]) -> int:
    low, high, _ = bounds
    if not isinstance(limit, int) or isinstance(limit, bool) or not low <= limit <= high:
        raise ValueError(f"limit must be an integer in [{low}, {high}], got {limit!r}")
    return limit


def search_standings(
    standings: DataFrame,
    team: str | None = None,
    season: int | None = None,
    limit: int = STANDINGS_LIMIT[2],
    *,
    team_col: str = "team",
    season_col: str = "year",
) -> DataFrame:
    """Optional filters (applied only when truthy: ``""`` and ``0`` mean no filter); the team
    filter is a case-insensitive substring match in which ``%`` and ``_`` stay wildcards.
    Newest season first, then most points."""
    check_limit(limit, STANDINGS_LIMIT)
    df = standings
    if team:
        df = df.filter(F.col(team_col).ilike(f"%{team}%"))
    if season:
        df = df.filter(F.col(season_col) == F.lit(season))
    return df.orderBy(
        F.col(season_col).desc_nulls_first(), F.col("points").desc_nulls_first(),
        F.col(team_col).asc_nulls_last(),
    ).limit(limit)


def list_seasons(stats: DataFrame, season_col: str = "year") -> DataFrame:
    return stats.orderBy(F.col(season_col).desc_nulls_first())


def list_predictions(
    predictions: DataFrame,
    limit: int = PREDICTIONS_LIMIT[2],
    *,
    date_col: str = "match_date",
    id_col: str = "match_id",
) -> DataFrame:
    """First ``limit`` predictions by date (ties by id)."""
    check_limit(limit, PREDICTIONS_LIMIT)
    return predictions.orderBy(
        F.col(date_col).asc_nulls_last(), F.col(id_col).asc_nulls_last()
    ).limit(limit)


def top_teams(
    standings: DataFrame, limit: int = TOP_TEAMS_LIMIT[2], *, team_col: str = "team"
) -> DataFrame:
    """Totals over all seasons per team, most wins first."""
    check_limit(limit, TOP_TEAMS_LIMIT)
    return (
        standings.groupBy(team_col)
        .agg(
            F.sum("wins").alias("total_wins"),
            F.sum("matches_played").alias("total_matches"),
            F.sum("goals_scored").alias("total_goals"),
        )
        .orderBy(F.col("total_wins").desc_nulls_first(), F.col(team_col).asc_nulls_last())
        .limit(limit)
    )


def season_series(stats: DataFrame, season_col: str = "year") -> DataFrame:
    """Goals per season as a (time, value) series, oldest first."""
    return stats.orderBy(F.col(season_col).asc_nulls_last()).select(
        year_start(F.col(season_col)).alias("time"), F.col("total_goals").alias("value")
    )


# --- registries ---------------------------------------------------------------

def manifest(registry: DataFrame, by: str = "table_name") -> DataFrame:
    """Landing registry, ordered by name (ascending) or by a measure (descending)."""
    order = F.col(by).asc_nulls_last() if by == "table_name" else F.col(by).desc_nulls_first()
    return registry.orderBy(order, F.col("table_name").asc_nulls_last())


def quality_log(log: DataFrame, by: str = "table_name") -> DataFrame:
    return manifest(log, by)


def ensure_nonempty(df: DataFrame, what: str = "registry") -> DataFrame:
    """Raise ``LookupError`` when ``df`` has no rows (a one-row probe, not a count)."""
    if df.isEmpty():
        raise LookupError(f"no {what} rows found")
    return df


def manifest_total(registry: DataFrame, column: str = "row_count") -> DataFrame:
    """Total rows landed; 0 (not NULL) for an empty registry."""
    return registry.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("value"))


def nonempty_tables(
    registry: DataFrame, names: Sequence[str], exclude: str = "metadata"
) -> DataFrame:
    """Registered tables among ``names`` that hold rows."""
    return registry.filter(
        (F.col("row_count") > 0)
        & (F.col("table_name") != F.lit(exclude))
        & F.col("table_name").isin(list(names))
    )


def count_tables(spark: SparkSession, database: str, exclude: Sequence[str] = ("metadata",)) -> int:
    """Tables in a catalog database, not counting ``exclude`` (a catalog call, no job)."""
    return sum(1 for t in spark.catalog.listTables(database) if t.name not in set(exclude))


def table_bytes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Bytes on storage per table, largest first.

    Sizes come from a file-system listing (O(files), no Spark job) rather than from the
    ``_metadata`` columns, which would iterate every row of the table.  One row per table."""
    from layerwise.sources.fs import size_bytes

    sizes = [(name, size_bytes(spark, path)) for name, path in paths.items()]
    return spark.createDataFrame(sizes, "table_name string, bytes long").orderBy(
        F.col("bytes").desc_nulls_first(), "table_name")


# --- ratings ------------------------------------------------------------------

def best_ratings(
    ratings: DataFrame, n: int = TOP_RATINGS_DEFAULT, *, entity: str = "country", rating: str = "rating",
) -> DataFrame:
    """Best ``n`` ratings of the rows given, such as those of one day (``sources.files.read_latest_date``)."""
    return (
        ratings.select(entity, numeric(ratings, rating).alias(rating))
        .orderBy(F.col(rating).desc_nulls_first(), F.col(entity).asc_nulls_last())
        .limit(n)
    )


def top_ratings(
    ratings: DataFrame, n: int = TOP_RATINGS_DEFAULT, *, entity: str = "country",
    rating: str = "rating", snapshot: str = "snapshot_date",
) -> DataFrame:
    """Best ``n`` ratings at the global latest snapshot."""
    return best_ratings(at_global_max(ratings, snapshot), n, entity=entity, rating=rating)


def rating_by_group(
    ratings: DataFrame, *, group: str = "confederation", rating: str = "rating",
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """Mean rating per group at the global latest snapshot, rounded to a whole number."""
    return (
        at_global_max(ratings, snapshot)
        .groupBy(group)
        .agg(F.round(F.avg(numeric(ratings, rating))).alias("avg_rating"))
        .orderBy(F.col("avg_rating").desc_nulls_first(), F.col(group).asc_nulls_last())
    )


# --- prediction reports ---------------------------------------------------------

def prediction_report(predictions: DataFrame) -> DataFrame:
    """Ratings, percentage texts and ``'x - y'`` expected score, a row per prediction in no order."""
    return predictions.select(
        "home_team", "rating_home", "away_team", "rating_away",
        percent_text("prob_home_win").alias("prob_home_win"),
        percent_text("prob_away_win").alias("prob_away_win"),
        percent_text("prob_draw").alias("prob_draw"),
        score_text("expected_goals_home", "expected_goals_away").alias("expected_score"),
        "predicted_winner",
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Number of predictions, mean draw probability as text, mean expected goals per contest."""
    return predictions.agg(
        F.count(F.lit(1)).alias("matches_simulated"),
        percent_text(F.avg("prob_draw")).alias("avg_draw_probability"),
        F.round(
            F.avg(F.col("expected_goals_home") + F.col("expected_goals_away")).try_cast("decimal(18,6)"), 2
        ).try_cast("decimal(18,2)").alias("avg_expected_goals"),
    )
