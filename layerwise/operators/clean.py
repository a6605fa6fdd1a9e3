"""Cleaning of raw tables into the typed, de-duplicated layer.

Raw tables drift: a column may come under one of several names, numbers may be
text, dates may be malformed.  Every conversion is tolerant (malformed → NULL,
never an error) and every table is de-duplicated on its key with a repeatable
choice of row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.functions.casts import parse_date, truncating_int
from layerwise.functions.defaults import (
    TO_BE_DECIDED,
    UNKNOWN,
    default_cast_first,
    default_coalesce_first,
    unknown_if_null,
)
from layerwise.functions.names import first_existing
from layerwise.functions.text import after_first_comma, first_part, natural_key
from layerwise.operators.dedup import dedup

# Accepted alternative names of raw columns, in order of preference.
NAME_COLUMNS = ("team", "country")
CONTEST_DATE_COLUMNS = ("Date", "match_date")
CONTEST_YEAR_COLUMNS = ("Year", "year")
CONTEST_STAGE_COLUMNS = ("Round", "stage")
CONTEST_ATTENDANCE_COLUMNS = ("Attendance", "attendance")
CONTEST_VENUE_COLUMNS = ("Venue", "stadium")
DATE_FORMAT = "yyyy-MM-dd"
CONTEST_REQUIRED = ("home_team", "away_team", "home_score", "away_score")

# Columns and keys of the cleaned tables.
RANKING_COLUMNS = ["rank", "country", "points", "year"]
RANKING_KEY = ["country", "year"]
HISTORY_KEY = "year"
SCHEDULE_KEY = "match_id"
CONTEST_KEY = "match_id"
HISTORY_COLUMNS = [
    "year", "host_country", "winner", "runner_up", "third_place", "fourth_place",
    "goals_scored", "matches_played",
]
SCHEDULE_COLUMNS = [
    "match_id", "match_date", "stage", "group_name", "home_team", "away_team", "stadium", "city",
]
CONTEST_COLUMNS = [
    "match_id", "year", "match_date", "stage", "group_name", "home_team", "away_team",
    "home_score", "away_score", "stadium", "city", "attendance",
]


INVALID = "__invalid"
REJECT = "__reject"

# The columns by which rows of one key can differ: what is in the key or constant says nothing.
CHOICE = {
    "rankings": ["rank", "points"],
    "history": ["host_country", "winner", "runner_up", "matches_played"],
    "schedule": ["stage"],
    "contests": ["year", "stage", "home_score", "away_score", "stadium", "city", "attendance"],
}


def _invalid(*checks: tuple[Column, Column]) -> Column:
    """Flag: some raw value is present but its parsed value is NULL."""
    flags = [raw.isNotNull() & parsed.isNull() for raw, parsed in checks]
    return reduce(lambda a, b: a | b, flags, F.lit(False)).alias(INVALID)


def _reject(**parts: Column) -> Column:
    """Names of the key parts that are missing or did not parse, comma-joined; empty if the key is whole."""
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in parts.items()]).alias(REJECT)


def keep_one(rows: DataFrame, key: str | Sequence[str], choice: Sequence[str]) -> DataFrame:
    """De-duplicate typed rows on ``key``.  Rows with a value that did not parse come last; the kept
    row is then the first by the ``choice`` columns (ascending, NULLs last)."""
    keys = [key] if isinstance(key, str) else list(key)
    return dedup(rows, keys, order=[F.col(INVALID).asc(), *[F.col(c).asc_nulls_last() for c in choice]])


def rejects(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row with a missing or unparsed key part, and which (``reason``).

    The cleaned table keeps one row per key text, so such rows may stand for one another there;
    here each of them is listed."""
    return rows.filter(F.col(REJECT) != "").select(*columns, F.col(REJECT).alias("reason"))


def routed(rows: DataFrame, key: str | Sequence[str], choice: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Cleaned rows and rejected ones apart: ``columns`` and ``reason``, which is NULL for a kept row.

    Rows without a whole key are taken out before the de-duplication: they go straight to the result, each of
    them, and are never merged with one another by the text of their key or gathered under it."""
    kept = keep_one(rows.filter(F.col(REJECT) == ""), key, choice).select(
        *columns, F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(rejects(rows, columns))


def routing_record(rows: DataFrame, key: str | Sequence[str], table_name: str) -> DataFrame:
    """One row: ``rows_in`` and what became of them, kept_records, duplicate_count and rejected_records, which
    add up to it, and invalid_records.  One hash aggregate per key, which rejected rows share as one."""
    keys = [key] if isinstance(key, str) else list(key)
    whole = F.col(REJECT) == ""
    by_key = rows.groupBy(whole.alias("whole"), *[F.when(whole, F.col(k)).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(INVALID)).alias("bad"))
    none = F.lit(0).cast("long")
    return by_key.agg(
        F.coalesce(F.sum("n"), none).alias("rows_in"), F.count_if("whole").alias("kept_records"),
        F.coalesce(F.sum(F.when(F.col("whole"), F.col("n") - 1)), none).alias("duplicate_count"),
        F.coalesce(F.sum(F.when(~F.col("whole"), F.col("n"))), none).alias("rejected_records"),
        F.coalesce(F.sum("bad"), none).alias("invalid_records"),
    ).withColumn("table_name", F.lit(table_name))


def require_key(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} source lacks required columns {missing}")


def _optional(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First existing alternative, or a NULL text column when the source has none of them."""
    present = [c for c in candidates if c in df.columns]
    return F.col(present[0]) if present else F.lit(None).cast("string")


def standardise_rankings(vintage: DataFrame, year: int) -> DataFrame:
    """One ranking vintage: integer rank, points truncated to int, trimmed name, year tag."""
    name = first_existing(vintage, NAME_COLUMNS)
    rank = truncating_int("rank")
    points = truncating_int("points")
    return vintage.select(
        rank.alias("rank"),
        F.trim(F.col(name)).alias("country"),
        points.alias("points"),
        F.lit(year).cast("int").alias("year"),
        _invalid((F.col("rank"), rank), (F.col("points"), points)),
        _reject(country=F.coalesce(F.trim(F.col(name)) == "", F.lit(True))),
    )


def ranking_rows(vintages: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    frames = [standardise_rankings(df, year) for df, year in vintages]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def clean_rankings(vintages: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """Union of standardised vintages (by column name), one row per (country, year)."""
    return keep_one(ranking_rows(vintages), RANKING_KEY, CHOICE["rankings"]).select(*RANKING_COLUMNS)


def history_rows(
    history: DataFrame,
    *,
    year: str = "Year",
    host: str = "Host",
    winner: str = "Champion",
    runner_up: str = "Runner-Up",
    matches: str = "Matches",
) -> DataFrame:
    require_key(history, [year], "history")
    matches_col = _optional(history, [matches])
    year_int = truncating_int(year)
    matches_int = truncating_int(matches_col)
    return history.select(
        year_int.alias("year"),
        unknown_if_null(_optional(history, [host])).alias("host_country"),
        unknown_if_null(_optional(history, [winner])).alias("winner"),
        unknown_if_null(_optional(history, [runner_up])).alias("runner_up"),
        F.lit(None).cast("string").alias("third_place"),
        F.lit(None).cast("string").alias("fourth_place"),
        F.lit(None).cast("int").alias("goals_scored"),
        default_cast_first(matches_col, "int", 0).alias("matches_played"),
        _invalid((F.col(year), year_int), (matches_col, matches_int)),
        _reject(year=year_int.isNull()),
    )


def clean_history(history: DataFrame, **names: str) -> DataFrame:
    """Season history: unknown labels become ``'Unknown'``, columns the source lacks are
    typed NULLs, matches default to 0 (malformed included), one row per year."""
    return keep_one(history_rows(history, **names), HISTORY_KEY, CHOICE["history"]).select(*HISTORY_COLUMNS)


def schedule_rows(
    schedule: DataFrame,
    *,
    date: str = "Date",
    stage: str = "Round",
    home: str = "home_team",
    away: str = "away_team",
) -> DataFrame:
    require_key(schedule, [date, home, away], "schedule")
    match_date = parse_date(date, DATE_FORMAT)
    return schedule.select(
        natural_key(date, home, away).alias("match_id"),
        match_date.alias("match_date"),
        unknown_if_null(_optional(schedule, [stage])).alias("stage"),
        F.lit(TO_BE_DECIDED).alias("group_name"),
        F.col(home).alias("home_team"),
        F.col(away).alias("away_team"),
        F.lit(TO_BE_DECIDED).alias("stadium"),
        F.lit(TO_BE_DECIDED).alias("city"),
        _invalid((F.col(date), match_date)),
        _reject(date=match_date.isNull(), home_team=F.col(home).isNull(), away_team=F.col(away).isNull()),
    )


def clean_schedule(schedule: DataFrame, **names: str) -> DataFrame:
    """Fixture list: parsed date, stage default, placeholders for unknown venue and group,
    key ``date_home_away`` built from the raw text, one row per key."""
    return keep_one(schedule_rows(schedule, **names), SCHEDULE_KEY, CHOICE["schedule"]).select(*SCHEDULE_COLUMNS)


def contest_rows(contests: DataFrame) -> DataFrame:
    require_key(contests, list(CONTEST_REQUIRED), "contest")
    for alternatives in (CONTEST_DATE_COLUMNS, CONTEST_YEAR_COLUMNS):
        if not any(a in contests.columns for a in alternatives):
            raise ValueError(f"contest source lacks required columns {[alternatives[0]]}")
    date = first_existing(contests, CONTEST_DATE_COLUMNS)
    year = first_existing(contests, CONTEST_YEAR_COLUMNS)
    stage = _optional(contests, CONTEST_STAGE_COLUMNS)
    attendance = _optional(contests, CONTEST_ATTENDANCE_COLUMNS)
    venue = _optional(contests, CONTEST_VENUE_COLUMNS)
    home = unknown_if_null("home_team")
    away = unknown_if_null("away_team")
    year_int = truncating_int(year)
    match_date = parse_date(date, DATE_FORMAT)
    return contests.select(
        natural_key(F.col(date), home, away).alias("match_id"),
        year_int.alias("year"),
        match_date.alias("match_date"),
        unknown_if_null(stage).alias("stage"),
        F.lit(None).cast("string").alias("group_name"),
        home.alias("home_team"),
        away.alias("away_team"),
        default_coalesce_first("home_score", "int", 0).alias("home_score"),
        default_coalesce_first("away_score", "int", 0).alias("away_score"),
        F.coalesce(first_part(venue), F.lit(UNKNOWN)).alias("stadium"),
        F.coalesce(after_first_comma(venue), F.lit(UNKNOWN)).alias("city"),
        default_coalesce_first(attendance, "int", 0).alias("attendance"),
        _invalid((F.col(date), match_date), (F.col(year), year_int)),
        _reject(date=match_date.isNull(), home_team=F.col("home_team").isNull(),
                away_team=F.col("away_team").isNull()),
    )


def clean_contests(contests: DataFrame) -> DataFrame:
    """Played contests: alternative raw column names, tolerant casts, defaults, venue split
    into stadium and city (both read from the original venue text), key
    ``date_home_away`` with defaulted team names, one row per key."""
    return keep_one(contest_rows(contests), CONTEST_KEY, CHOICE["contests"]).select(*CONTEST_COLUMNS)
