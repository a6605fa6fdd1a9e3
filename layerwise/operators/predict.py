"""Outcome predictions for scheduled contests from rating snapshots.

``predict``            – the contest job: host advantage, rank columns, winner on unrounded
                         probabilities (14-column wide form; ``narrow`` gives the 7-column form).
``predict_clamped``    – the single-pair variant re-expressed over a whole schedule: optional
                         home side, goals and matches clamped to at least 1, rank looked up by raw
                         name then by normalised name, winner on rounded probabilities, score text.
``pair_probabilities`` – two-sided win expectancies and expected goals at the global latest
                         snapshot for a table of ordered pairs (equi-joins, never all pairs).

Join shape: ratings and ranks are first folded into one profile per entity (ranks full-outer
latest rating).  Where names are normalised, names are resolved into a dictionary per raw name
first: from the profiles and the aliases where names match exactly, from the distinct names of the
schedule where they match in any case.  So the large schedule side is joined twice (home, away) in
every variant.  Profile and dictionary hold a row per name; AQE broadcasts them only when their measured size is under the broadcast threshold,
otherwise it is a shuffled join with skew splitting for popular teams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from layerwise.functions.casts import numeric
from layerwise.functions.elo import (
    DEFAULT_RATING,
    GOALS_DIGITS,
    PROBABILITY_DIGITS,
    expected_goals,
    host_advantage,
    outcome_probabilities,
    winner_label,
)
from layerwise.functions.names import TEAM_ALIASES, Aliases, normalise, normalise_ci, spellings
from layerwise.functions.text import score_text_1dp
from layerwise.operators.dedup import dedup
from layerwise.operators.snapshots import at_global_max, latest_per_key

# The output columns of both forms, and what a missing rating counts as.
NARROW_COLUMNS = [
    "match_id", "home_team", "away_team", "match_date", "home_rank", "away_rank",
    "predicted_winner",
]
WIDE_COLUMNS = [
    "match_id", "home_team", "away_team", "match_date", "home_rank", "away_rank",
    "rating_home", "rating_away", "prob_home_win", "prob_away_win", "prob_draw",
    "expected_goals_home", "expected_goals_away", "predicted_winner",
]
MISSING = {
    "rating_home": DEFAULT_RATING, "rating_away": DEFAULT_RATING,
    "goals_for_home": 1, "goals_for_away": 1,
    "matches_total_home": 1, "matches_total_away": 1,
    "home_is_host": 0, "away_is_host": 0,
}


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def _measure(df: DataFrame, name: str, to: str = "double") -> Column:
    """A numeric input as is; text (an untyped landing) converted tolerantly: malformed → NULL,
    which the defaults then fill."""
    return numeric(df, name, to)


def _keyed(df: DataFrame, name: str, aliases: Aliases | None, out: str, ci: bool = False) -> DataFrame:
    """``df`` with ``out``: the normalised name, or the value itself where there is nothing to normalise."""
    if not aliases or not _is_text(df, name):
        return df.withColumn(out, F.col(name))
    return (normalise_ci if ci else normalise)(df, name, aliases, out)


def distinct_names(df: DataFrame, *columns: str) -> DataFrame:
    """``name``: every value of the columns once, without NULL; combined in each task before the shuffle."""
    return df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("name")).filter("name is not null").distinct()


def _best_ranks(ranks: DataFrame, entity: str, rank: str, aliases: Aliases | None, ci: bool = False) -> DataFrame:
    """``entity, rank``: one row per (normalised) entity, the best rank of those listed for it."""
    keyed = _keyed(ranks, entity, aliases, "__entity", ci)
    return dedup(keyed.select(F.col("__entity").alias("entity"), F.col(rank).alias("rank")), "entity",
                 order=[F.col("rank").asc_nulls_last()])


def entity_profile(
    ratings: DataFrame,
    ranks: DataFrame | None = None,
    *,
    entity: str = "country",
    snapshot: str = "snapshot_date",
    rating: str = "rating",
    goals: str = "goals_for",
    matches: str = "matches_total",
    host: str = "is_host",
    rank_entity: str = "country",
    rank: str = "rank",
    aliases: Aliases | None = None,
) -> DataFrame:
    """One row per (normalised) entity: latest rating stats and rank.

    Names are normalised *before* the latest snapshot is chosen, so two spellings of one
    entity cannot both survive and fan out the later joins; ranks are likewise kept once
    per normalised entity (best rank)."""
    rated = _keyed(ratings, entity, aliases, "__entity").select(
        F.col("__entity").alias("entity"),
        (F.col(snapshot).try_cast("date") if _is_text(ratings, snapshot) else F.col(snapshot)).alias(snapshot),
        _measure(ratings, rating).alias("rating"), _measure(ratings, goals).alias("goals_for"),
        _measure(ratings, matches).alias("matches_total"), _measure(ratings, host, "int").alias("is_host"),
    )
    latest = latest_per_key(rated, "entity", snapshot).drop(snapshot)
    if ranks is None:
        return latest.withColumn("rank", F.lit(None).cast("int"))
    return latest.join(_best_ranks(ranks, rank_entity, rank, aliases), on="entity", how="full")


def predict(
    schedule: DataFrame,
    ratings: DataFrame,
    ranks: DataFrame | None = None,
    *,
    match_id: str = "match_id",
    home: str = "home_team",
    away: str = "away_team",
    match_date: str = "match_date",
    entity: str = "country",
    snapshot: str = "snapshot_date",
    rating: str = "rating",
    goals: str = "goals_for",
    matches: str = "matches_total",
    host: str = "is_host",
    rank_entity: str = "country",
    rank: str = "rank",
    aliases: Aliases | None = None,
    narrow: bool = False,
) -> DataFrame:
    """Predictions for every scheduled contest (left joins: unknown entities get
    rating 1500, goals and matches 1, no host flag, NULL rank)."""
    profile = entity_profile(
        ratings, ranks, entity=entity, snapshot=snapshot, rating=rating, goals=goals,
        matches=matches, host=host, rank_entity=rank_entity, rank=rank, aliases=aliases,
    )

    if aliases and _is_text(schedule, home) and _is_text(schedule, away):
        # one profile per raw name: every spelling of an entity, so that the schedule needs no normalising
        spelled = spellings(schedule.sparkSession, aliases)
        profile = profile.join(spelled, F.col("entity") == F.col("canonical"), "left") \
            .withColumn("entity", F.coalesce("name", "entity")).drop("name", "canonical")
        aliases = None

    def side(tag: str) -> DataFrame:
        return profile.select(
            F.col("entity").alias(f"__{tag}_key"),
            F.col("rating").alias(f"rating_{tag}"),
            F.col("goals_for").alias(f"goals_for_{tag}"),
            F.col("matches_total").alias(f"matches_total_{tag}"),
            F.col("is_host").alias(f"{tag}_is_host"),
            F.col("rank").alias(f"{tag}_rank"),
        )

    games = schedule.select(
        F.col(match_id).alias("match_id"), F.col(home).alias("home_team"),
        F.col(away).alias("away_team"), F.col(match_date).alias("match_date"),
    )
    games = _keyed(_keyed(games, "home_team", aliases, "__home_key"), "away_team", aliases, "__away_key")
    joined = (
        games.join(side("home"), on="__home_key", how="left")
        .join(side("away"), on="__away_key", how="left")
        .na.fill(MISSING)
    )
    diff = F.col("rating_home") + host_advantage("home_is_host", "away_is_host") - F.col("rating_away")
    p_home, p_away, p_draw = outcome_probabilities(diff)
    scored = joined.select(
        "*",
        p_home.alias("__ph"), p_away.alias("__pa"), p_draw.alias("__pd"),
        expected_goals("goals_for_home", "matches_total_home", "rating_home", "rating_away").alias("__xh"),
        expected_goals("goals_for_away", "matches_total_away", "rating_away", "rating_home").alias("__xa"),
    )
    out = scored.select(
        "match_id", "home_team", "away_team", "match_date", "home_rank", "away_rank",
        "rating_home", "rating_away",
        F.round("__ph", PROBABILITY_DIGITS).alias("prob_home_win"),
        F.round("__pa", PROBABILITY_DIGITS).alias("prob_away_win"),
        F.round("__pd", PROBABILITY_DIGITS).alias("prob_draw"),
        F.round("__xh", GOALS_DIGITS).alias("expected_goals_home"),
        F.round("__xa", GOALS_DIGITS).alias("expected_goals_away"),
        winner_label(F.col("__ph"), F.col("__pa"), F.col("__pd"), "home_team", "away_team")
        .alias("predicted_winner"),
    )
    return out.select(*NARROW_COLUMNS) if narrow else out


def resolve_ranks(
    df: DataFrame,
    dim: DataFrame,
    *,
    name: str,
    key: str = "country",
    value: str = "rank",
    out: str = "rank",
    aliases: Aliases = TEAM_ALIASES,
) -> DataFrame:
    """``df`` with ``out``: the value of its raw name in ``dim`` (unique on ``key``), else of the normalised name.

    Raw names with a value are those of ``dim`` and the aliases of its names, so they are listed once and
    ``df`` meets the list in one join."""
    spelled = spellings(df.sparkSession, aliases)
    own = dim.select(F.col(key).alias("__name"), F.col(value).alias(out))
    other = spelled.join(own.select("__name"), F.col("name") == F.col("__name"), "left_anti") \
        .join(own, F.col("canonical") == F.col("__name")).select(F.col("name").alias("__name"), out)
    return df.join(own.union(other), F.col(name) == F.col("__name"), "left").drop("__name")


def attach_ranks(
    schedule: DataFrame,
    ranks: DataFrame,
    *,
    home: str = "home_team",
    away: str = "away_team",
    rank_entity: str = "country",
    rank: str = "rank",
    aliases: Aliases | None = None,
) -> DataFrame:
    """The schedule with ``home_rank`` and ``away_rank`` (the same values ``predict`` reports),
    without the rating side: for checks that only need ranks, such as rank coverage."""
    ranked = _best_ranks(ranks, rank_entity, rank, aliases)
    out = schedule
    for tag, col in (("home", home), ("away", away)):
        side = ranked.select(F.col("entity").alias(f"__{tag}_rk"), F.col("rank").alias(f"{tag}_rank"))
        out = _keyed(out, col, aliases, f"__{tag}_key") \
            .join(side, F.col(f"__{tag}_key") == F.col(f"__{tag}_rk"), "left").drop(f"__{tag}_rk", f"__{tag}_key")
    return out


def predict_clamped(
    schedule: DataFrame,
    ratings: DataFrame,
    ranks: DataFrame | None = None,
    *,
    match_id: str = "match_id",
    home: str = "home_team",
    away: str = "away_team",
    match_date: str = "match_date",
    home_side: str | None = None,
    entity: str = "country",
    snapshot: str = "snapshot_date",
    rating: str = "rating",
    goals: str = "goals_for",
    matches: str = "matches_total",
    rank_entity: str = "country",
    rank: str = "rank",
    aliases: Aliases | None = TEAM_ALIASES,
) -> DataFrame:
    """Single-pair prediction semantics over a whole schedule.

    Ratings are the latest snapshot per entity; names of ratings and schedule are normalised alike
    (exact alias, else case-insensitive); rating 1500.0 when unknown; goals and matches are
    clamped to at least 1 (and 1 when unknown); the optional ``home_side`` column names the
    side with the +100 advantage (NULL → none); ranks, the best one listed per name, are looked up by
    raw name and only when that name is absent by normalised name; the winner is decided on rounded probabilities;
    ``expected_score`` formats the unrounded expected goals with one decimal."""
    rated = _keyed(ratings, entity, aliases, "__key", True).select(
        "__key", snapshot, F.col(rating).try_cast("double").alias("__rating"),
        F.col(goals).try_cast("double").alias("__goals"), F.col(matches).try_cast("double").alias("__matches"))
    latest = latest_per_key(rated, "__key", snapshot).drop(snapshot)
    games = schedule.select(
        F.col(match_id).alias("match_id"), F.col(home).alias("home_team"),
        F.col(away).alias("away_team"), F.col(match_date).alias("match_date"),
        (F.col(home_side) if home_side else F.lit(None).cast(schedule.schema[home].dataType)).alias("__host"),
    )
    named = aliases and _is_text(schedule, home) and _is_text(schedule, away)
    if named:  # every raw name is resolved once; the schedule meets the result by raw name
        book = normalise_ci(distinct_names(games, "home_team", "away_team"), "name", aliases, "__key") \
            .join(latest, "__key", "left")
        if ranks is not None:
            book = rank_lookup_fallback(
                book, _best_ranks(ranks, rank_entity, rank, None), raw="name", clean="__key", key="entity",
                value="rank", out="__rank", clean_dim=_best_ranks(ranks, rank_entity, rank, aliases, True))
    else:  # the raw name is the key, so ranks fold into the profile
        book = latest if ranks is None else latest.join(
            _best_ranks(ranks, rank_entity, rank, None).toDF("__key", "__rank"), "__key", "full")
        book = book.withColumn("name", F.col("__key"))
    if ranks is None:
        book = book.withColumn("__rank", F.lit(None).cast("int"))

    def stats(tag: str) -> DataFrame:
        return book.select(
            F.col("name").alias(f"__{tag}_name"), F.col("__key").alias(f"__{tag}_clean"),
            F.col("__rating").alias(f"__r_{tag}"), F.col("__goals").alias(f"__g_{tag}"),
            F.col("__matches").alias(f"__m_{tag}"), F.col("__rank").alias(f"{tag}_rank"),
        )

    joined = games.join(stats("home"), F.col("home_team") == F.col("__home_name"), "left") \
        .join(stats("away"), F.col("away_team") == F.col("__away_name"), "left")

    r_home = F.coalesce(F.col("__r_home"), F.lit(float(DEFAULT_RATING)))
    r_away = F.coalesce(F.col("__r_away"), F.lit(float(DEFAULT_RATING)))
    host = F.col("__host")
    adv = (
        F.when((host == F.col("home_team")) | (host == F.col("__home_clean")), F.lit(100))
        .when((host == F.col("away_team")) | (host == F.col("__away_clean")), F.lit(-100))
        .otherwise(F.lit(0))
    )
    p_home, p_away, p_draw = outcome_probabilities(r_home + adv - r_away)
    one = F.lit(1.0)
    g_home, m_home = F.greatest(one, F.col("__g_home")), F.greatest(one, F.col("__m_home"))
    g_away, m_away = F.greatest(one, F.col("__g_away")), F.greatest(one, F.col("__m_away"))
    scored = joined.select(
        "match_id", "home_team", "away_team", "match_date", "home_rank", "away_rank",
        r_home.alias("rating_home"), r_away.alias("rating_away"),
        F.round(p_home, PROBABILITY_DIGITS).alias("prob_home_win"),
        F.round(p_away, PROBABILITY_DIGITS).alias("prob_away_win"),
        F.round(p_draw, PROBABILITY_DIGITS).alias("prob_draw"),
        ((g_home / m_home) * (r_home / r_away)).alias("__xh"),
        ((g_away / m_away) * (r_away / r_home)).alias("__xa"),
    )
    return scored.select(
        "match_id", "home_team", "away_team", "match_date", "home_rank", "away_rank",
        "rating_home", "rating_away", "prob_home_win", "prob_away_win", "prob_draw",
        F.round("__xh", GOALS_DIGITS).alias("expected_goals_home"),
        F.round("__xa", GOALS_DIGITS).alias("expected_goals_away"),
        score_text_1dp("__xh", "__xa").alias("expected_score"),
        winner_label(F.col("prob_home_win"), F.col("prob_away_win"), F.col("prob_draw"),
                     "home_team", "away_team").alias("predicted_winner"),
    )


def rank_lookup_fallback(
    df: DataFrame,
    dim: DataFrame,
    *,
    raw: str,
    clean: str,
    key: str = "country",
    value: str = "rank",
    out: str = "rank",
    clean_dim: DataFrame | None = None,
) -> DataFrame:
    """``dim.get(raw, clean_dim.get(clean))``: the value under the raw key when that key exists in
    ``dim`` (even if its value is NULL), otherwise the value under the clean key (``clean_dim``:
    ``dim`` itself unless given).

    Both must be unique on ``key``.  Two left joins; the dimension is small in practice
    and AQE broadcasts it after measuring it."""
    by_raw = dim.select(F.col(key).alias(f"__{out}_rk"), F.col(value).alias(f"__{out}_rv"),
                        F.lit(True).alias(f"__{out}_rf"))
    by_clean = (dim if clean_dim is None else clean_dim).select(F.col(key).alias(f"__{out}_ck"), F.col(value).alias(f"__{out}_cv"))
    joined = df.join(by_raw, F.col(raw) == F.col(f"__{out}_rk"), "left").join(
        by_clean, F.col(clean) == F.col(f"__{out}_ck"), "left"
    )
    picked = F.when(F.col(f"__{out}_rf").isNotNull(), F.col(f"__{out}_rv")).otherwise(
        F.col(f"__{out}_cv"))
    return joined.withColumn(out, picked).drop(
        f"__{out}_rk", f"__{out}_rv", f"__{out}_rf", f"__{out}_ck", f"__{out}_cv")


def pair_probabilities(
    pairs: DataFrame,
    ratings: DataFrame,
    *,
    a: str = "team_a",
    b: str = "team_b",
    entity: str = "country",
    snapshot: str = "snapshot_date",
    rating: str = "rating",
    goals: str = "goals_for",
    matches: str = "matches_total",
) -> DataFrame:
    """Win expectancy of each side and expected goals for each distinct ordered pair in
    ``pairs`` whose two (different) entities both appear at the global latest snapshot.

    Expected goals use true division (goals / NULLIF(matches, 0)) · (rating ratio)."""
    latest = at_global_max(ratings, snapshot).select(
        entity, _measure(ratings, rating).alias(rating), _measure(ratings, goals).alias(goals),
        _measure(ratings, matches).alias(matches))

    def side(tag: str) -> DataFrame:
        return latest.select(
            F.col(entity).alias(f"team_{tag}"), F.col(rating).alias(f"rating_{tag}"),
            F.col(goals).alias(f"__g_{tag}"), F.col(matches).alias(f"__m_{tag}"),
        )

    distinct_pairs = (
        pairs.select(F.col(a).alias("team_a"), F.col(b).alias("team_b"))
        .filter(F.col("team_a") != F.col("team_b"))
        .distinct()
    )
    joined = distinct_pairs.join(side("a"), "team_a").join(side("b"), "team_b")
    ra, rb = F.col("rating_a"), F.col("rating_b")
    return joined.select(
        "team_a", "team_b", "rating_a", "rating_b",
        (F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (rb - ra) / F.lit(400.0)))).alias("prob_a_win"),
        (F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (ra - rb) / F.lit(400.0)))).alias("prob_b_win"),
        expected_goals("__g_a", "__m_a", "rating_a", "rating_b").alias("expected_goals_a"),
        expected_goals("__g_b", "__m_b", "rating_b", "rating_a").alias("expected_goals_b"),
    )
