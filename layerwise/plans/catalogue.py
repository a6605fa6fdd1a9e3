"""Named queries: each ``(spark, root) -> DataFrame`` over the benchmark tables at ``root``.

The same names key the DuckDB oracle in ``layerwise.plans.oracle``.  Unrounded
floating-point outputs (averages, pow/exp) are rounded to ``FLOAT_DIGITS`` in the
checked output so that two engines' last-bit differences cannot flip a hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.functions import (
    default_cast_first,
    default_coalesce_first,
    normalise,
    normalise_ci,
    parse_date,
    cast_date,
    truncating_int,
    unknown_if_null,
)
from layerwise.functions.text import after_first_comma, first_part
from layerwise.operators import buckets, clean, dedup as dd, incremental, quality, serving, snapshots, standings, upsert
from layerwise.operators.predict import (
    attach_ranks,
    pair_probabilities,
    predict,
    predict_clamped,
    resolve_ranks,
)
from layerwise.plans import fixtures as fx
from layerwise.sources import fs
from layerwise.sources.catalog import Source, land, rejects_path
from layerwise.sources.files import read_landed, read_latest_date, read_rejects, write_by_date

FLOAT_DIGITS = 6
Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, *cols: str, digits: int = FLOAT_DIGITS) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _standings(spark, root, with_ranks=True) -> DataFrame:
    ranks = fx.season_ranks(spark, root) if with_ranks else None
    return standings.standings(fx.contests(spark, root, drop_same_side=True), ranks, season="season", rank_team="team")


# --- aggregate layer --------------------------------------------------------------

def team_performance(spark, root):
    return _round(_standings(spark, root), "avg_goals_scored", "avg_goals_conceded", "avg_rank")


def season_stats(spark, root):
    stats = standings.season_stats(fx.contests(spark, root), season="season")
    return serving.list_seasons(_round(stats, "avg_goals_per_match"), season_col="season")


def rank_average(spark, root):
    return _round(standings.rank_average(fx.season_ranks(spark, root), "team", "year", "rank"), "avg_rank")


def top_teams(spark, root):
    return serving.top_teams(_standings(spark, root, with_ranks=False), 10)


def team_performance_search(spark, root):
    found = serving.search_standings(_standings(spark, root), team="nation_1", season=1998, limit=100,
                                     season_col="season")
    return _round(found, "avg_goals_scored", "avg_goals_conceded", "avg_rank")


def season_goal_series(spark, root):
    stats = standings.season_stats(fx.contests(spark, root), season="season")
    return serving.season_series(stats, season_col="season")


def standings_incremental(spark, root):
    """Three batches by order key: two thirds, the last third with one goal too many for the home side, and its
    correction."""
    folder = fs.scratch_path(spark, "standings-incremental")
    fx.contests(spark, root, drop_same_side=True).write.parquet(f"{folder}/contests")
    contests = spark.read.parquet(f"{folder}/contests")
    late = F.substring_index("contest_id", "_", 1).cast("long") % 3 == 2
    wrong = contests.filter(late).withColumn("home_score", F.col("home_score") + 1)
    fixed = wrong.withColumn("sign", F.lit(-1)).unionByName(contests.filter(late).withColumn("sign", F.lit(1)))
    for name, batch in (("first", contests.filter(~late)), ("late", wrong), ("fixed", fixed)):
        state = incremental.standings_state(batch, season="season", weight="sign" if name == "fixed" else None)
        incremental.add_batch(spark, f"{folder}/state", state, ["team", "season"], name, buckets=8)
    table = incremental.standings_of(buckets.read_buckets(spark, f"{folder}/state"), fx.season_ranks(spark, root),
                                     season="season", rank_team="team")
    return _round(table, "avg_goals_scored", "avg_goals_conceded", "avg_rank")


def season_stats_incremental(spark, root):
    folder = fs.scratch_path(spark, "season-incremental")
    contests = fx.contests(spark, root)
    half = F.substring_index("contest_id", "_", 1).cast("long") % 2
    for name in (0, 1):
        incremental.add_batch(spark, folder, incremental.season_state(contests.filter(half == name), season="season"),
                              ["season", "goals"], str(name), buckets=4)
    stats = incremental.season_stats_of(buckets.read_buckets(spark, folder), season="season")
    return serving.list_seasons(_round(stats, "avg_goals_per_match"), season_col="season")


# --- scalar cleaning ----------------------------------------------------------------

def safe_cast_query(spark, root):
    raw = fx.raw_numbers(spark, root)
    return raw.select(
        "key", "text",
        truncating_int("text").alias("as_int"),
        truncating_int("price").alias("price_int"),
    )


def parse_dates_query(spark, root):
    raw = fx.raw_dates(spark, root)
    return raw.select("key", "text", parse_date("text").alias("parsed"), cast_date("text").alias("casted"))


def default_fill(spark, root):
    docs = fx.labelled_docs(spark, root)
    return docs.select(
        "doc_id",
        default_cast_first("quality", "int", 0).alias("quality_filled"),
        default_coalesce_first("toxic", "int", 0).alias("toxic_filled"),
        default_cast_first("lang", "int", 0).alias("lang_cast_first"),
        default_coalesce_first("lang", "int", "0").alias("lang_coalesce_first"),
        unknown_if_null(F.when(F.col("quality") == 1, F.lit("good"))
                        .when(F.col("quality") == 0, F.lit("poor"))).alias("verdict"),
    )


def split_location(spark, root):
    v = fx.venues(spark, root)
    return v.select(
        "key", "venue",
        F.coalesce(first_part("venue"), F.lit("Unknown")).alias("stadium"),
        F.coalesce(after_first_comma("venue"), F.lit("Unknown")).alias("city"),
    )


def normalise_names(spark, root):
    c = fx.contests(spark, root).select("contest_id", "home_team", "away_team")
    c = normalise(c, "home_team", fx.NATION_ALIASES, "home_team_norm")
    return normalise(c, "away_team", fx.NATION_ALIASES, "away_team_norm")


def normalise_names_by_table(spark, root):
    names, aliases = fx.customer_names(spark, root), fx.club_aliases(spark, root)
    return normalise_ci(normalise(names, "name", aliases, "exact_name"), "name", aliases, "any_case_name")


def _mixed_case_names(spark, root) -> DataFrame:
    c = fx.contests(spark, root)
    raw = (
        F.when(F.col("away_score") == 7, F.lit(""))
        .when(F.col("away_score") % 2 == 0, F.lower("home_team"))
        .otherwise(F.col("home_team"))
    )
    return c.select("contest_id", raw.alias("name"))


def normalise_names_ci(spark, root):
    names = _mixed_case_names(spark, root)
    return normalise_ci(names, "name", fx.NATION_ALIASES_CI, "name_norm")


def rank_lookup_fallback_query(spark, root):
    nation = fx.table(spark, root, "nation")
    dim = dd.dedup(
        normalise(nation, "n_name", fx.NATION_ALIASES, "team").select(
            "team", (F.col("n_nationkey") + 1).alias("rank")),
        "team", order=[F.col("rank").asc()],
    )
    c = fx.contests(spark, root).select("contest_id", "home_team")
    return resolve_ranks(c, dim, name="home_team", key="team", out="home_rank", aliases=fx.NATION_ALIASES)


# --- table cleaning -------------------------------------------------------------------

def standardise_rankings(spark, root):
    return clean.clean_rankings(fx.ranking_vintages(spark, root))


def clean_history(spark, root):
    return clean.clean_history(fx.raw_history(spark, root))


def clean_schedule(spark, root):
    return clean.clean_schedule(fx.raw_schedule(spark, root))


def clean_contests(spark, root):
    return clean.clean_contests(fx.raw_contests(spark, root))


def contest_rejects(spark, root):
    return clean.rejects(clean.contest_rows(fx.raw_contests(spark, root)), clean.CONTEST_COLUMNS)


def route_contests(spark, root):
    return clean.routed(clean.contest_rows(fx.raw_contests(spark, root)), clean.CONTEST_KEY, clean.CHOICE["contests"],
                        clean.CONTEST_COLUMNS)


def routing_record(spark, root):
    return clean.routing_record(clean.contest_rows(fx.raw_contests(spark, root)), clean.CONTEST_KEY, "contests")


def dedup_keep_one(spark, root):
    scored = fx.contests(spark, root).withColumn("home_score", F.nullif("home_score", F.lit(0)))
    return dd.dedup(scored, "contest_id")


def dedup_report(spark, root):
    return dd.dedup_report(fx.contests(spark, root), "contest_id")


# --- quality ---------------------------------------------------------------------------

def quality_profile(spark, root):
    numbers = fx.raw_numbers(spark, root).select("key", "text", truncating_int("text").alias("as_int"))
    records = [
        quality.profile(fx.labelled_docs(spark, root), "labelled_docs", key="doc_id"),
        quality.profile(fx.contests(spark, root), "contests", key="contest_id"),
        quality.profile(numbers, "raw_numbers", key="key", invalid=[("text", "as_int")]),
    ]
    out = records[0]
    for r in records[1:]:
        out = out.unionByName(r)
    return serving.quality_log(out)


def key_violations(spark, root):
    return quality.key_violations(fx.contests(spark, root), "contest_id")


def rank_coverage(spark, root):
    # ranks exactly as the predictions carry them, without computing the rating side
    ranked = attach_ranks(fx.schedule(spark, root), fx.ranks_for_year(spark, root), rank_entity="entity")
    return quality.coverage(ranked, ["home_rank", "away_rank"], bound=0.9, name="both_ranks")


# --- registries --------------------------------------------------------------------------

def upsert_by_key(spark, root):
    return upsert.upsert(fx.customer_registry(spark, root), fx.customer_changes(spark, root), "c_custkey")


def upsert_duplicate_keys(spark, root):
    changes = fx.customer_changes(spark, root)
    again = changes.filter(F.col("c_custkey") % 3 == 0).withColumn("c_acctbal", F.col("c_acctbal") - 7)
    return upsert.upsert(fx.customer_registry(spark, root), changes.unionByName(again), "c_custkey")


def upsert_partial(spark, root):
    return upsert.upsert(fx.customer_registry(spark, root), fx.customer_changes(spark, root), "c_custkey",
                         update=["c_acctbal", "c_mktsegment"])


def upsert_buckets(spark, root):
    target = fs.scratch_path(spark, "upsert-buckets")
    buckets.upsert_buckets(spark, target, fx.customer_registry(spark, root), "c_custkey", buckets=32)
    buckets.upsert_buckets(spark, target, fx.customer_changes(spark, root), "c_custkey")
    return buckets.read_buckets(spark, target)


def landing_rejects(spark, root):
    folder = fs.scratch_path(spark, "landing-rejects")
    fx.part_lines(spark, root).write.text(f"{folder}/parts.csv")
    source = Source("parts", f"{folder}/parts.csv", "key long, size int, type string", options={"header": False})
    entry = land(spark, [source], f"{folder}/raw").first()  # the manifest has one row per source
    good = read_landed(spark, f"{folder}/raw/parts")
    bad = read_rejects(spark, rejects_path(f"{folder}/raw", "parts"))
    return good.unionByName(bad, allowMissingColumns=True).withColumns(
        {c: F.lit(entry[c]).cast("long") for c in ("row_count", "rejected_count")})


def ingest_manifest(spark, root):
    return serving.manifest(fx.registry(spark, root), by="row_count")


def manifest_total(spark, root):
    return serving.manifest_total(fx.registry(spark, root))


def manifest_nonempty(spark, root):
    names = ["lineitem", "orders", "customer", "supplier", "part", "nation", "region", "metadata"]
    return serving.nonempty_tables(fx.registry(spark, root), names)


# --- ratings -------------------------------------------------------------------------------

def latest_snapshot(spark, root):
    return snapshots.latest_per_key(fx.text_ratings(spark, root), "entity", "snapshot_date")


def latest_register(spark, root):
    """The register after the snapshots came in three batches that follow no order of dates, one of them twice."""
    folder = fs.scratch_path(spark, "latest-register")
    ratings = fx.text_ratings(spark, root)
    batch = F.pmod(F.xxhash64("snapshot_date", "rating"), F.lit(3))
    for number in (2, 0, 1, 2):
        incremental.register_latest(spark, folder, ratings.filter(batch == number), "entity", buckets=16)
    return buckets.read_buckets(spark, folder)


def global_latest(spark, root):
    return snapshots.at_global_max(fx.text_ratings(spark, root), "snapshot_date")


def top_ratings(spark, root):
    return serving.top_ratings(fx.text_ratings(spark, root), 15, entity="entity")


def top_ratings_by_date(spark, root):
    folder = fs.scratch_path(spark, "ratings-by-date")
    write_by_date(fx.text_ratings(spark, root), folder)
    return serving.best_ratings(read_latest_date(spark, folder), 15, entity="entity")


def rating_by_group(spark, root):
    return serving.rating_by_group(fx.text_ratings(spark, root), group="grp")


# --- predictions -------------------------------------------------------------------------------

def _predictions(spark, root, narrow=False) -> DataFrame:
    return predict(
        fx.schedule(spark, root), fx.ratings(spark, root), fx.ranks_for_year(spark, root),
        entity="entity", rank_entity="entity", narrow=narrow,
    )


def predict_contests(spark, root):
    return _predictions(spark, root)


def predict_contests_all_narrow(spark, root):
    return _predictions(spark, root, narrow=True)


def predict_contests_narrow(spark, root):
    # a contest has one prediction, so the first contests have the first predictions
    first = serving.list_predictions(fx.schedule(spark, root), 100)
    return serving.list_predictions(predict(
        first, fx.ratings(spark, root), fx.ranks_for_year(spark, root), entity="entity", rank_entity="entity",
        narrow=True), 100)


def predict_contests_named(spark, root):
    return predict(
        fx.named_schedule(spark, root), fx.named_ratings(spark, root), fx.named_ranks(spark, root),
        entity="entity", rank_entity="entity", aliases=fx.club_aliases(spark, root))


def predict_pair_named(spark, root):
    return predict_clamped(
        fx.named_schedule(spark, root), fx.named_ratings(spark, root), fx.named_ranks(spark, root),
        entity="entity", rank_entity="entity", aliases=fx.club_aliases(spark, root))


def predict_pair_clamped(spark, root):
    return predict_clamped(
        fx.schedule(spark, root), fx.ratings(spark, root), fx.ranks_for_year(spark, root),
        entity="entity", rank_entity="entity",
    )


def pairwise_predictions(spark, root):
    pairs = fx.schedule(spark, root)
    out = pair_probabilities(pairs, fx.ratings(spark, root), a="home_team", b="away_team", entity="entity")
    return _round(out, "prob_a_win", "prob_b_win", "expected_goals_a", "expected_goals_b")


def prediction_report(spark, root):
    return serving.prediction_report(_predictions(spark, root))


def prediction_summary(spark, root):
    return serving.prediction_summary(_predictions(spark, root))


QUERIES: dict[str, Query] = {
    "team_performance": team_performance,
    "season_stats": season_stats,
    "standings_incremental": standings_incremental,
    "season_stats_incremental": season_stats_incremental,
    "rank_average": rank_average,
    "top_teams": top_teams,
    "team_performance_search": team_performance_search,
    "season_goal_series": season_goal_series,
    "safe_cast": safe_cast_query,
    "parse_dates": parse_dates_query,
    "default_fill": default_fill,
    "split_location": split_location,
    "normalise_names": normalise_names,
    "normalise_names_ci": normalise_names_ci,
    "normalise_names_by_table": normalise_names_by_table,
    "rank_lookup_fallback": rank_lookup_fallback_query,
    "standardise_rankings": standardise_rankings,
    "clean_history": clean_history,
    "clean_schedule": clean_schedule,
    "clean_contests": clean_contests,
    "contest_rejects": contest_rejects,
    "route_contests": route_contests,
    "routing_record": routing_record,
    "dedup_keep_one": dedup_keep_one,
    "dedup_report": dedup_report,
    "quality_profile": quality_profile,
    "key_violations": key_violations,
    "rank_coverage": rank_coverage,
    "upsert_by_key": upsert_by_key,
    "upsert_partial": upsert_partial,
    "upsert_duplicate_keys": upsert_duplicate_keys,
    "upsert_buckets": upsert_buckets,
    "landing_rejects": landing_rejects,
    "ingest_manifest": ingest_manifest,
    "manifest_total": manifest_total,
    "manifest_nonempty": manifest_nonempty,
    "latest_snapshot": latest_snapshot,
    "latest_register": latest_register,
    "global_latest": global_latest,
    "top_ratings": top_ratings,
    "top_ratings_by_date": top_ratings_by_date,
    "rating_by_group": rating_by_group,
    "predict_contests": predict_contests,
    "predict_contests_narrow": predict_contests_narrow,
    "predict_contests_all_narrow": predict_contests_all_narrow,
    "predict_contests_named": predict_contests_named,
    "predict_pair_named": predict_pair_named,
    "predict_pair_clamped": predict_pair_clamped,
    "pairwise_predictions": pairwise_predictions,
    "prediction_report": prediction_report,
    "prediction_summary": prediction_summary,
}
