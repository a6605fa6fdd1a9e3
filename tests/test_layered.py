"""End to end: land hand-made CSV sources, clean them, build the aggregate tables."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from layerwise.plans.layered import LayeredConfig, manifest_report, quality_report, run_layered
from layerwise.plans.views import register_views
from layerwise.operators.upsert import read_current
from layerwise.sources.catalog import Source

RANK_2022 = """team,rank,points
Alpha,1,1841.9
 Beta ,2,1700.2
Gamma,x,1650.0
"""
RANK_2026 = """country,rank,points
Alpha,2,1850.5
Beta,1,1900.0
Beta,5,10.0
"""
HISTORY = """Year,Host,Champion,Runner-Up,Matches
2018,Alpha,Beta,,64
2022,,Alpha,Beta,abc
2022,Gamma,Alpha,Beta,64
"""
SCHEDULE = """Round,Date,home_team,away_team
Group,2026-06-11,Alpha,Beta
Group,2026-06-11,Alpha,Beta
,2026-06-12,Gamma,Delta
Group,not-a-date,Beta,Gamma
"""
MATCHES = """Date,Year,Round,home_team,away_team,home_score,away_score,Attendance,Venue
2018-06-14,2018,Group,Alpha,Beta,2,1,1000,"Stadium One, City, Land"
2018-06-15,2018,Group,Beta,Gamma,0,0,,NoComma
2018-06-15,2018,Group,Beta,Gamma,1,1,,NoComma
2022-11-20,2022,Final,Alpha,,3,2,5000,
"""
RATINGS = """country,snapshot_date,rating,goals_for,matches_total,is_host
Alpha,2026-01-01,1800,100,50,0
Alpha,2026-06-01,1935,520,700,1
Beta,2026-06-01,1785,210,320,0
Gamma,2026-06-01,1600,0,0,0
"""
RATING_SCHEMA = ("country string, snapshot_date date, rating long, goals_for long, "
                 "matches_total long, is_host int")


def test_layered_job(spark, tmp_root):
    files = {"rank_2022": RANK_2022, "rank_2026": RANK_2026, "history": HISTORY,
             "schedule": SCHEDULE, "matches": MATCHES, "ratings": RATINGS}
    for name, text in files.items():
        with open(f"{tmp_root}/{name}.csv", "w") as fh:
            fh.write(text)
    sources = [Source(n, f"{tmp_root}/{n}.csv", RATING_SCHEMA if n == "ratings" else None)
               for n in files]
    sources.append(Source("extra", f"{tmp_root}/absent.csv", required=False))
    config = LayeredConfig(ranking_vintages=[("rank_2022", 2022), ("rank_2026", 2026)],
                           history="history", schedule="schedule", contests="matches",
                           ratings="ratings")
    out = f"{tmp_root}/warehouse"
    stamp = dt.datetime(2026, 6, 1, 12, 0, 0)
    paths = run_layered(spark, sources, out, config, ingestion_time=stamp)

    manifest = {r.table_name: r for r in manifest_report(spark, out).collect()}
    assert set(manifest) == set(files) and manifest["matches"].row_count == 4

    q = {r.table_name: r for r in quality_report(spark, out).collect()}
    assert (q["rankings"].total_records, q["rankings"].duplicate_count, q["rankings"].invalid_records) == (5, 1, 1)
    assert (q["history"].total_records, q["history"].duplicate_count, q["history"].invalid_records) == (2, 1, 1)  # over all rows read
    assert (q["schedule"].total_records, q["schedule"].duplicate_count, q["schedule"].invalid_records) == (3, 1, 1)
    assert (q["contests"].total_records, q["contests"].duplicate_count) == (3, 1)
    assert all(r.processing_time_seconds >= 0 for r in q.values())

    ranks = {(r.country, r.year): (r.rank, r.points) for r in spark.read.parquet(paths["rankings"]).collect()}
    assert ranks[("Alpha", 2022)] == (1, 1841) and ranks[("Beta", 2022)] == (2, 1700)
    assert ranks[("Gamma", 2022)] == (None, 1650) and ranks[("Beta", 2026)] == (1, 1900)

    listed = spark.read.parquet(f"{out}/rejects/schedule").collect()
    assert [r.reason for r in listed] == ["date"]

    contests = {r.match_id: r for r in spark.read.parquet(paths["contests"]).collect()}
    final = contests["2022-11-20_Alpha_Unknown"]
    assert (final.stadium, final.city, final.attendance, final.away_team) == ("Unknown", "Unknown", 5000, "Unknown")
    first = contests["2018-06-14_Alpha_Beta"]
    assert (first.stadium, first.city) == ("Stadium One", "City, Land")
    assert contests["2018-06-15_Beta_Gamma"].home_score == 0  # kept row is the first by score

    tp = {(r.team, r.year): r for r in spark.read.parquet(paths["team_performance"]).collect()}
    assert tp[("Alpha", 2018)].wins == 1 and tp[("Alpha", 2018)].avg_rank is None  # no 2018 ranking
    assert tp[("Alpha", 2022)].avg_rank == 1.0 and tp[("Unknown", 2022)].losses == 1

    preds = {r.match_id: r for r in spark.read.parquet(paths["tournament_predictions"]).collect()}
    m = preds["2026-06-11_Alpha_Beta"]
    assert (m.prob_home_win, m.prob_away_win, m.prob_draw) == (0.7074, 0.1678, 0.1248)
    assert (m.expected_goals_home, m.expected_goals_away, m.home_rank, m.away_rank) == (0.81, 0.61, 2, 1)
    assert spark.read.parquet(paths["predictions"]).count() == 3

    # the serving queries run on the aggregate tables with their default column names
    from layerwise.operators import serving

    gold_tp = spark.read.parquet(paths["team_performance"])
    found = serving.search_standings(gold_tp, team="alp").collect()
    assert [(r.team, r.year) for r in found] == [("Alpha", 2022), ("Alpha", 2018)]
    assert serving.top_teams(gold_tp, 2).collect()[0].team == "Alpha"
    stats = spark.read.parquet(paths["tournament_stats"])
    assert [r.year for r in serving.list_seasons(stats).collect()] == [2022, 2018]
    assert [r.value for r in serving.season_series(stats).collect()] == [3, 5]  # 2-1 and 0-0; 3-2
    assert serving.list_predictions(spark.read.parquet(paths["predictions"]), 2).count() == 2
    report = serving.prediction_report(spark.read.parquet(paths["tournament_predictions"])).collect()
    assert report[0].prob_home_win == "70.7%" and report[0].expected_score == "0.81 - 0.61"
    summary = serving.prediction_summary(spark.read.parquet(paths["tournament_predictions"])).collect()[0]
    assert summary.matches_simulated == 3

    from layerwise.plans.layered import expectations

    checks = {r.check_name: r for r in expectations(spark, out, paths).collect()}
    assert checks["quality rows"].passed and checks["one prediction per contest"].observed == 3
    assert checks["contests rows"].passed and checks["manifest rows"].observed == 6
    assert checks["both ranks"].observed == 1 / 3 and not checks["both ranks"].passed  # Gamma, Delta unranked

    views = register_views(spark, paths)
    assert spark.sql("SELECT count(*) FROM v_tournament_stats").collect()[0][0] == 2
    assert set(views) == {"v_team_performance", "v_tournament_stats"}

    # re-running upserts the registries into new versions without duplicating keys
    run_layered(spark, sources, out, config, ingestion_time=stamp)
    assert quality_report(spark, out).count() == 4
    assert read_current(spark, f"{out}/registry/manifest").filter(F.col("table_name") == "matches").count() == 1


def test_layered_job_from_json_config(spark, tmp_root):
    import json

    from layerwise.plans.layered import main

    with open(f"{tmp_root}/matches.csv", "w") as fh:
        fh.write(MATCHES)
    spec = {"root": f"{tmp_root}/wh",
            "sources": [{"name": "matches", "path": f"{tmp_root}/matches.csv"}],
            "layers": {"contests": "matches"}}
    with open(f"{tmp_root}/job.json", "w") as fh:
        json.dump(spec, fh)
    report = main([f"{tmp_root}/job.json"])
    assert set(report["paths"]) >= {"contests", "team_performance", "tournament_stats", "quality"}
    assert [q["table_name"] for q in report["quality"]] == ["contests"]
    assert report["quality"][0]["total_records"] == 3
    assert all(c["passed"] for c in report["checks"])
    gold = spark.read.parquet(report["paths"]["team_performance"])
    assert gold.columns[-1] == "avg_rank" and register_views(spark, report["paths"])


def test_layered_job_exports_to_jdbc(spark, tmp_root):
    from layerwise.plans.layered import export_jdbc
    from layerwise.sources.jdbc import read_jdbc

    for name, text in {"matches": MATCHES}.items():
        with open(f"{tmp_root}/{name}.csv", "w") as fh:
            fh.write(text)
    url = "jdbc:derby:memory:layered_sink;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    config = LayeredConfig(contests="matches", jdbc_sink={"url": url, "properties": props, "truncate": False},
                           table_names={"contests": "matches_clean"})
    paths = run_layered(spark, [Source("matches", f"{tmp_root}/matches.csv")], f"{tmp_root}/wh", config)
    assert paths["contests"].endswith("/cleaned/matches_clean")
    assert read_jdbc(spark, url, "matches_clean", props, small=True).count() == 3
    assert read_jdbc(spark, url, "tournament_stats", props, small=True).count() == 2
    # a second export truncates and refills the same tables
    assert export_jdbc(spark, paths, {"url": url, "properties": props}, config.table_names) == [
        "matches_clean", "team_performance", "tournament_stats"]
    assert read_jdbc(spark, url, "team_performance", props, small=True).count() == spark.read.parquet(
        paths["team_performance"]).count()


def test_skipped_optional_source_does_not_reuse_stale_raw_data(spark, tmp_root):
    with open(f"{tmp_root}/matches.csv", "w") as fh:
        fh.write(MATCHES)
    config = LayeredConfig(contests="matches")
    out = f"{tmp_root}/wh"
    first = run_layered(spark, [Source("matches", f"{tmp_root}/matches.csv", required=False)], out, config)
    assert "contests" in first
    second = run_layered(spark, [Source("matches", f"{tmp_root}/gone.csv", required=False)], out, config)
    assert "contests" not in second  # the old raw/matches folder is not cleaned again


def test_predictions_from_untyped_ratings(spark, tmp_root):
    from layerwise.operators.predict import predict

    with open(f"{tmp_root}/ratings.csv", "w") as fh:
        fh.write(RATINGS + "Delta,2026-06-01,not-a-number,1,1,0\n")
    untyped = spark.read.option("header", True).csv(f"{tmp_root}/ratings.csv")
    schedule = spark.createDataFrame([("m1", "Alpha", "Beta", None), ("m2", "Delta", "Beta", None)],
                                     "match_id string, home_team string, away_team string, match_date date")
    got = {r.match_id: r for r in predict(schedule, untyped).collect()}
    assert (got["m1"].prob_home_win, got["m1"].prob_draw, got["m1"].expected_goals_home) == (0.7074, 0.1248, 0.81)
    assert got["m2"].rating_home == 1500.0  # malformed rating → default


def test_documented_command_runs(tmp_root):
    import json
    import os
    import subprocess
    import sys

    with open(f"{tmp_root}/matches.csv", "w") as fh:
        fh.write(MATCHES)
    with open(f"{tmp_root}/job.json", "w") as fh:
        json.dump({"root": f"{tmp_root}/out", "sources": [{"name": "matches", "path": f"{tmp_root}/matches.csv"}],
                   "layers": {"contests": "matches"}}, fh)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-m", "layerwise.plans.layered", f"{tmp_root}/job.json"], cwd=root,
                         capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    report = json.loads(run.stdout.strip().splitlines()[-1])
    assert report["quality"][0]["total_records"] == 3 and "contests" in report["paths"]


def _stamps(root):
    """Modification time of every data file, by table folder."""
    found = {}
    for layer in ("raw", "cleaned", "aggregate"):
        for folder, _, names in os.walk(f"{root}/{layer}"):
            for name in names:
                if name.endswith(".parquet"):
                    found[os.path.join(folder, name)] = os.path.getmtime(os.path.join(folder, name))
    return found


def test_a_lost_run_goes_on_at_the_first_unfinished_step(spark, tmp_root, monkeypatch):
    from layerwise.plans import layered

    for name, text in {"matches": MATCHES, "schedule": SCHEDULE, "ratings": RATINGS, "rank_2026": RANK_2026}.items():
        with open(f"{tmp_root}/{name}.csv", "w") as fh:
            fh.write(text)
    sources = [Source(n, f"{tmp_root}/{n}.csv", RATING_SCHEMA if n == "ratings" else None)
               for n in ("matches", "schedule", "ratings", "rank_2026")]
    config = LayeredConfig(contests="matches", schedule="schedule", ratings="ratings",
                           ranking_vintages=[("rank_2026", 2026)])
    out = f"{tmp_root}/wh"

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:  # the run ends after cleaning
        patch.setattr(layered, "season_stats", lost)
        with pytest.raises(RuntimeError):
            run_layered(spark, sources, out, config, resume=True)
    before = _stamps(out)

    def resumed():
        steps = layered.Steps(spark, out, True)
        paths = run_layered(spark, sources, out, config, resume=True, steps=steps)
        return steps.run, paths

    run, paths = resumed()
    assert run == ["tournament_stats", "tournament_predictions", "predictions"]
    after = _stamps(out)
    assert all(after[path] == stamp for path, stamp in before.items())  # nothing was written twice
    assert resumed() == ([], paths) and _stamps(out) == after
    fresh = run_layered(spark, sources, f"{tmp_root}/fresh", config)
    for table in ("team_performance", "tournament_stats", "predictions", "contests"):
        assert sorted(map(str, spark.read.parquet(paths[table]).collect())) == sorted(
            map(str, spark.read.parquet(fresh[table]).collect()))
    assert quality_report(spark, out).count() == 3 and manifest_report(spark, out).count() == 4

    with open(f"{tmp_root}/schedule.csv", "a") as fh:  # one source changes: only what depends on it runs
        fh.write("Final,2026-07-01,Alpha,Gamma\n")
    run, paths = resumed()
    assert run == ["land-schedule", "clean-schedule", "tournament_predictions", "predictions"]
    assert spark.read.parquet(paths["predictions"]).count() == 4
    config.rank_year = 2022  # a configuration that changes counts too
    assert resumed()[0] == ["tournament_predictions", "predictions"]


def test_rejected_rows_can_be_kept_out(spark, tmp_root):
    with open(f"{tmp_root}/schedule.csv", "w") as fh:
        fh.write(SCHEDULE)
    sources = [Source("schedule", f"{tmp_root}/schedule.csv")]
    out = f"{tmp_root}/wh"
    paths = run_layered(spark, sources, out, LayeredConfig(schedule="schedule", route_rejects=True))
    q = quality_report(spark, out).collect()[0]
    rejected = spark.read.parquet(f"{out}/rejects/schedule").count()
    assert (q.total_records, q.duplicate_count, rejected) == (2, 1, 1)  # four rows in
    assert spark.read.parquet(paths["schedule"]).filter("match_date is null").count() == 0
    assert os.listdir(f"{out}/cleaned") == ["schedule"]  # the typed rows are gone
