"""The layered job: land raw sources → clean them → build aggregate tables.

One session, one write per table; each layer reads the previous layer back from
storage, so lineage is cut at every table and a lost executor only recomputes
from the last written layer.  Rows with a missing or unparsed key part are also
written to a rejects table beside each cleaned one.  Quality records (rows in,
rows kept, NULL cells, invalid values) come from the operator that the quality
query uses; seconds are measured per table.
Registries (landing manifest, quality log) are kept by keyed upsert into
versioned tables.  A run can go on where an earlier one was lost: see ``Steps``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.functions.names import TEAM_ALIASES
from layerwise.operators import clean
from layerwise.operators.predict import NARROW_COLUMNS, WIDE_COLUMNS, predict
from layerwise.operators.quality import record
from layerwise.operators.standings import season_stats, standings
from layerwise.operators.upsert import current_path, read_current, upsert_table
from layerwise.sources import fs
from layerwise.sources.catalog import Source, available, land
from layerwise.sources.files import read_landed
from layerwise.sources.jdbc import write_jdbc

QUALITY_SCHEMA = (
    "table_name string, ingestion_timestamp timestamp, total_records long, null_count long, "
    "duplicate_count long, invalid_records long, processing_time_seconds double"
)
MANIFEST_UPDATED = [
    "source_file", "ingestion_timestamp", "row_count", "file_size_bytes", "ingestion_seconds",
    "rows_per_second", "rejected_count",
]


@dataclass
class LayeredConfig:
    """Which landed tables feed which cleaning step (names of ``Source`` entries)."""

    ranking_vintages: Sequence[tuple[str, int]] = ()
    history: str | None = None
    schedule: str | None = None
    contests: str | None = None
    ratings: str | None = None
    rank_year: int = 2026
    aliases: Mapping[str, str] = field(default_factory=lambda: dict(TEAM_ALIASES))
    # rows without a whole key: only among the rejects (True), or in the cleaned table too, one per key text (False)
    route_rejects: bool = False
    # optional export of the cleaned and aggregate tables to a database:
    # {"url": ..., "properties": {...}, "prefix": "SCHEMA."}
    jdbc_sink: Mapping | None = None
    # physical names of the written tables (folders, database tables), by logical name,
    # e.g. {"contests": "matches"}; unnamed tables keep their logical name
    table_names: Mapping[str, str] = field(default_factory=dict)

    def name(self, table: str) -> str:
        return self.table_names.get(table, table)


EXPORTED = ("rankings", "history", "schedule", "contests", "team_performance", "tournament_stats",
            "tournament_predictions", "predictions")


def export_jdbc(
    spark: SparkSession, paths: Mapping[str, str], sink: Mapping, names: Mapping[str, str] | None = None
) -> list[str]:
    """Copy the written cleaned / aggregate tables into a database (truncate-overwrite, so the
    target tables keep their DDL); each table is read back from storage, not recomputed."""
    written = []
    for table in EXPORTED:
        if table in paths:
            name = f"{sink.get('prefix', '')}{(names or {}).get(table, table)}"
            write_jdbc(spark.read.parquet(paths[table]), sink["url"], name, dict(sink.get("properties", {})),
                       truncate=sink.get("truncate", True))
            written.append(name)
    return written


def _write_clean(
    spark: SparkSession, rows: DataFrame, key, columns: Sequence[str], choice: Sequence[str], path: str,
    rejects: str, table: str, stamp: dt.datetime, route_rejects: bool = False,
) -> DataFrame:
    """Write one cleaned table and its rejects; returns its quality record.

    The raw rows are parsed once, into a table of typed rows that the cleaned rows, the rejects and the counts
    are read from.  Rows are counted by aggregates of their own, not by counters inside the write, which a task
    that runs again after a lost executor would raise twice."""
    started = time.perf_counter()
    typed = f"{path}.typed-{uuid.uuid4().hex}"
    rows.write.parquet(typed)
    rows = spark.read.parquet(typed)
    kept = rows.filter(F.col(clean.REJECT) == "") if route_rejects else rows
    clean.keep_one(kept, key, choice).select(*columns).write.mode("overwrite").parquet(path)
    clean.rejects(rows, columns).write.mode("overwrite").parquet(rejects)
    counted = record(rows, spark.read.parquet(path), table, F.count_if(F.col(clean.INVALID)), columns)
    out = counted.first()  # one row
    if route_rejects:  # rejected rows are no duplicates
        rejected = spark.read.parquet(rejects).count()
        out = {**out.asDict(), "duplicate_count": out["duplicate_count"] - rejected}
    fs.delete(spark, typed)
    return spark.createDataFrame([(
        table, stamp, out["total_records"], out["null_count"], out["duplicate_count"], out["invalid_records"],
        time.perf_counter() - started)], QUALITY_SCHEMA)


class Steps:
    """Which steps of a job have ended, and on what input: one small file per step in the registry.

    A step's fingerprint is made of its input files and configuration, or of the fingerprints of the steps before
    it.  The file is removed before a step begins and written when it has ended, so after a lost run the first
    unfinished step is found, and what it left half-written is written again."""

    def __init__(self, spark: SparkSession, root: str, resume: bool):
        self._spark, self._root, self._resume = spark, f"{root}/registry/steps", resume
        self.fingerprints: dict[str, str] = {}
        self.run: list[str] = []

    def needed(self, name: str, *parts) -> bool:
        """Whether the step has to run; if so it counts as unfinished from now on."""
        text = json.dumps(parts, sort_keys=True, default=str)
        self.fingerprints[name] = hashlib.sha256(text.encode()).hexdigest()
        if self._resume and fs.read_small(self._spark, f"{self._root}/{name}") == self.fingerprints[name]:
            return False
        fs.delete(self._spark, f"{self._root}/{name}")
        self.run.append(name)
        return True

    def ended(self, name: str) -> None:
        fs.create_exclusively(self._spark, f"{self._root}/{name}", self.fingerprints[name])

    def of(self, *names: str | None) -> list[str | None]:
        """Fingerprints of earlier steps; None for one that this run does not have."""
        return [self.fingerprints.get(name) for name in names]


def _source_state(spark: SparkSession, source: Source) -> list:
    """What a landed table depends on: the files of the source and how they are read.  A database table has no
    listing and counts as changed."""
    schema = source.schema if source.schema is None or isinstance(source.schema, str) else source.schema.json()
    files = [uuid.uuid4().hex] if source.fmt == "jdbc" else fs.listing(spark, source.path)
    return [source.name, source.path, schema, source.fmt, dict(source.options), source.keep_schema, files]


def run_layered(
    spark: SparkSession,
    sources: list[Source],
    root: str,
    config: LayeredConfig,
    ingestion_time: dt.datetime | None = None,
    resume: bool = False,
    steps: Steps | None = None,
) -> dict[str, str]:
    """Run all three layers under ``root``; returns the written table paths.

    With ``resume`` a step whose input and configuration are those of its last finished run is skipped: a run after
    a lost one goes on at the first unfinished step, and a run over unchanged sources writes nothing.  ``steps``
    tells the caller which steps were run."""
    stamp = ingestion_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    raw, cleaned, gold = f"{root}/raw", f"{root}/cleaned", f"{root}/aggregate"
    paths: dict[str, str] = {}
    steps = steps or Steps(spark, root, resume)

    # tables of this run; a skipped optional source must not be replaced by a raw folder left over from an earlier run
    landed = {s.name for s in sources if available(spark, s)}
    to_land = [s for s in sources if s.name not in landed or steps.needed(f"land-{s.name}", _source_state(spark, s))]
    for group in ([[s] for s in to_land] if resume else [to_land]):  # one by one, so that each can be told as ended
        manifest = land(spark, group, raw, stamp)
        if group:
            _register(spark, f"{root}/registry/manifest", manifest, MANIFEST_UPDATED)
        for source in group:
            if source.name in landed:
                steps.ended(f"land-{source.name}")
    paths["manifest"] = current_path(spark, f"{root}/registry/manifest")

    def read_raw(name: str | None) -> DataFrame | None:
        return read_landed(spark, f"{raw}/{name}") if name in landed else None

    vintages = [(n, y) for n, y in config.ranking_vintages if n in landed]
    tables = []
    if vintages:
        tables.append(("rankings", lambda: clean.ranking_rows([(read_raw(n), y) for n, y in vintages]),
                       clean.RANKING_KEY, clean.RANKING_COLUMNS, vintages))
    for table, name, typed, key, columns in (
            ("history", config.history, clean.history_rows, clean.HISTORY_KEY, clean.HISTORY_COLUMNS),
            ("schedule", config.schedule, clean.schedule_rows, clean.SCHEDULE_KEY, clean.SCHEDULE_COLUMNS),
            ("contests", config.contests, clean.contest_rows, clean.CONTEST_KEY, clean.CONTEST_COLUMNS)):
        if name in landed:
            tables.append((table, lambda typed=typed, name=name: typed(read_raw(name)), key, columns, [(name, None)]))
    quality = []
    for table, rows, key, columns, inputs in tables:
        paths[table] = f"{cleaned}/{config.name(table)}"
        step = f"clean-{table}"
        if not steps.needed(step, steps.of(*(f"land-{n}" for n, _ in inputs)), inputs, paths[table], config.route_rejects):
            continue
        counted = _write_clean(spark, rows(), key, columns, clean.CHOICE[table], paths[table],
                               f"{root}/rejects/{config.name(table)}", table, stamp, config.route_rejects)
        if resume:  # its record is kept before the step is told as ended
            _register(spark, f"{root}/registry/quality", counted)
        else:
            quality.append(counted)
        steps.ended(step)
    if not resume or current_path(spark, f"{root}/registry/quality") is None:
        _register(spark, f"{root}/registry/quality", reduce(
            DataFrame.unionByName, quality, spark.createDataFrame([], QUALITY_SCHEMA)))
    paths["quality"] = current_path(spark, f"{root}/registry/quality")

    def read_clean(table: str) -> DataFrame | None:
        return spark.read.parquet(paths[table]) if table in paths else None

    contests, rankings = read_clean("contests"), read_clean("rankings")
    if contests is not None:
        paths["team_performance"] = f"{gold}/{config.name('team_performance')}"
        if steps.needed("team_performance", steps.of("clean-contests", "clean-rankings"), paths["team_performance"]):
            table = standings(contests, rankings, season="year", team="team", rank_team="country",
                              rank_season="year")
            if rankings is None:  # the aggregate table keeps its schema without a ranking source
                table = table.withColumn("avg_rank", F.lit(None).cast("double"))
            table.write.mode("overwrite").parquet(paths["team_performance"])
            steps.ended("team_performance")
        paths["tournament_stats"] = f"{gold}/{config.name('tournament_stats')}"
        if steps.needed("tournament_stats", steps.of("clean-contests"), paths["tournament_stats"]):
            season_stats(contests, season="year").write.mode("overwrite").parquet(paths["tournament_stats"])
            steps.ended("tournament_stats")

    schedule, ratings = read_clean("schedule"), read_raw(config.ratings)
    if schedule is not None and ratings is not None:
        paths["tournament_predictions"] = f"{gold}/{config.name('tournament_predictions')}"
        before = steps.of("clean-schedule", "clean-rankings", f"land-{config.ratings}")
        if steps.needed("tournament_predictions", before, config.rank_year, dict(config.aliases),
                        paths["tournament_predictions"]):
            ranks = rankings.filter(F.col("year") == config.rank_year) if rankings is not None else None
            wide = predict(schedule, ratings, ranks, aliases=config.aliases)
            wide.write.mode("overwrite").parquet(paths["tournament_predictions"])
            steps.ended("tournament_predictions")
        paths["predictions"] = f"{gold}/{config.name('predictions')}"
        if steps.needed("predictions", steps.of("tournament_predictions"), paths["predictions"]):
            spark.read.parquet(paths["tournament_predictions"]).select(*NARROW_COLUMNS) \
                .write.mode("overwrite").parquet(paths["predictions"])
            steps.ended("predictions")
    if config.jdbc_sink and steps.needed("export", steps.fingerprints, dict(config.jdbc_sink)):
        export_jdbc(spark, paths, config.jdbc_sink, config.table_names)
        steps.ended("export")
    return paths


def _register(spark: SparkSession, root: str, rows: DataFrame, update: Sequence[str] | None = None) -> None:
    """Upsert registry rows; a registry kept by an earlier release may lack newer columns."""
    known = read_current(spark, root)
    if update is not None and known is not None:
        update = [c for c in update if c in known.columns]
    upsert_table(spark, root, rows, "table_name", update=update)


def quality_report(spark: SparkSession, root: str) -> DataFrame | None:
    return read_current(spark, f"{root}/registry/quality")


def manifest_report(spark: SparkSession, root: str) -> DataFrame | None:
    return read_current(spark, f"{root}/registry/manifest")


__all__ = ["LayeredConfig", "run_layered", "quality_report", "manifest_report", "WIDE_COLUMNS"]


def config_from_json(spec: dict) -> tuple[list[Source], str, LayeredConfig]:
    """``{"root": ..., "sources": [{name, path, schema?, required?, fmt?, options?}],
    "layers": {ranking_vintages: [[name, year]], history, schedule, contests, ratings,
    rank_year, aliases}}`` → arguments of ``run_layered``."""
    sources = [Source(**s) for s in spec["sources"]]
    layers = dict(spec.get("layers", {}))
    layers["ranking_vintages"] = [tuple(v) for v in layers.get("ranking_vintages", [])]
    return sources, spec["root"], LayeredConfig(**layers)


def main(argv: list[str] | None = None) -> dict:
    """``python -m layerwise.plans.layered config.json``: run the job, print a JSON report
    (written paths and the quality log, one row per cleaned table)."""
    import argparse

    from layerwise.session import get_session

    parser = argparse.ArgumentParser(description="land → clean → aggregate")
    parser.add_argument("config", help="JSON file with root, sources and layers")
    parser.add_argument("--resume", action="store_true", help="skip steps whose input has not changed")
    args = parser.parse_args(argv)
    with open(args.config) as fh:
        sources, root, config = config_from_json(json.load(fh))
    spark = get_session("layerwise-layered")
    paths = run_layered(spark, sources, root, config, resume=args.resume)
    quality = quality_report(spark, root)
    checks = [r.asDict() for r in expectations(spark, root, paths).collect()]  # one row per check
    report = {
        "paths": paths,
        "checks": checks,
        "quality": [
            {k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in r.asDict().items()}
            for r in (quality.orderBy("table_name").collect() if quality is not None else [])
        ],
    }
    print(json.dumps(report))
    return report


def expectations(spark: SparkSession, root: str, paths: Mapping[str, str],
                 coverage_bound: float = 0.9) -> DataFrame:
    """Post-run checks over the written tables, one row each: check_name, observed, bound,
    passed.  Volume: every landed, cleaned and aggregate table holds rows; one quality row per
    cleaned table; one prediction per scheduled contest.  Coverage: share of predictions with
    both ranks above ``coverage_bound``.  Each check is one aggregation over one table."""
    from layerwise.operators.quality import coverage, row_count_check

    def norm(df: DataFrame) -> DataFrame:
        return df.select("check_name", F.col("observed").cast("double"), F.col("bound").cast("double"),
                         "passed")

    checks = [norm(row_count_check(manifest_report(spark, root), "manifest rows", 1))]
    cleaned = [t for t in ("rankings", "history", "schedule", "contests") if t in paths]
    for table in cleaned + [t for t in EXPORTED if t in paths and t not in cleaned]:
        checks.append(norm(row_count_check(spark.read.parquet(paths[table]), f"{table} rows", 1)))
    quality = quality_report(spark, root)
    checks.append(norm(row_count_check(quality, "quality rows", len(cleaned)).withColumn(
        "passed", F.col("observed") == F.lit(len(cleaned)))))
    if "predictions" in paths and "schedule" in paths:
        scheduled = spark.read.parquet(paths["schedule"]).select(F.count(F.lit(1))).scalar()
        predicted = row_count_check(spark.read.parquet(paths["predictions"]), "one prediction per contest")
        checks.append(norm(predicted.withColumn("bound", scheduled).withColumn(
            "passed", F.col("observed") == scheduled)))
        covered = coverage(spark.read.parquet(paths["predictions"]), ["home_rank", "away_rank"],
                           coverage_bound, "both ranks")
        checks.append(covered.select("check_name", F.col("coverage").alias("observed"), "bound", "passed"))
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out


if __name__ == "__main__":
    main()
