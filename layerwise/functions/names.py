"""Name normalisation through alias dictionaries.

A dictionary of any size - a mapping, or a table ``(alias, canonical)`` - becomes an alias table
with one row per alias, and names meet it in one left join.  The join is left to the planner: an
alias table under the session's broadcast threshold is broadcast, a larger one is shuffled.

An alias that is listed more than once keeps its first meaning in a mapping and the smallest
canonical name in a table, so a repeated alias never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Team-name aliases, the one dictionary of all operators (names that are not in it
# stay as they are).
TEAM_ALIASES = {
    "United States": "USA",
    "Bosnia-Herzegovina": "Bosnia and Herzegovina",
    "Cape Verde": "Cabo Verde",
    "Türkiye": "Turkey",
    "Korea Republic": "Korea Republic",
    "IR Iran": "Iran",
    "South Korea": "Korea Republic",
}

Aliases = Mapping[str, str] | DataFrame


def _pairs(spark: SparkSession, aliases: Aliases) -> DataFrame:
    """``alias, canonical, place``: every entry, ``place`` telling which of several comes first."""
    if isinstance(aliases, DataFrame):
        return aliases.select("alias", "canonical", F.col("canonical").alias("place")).filter("alias is not null")
    rows = [(alias, canonical, i) for i, (alias, canonical) in enumerate(aliases.items())]
    return spark.createDataFrame(rows, "alias string, canonical string, place long")


def alias_table(spark: SparkSession, aliases: Aliases) -> DataFrame:
    """``__alias, __canonical``: one row per alias."""
    return _pairs(spark, aliases).groupBy(F.col("alias").alias("__alias")).agg(
        F.min_by("canonical", "place").alias("__canonical"))


def spellings(spark: SparkSession, aliases: Aliases) -> DataFrame:
    """``name, canonical``: every name that ``normalise`` turns into a canonical one, itself included unless it is
    an alias of another."""
    table = alias_table(spark, aliases)
    itself = table.select(F.col("__canonical").alias("name")).distinct() \
        .join(table, F.col("name") == F.col("__alias"), "left_anti")
    return table.select(F.col("__alias").alias("name"), F.col("__canonical").alias("canonical")).union(
        itself.select("name", F.col("name").alias("canonical")))


def folded_alias_table(spark: SparkSession, aliases: Aliases) -> DataFrame:
    """``__alias, __canonical, __exact``: one row per spelling ignoring case, of aliases and of canonical
    names; ``__exact`` maps the aliases written in exactly some way to what they mean."""
    exact = alias_table(spark, aliases).groupBy(F.lower("__alias").alias("__alias")).agg(
        F.map_from_entries(F.collect_list(F.struct("__alias", "__canonical"))).alias("__exact"))
    spelled = _pairs(spark, aliases).select(
        "canonical", F.posexplode(F.array(F.lower("alias"), F.lower("canonical"))).alias("side", "__alias"), "place")
    return spelled.groupBy("__alias").agg(
        F.min_by("canonical", F.struct("place", "side")).alias("__canonical")).join(exact, "__alias", "left")


def normalise(df: DataFrame, name: str, aliases: Aliases = TEAM_ALIASES, out: str | None = None) -> DataFrame:
    """``df`` with ``out`` (default: ``name``): the canonical name of an alias; other names pass through."""
    joined = df.join(alias_table(df.sparkSession, aliases), F.col(name) == F.col("__alias"), "left")
    return joined.withColumn(out or name, F.coalesce("__canonical", F.col(name))).drop("__alias", "__canonical")


def normalise_ci(df: DataFrame, name: str, aliases: Aliases = TEAM_ALIASES, out: str | None = None) -> DataFrame:
    """Exact alias, else a match ignoring case on aliases or canonical names, else the name.

    NULL and the empty string are returned as they are.
    """
    spelled = F.when(F.col(name) != "", F.lower(F.col(name)))
    joined = df.join(folded_alias_table(df.sparkSession, aliases), spelled == F.col("__alias"), "left")
    return joined.withColumn(out or name, F.coalesce(
        F.try_element_at("__exact", F.col(name)), F.col("__canonical"), F.col(name),
    )).drop("__alias", "__canonical", "__exact")


def first_existing(df: DataFrame, candidates: Iterable[str]) -> str:
    """First of ``candidates`` that is a column of ``df``, matched case-sensitively."""
    present = set(df.columns)
    for candidate in candidates:
        if candidate in present:
            return candidate
    raise KeyError(f"none of {list(candidates)} in {df.columns}")
