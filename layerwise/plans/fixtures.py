"""Stand-ins for the reference's data model, derived from the benchmark tables.

Every fixture reads whole tables; its size grows with the scale factor.  The
mapping (see SURVEY §5.4) uses integer and text columns only, so sums are exact.

* contests      lineitem ⋈ orders ⋈ customer ⋈ nation (home) ⋈ supplier ⋈ nation (away)
* ratings       events per (user, day)
* schedule      orders (entity ids derived from customer / order keys)
* rankings      customer, two vintages by key parity
* season_ranks  customer ⋈ nation
* …plus raw (uncleaned) variants used by the cleaning operators.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.functions.dates import calendar_date
from layerwise.sources.catalog import registered
from layerwise.sources.files import read_table

# Alias spellings of the benchmark's nation names used by the fixtures
# (exact dictionary, including an identity entry and two spellings of one entity).
NATION_ALIASES = {
    "NATION_1": "NATION_ONE",
    "NATION_2": "NATION_TWO",
    "NATION_3": "NATION_THREE",
    "NATION_5": "NATION_FIVE",
    "NATION_8": "NATION_8",
    "NATION_13": "NATION_THIRTEEN",
    "NATION_21": "NATION_8",
}
# Dictionary for the case-insensitive normalisation fixture.
NATION_ALIASES_CI = {
    "NATION_4": "Nation Four",
    "Nation Four": "Nation Four",
    "NATION_7": "Nation Seven",
    "Nation Seven": "Nation Seven",
    "NATION_9": "Nation Nine",
    "Nation Nine": "Nation Nine",
}
RANK_YEAR = 2026
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A benchmark table.  No join is forced: small sides are broadcast where their measured size allows it."""
    return read_table(spark, root, name)


def _div(c: str, d: int):
    return F.expr(f"{c} div {d}")


def _contest_join(spark: SparkSession, root: str) -> DataFrame:
    """Line items with their order date, customer nation (home) and supplier nation (away).

    Join order is written for scale (Catalyst keeps it without CBO statistics): the
    customer → nation lookup is folded into orders and the nation into suppliers first, so
    the line-item stream meets only two larger inputs (orders by order key, suppliers by
    supplier key).  Each join is broadcast by AQE only while that side is measured small."""
    nation = table(spark, root, "nation")
    customer = table(spark, root, "customer").select("c_custkey", "c_nationkey", "c_name")
    home = customer.join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home_team"),
                      F.col("n_regionkey").alias("home_region")),
        "c_nationkey",
    ).withColumnRenamed("c_nationkey", "home_key")
    orders = table(spark, root, "orders")
    orders = orders.select(
        "o_orderkey", "o_custkey", calendar_date(orders, "o_orderdate").alias("o_date"))
    orders = orders.join(home, orders.o_custkey == home.c_custkey).drop("o_custkey")
    supplier = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    away = supplier.join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away_team")),
        "s_nationkey",
    ).withColumnRenamed("s_nationkey", "away_key")
    lineitem = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey", "l_returnflag")
    return (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(away, lineitem.l_suppkey == away.s_suppkey)
    )


def contests(spark: SparkSession, root: str, drop_same_side: bool = False) -> DataFrame:
    """contest_id, home_team, away_team, season, contest_date, home_score, away_score.

    ``contest_id`` is not unique (natural duplicates for the de-duplication operators).  The two-sided
    queries take contests between different sides only (``drop_same_side``)."""
    df = _contest_join(spark, root).select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("contest_id"),
        "home_team",
        "away_team",
        F.year("o_date").alias("season"),
        F.col("o_date").alias("contest_date"),
        (F.col("l_quantity").try_cast("int") % F.lit(7)).alias("home_score"),
        F.col("l_linenumber").alias("away_score"),
    )
    return df.filter(F.col("home_team") != F.col("away_team")) if drop_same_side else df


def _decimal_text(number, key):
    """Whole numbers as an untyped file may hold them: every second one with a decimal part."""
    return F.concat(number.cast("string"), F.when(key % 2 == 0, F.lit(".0")).otherwise(F.lit("")))


def raw_contests(spark: SparkSession, root: str) -> DataFrame:
    """Uncleaned contests as landed: text dates (some malformed), text year, missing home
    names, venue text with two commas, none, or NULL, scores as text with decimals or malformed."""
    region = table(spark, root, "region").select(
        F.col("r_regionkey").alias("home_region"), F.col("r_name"))
    df = _contest_join(spark, root).join(region, "home_region")
    date_text = F.col("o_date").cast("string")
    venue = (
        F.when(F.col("c_custkey") % 3 == 0,
               F.concat_ws(", ", F.col("c_name"), F.col("home_team"), F.col("r_name")))
        .when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
    )
    return df.select(
        F.when(F.col("l_orderkey") % 89 == 0, F.lit("unknown")).otherwise(date_text).alias("Date"),
        F.year("o_date").cast("string").alias("Year"),
        F.col("l_returnflag").alias("Round"),
        F.when(F.col("c_custkey") % 41 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("home_team")).alias("home_team"),
        "away_team",
        _decimal_text(F.col("l_quantity").try_cast("int") % F.lit(7), F.col("l_linenumber")).alias("home_score"),
        F.when(F.col("l_orderkey") % 53 == 0, F.lit("x")).otherwise(F.col("l_linenumber").cast("string"))
        .alias("away_score"),
        F.col("l_partkey").alias("Attendance"),
        venue.alias("Venue"),
    )


def ratings(spark: SparkSession, root: str) -> DataFrame:
    """entity, snapshot_date, rating, goals_for, matches_total, is_host, grp — one row per
    (user, day) of the event stream."""
    events = table(spark, root, "events")
    day = calendar_date(events, "ts")
    return (
        events.select("user_id", "event_id", day.alias("snapshot_date"))
        .groupBy("user_id", "snapshot_date")
        .agg(
            F.max("event_id").alias("__last"),
            F.sum(F.col("event_id") % 5).alias("goals_for"),
            F.count(F.lit(1)).alias("matches_total"),
        )
        .select(
            F.col("user_id").alias("entity"),
            "snapshot_date",
            (F.lit(1500) + F.col("__last") % 400).alias("rating"),
            "goals_for",
            "matches_total",
            (F.col("user_id") % 16 == 0).cast("int").alias("is_host"),
            (F.col("user_id") % 6).alias("grp"),
        )
    )


def text_ratings(spark: SparkSession, root: str) -> DataFrame:
    """``ratings`` as landed without types: the date is text, and malformed for one entity in seventeen."""
    return ratings(spark, root).withColumn("snapshot_date", F.when(
        F.col("entity") % 17 == 3, F.lit("n/a")).otherwise(F.col("snapshot_date").cast("string")))


def _spelled(entity, other, prefix: str = "Club "):
    """An entity's name, spelled in the way of its alias where ``other`` holds."""
    return F.when(other, F.concat(F.lit(prefix), entity.cast("string"))).otherwise(
        F.concat(F.lit("Team "), entity.cast("string")))


def club_aliases(spark: SparkSession, root: str) -> DataFrame:
    """alias, canonical: one entry for every fifth customer key, every fiftieth listed twice."""
    key = F.col("c_custkey")
    customer = table(spark, root, "customer").filter(key % 5 == 0)
    first = customer.select(F.concat(F.lit("Club "), key.cast("string")).alias("alias"),
                            F.concat(F.lit("Team "), key.cast("string")).alias("canonical"))
    return first.unionByName(customer.filter(key % 50 == 0).select(
        F.concat(F.lit("Club "), key.cast("string")).alias("alias"),
        F.concat(F.lit("Zeam "), key.cast("string")).alias("canonical")))


def named_schedule(spark: SparkSession, root: str) -> DataFrame:
    """``schedule`` with names: homes by their alias, some aways in capitals."""
    home, away = F.col("home_team"), F.col("away_team")
    return schedule(spark, root).withColumns({
        "home_team": _spelled(home, home % 5 == 0),
        "away_team": _spelled(away, away % 7 == 0, "TEAM "),
    })


def named_ratings(spark: SparkSession, root: str) -> DataFrame:
    """``text_ratings`` with names, every tenth entity by its alias on odd days' rows."""
    entity = F.col("entity")
    odd = F.coalesce(F.dayofmonth(F.col("snapshot_date").try_cast("date")) % 2 == 1, F.lit(False))
    return text_ratings(spark, root).withColumn("entity", _spelled(entity, (entity % 10 == 0) & odd))


def named_ranks(spark: SparkSession, root: str) -> DataFrame:
    """Ranks of the year by name: some under the alias, some listed a second time with a worse rank."""
    entity = F.col("entity")
    ranks = ranks_for_year(spark, root).select("entity", "rank")
    again = ranks.filter(entity % 4 == 1).withColumn("rank", F.col("rank") + 3)
    return ranks.unionByName(again).withColumn("entity", _spelled(entity, entity % 15 == 0))


def customer_names(spark: SparkSession, root: str) -> DataFrame:
    """key, name: team names of all customers in three spellings."""
    key = F.col("c_custkey")
    return table(spark, root, "customer").select(
        key.alias("key"),
        F.when(key % 3 == 0, F.concat(F.lit("Club "), key.cast("string")))
        .when(key % 3 == 1, F.concat(F.lit("CLUB "), key.cast("string")))
        .otherwise(F.concat(F.lit("team "), key.cast("string"))).alias("name"))


def schedule(spark: SparkSession, root: str) -> DataFrame:
    """match_id, home_team, away_team (entity ids), match_date — one row per match_id."""
    orders = table(spark, root, "orders")
    date = calendar_date(orders, "o_orderdate")
    home, away = _div("o_custkey", 9), _div("o_orderkey", 100)
    return (
        orders.select(
            F.concat_ws("_", date.cast("string"), home.cast("string"), away.cast("string")).alias("match_id"),
            home.alias("home_team"),
            away.alias("away_team"),
            date.alias("match_date"),
        )
        .filter(F.col("home_team") != F.col("away_team"))
        .distinct()
    )


def raw_schedule(spark: SparkSession, root: str) -> DataFrame:
    """Uncleaned fixture list: text date (some not dates), round (some missing), team text."""
    orders = table(spark, root, "orders")
    date = calendar_date(orders, "o_orderdate")
    home, away = _div("o_custkey", 9).cast("string"), _div("o_orderkey", 100).cast("string")
    return orders.select(
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("TBD")).otherwise(date.cast("string")).alias("Date"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("Round"),
        home.alias("home_team"),
        away.alias("away_team"),
    )


def rankings(spark: SparkSession, root: str) -> DataFrame:
    """entity, year (2022 for even keys, 2026 for odd), rank, points (truncated balance)."""
    customer = table(spark, root, "customer")
    return customer.select(
        F.col("c_custkey").alias("entity"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit(2022)).otherwise(F.lit(2026)).alias("year"),
        (F.col("c_custkey") % 211 + 1).alias("rank"),
        F.col("c_acctbal").try_cast("int").alias("points"),
    )


def ranks_for_year(spark: SparkSession, root: str, year: int = RANK_YEAR) -> DataFrame:
    return rankings(spark, root).filter(F.col("year") == year)


def ranking_vintages(spark: SparkSession, root: str) -> list[tuple[DataFrame, int]]:
    """Two raw ranking files: 2022 names its team column ``team``, 2026 ``country``; rank is
    text (some malformed), points a double, some names padded; 2026 repeats some rows."""
    customer = table(spark, root, "customer")
    rank_text = F.when(F.col("c_custkey") % 50 == 0, F.lit("n/a")).otherwise(
        _decimal_text(F.col("c_custkey") % 211 + 1, F.col("c_custkey")))
    name = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).otherwise(
        F.col("c_name"))
    odd = customer.filter(F.col("c_custkey") % 2 == 1)
    v2022 = customer.filter(F.col("c_custkey") % 2 == 0).select(
        rank_text.alias("rank"), name.alias("team"), F.col("c_acctbal").alias("points"))
    v2026 = odd.select(rank_text.alias("rank"), name.alias("country"), F.col("c_acctbal").alias("points"))
    repeats = odd.filter(F.col("c_custkey") % 5 == 0).select(
        rank_text.alias("rank"), name.alias("country"), (F.col("c_acctbal") + 1).alias("points"))
    return [(v2022, 2022), (v2026.unionByName(repeats), 2026)]


def season_ranks(spark: SparkSession, root: str) -> DataFrame:
    """team (nation name), year (1995 + key % 9), rank — many rows per (team, year)."""
    customer = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, root, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customer.join(nation, "c_nationkey").select(
        F.col("n_name").alias("team"),
        (F.lit(1995) + F.col("c_custkey") % 9).cast("int").alias("year"),
        (F.col("c_custkey") % 211 + 1).alias("rank"),
    )


def raw_history(spark: SparkSession, root: str) -> DataFrame:
    """Season history as landed: several candidate rows per year, text year and match count."""
    grouped = _contest_join(spark, root).groupBy(F.year("o_date").alias("season"), "home_key").agg(
        F.max("away_key").alias("most"), F.min("away_key").alias("least"), F.count(F.lit(1)).alias("__n"))
    nation = table(spark, root, "nation")  # names are looked up for the groups, not aggregated as text
    for key, name in (("home_key", "Host"), ("most", "Champion"), ("least", "Runner-Up")):
        grouped = grouped.join(nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name)), key)
    return grouped.select(
        F.col("season").cast("string").alias("Year"), "Host", "Champion", "Runner-Up",
        _decimal_text(F.col("__n"), F.col("__n")).alias("Matches"))


def venues(spark: SparkSession, root: str) -> DataFrame:
    """key, venue: ``name, nation, region``; a bare name; or NULL."""
    customer = table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, root, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    region = table(spark, root, "region").select("r_regionkey", "r_name")
    df = customer.join(nation, "c_nationkey").join(region, "r_regionkey")
    return df.select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat_ws(", ", "c_name", "n_name", "r_name"))
        .when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
        .alias("venue"),
    )


def raw_numbers(spark: SparkSession, root: str) -> DataFrame:
    """key, text (about one in five is not a number, one in seven has decimals), price (double)."""
    part = table(spark, root, "part")
    return part.select(
        F.col("p_partkey").alias("key"),
        F.when(F.col("p_size") % 5 == 0, F.col("p_type"))
        .when(F.col("p_size") % 7 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".5")))
        .otherwise(F.col("p_size").cast("string"))
        .alias("text"),
        F.col("p_retailprice").alias("price"),
    )


def raw_dates(spark: SparkSession, root: str) -> DataFrame:
    """key, text: ISO order dates with some replaced by a word."""
    orders = table(spark, root, "orders")
    date = calendar_date(orders, "o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("not a date")).otherwise(date.cast("string"))
        .alias("text"),
    )


def labelled_docs(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, lang, source, quality, toxic — documents left join labels (real NULLs)."""
    docs = table(spark, root, "documents").select("doc_id", "lang", "source")
    labels = table(spark, root, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


def registry(spark: SparkSession, root: str, tables=TABLES) -> DataFrame:
    """Landing registry of the benchmark tables: table_name, source_file, row_count,
    schema_version."""
    return reduce(DataFrame.unionByName, [
        registered(table(spark, root, name), name, f"{name}.parquet") for name in tables])


def customer_registry(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def customer_changes(spark: SparkSession, root: str) -> DataFrame:
    """Changes for the registry: every even key revised (every fourth with a NULL balance),
    plus new (negative) keys derived from every seventh customer."""
    customer = customer_registry(spark, root)
    revised = customer.filter(F.col("c_custkey") % 2 == 0).select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit("*")).alias("c_name"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lit("UPDATED").alias("c_mktsegment"),
    )
    added = customer.filter(F.col("c_custkey") % 7 == 0).select(
        (-F.col("c_custkey") - 1).alias("c_custkey"),
        F.concat(F.lit("NEW "), F.col("c_name")).alias("c_name"),
        "c_acctbal",
        "c_mktsegment",
    )
    return revised.unionByName(added)


def part_lines(spark: SparkSession, root: str) -> DataFrame:
    """value: one line per part, ``key,size,type``: the size is a word for every fifth size, one field too many for
    every eleventh, one too few for every thirteenth."""
    size = F.col("p_size")
    text = F.when(size % 5 == 0, F.lit("large")).otherwise(size.cast("string"))
    line = F.when(size % 13 == 0, F.concat_ws(",", F.col("p_partkey").cast("string"), text)).otherwise(
        F.concat_ws(",", F.col("p_partkey").cast("string"), text, "p_type"))
    return table(spark, root, "part").select(
        F.when(size % 11 == 0, F.concat(line, F.lit(",extra"))).otherwise(line).alias("value"))
