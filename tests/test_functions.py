"""Column expressions on hand-made rows (cases the benchmark tables do not contain)."""

import math

import pytest
from pyspark.sql import functions as F

from layerwise.functions import (
    after_first_comma,
    default_cast_first,
    default_coalesce_first,
    first_part,
    natural_key,
    normalise,
    normalise_ci,
    parse_date,
    percent_text,
    safe_cast,
    score_text,
    score_text_1dp,
    truncating_int,
    unknown_if_null,
)
from layerwise.functions.elo import expected_goals, host_advantage, outcome_probabilities, winner_label


def one(df):
    return df.collect()[0]


def test_tolerant_casts(spark):
    df = spark.createDataFrame([("12", "1841.9", "x"), ("x", "-5.7", None)], "a string, b string, c string")
    rows = df.select(safe_cast("a", "int").alias("a"), truncating_int("b").alias("b"),
                     safe_cast("c", "int").alias("c")).collect()
    assert [tuple(r) for r in rows] == [(12, 1841, None), (None, -5, None)]


def test_parse_date(spark):
    df = spark.createDataFrame([("2026-06-11",), ("bad",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_date("d")).collect()]
    assert str(got[0]) == "2026-06-11" and got[1] is None and got[2] is None


def test_default_order_matters(spark):
    df = spark.createDataFrame([("x",), (None,), ("7",)], "v string")
    rows = df.select(default_cast_first("v", "int", 0).alias("cast_first"),
                     default_coalesce_first("v", "int", "0").alias("coalesce_first")).collect()
    assert [tuple(r) for r in rows] == [(0, None), (0, 0), (7, 7)]


def test_coalesce_first_with_numeric_default_on_text(spark):
    df = spark.createDataFrame([("x",), (None,), ("3",)], "s string")
    got = [r[0] for r in df.select(default_coalesce_first("s", "int", 0)).collect()]
    assert got == [None, 0, 3]


def test_unknown_default(spark):
    df = spark.createDataFrame([(None,), ("a",)], "v string")
    assert [r[0] for r in df.select(unknown_if_null("v")).collect()] == ["Unknown", "a"]


@pytest.mark.parametrize("venue,stadium,city", [
    ("Rose Bowl, Pasadena, USA", "Rose Bowl", "Pasadena, USA"),
    ("NoComma", "NoComma", ""),
    (None, "Unknown", "Unknown"),
])
def test_split_location(spark, venue, stadium, city):
    df = spark.createDataFrame([(venue,)], "venue string")
    r = one(df.select(F.coalesce(first_part("venue"), F.lit("Unknown")).alias("s"),
                      F.coalesce(after_first_comma("venue"), F.lit("Unknown")).alias("c")))
    assert (r.s, r.c) == (stadium, city)


def test_natural_key_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    assert one(df.select(natural_key("x", "y", "z").alias("k"))).k == "a_b"


def test_normalise_exact(spark):
    df = spark.createDataFrame([("Türkiye",), ("IR Iran",), ("South Korea",), ("Brazil",), (None,)], "n string")
    got = [r.m for r in normalise(df, "n", out="m").collect()]
    assert sorted(got, key=str) == sorted(["Turkey", "Iran", "Korea Republic", "Brazil", None], key=str)


def test_normalise_case_insensitive(spark):
    names = ["USA", "usa", "united states", "south KOREA", "", None, "Chile"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string")
    got = {r.i: r.m for r in normalise_ci(df, "n", out="m").collect()}
    assert [got[i] for i in range(7)] == ["USA", "USA", "USA", "Korea Republic", "", None, "Chile"]


def test_case_folding_first_pair_wins(spark):
    df = spark.createDataFrame([("A",), ("a",), ("X",), ("B",), ("Y",)], "n string")
    got = {r.n: r.m for r in normalise_ci(df, "n", {"A": "x", "b": "A", "a": "y"}, "m").collect()}
    assert got == {"A": "x", "a": "y", "X": "x", "B": "A", "Y": "y"}


def test_dictionaries_of_any_size(spark):
    aliases = {f"name{i}": f"canon{i}" for i in range(300)}
    df = spark.createDataFrame([("name7",), ("NAME8",), ("other",)], "n string")
    assert sorted(r.m for r in normalise(df, "n", aliases, "m").collect()) == ["NAME8", "canon7", "other"]
    assert sorted(r.m for r in normalise_ci(df, "n", aliases, "m").collect()) == ["canon7", "canon8", "other"]
    assert [r.n for r in normalise(df, "n", {}).orderBy("n").collect()] == ["NAME8", "name7", "other"]


def test_text_formats(spark):
    df = spark.createDataFrame([(0.7074, 0.81, 0.61, 2.25, 0.15)], "p double, a double, b double, x double, y double")
    r = one(df.select(percent_text("p").alias("pct"), score_text("a", "b").alias("s"),
                      score_text_1dp("x", "y").alias("t"), percent_text(F.lit(0.5)).alias("half")))
    assert (r.pct, r.s, r.half) == ("70.7%", "0.81 - 0.61", "50.0%")
    assert r.t == f"{2.25:.1f}-{0.15:.1f}"  # half-even on the exact binary value


def _predict_row(spark, rh, ra, gh, mh, ga, ma, host_h=0, host_a=0):
    df = spark.createDataFrame([(rh, ra, gh, mh, ga, ma, host_h, host_a)],
                               "rh long, ra long, gh long, mh long, ga long, ma long, hh int, ah int")
    diff = F.col("rh") + host_advantage("hh", "ah") - F.col("ra")
    ph, pa, pd = outcome_probabilities(diff)
    return one(df.select(
        host_advantage("hh", "ah").alias("adv"),
        F.round(ph, 4).alias("ph"), F.round(pa, 4).alias("pa"), F.round(pd, 4).alias("pd"),
        (ph + pa + pd).alias("total"),
        F.round(expected_goals("gh", "mh", "rh", "ra"), 2).alias("xh"),
        F.round(expected_goals("ga", "ma", "ra", "rh"), 2).alias("xa"),
        winner_label(ph, pa, pd, F.lit("H"), F.lit("A")).alias("w"),
    ))


def test_prediction_host_at_home(spark):
    r = _predict_row(spark, 1935, 1785, 520, 700, 210, 320, host_h=1)
    assert (r.adv, r.ph, r.pa, r.pd, r.xh, r.xa, r.w) == (100, 0.7074, 0.1678, 0.1248, 0.81, 0.61, "H")
    assert math.isclose(r.total, 1.0)


def test_prediction_neutral(spark):
    r = _predict_row(spark, 1870, 1850, 320, 460, 230, 340)
    assert (r.adv, r.ph, r.pa, r.pd, r.xh, r.xa) == (0, 0.3971, 0.354, 0.2489, 0.7, 0.67)


def test_prediction_host_flags(spark):
    assert _predict_row(spark, 1500, 1500, 1, 1, 1, 1, host_a=1).adv == -100
    assert _predict_row(spark, 1500, 1500, 1, 1, 1, 1, host_h=1, host_a=1).adv == 100


def test_prediction_equal_ratings_is_draw(spark):
    r = _predict_row(spark, 1500, 1500, 1, 1, 1, 1)
    assert (r.ph, r.pa, r.pd, r.w) == (0.375, 0.375, 0.25, "Draw")


def test_zero_matches_gives_null_expected_goals(spark):
    assert _predict_row(spark, 1600, 1500, 5, 0, 1, 1).xh is None


def test_normalise_with_alias_table(spark):
    aliases = spark.createDataFrame([("Türkiye", "Turkey"), ("Türkiye", "Zurkey"), (None, "x")],
                                    "alias string, canonical string")
    df = spark.createDataFrame([("Türkiye",), ("TÜRKIYE",), ("Chile",), (None,)], "n string")
    got = sorted((r.m for r in normalise(df, "n", aliases, "m").collect()), key=str)
    assert got == sorted(["Turkey", "TÜRKIYE", "Chile", None], key=str)  # a repeated alias adds no row
    got = sorted((r.m for r in normalise_ci(df, "n", aliases, "m").collect()), key=str)
    assert got == sorted(["Turkey", "Turkey", "Chile", None], key=str)


def test_whole_numbers_from_decimal_text(spark):
    df = spark.createDataFrame([("3.0",), ("12.5",), ("-5.7",), ("x",), (None,), ("99999999999",)], "s string")
    got = df.select(truncating_int("s"), default_cast_first("s", "int", 0), default_coalesce_first("s", "int", 0)).collect()
    assert [tuple(r) for r in got] == [
        (3, 3, 3), (12, 12, 12), (-5, -5, -5), (None, 0, None), (None, 0, 0), (None, 0, None)]


def test_first_part_takes_its_separator_literally(spark):
    df = spark.createDataFrame([("a.b|c",)], "s string")
    assert one(df.select(first_part("s", "."), first_part("s", "|"), first_part("s")))[:] == ("a", "a.b", "a.b|c")
