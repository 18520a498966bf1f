from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plan, raw_frame, rows
from touchline.functions.names import csv_name, league_of, season_of
from touchline.operators import clean
from touchline.schemas import CLEAN, RAW


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ((0.0, 0.0, 0.0), (0.0, 0.0, 0.0)),
        ((1.0, 1.0, 2.0), (25.0, 25.0, 50.0)),
        ((None, 1.0, 1.0), (0.0, 50.0, 50.0)),
        ((None, None, None), (0.0, 0.0, 0.0)),
    ],
)
def test_shares(spark, given, expected):
    df = raw_frame(spark, dict(zip(("xG", "xA", "npxG"), given)))
    shares = clean.pct_share(df).select("xG_percentage", "xA_percentage", "npxG_percentage")
    assert rows(shares) == [expected]


def test_shares_sum_to_hundred_or_zero(spark):
    df = raw_frame(spark, *(dict(xG=i / 7, xA=i / 3, npxG=float(i % 4)) for i in range(40)))
    total = clean.pct_share(df).select(F.expr("xG_percentage + xA_percentage + npxG_percentage"))
    assert {round(r[0], 9) for r in total.collect()} == {0.0, 100.0}


def test_multi_team_is_dropped_and_unusable_rows_set_aside(spark):
    df = raw_frame(spark, {"team_title": "A"}, {"team_title": "A,B"}, {"team_title": None}, {"player_id": None})
    assert [r.team_title for r in clean.clean_players(df).collect()] == ["A", "A"]
    assert clean.unusable_rows(df).count() == 2


def test_clean_layout_and_missed_shots(spark):
    df = clean.clean_players(raw_frame(spark, {"shots": 5, "goals": 2}, {"shots": None}))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN]
    assert {r.missed_shots for r in df.collect()} == {3, None}


def test_clean_is_one_stage(spark):
    assert "Exchange" not in plan(clean.clean_players(raw_frame(spark, {})))


def test_union_fills_missing_columns_and_keeps_integers(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, "q")], "b int, z string")
    both = clean.union_sources(a, b)
    assert rows(both) == [(1, 2, None), (None, 3, "q")]
    assert both.schema["a"].dataType.simpleString() == "int"


def test_standardise(spark):
    df = raw_frame(spark, {"player_id": 9}).withColumnRenamed("player_id", "id")
    out = clean.standardise_columns(df.select("id", *(c for c in RAW.names if c != "player_id")))
    assert out.columns == RAW.names
    assert out.first().player_id == 9


def test_split_covers_every_row(spark):
    leagues = ["bundesliga", "epl", "la_liga", "ligue_1", "serie_a", "other", None]
    routed = clean.split_by_league(raw_frame(spark, *({"league": x} for x in leagues)))
    counts = {r.route: r["count"] for r in routed.groupBy("route").count().collect()}
    assert counts == {"csv": 3, "json": 1, "api": 1, "unrouted": 2}


def test_preview_is_a_top_k(spark):
    df = raw_frame(spark, *({"player_id": i} for i in range(20, 0, -1)))
    first = clean.preview(df, ["player_id"])
    assert [r.player_id for r in first.collect()] == [1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in plan(first)


@pytest.mark.parametrize(
    ("path", "league", "season"),
    [
        ("file:/x/shots_epl_14-15.csv", "epl", "2014-2015"),
        ("file:/x/shots_la_liga_09-10.csv", "la_liga", "2009-2010"),
        ("file:/x/players_ligue_1_20-21.csv", "ligue_1", "2020-2021"),
        ("file:/x/shots_serie_a_18-19.csv/part-0.csv", "serie_a", "2018-2019"),
        ("file:/x/file=shots_bundesliga_16-17.csv/part-0.csv", "bundesliga", "2016-2017"),
        ("file:/x/shots_epl_dataset.csv", "epl", None),
    ],
)
def test_file_names(spark, path, league, season):
    df = spark.createDataFrame([(path,)], "path string").select(csv_name(F.col("path")).alias("n"))
    assert df.select(league_of(F.col("n")), season_of(F.col("n"))).first() == (league, season)
