"""Union, column and cleaning steps for player seasons. Map-only: nothing here shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.schemas import CLEAN, LOAD_ORDER, RAW

SHARE_INPUTS = ["xG", "xA", "npxG"]

# Which landing route a league takes.
CSV_LEAGUES = ["bundesliga", "epl", "la_liga"]
JSON_LEAGUES = ["ligue_1"]
API_LEAGUES = ["serie_a"]
UNROUTED = "unrouted"


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def standardise_columns(df: DataFrame) -> DataFrame:
    """``id`` becomes ``player_id``; the fixed column list in its fixed order."""
    return df.withColumnRenamed("id", "player_id").select(*RAW.names)


def route(
    league: Column,
    csv: list[str] = CSV_LEAGUES,
    jsonl: list[str] = JSON_LEAGUES,
    api: list[str] = API_LEAGUES,
) -> Column:
    return (
        F.when(league.isin(csv), "csv")
        .when(league.isin(jsonl), "json")
        .when(league.isin(api), "api")
        .otherwise(UNROUTED)
    )


def split_by_league(df: DataFrame, **leagues: list[str]) -> DataFrame:
    """Add the landing route. Leagues without a route are marked, not lost."""
    return df.withColumn("route", route(F.col("league"), **leagues))


def drop_multi_team(df: DataFrame) -> DataFrame:
    """Keep players with exactly one team. Rows without a team go to :func:`unusable_rows`."""
    return df.where(~F.contains("team_title", F.lit(",")))


def unusable_rows(df: DataFrame) -> DataFrame:
    """Rows that reach no warehouse table because their team or player is unknown."""
    return df.where(F.col("team_title").isNull() | F.col("player_id").isNull())


def pct_share(df: DataFrame, inputs: list[str] = SHARE_INPUTS) -> DataFrame:
    """Each input's share of the row sum, in percent. Nulls count as 0 in the sum; 0/0 gives 0."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in inputs[1:]), F.coalesce(F.col(inputs[0]), F.lit(0.0)))
    return df.withColumns(
        {
            f"{c}_percentage": F.coalesce(F.try_divide(F.col(c), total) * 100, F.lit(0.0))
            for c in inputs
        }
    )


def missed_shots(df: DataFrame) -> DataFrame:
    return df.withColumn("missed_shots", F.col("shots") - F.col("goals"))


def clean_players(df: DataFrame) -> DataFrame:
    """The whole cleaning step as one projection over one scan. A load order comes along."""
    landed = [LOAD_ORDER] if LOAD_ORDER in df.columns else []
    return (
        df.transform(drop_multi_team)
        .drop("xGChain", "xGBuildup")
        .transform(pct_share)
        .drop(*SHARE_INPUTS)
        .transform(missed_shots)
        .select(*CLEAN.names, *landed)
    )


def preview(df: DataFrame, keys: list[str], rows: int = 5) -> DataFrame:
    """The first rows in key order; a top-k per task, not a full sort."""
    return df.orderBy(*keys).limit(rows)
