"""The seven dashboard questions, asked of the two marts.

Questions to the player mart only sum by one label. They also take totals that are already summed by
key (:func:`touchline.operators.marts.label_totals`) and then shuffle next to nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _top(df: DataFrame, value: str, name: str, rows: int) -> DataFrame:
    """Top-k with ties broken by name; every task keeps k rows, nothing is sorted whole."""
    return df.orderBy(F.desc(value), F.asc(name)).limit(rows)


def top_scoring_teams(team_mart: DataFrame, rows: int = 10) -> DataFrame:
    teams = team_mart.groupBy("team_title").agg(F.sum("total_goals").alias("goals"))
    return _top(teams, "goals", "team_title", rows)


def top_card_teams(team_mart: DataFrame, rows: int = 5) -> DataFrame:
    cards = F.sum(F.col("total_yellow_cards") + F.col("total_red_cards")).alias("cards")
    return _top(team_mart.groupBy("team_title").agg(cards), "cards", "team_title", rows)


def top_chance_teams(player_mart: DataFrame, rows: int = 10, metric: str = "key_passes") -> DataFrame:
    """Chances are counted by key passes, which only the player mart has; ``shots`` also works."""
    teams = player_mart.groupBy("team_title").agg(F.sum(metric).alias("chances"))
    return _top(teams, "chances", "team_title", rows)


def goals_per_league(team_mart: DataFrame) -> DataFrame:
    return team_mart.groupBy("league").agg(F.sum("total_goals").alias("goals"))


def goals_missed_per_player(player_mart: DataFrame) -> DataFrame:
    return player_mart.groupBy("player_name").agg(
        F.sum("goals").alias("goals"), F.sum("missed_shots").alias("missed_shots")
    )


def cards_per_player(player_mart: DataFrame) -> DataFrame:
    return player_mart.groupBy("player_name").agg(
        F.sum("red_cards").alias("red_cards"), F.sum("yellow_cards").alias("yellow_cards")
    )


def top_playing_time(player_mart: DataFrame, rows: int = 5) -> DataFrame:
    players = player_mart.groupBy("player_name").agg(F.sum("time").alias("time"))
    return _top(players, "time", "player_name", rows)
