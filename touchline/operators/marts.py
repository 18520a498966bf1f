"""The two data marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.joins import fits_broadcast, lookup
from touchline.schemas import (
    DIM_LEAGUE,
    DIM_PLAYER,
    DIM_POSITION,
    DIM_SEASON,
    DIM_TEAM,
    MEASURES,
)


def _labelled(
    rows: DataFrame,
    dims: Mapping[str, DataFrame],
    keys: Mapping[str, str],
    small: Mapping[str, bool] | None,
) -> DataFrame:
    """Join the dimensions in ``keys``. Sizes not told by ``small`` are measured in one job."""
    fits = dict(small or {})
    unknown = {name: dims[name] for name in keys if name not in fits}
    if unknown:
        fits |= fits_broadcast(unknown)
    labelled = rows
    for name, key in keys.items():
        labelled = lookup(labelled, dims[name], key, "inner", fits[name], counted=rows)
    return labelled


def player_mart(
    fact: DataFrame, dims: Mapping[str, DataFrame], small: Mapping[str, bool] | None = None
) -> DataFrame:
    """Fact rows with their five labels."""
    rows = _labelled(
        fact,
        dims,
        {
            DIM_LEAGUE: "league_id",
            DIM_SEASON: "season_id",
            DIM_PLAYER: "player_id",
            DIM_TEAM: "team_id",
            DIM_POSITION: "position_id",
        },
        small,
    )
    return rows.select(
        "pstatistics_id", "league", "season", "player_name", "team_title", "position", *MEASURES
    )


def team_mart(
    fact: DataFrame, dims: Mapping[str, DataFrame], small: Mapping[str, bool] | None = None
) -> DataFrame:
    """Totals and averages by league, season and team.

    The fact is summed by its integer keys before it meets the dimensions, so the joins see one row
    per team and season. Averages travel as sum and count.
    """
    sums = ("goals", "assists", "shots", "missed_shots", "yellow_cards", "red_cards")
    means = ("xG_percentage", "xA_percentage")
    by_key = fact.groupBy("league_id", "season_id", "team_id").agg(
        *(F.sum(c).alias(c) for c in sums + means),
        *(F.count(c).alias(f"{c}_n") for c in means),
    )
    keys = {DIM_LEAGUE: "league_id", DIM_SEASON: "season_id", DIM_TEAM: "team_id"}
    rows = _labelled(by_key, dims, keys, small)

    def mean(c):
        return F.try_divide(F.sum(c), F.sum(f"{c}_n")).alias(f"avg_{c}")

    return rows.groupBy("league", "season", "team_title").agg(
        F.sum("goals").alias("total_goals"),
        F.sum("assists").alias("total_assists"),
        mean("xG_percentage"),
        mean("xA_percentage"),
        F.sum("shots").alias("total_shots"),
        F.sum("missed_shots").alias("total_missed_shots"),
        F.sum("yellow_cards").alias("total_yellow_cards"),
        F.sum("red_cards").alias("total_red_cards"),
    )


def label_totals(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    name: str,
    key: str,
    measures: Sequence[str],
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Sums of ``measures`` per row of one dimension, with its label.

    Stands in for the player mart where a report sums by one label: the fact is summed by key before
    it meets that one dimension.
    """
    sums = fact.groupBy(key).agg(*(F.sum(c).alias(c) for c in measures))
    return _labelled(sums, dims, {name: key}, small).drop(key)
