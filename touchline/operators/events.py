"""Shot messages and the match view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.shots import match_label, match_title, result_colour, score_line
from touchline.functions.values import nan_to_null
from touchline.schemas import SHOT, SHOT_IGNORED

RAW_MESSAGE = "raw_message"


def parse_events(messages: DataFrame) -> DataFrame:
    """Message bytes -> shot columns plus the message text.

    The schema names the stored fields only, so other fields are skipped by the parser. A field of
    the wrong type is null; a message that is no JSON object has nulls throughout.
    """
    text = messages.select(F.col("value").cast("string").alias(RAW_MESSAGE))
    parsed = text.select(F.from_json(RAW_MESSAGE, SHOT).alias("data"), RAW_MESSAGE)
    flat = parsed.select("data.*", RAW_MESSAGE).drop(*SHOT_IGNORED)
    return nan_to_null(flat)


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("id").isNotNull()).select(*SHOT.names)


def bad_events(parsed: DataFrame) -> DataFrame:
    """Messages without a usable id, as they came in."""
    return parsed.where(F.col("id").isNull()).select(RAW_MESSAGE)


def scale_coords(events: DataFrame, factor: int = 100) -> DataFrame:
    return events.withColumns({axis: F.col(axis) * factor for axis in ("X", "Y")})


def shot_rows(messages: DataFrame) -> DataFrame:
    """Everything between the source and the sink of the stream."""
    return messages.transform(parse_events).transform(scale_coords)


def labelled(events: DataFrame) -> DataFrame:
    """Events with their match label."""
    return events.withColumn("match_identifier", match_label())


def distinct_leagues(events: DataFrame) -> DataFrame:
    return events.select("league").distinct()


def distinct_seasons(events: DataFrame) -> DataFrame:
    return events.select("season").distinct()


def match_list(events: DataFrame) -> DataFrame:
    """One option per match, labelled by the match's first event. A null match is one group."""
    first = F.min_by(F.struct("h_team", "a_team", "date"), "id").alias("_first")
    return (
        events.groupBy("match_id")
        .agg(first)
        .select("match_id", "_first.*")
        .select(match_label().alias("label"), F.col("match_id").alias("value"))
    )


def select_match(events: DataFrame, match_id: float, season: str, league: str) -> DataFrame:
    """Events of one match; all three conditions reach the Parquet scan."""
    return events.where(
        (F.col("match_id") == match_id) & (F.col("season") == season) & (F.col("league") == league)
    )


def first_selection(events: DataFrame) -> DataFrame:
    """What a fresh match view shows: league, season and match of the first event. One row."""
    return events.agg(F.min_by(F.struct("league", "season", "match_id"), "id").alias("s")).select("s.*")


def select_first_match(events: DataFrame) -> DataFrame:
    """Events of the match that a fresh match view shows."""
    # One row by construction.
    return events.join(F.broadcast(first_selection(events)), ["league", "season", "match_id"], "left_semi")


def shot_map(events: DataFrame) -> DataFrame:
    """What is drawn: place, result and colour of every shot, with its match."""
    return events.select(
        "league", "season", "match_id", "id", "X", "Y", "result", result_colour().alias("colour")
    )


def match_outcome(events: DataFrame) -> DataFrame:
    """Title and score per match, from the match's first event.

    After :func:`select_match` this is one row, or none if there is no such match.
    """
    first = F.min_by(F.struct("h_team", "a_team", "h_goals", "a_goals"), "id").alias("_first")
    return (
        events.groupBy("league", "season", "match_id")
        .agg(first)
        .select("league", "season", "match_id", "_first.*")
        .select(
            "league",
            "season",
            "match_id",
            match_title().alias("title"),
            score_line(F.col("h_goals"), F.col("a_goals")).alias("outcome"),
        )
    )
