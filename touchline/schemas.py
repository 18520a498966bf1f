"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple[str, str]) -> T.StructType:
    schema = T.StructType()
    for name, kind in fields:
        schema.add(name, kind)
    return schema


# Column names, order and types of the player tables.
RAW = _table(
    ("league", "string"), ("season", "string"), ("player_id", "integer"), ("player_name", "string"),
    ("team_title", "string"), ("position", "string"), ("games", "integer"), ("time", "integer"), ("goals", "integer"),
    ("assists", "integer"), ("xG", "double"), ("xA", "double"), ("shots", "integer"), ("key_passes", "integer"),
    ("yellow_cards", "integer"), ("red_cards", "integer"), ("npg", "integer"), ("npxG", "double"),
    ("xGChain", "double"), ("xGBuildup", "double"),
)
CLEAN = _table(
    ("league", "string"), ("season", "string"), ("player_id", "integer"), ("player_name", "string"),
    ("team_title", "string"), ("position", "string"), ("games", "integer"), ("time", "integer"), ("goals", "integer"),
    ("assists", "integer"), ("npg", "integer"), ("xG_percentage", "double"), ("xA_percentage", "double"),
    ("npxG_percentage", "double"), ("shots", "integer"), ("missed_shots", "integer"), ("key_passes", "integer"),
    ("yellow_cards", "integer"), ("red_cards", "integer"),
)

# The shot event as it is stored.
SHOT = _table(
    ("X", "double"), ("Y", "double"), ("a_goals", "double"), ("a_team", "string"), ("date", "string"),
    ("h_goals", "double"), ("h_team", "string"), ("id", "double"), ("league", "string"),
    ("match_id", "double"), ("result", "string"), ("season", "string"),
)
# Fields of a shot message that are not stored.
SHOT_IGNORED = [
    "shotType", "minute", "situation", "player_assisted", "lastAction", "xG", "player", "h_a",
    "player_id",
]

# The thirteen measures of the fact table, in order.
MEASURES = [
    "games", "time", "goals", "assists", "npg", "xG_percentage", "xA_percentage",
    "npxG_percentage", "shots", "missed_shots", "key_passes", "yellow_cards", "red_cards",
]

# Labelled dimensions: label column -> key column.
LABEL_KEYS = {
    "league": "league_id",
    "season": "season_id",
    "team_title": "team_id",
    "position": "position_id",
}
# The key columns of the fact, in order.
FACT_KEYS = ["league_id", "season_id", "player_id", "team_id", "position_id"]
# The same columns for grouping and joining. Sorts compare the first one first, so the key with the
# most values leads.
GRAIN_KEYS = ["player_id", "season_id", "team_id", "league_id", "position_id"]

# Order in which "first" and "last" are decided.
ROW_ORDER = ["season", "league", "player_id", "team_title", "position"]
# Optional column of rows to be loaded: a larger number was landed later.
LOAD_ORDER = "load_order"
KEY_ORDER = ["season_id", "league_id", "player_id", "team_id", "position_id"]

# Warehouse table names.
DIM_LEAGUE = "DimLeague"
DIM_SEASON = "DimSeason"
DIM_PLAYER = "DimPlayer"
DIM_TEAM = "DimTeam"
DIM_POSITION = "DimPosition"
FACT_TABLE = "FactPlayerStatistics"
FACT_IDS = "FactIds"
LOAD_REPORT = "LoadReport"
PUBLISHED = "PublishedViews"
PLAYER_MART = "PlayerPerformanceDataMart"
TEAM_MART = "TeamStatisticsDataMart"

DIMENSIONS = {
    DIM_LEAGUE: _table(("league_id", "integer"), ("league", "string")),
    DIM_SEASON: _table(("season_id", "integer"), ("season", "string")),
    DIM_PLAYER: _table(("player_id", "integer"), ("player_name", "string")),
    DIM_TEAM: _table(("team_id", "integer"), ("team_title", "string")),
    DIM_POSITION: _table(("position_id", "integer"), ("position", "string")),
}
REPORT = _table(("source", "string"), ("rows", "long"), ("set_aside", "long"))
# The row id is a long: row counts beyond two billion must fit.
FACT = T.StructType(
    [T.StructField("pstatistics_id", T.LongType())]
    + [T.StructField(name, T.IntegerType()) for name in FACT_KEYS]
    + [CLEAN[name] for name in MEASURES]
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
