"""One query per operator, each over the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.operators import checks, clean, events, ids, marts, star
from touchline.operators.load import insert_if_absent, scd1
from touchline.plans import batch, catalog, dashboard
from touchline.plans.adapter import ROUTES, player_seasons_raw, shot_events
from touchline.plans.batch import (
    BatchConfig,
    load_dimensions,
    load_fact,
    load_warehouse,
    read_exported_seasons,
)
from touchline.plans.warehouse import Warehouse
from touchline.schemas import (
    CLEAN,
    DIM_LEAGUE,
    DIM_PLAYER,
    DIM_POSITION,
    DIM_SEASON,
    DIM_TEAM,
    DIMENSIONS,
    FACT_TABLE,
    LABEL_KEYS,
    LOAD_ORDER,
    RAW,
    ROW_ORDER,
    SHOT,
    TEAM_MART,
)
from touchline.session import fresh_dir, materialise
from touchline.sources import files, landing
from touchline.sources.tables import append_version, read_version, replace_version
from touchline.streaming import shots as stream
from touchline.streaming.topic import publish_to_topic, publish_with_report, topic_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Seasons up to this one play the part of an earlier load.
EARLY = "1996-1997"
# Full league names for file names, by stand-in league.
FILE_LEAGUES = {
    "AFRICA": "bundesliga",
    "AMERICA": "epl",
    "ASIA": "la_liga",
    "EUROPE": "ligue_1",
    "MIDDLE EAST": "serie_a",
}
FOREIGN_KEYS = [
    (DIM_LEAGUE, "league_id"),
    (DIM_SEASON, "season_id"),
    (DIM_PLAYER, "player_id"),
    (DIM_TEAM, "team_id"),
    (DIM_POSITION, "position_id"),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view as a stored table, for queries that read it more than once."""
    return materialise(player_seasons_raw(spark, sf_dir), "raw")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_players(_raw(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str, key: str = "grain") -> star.Star:
    return star.Star(_clean(spark, sf_dir), key)


def _player_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _star(spark, sf_dir)
    return marts.player_mart(built.fact, built.dims, built.small)


def _team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The team mart reads neither players nor row ids, so neither is built."""
    built = _star(spark, sf_dir)
    return marts.team_mart(built.rows, built.label_dims, built.small)


def _awkward(raw: DataFrame) -> DataFrame:
    """Raw rows with quotes, commas and nulls."""

    def holes(column: str, every: int) -> Column:
        return F.when(F.col("player_id") % every != 0, F.col(column))

    return raw.withColumns(
        {
            "player_name": F.concat("player_name", F.lit(' "Jr", N/A')),
            "position": holes("position", 7),
            "xG": holes("xG", 17),
            "games": holes("games", 19),
        }
    )


# ---- sources -----------------------------------------------------------------------------------


@query
def scan_csv(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    landing.write_csv(player_seasons_raw(spark, sf_dir), path)
    return files.scan_csv(spark, path)


@query
def scan_csv_folder(spark, sf_dir):
    """The warehouse input: a folder of clean CSV files."""
    path = fresh_dir(spark, "csv-folder")
    landing.write_csv(clean.clean_players(player_seasons_raw(spark, sf_dir)), path)
    return files.scan_csv(spark, path, CLEAN)


@query
def scan_csv_unlike_headers(spark, sf_dir):
    """Three kinds of files in one folder: one lacks a column each, one has another column order."""
    path = fresh_dir(spark, "csv-mixed")
    raw = _raw(spark, sf_dir)
    kind = F.col("player_id") % 3
    landing.write_csv(raw.where(kind == 0).select(*reversed(RAW.names)), path)
    landing.write_csv(raw.where(kind == 1).drop("xG"), path, "append")
    landing.write_csv(raw.where(kind == 2).drop("position"), path, "append")
    return files.scan_csv(spark, path)


@query
def scan_league_tree(spark, sf_dir):
    """One merged CSV folder per league, with the inputs it was made of one level deeper."""
    root = fresh_dir(spark, "tree")
    rows = shot_events(spark, sf_dir).withColumn("folder", F.col("league"))
    writer = rows.write.option("header", True)
    writer.partitionBy("folder").csv(root)
    inputs = rows.withColumn("inputs", F.lit("shots")).write.option("header", True)
    inputs.mode("append").partitionBy("folder", "inputs").csv(root)
    return files.scan_csv_tree(spark, root, SHOT)


def _land_json(spark, sf_dir) -> str:
    path = fresh_dir(spark, "jsonl")
    raw = _raw(spark, sf_dir)
    torn = raw.where(F.col("player_id") % 13 == 0).select(
        F.concat(F.lit('{"torn": '), F.col("player_id").cast("string"), F.lit(" "), "season").alias("value")
    )
    blank = raw.where(F.col("player_id") % 29 == 0).select(F.lit("").alias("value"))
    landing.as_messages(raw).unionByName(torn).unionByName(blank).write.text(path)
    return path


@query
def scan_jsonl(spark, sf_dir):
    return files.scan_jsonl(spark, _land_json(spark, sf_dir))


@query
def scan_jsonl_quarantine(spark, sf_dir):
    return files.bad_json_lines(spark, _land_json(spark, sf_dir)).select("line")


@query
def scan_api_extract(spark, sf_dir):
    """API pages of at most 50 players a season, with other columns and another column order."""
    path = fresh_dir(spark, "api")
    raw = player_seasons_raw(spark, sf_dir)
    item = F.struct(F.lit("x").alias("extra"), *reversed(RAW.names))
    page = [F.col("season"), F.floor(F.col("player_id") / 50).alias("page")]
    pages = raw.groupBy(*page).agg(F.collect_list(item).alias("items"))
    pages.select(F.to_json("items").alias("value")).write.text(path)
    return files.scan_api_extract(spark, path)


def _land_pretty(spark, sf_dir) -> str:
    """One indented response per file: a season's players of one region; every third season's is torn."""
    path, raw = fresh_dir(spark, "api-pretty"), _raw(spark, sf_dir)
    season = F.substring("season", 1, 4).cast("int")
    item = F.to_json(F.struct(*reversed(RAW.names)), {"ignoreNullFields": "false", "pretty": "true"})
    page = W.partitionBy("league", "season").orderBy("item")
    first, last = F.row_number().over(page) == 1, F.lead(F.lit(1)).over(page).isNull()
    end = F.when(~last, ",").when(season % 3 != 0, "\n]").otherwise("")
    items = raw.select("league", "season", item.alias("item"))
    # A page is written as it comes, object by object, by the task that has its rows in order.
    lines = items.select(F.concat(F.when(first, "[\n").otherwise(""), "item", end).alias("value"), "league", "season")
    lines.write.partitionBy("league", "season").text(path)
    return path


@query
def scan_api_pretty(spark, sf_dir):
    """Indented responses, one per file, some torn; what is whole is read."""
    return files.scan_api_extract(spark, f"{_land_pretty(spark, sf_dir)}/*/*", pretty=True)


@query
def scan_api_pretty_quarantine(spark, sf_dir):
    """The torn ones are set aside as whole files: how many rows each holds."""
    bad = files.bad_json_lines(spark, f"{_land_pretty(spark, sf_dir)}/*/*", pretty=True)
    season = F.regexp_extract("file", "season=([^/]*)", 1)
    players = bad.groupBy("file").agg(F.sum(F.size(F.split("line", '"player_id"')) - 1).alias("players"))
    return players.select(season.alias("season"), "players")


@query
def scan_optional(spark, sf_dir):
    path = fresh_dir(spark, "present")
    landing.write_csv(player_seasons_raw(spark, sf_dir), path)
    nowhere = fresh_dir(spark, "absent")
    return clean.union_sources(
        files.optional(files.scan_csv, spark, path),
        files.optional(files.scan_csv, spark, nowhere),
        files.optional(files.scan_jsonl, spark, nowhere),
    )


def _lake(spark, sf_dir) -> str:
    path = fresh_dir(spark, "lake")
    landing.write_lake(player_seasons_raw(spark, sf_dir), path)
    return path


def _newest(df: DataFrame) -> str:
    return df.agg(F.max("season")).first()[0]


@query
def scan_season(spark, sf_dir):
    """The newest season of the lake."""
    path = _lake(spark, sf_dir)
    return files.scan_season(spark, path, _newest(files.list_seasons(spark, path)))


@query
def list_seasons(spark, sf_dir):
    return files.list_seasons(spark, _lake(spark, sf_dir))


def _legacy_lake(spark, sf_dir) -> str:
    """One folder per season, named the old way, with a stray index column."""
    root = fresh_dir(spark, "legacy")
    raw = _raw(spark, sf_dir)
    for row in raw.select("season").distinct().collect():
        part = raw.where(F.col("season") == row["season"]).withColumn("__index_level_0__", F.lit(0))
        part.write.parquet(f"{root}/season{row['season']}")
    return root


@query
def scan_legacy_lake(spark, sf_dir):
    return files.scan_legacy_lake(spark, _legacy_lake(spark, sf_dir))


@query
def list_legacy_seasons(spark, sf_dir):
    return files.list_legacy_seasons(spark, _legacy_lake(spark, sf_dir))


def _tagged(spark, sf_dir) -> DataFrame:
    """Raw rows as files named ``shots_<league>_<yy>-<yy>.csv``, without league and season inside."""
    path = fresh_dir(spark, "tagged")
    raw = player_seasons_raw(spark, sf_dir)
    names = F.create_map(*(F.lit(x) for pair in FILE_LEAGUES.items() for x in pair))
    season = F.concat(F.substring("season", 3, 2), F.lit("-"), F.substring("season", 8, 2))
    file = F.concat(F.lit("shots_"), F.element_at(names, F.col("league")), F.lit("_"), season, F.lit(".csv"))
    rows = raw.withColumn("file", file).drop("league", "season")
    rows.write.option("header", True).partitionBy("file").csv(path)
    return files.scan_tagged_csv(spark, f"{path}/*", RAW)


@query
def league_from_filename(spark, sf_dir):
    return _tagged(spark, sf_dir).select("league", "player_id", "games", "goals")


@query
def season_from_filename(spark, sf_dir):
    return _tagged(spark, sf_dir).select("season", "player_id", "games", "goals")


# ---- sinks -------------------------------------------------------------------------------------


@query
def roundtrip_csv(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    landing.write_csv(_awkward(player_seasons_raw(spark, sf_dir)), path)
    return files.scan_csv(spark, path)


@query
def roundtrip_json(spark, sf_dir):
    path = fresh_dir(spark, "json")
    landing.write_jsonl(_awkward(player_seasons_raw(spark, sf_dir)), path)
    return files.scan_jsonl(spark, path)


@query
def lake_overwrite_season(spark, sf_dir):
    """A second load replaces the newest season and leaves the others."""
    raw = _raw(spark, sf_dir)
    path = fresh_dir(spark, "lake")
    landing.write_lake(raw, path)
    newest = raw.where(F.col("season") == _newest(raw))
    landing.write_lake(newest.withColumn("games", F.col("games") + 1), path)
    return files.scan_lake(spark, path)


@query
def export_season_csv(spark, sf_dir):
    path = fresh_dir(spark, "export")
    lake = files.scan_lake(spark, _lake(spark, sf_dir))
    landing.export_season_csv(clean.clean_players(lake), path)
    return read_exported_seasons(spark, path)


@query
def load_league_table(spark, sf_dir):
    path = fresh_dir(spark, "league")
    landing.load_league_table(player_seasons_raw(spark, sf_dir), ROUTES["api"][0], path)
    return spark.read.schema(RAW).parquet(path)


def _renamed(raw: DataFrame, suffix: Column) -> DataFrame:
    return raw.select("player_id", F.concat("player_name", suffix).alias("player_name"), "season")


@query
def dim_insert_if_absent(spark, sf_dir):
    """Players of an earlier load keep their name; players new since then are added."""
    raw = _raw(spark, sf_dir)
    path = fresh_dir(spark, "dim")
    schema = DIMENSIONS[DIM_PLAYER]
    loads = (raw.where(F.col("season") <= EARLY), " (old)"), (raw, "")
    for rows, suffix in loads:
        current = read_version(spark, path, schema)
        incoming = _renamed(rows, F.lit(suffix))
        append_version(insert_if_absent(current, incoming, ["player_id"], ["season"]), path)
    return read_version(spark, path, schema)


def _two_load_store(spark, clean_rows: DataFrame) -> tuple[Warehouse, DataFrame]:
    store = Warehouse(spark, fresh_dir(spark, "store"))
    return store, load_dimensions(clean_rows, store)


@query
def fact_insert_if_absent(spark, sf_dir):
    """Early seasons first, then everything: known rows keep their id, new ones follow."""
    rows = _clean(spark, sf_dir)
    store, book = _two_load_store(spark, rows)
    load_fact(rows.where(F.col("season") <= EARLY), book, store)
    load_fact(rows, book, store)
    return store.fact()


@query
def fact_insert_stat_line(spark, sf_dir):
    """Early seasons first, then the others, keyed by stat line: stored lines keep their id."""
    rows = _clean(spark, sf_dir)
    store, book = _two_load_store(spark, rows)
    for part in (F.col("season") <= EARLY, F.col("season") > EARLY):
        load_fact(rows.where(part), book, store, key="stat_line")
    return store.fact()


@query
def upsert_last_record(spark, sf_dir):
    """Within one upsert the newest season comes twice; the rows that were landed later win."""
    rows = _clean(spark, sf_dir)
    store, book = _two_load_store(spark, rows)
    load_fact(rows, book, store)
    newest = rows.where(F.col("season") == _newest(rows))
    better = [newest.withColumns({"goals": F.col("goals") + n, LOAD_ORDER: F.lit(at)}) for n, at in ((2, 20), (9, 10))]
    load_fact(better[0].unionByName(better[1]), book, store, mode="upsert")
    return store.fact().select("season_id", "player_id", "goals")


@query
def scd1_upsert(spark, sf_dir):
    """Later seasons rename their players; the last name wins."""
    raw = _raw(spark, sf_dir)
    path = fresh_dir(spark, "dim")
    schema = DIMENSIONS[DIM_PLAYER]
    at_season = F.concat(F.lit(" @"), "season")
    loads = (raw.where(F.col("season") <= EARLY), F.lit(" (old)")), (raw.where(F.col("season") >= EARLY), at_season)
    for rows, suffix in loads:
        current = read_version(spark, path, schema)
        replace_version(scd1(current, _renamed(rows, suffix), ["player_id"], ["season"]), path)
    return read_version(spark, path, schema)


def _corrected_store(spark, sf_dir) -> Warehouse:
    """The newest season comes again with corrected goals and with players it lacked before."""
    rows = _clean(spark, sf_dir)
    store, book = _two_load_store(spark, rows)
    newest = F.col("season") == _newest(rows)
    load_fact(rows.where(~(newest & (F.col("player_id") % 2 == 0))), book, store)
    corrected = rows.where(newest).withColumn("goals", F.col("goals") + 1)
    load_fact(corrected, book, store, mode="upsert")
    return store


@query
def scd1_fact_upsert(spark, sf_dir):
    """Corrected and new rows lie over those of before."""
    return _corrected_store(spark, sf_dir).fact()


@query
def scd1_fact_fold(spark, sf_dir):
    """The same once the seasons with changed rows were written anew."""
    store = _corrected_store(spark, sf_dir)
    store.fold()
    return store.fact()


def _messages(events_df: DataFrame) -> DataFrame:
    """Shots with the nine fields that are not stored, some of them null."""
    shot_id = F.col("id").cast("long")
    return events_df.withColumns(
        {
            "shotType": F.lit("RightFoot"),
            "minute": shot_id % 90,
            "situation": F.lit("OpenPlay"),
            "player_assisted": F.when(shot_id % 3 != 0, F.lit('A "B" C')),
            "lastAction": F.lit("Pass"),
            "xG": (shot_id % 100) / 100,
            "player": F.concat(F.lit("P"), (shot_id % 50).cast("string")),
            "h_a": F.when(shot_id % 2 == 0, "h").otherwise("a"),
            "player_id": shot_id % 50,
        }
    )


@query
def publish_json(spark, sf_dir):
    path = fresh_dir(spark, "messages")
    messages = _messages(shot_events(spark, sf_dir))
    landing.publish(messages, path)
    return spark.read.schema(messages.schema).json(path)


# ---- projections, filters, set operations ------------------------------------------------------


@query
def standardise_columns(spark, sf_dir):
    raw = player_seasons_raw(spark, sf_dir)
    return clean.standardise_columns(raw.withColumnRenamed("player_id", "id").select(
        "id", *(c for c in reversed(RAW.names) if c != "player_id")
    ))


@query
def clean_players(spark, sf_dir):
    return clean.clean_players(player_seasons_raw(spark, sf_dir))


@query
def split_by_league(spark, sf_dir):
    """Rows per route and league; leagues without a route are counted too."""
    routed = clean.split_by_league(
        player_seasons_raw(spark, sf_dir), csv=ROUTES["csv"][:2], jsonl=ROUTES["jsonl"], api=ROUTES["api"]
    )
    return routed.groupBy("route", "league").agg(F.count("*").alias("rows"))


@query
def drop_multi_team(spark, sf_dir):
    return clean.drop_multi_team(player_seasons_raw(spark, sf_dir))


@query
def unusable_rows(spark, sf_dir):
    """Rows without a team or a player, of raw rows with some of either missing."""
    raw, player = player_seasons_raw(spark, sf_dir), F.col("player_id")
    holes = {
        "team_title": F.when(player % 7 != 0, F.col("team_title")),
        "player_id": F.when(player % 10 != 0, player),
    }
    return clean.unusable_rows(raw.withColumns(holes))


@query
def pct_share(spark, sf_dir):
    shares = clean.pct_share(player_seasons_raw(spark, sf_dir))
    return shares.select("season", "player_id", "xG_percentage", "xA_percentage", "npxG_percentage")


@query
def missed_shots(spark, sf_dir):
    missed = clean.missed_shots(player_seasons_raw(spark, sf_dir))
    return missed.select("season", "player_id", "shots", "goals", "missed_shots")


@query
def union_sources(spark, sf_dir):
    """Three sources with different columns; what a source lacks is null."""
    raw = _raw(spark, sf_dir)
    by_csv = raw.where(F.col("league").isin(ROUTES["csv"])).drop("xGChain")
    by_json = raw.where(F.col("league").isin(ROUTES["jsonl"])).drop("key_passes")
    by_api = raw.where(F.col("league").isin(ROUTES["api"])).select(*reversed(RAW.names))
    return clean.union_sources(by_csv, by_json, by_api).select(*RAW.names)


@query
def preview(spark, sf_dir):
    return clean.preview(player_seasons_raw(spark, sf_dir), ROW_ORDER)


# ---- ids, star schema, checks ------------------------------------------------------------------


@query
def assign_codes(spark, sf_dir):
    return ids.assign_codes(_clean(spark, sf_dir), list(LABEL_KEYS))


@query
def assign_codes_stable(spark, sf_dir):
    """Two leagues are known from an earlier run; the labels of the others are appended."""
    rows = _clean(spark, sf_dir)
    known = ids.assign_codes(rows.where(F.col("league").isin("ASIA", "EUROPE")), list(LABEL_KEYS))
    return ids.assign_codes_stable(rows, list(LABEL_KEYS), known)


@query
def factorize_stat_line(spark, sf_dir):
    numbered = ids.factorize_stat_line(_clean(spark, sf_dir))
    return numbered.select("season", "player_id", "pstatistics_id")


@query
def fact_keep_first(spark, sf_dir):
    """The fact keyed by stat line."""
    return _star(spark, sf_dir, "stat_line").fact


@query
def fact_build(spark, sf_dir):
    """The fact keyed by its grain."""
    return _star(spark, sf_dir).fact


@query
def check_primary_keys(spark, sf_dir):
    """Every tenth player occurs twice."""
    built = _star(spark, sf_dir)
    players = built.dims[DIM_PLAYER]
    tables = built.dims | {
        DIM_PLAYER: players.unionByName(players.where(F.col("player_id") % 10 == 0)),
        FACT_TABLE: built.fact,
    }
    return checks.check_primary_keys(tables, dict(FOREIGN_KEYS) | {FACT_TABLE: "pstatistics_id"})


@query
def check_foreign_keys(spark, sf_dir):
    """Every fifth team is missing."""
    built = _star(spark, sf_dir)
    teams = built.dims[DIM_TEAM].where(F.col("team_id") % 5 != 0)
    return checks.check_foreign_keys(built.fact, built.dims | {DIM_TEAM: teams}, FOREIGN_KEYS)


# ---- marts and dashboards ----------------------------------------------------------------------


@query
def player_mart(spark, sf_dir):
    return _player_mart(spark, sf_dir)


@query
def team_mart(spark, sf_dir):
    mart = _team_mart(spark, sf_dir)
    return mart.withColumns(
        {c: F.round(c, 6) for c in ("avg_xG_percentage", "avg_xA_percentage")}
    )


@query
def top10_scoring_teams(spark, sf_dir):
    return dashboard.top_scoring_teams(_team_mart(spark, sf_dir))


@query
def top5_card_teams(spark, sf_dir):
    return dashboard.top_card_teams(_team_mart(spark, sf_dir))


@query
def top10_chance_teams(spark, sf_dir):
    built = _star(spark, sf_dir)
    totals = marts.label_totals(
        built.rows, built.label_dims, DIM_TEAM, "team_id", ["key_passes"], built.small
    )
    return dashboard.top_chance_teams(totals)


@query
def goals_per_league(spark, sf_dir):
    return dashboard.goals_per_league(_team_mart(spark, sf_dir))


def _player_totals(spark: SparkSession, sf_dir: str, *measures: str) -> DataFrame:
    built = _star(spark, sf_dir)
    return marts.label_totals(built.rows, built.dims, DIM_PLAYER, "player_id", measures)


@query
def goals_missed_per_player(spark, sf_dir):
    return dashboard.goals_missed_per_player(_player_totals(spark, sf_dir, "goals", "missed_shots"))


@query
def cards_per_player(spark, sf_dir):
    return dashboard.cards_per_player(_player_totals(spark, sf_dir, "red_cards", "yellow_cards"))


@query
def top5_playing_time(spark, sf_dir):
    return dashboard.top_playing_time(_player_totals(spark, sf_dir, "time"))


# ---- shots -------------------------------------------------------------------------------------


def _with_bad(messages: DataFrame, events_df: DataFrame) -> DataFrame:
    """Messages plus one useless line for every fiftieth shot."""
    bad = events_df.where(F.col("id").cast("long") % 50 == 0).select(
        F.concat(F.lit("not json "), F.col("id").cast("long").cast("string")).alias("value")
    )
    return messages.unionByName(bad)


def _messages_with_bad(spark, sf_dir) -> DataFrame:
    shots = shot_events(spark, sf_dir)
    return _with_bad(landing.as_messages(_messages(shots)), shots)


@query
def parse_events(spark, sf_dir):
    return events.valid_events(events.parse_events(_messages_with_bad(spark, sf_dir)))


@query
def quarantine_events(spark, sf_dir):
    return events.bad_events(events.parse_events(_messages_with_bad(spark, sf_dir)))


@query
def scale_coords(spark, sf_dir):
    return events.scale_coords(shot_events(spark, sf_dir)).select("id", "X", "Y")


# Messages of a landed file, which one task writes.
LANDED = 250_000


def _land(messages: DataFrame, path: str, files: int) -> int:
    """Land messages as ``files`` text files, or a multiple of that if they hold many; which multiple."""
    times = max(1, -(-messages.count() // (files * LANDED)))
    messages.repartition(files * times).write.mode("append").text(path)
    return times


@query
def stream_shots(spark, sf_dir):
    """Messages landed as files, streamed into the event table, read back."""
    landed, table, checkpoint = (fresh_dir(spark, d) for d in ("landed", "events", "progress"))
    times = _land(_messages_with_bad(spark, sf_dir), landed, 4)
    stream.run_shot_stream(stream.file_messages(spark, landed, files_per_batch=2 * times), table, checkpoint)
    return stream.scan_events(spark, table)


@query
def scan_bad_events(spark, sf_dir):
    """What two micro-batches could not use, the first of them merged."""
    table = fresh_dir(spark, "events")
    rows = events.shot_rows(_messages_with_bad(spark, sf_dir))
    half = F.pmod(F.xxhash64(F.coalesce("id", F.xxhash64(events.RAW_MESSAGE).cast("double"))), F.lit(2))
    for n in (0, 1):
        stream.write_batch(rows.where(half == n), n, table, "s")
        if n == 0:
            stream.compact(spark, table)
    return stream.scan_bad_events(spark, table).select(events.RAW_MESSAGE)


@query
def compact_events(spark, sf_dir):
    """The stream in small batches, merged, then some more batches; read as one table."""
    landed, table, checkpoint = (fresh_dir(spark, d) for d in ("landed", "events", "progress"))
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    rows = materialise(_messages_with_bad(spark, sf_dir).withColumn("part", part), "messages")
    for part in (0, 1):
        times = _land(rows.where(F.col("part") == part).select("value"), landed, 3)
        stream.run_shot_stream(stream.file_messages(spark, landed, files_per_batch=times), table, checkpoint)
        if part == 0:
            stream.compact(spark, table)
    return stream.scan_events(spark, table)


@query
def events_snapshot(spark, sf_dir):
    """Planned over two batches; a merge and another batch are committed before it is read."""
    table = fresh_dir(spark, "events")
    rows = events.shot_rows(_messages_with_bad(spark, sf_dir))
    third = F.pmod(F.coalesce("id", F.lit(0.0)).cast("long"), F.lit(3))
    for n in (0, 1):
        stream.write_batch(rows.where(third == n), n, table, "s")
    planned = stream.scan_events(spark, table)
    stream.compact(spark, table)
    stream.write_batch(rows.where(third == 2), 2, table, "s")
    stream.compact(spark, table)
    return planned


@query
def stream_topic(spark, sf_dir):
    """Messages of a topic in two runs of one stream: the second begins in the middle of the topic."""
    topic, table, checkpoint = (fresh_dir(spark, d) for d in ("topic", "events", "progress"))
    keyed = _messages_with_bad(spark, sf_dir).select(F.get_json_object("value", "$.match_id").alias("key"), "value")
    rows = materialise(keyed.withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2))), "messages")
    for half in (0, 1):
        publish_to_topic(rows.where(F.col("half") == half), topic)
        stream.run_shot_stream(topic_messages(spark, topic).select("value"), table, checkpoint)
    return stream.scan_events(spark, table)


@query
def publish_report(spark, sf_dir):
    """Sent and refused rows of one publication: every tenth message has no value, every eleventh is too long."""
    shots = shot_events(spark, sf_dir)
    number = F.col("id").cast("long")
    text = F.to_json(F.struct(*SHOT.names))
    value = F.when(number % 10 == 0, F.lit(None)).when(number % 11 == 0, F.rpad(text, 5000, "-")).otherwise(text)
    report = publish_with_report(shots.select(number.cast("string").alias("key"), value.alias("value")), fresh_dir(spark, "topic"), max_bytes=4000)
    return report.select("key", "error", F.col("offset").isNotNull().alias("sent"))


@query
def stream_shots_deduped(spark, sf_dir):
    """Every shot comes three times, in several batches and a restart; some come long after all others."""
    landed, table, checkpoint = (fresh_dir(spark, d) for d in ("landed", "events", "progress"))
    shots = materialise(shot_events(spark, sf_dir), "shots")
    number = F.col("id").cast("long")
    late = shots.where(number % 17 == 0).withColumn("date", F.lit("1990-01-01 20:00:00"))
    parts = (shots.where(number % 17 != 0), shots.unionByName(shots).where(number % 17 != 0), late)
    for n, part in enumerate(parts):
        times = _land(_with_bad(landing.as_messages(_messages(part)), part if n == 0 else part.limit(0)), landed, 2)
        messages = stream.file_messages(spark, landed, files_per_batch=times)
        stream.run_shot_stream(messages, table, checkpoint, once_within="20 years")
    return stream.scan_events(spark, table)


@query
def stream_into_memory(spark, sf_dir):
    """Shots by league, kept up to date by the stream in a table in memory: a row for each league."""
    landed, name = fresh_dir(spark, "landed"), f"shots_{uuid.uuid4().hex}"
    times = _land(_messages_with_bad(spark, sf_dir), landed, 4)
    shots = events.valid_events(events.shot_rows(stream.file_messages(spark, landed, files_per_batch=2 * times)))
    counts = shots.groupBy("league").agg(F.count("*").alias("shots"))
    sink = counts.writeStream.format("memory").queryName(name).outputMode("complete")
    sink = sink.option("checkpointLocation", fresh_dir(spark, "progress"))
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


@query
def scan_events(spark, sf_dir):
    """The event table of one micro-batch, read by column."""
    table = fresh_dir(spark, "events")
    messages = landing.as_messages(shot_events(spark, sf_dir))
    stream.write_batch(events.shot_rows(messages), 0, table, "once")
    return stream.scan_events(spark, table).select("id", "match_id", "season", "league", "result")


@query
def distinct_leagues(spark, sf_dir):
    return events.distinct_leagues(shot_events(spark, sf_dir))


@query
def distinct_seasons(spark, sf_dir):
    return events.distinct_seasons(shot_events(spark, sf_dir))


@query
def match_label(spark, sf_dir):
    return events.labelled(shot_events(spark, sf_dir)).select("id", "match_identifier")


@query
def match_list(spark, sf_dir):
    return events.match_list(shot_events(spark, sf_dir))


@query
def shot_map(spark, sf_dir):
    return events.shot_map(events.scale_coords(shot_events(spark, sf_dir)))


@query
def first_match_shots(spark, sf_dir):
    return events.shot_map(events.select_first_match(shot_events(spark, sf_dir)))


@query
def match_outcome(spark, sf_dir):
    return events.match_outcome(shot_events(spark, sf_dir))


# ---- jobs --------------------------------------------------------------------------------------


@query
def warehouse_build(spark, sf_dir):
    """Rows per warehouse table after loading the same rows twice."""
    rows = _clean(spark, sf_dir)
    store = Warehouse(spark, fresh_dir(spark, "store"))
    store.create()
    for _ in range(2):
        load_warehouse(rows, store)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        for name, df in (store.dims() | {FACT_TABLE: store.fact()}).items()
    ]
    return clean.union_sources(*counts)


@query
def run_batch(spark, sf_dir):
    """The whole batch over three landed sources; the result is the team mart."""
    raw = _raw(spark, sf_dir)
    base = fresh_dir(spark, "batch")
    cfg = BatchConfig(
        csv=f"{base}/csv", jsonl=f"{base}/jsonl", api=f"{base}/api",
        lake=f"{base}/lake", warehouse=f"{base}/warehouse",
    )

    def part(name):
        return raw.where(F.col("league").isin(ROUTES[name]))

    landing.write_csv(part("csv"), cfg.csv)
    landing.write_jsonl(part("jsonl"), cfg.jsonl)
    one_item = F.array(F.struct("*"))
    part("api").select(F.to_json(one_item).alias("value")).write.text(cfg.api)
    mart = batch.run_batch(spark, cfg).team_mart()
    return mart.withColumns(
        {c: F.round(c, 6) for c in ("avg_xG_percentage", "avg_xA_percentage")}
    )


def _faulty_batch(spark, sf_dir) -> BatchConfig:
    """Landed sources with torn lines, a torn API page, an empty CSV folder and rows without player."""
    raw = _raw(spark, sf_dir)
    base = fresh_dir(spark, "batch")
    cfg = BatchConfig(
        csv=f"{base}/csv", jsonl=f"{base}/jsonl", api=f"{base}/api",
        lake=f"{base}/lake", warehouse=f"{base}/warehouse",
    )
    spark.createDataFrame([], "value string").write.text(cfg.csv)
    player = F.col("player_id")
    europe = raw.where(F.col("league") == ROUTES["jsonl"][0])
    torn = F.concat(F.lit('{"torn": '), player.cast("string"), F.lit(" "), "season").alias("value")
    landing.as_messages(europe).unionByName(europe.where(player % 13 == 0).select(torn)).write.text(cfg.jsonl)
    api = raw.where(F.col("league") == ROUTES["api"][0])
    nobody = F.when(player % 5 != 0, player)
    item = F.struct(*[nobody.alias(c) if c == "player_id" else F.col(c) for c in RAW.names])
    page = F.to_json(F.array(item))
    half = F.expr("substring(page, 1, length(page) - 1)")
    pages = api.select(page.alias("page"), (player % 7 == 0).alias("torn"))
    pages.select(F.when(F.col("torn"), half).otherwise(F.col("page")).alias("value")).write.text(cfg.api)
    return cfg


@query
def run_batch_quarantine(spark, sf_dir):
    """What a run over faulty sources read and set aside."""
    return batch.run_batch(spark, _faulty_batch(spark, sf_dir)).load_report()


@query
def batch_bad_lines(spark, sf_dir):
    """The lines that a run over faulty sources set aside: JSON lines and torn API pages."""
    cfg = _faulty_batch(spark, sf_dir)
    batch.ingest(spark, cfg)
    return spark.read.parquet(cfg.bad_lines).select("source", "line")


@query
def mart_after_loads(spark, sf_dir):
    """Views that are registered once see an insert and an upsert that come after them."""
    rows = _clean(spark, sf_dir)
    store = Warehouse(spark, fresh_dir(spark, "store"))
    load_warehouse(rows.where(F.col("season") <= EARLY), store)
    store.register_views()
    load_warehouse(rows, store)
    newest = rows.where(F.col("season") == _newest(rows))
    load_warehouse(newest.withColumn("goals", F.col("goals") + 1), store, mode="upsert")
    return spark.sql(f"select season, team_title, total_goals from {TEAM_MART}")


@query
def mart_in_catalog(spark, sf_dir):
    """The team mart as another session sees it in the catalog, after an insert and an upsert."""
    rows = _clean(spark, sf_dir)
    store, database = Warehouse(spark, fresh_dir(spark, "store")), f"store_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{fresh_dir(spark, 'database')}'")
    catalog.publish(store, database)
    load_warehouse(rows.where(F.col("season") <= EARLY), store)
    load_warehouse(rows, store)
    newest = rows.where(F.col("season") == _newest(rows))
    load_warehouse(newest.withColumn("goals", F.col("goals") + 1), store, mode="upsert")
    mart = spark.newSession().table(f"{database}.{TEAM_MART}").select("season", "team_title", "total_goals")
    mart = materialise(mart, "mart")
    spark.sql(f"drop database {database} cascade")
    return mart
