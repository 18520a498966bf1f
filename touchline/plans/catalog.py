"""Tables and marts as views of the session catalog, which every session that shares it sees.

A view is SQL over the folders that the last commit names, so it is the same for all sessions, replaced as
a whole, and needs nothing registered. Loads write the views anew; folders that a commit replaced stay for
readers that began before (see :mod:`touchline.sources.tables`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import types as T

from touchline.plans.warehouse import Warehouse, season_of
from touchline.schemas import (
    DIM_LEAGUE,
    DIM_PLAYER,
    DIM_POSITION,
    DIM_SEASON,
    DIM_TEAM,
    DIMENSIONS,
    FACT,
    FACT_TABLE,
    MEASURES,
    PLAYER_MART,
    PUBLISHED,
    TEAM_MART,
)
from touchline.sources import commits
from touchline.sources.tables import log_of

_SEASON_KEY = "season_id"


def _columns(schema: T.StructType, given: dict[str, str]) -> str:
    return ", ".join(
        f"cast({given.get(f.name, f'`{f.name}`')} as {f.dataType.simpleString()}) as `{f.name}`" for f in schema
    )


def _union(schema: T.StructType, folders: Sequence[tuple[str, dict[str, str]]]) -> str:
    """The rows of all folders; ``folders`` have what the folder's name gives for some columns."""
    if not folders:
        return f"select {_columns(schema, dict.fromkeys(schema.names, 'null'))} where false"
    return " union all ".join(f"select {_columns(schema, given)} from parquet.`{path}`" for path, given in folders)


def _dimension(store: Warehouse, name: str) -> str:
    parts = commits.state(store.spark, log_of(store.path(name))).parts
    return _union(DIMENSIONS[name], [(f"{store.path(name)}/part={p.id}", {}) for p in parts])


def _fact(store: Warehouse) -> str:
    """Plain folders only: seasons with changed rows are written anew first."""
    state = store.fact_state()
    while any(p.order for p in state.parts):
        store.fold()
        state = store.fact_state()
    places = [(store.fact_folder(p), season_of(p)) for p in state.parts]
    known = lambda season: season if season.lstrip("-").isdigit() else "null"
    return _union(FACT, [(path, {_SEASON_KEY: known(season)}) for path, season in places])


def _marts(database: str) -> dict[str, str]:
    at = lambda name: f"`{database}`.`{name}`"
    measures = ", ".join(f"f.{c}" for c in MEASURES)
    sums = ("goals", "assists", "shots", "missed_shots", "yellow_cards", "red_cards")
    means = ("xG_percentage", "xA_percentage")
    by_key = ", ".join(
        [f"sum({c}) as {c}" for c in sums + means] + [f"count({c}) as {c}_n" for c in means]
    )
    totals = {c: f"sum({c}) as total_{c}" for c in sums}
    averages = [f"try_divide(sum({c}), sum({c}_n)) as avg_{c}" for c in means]
    figures = ", ".join(
        [totals["goals"], totals["assists"], *averages, *(totals[c] for c in sums if c not in ("goals", "assists"))]
    )
    return {
        PLAYER_MART: f"""select f.pstatistics_id, l.league, s.season, p.player_name, t.team_title, o.position, {measures}
from {at(FACT_TABLE)} f join {at(DIM_LEAGUE)} l using (league_id) join {at(DIM_SEASON)} s using (season_id)
join {at(DIM_PLAYER)} p using (player_id) join {at(DIM_TEAM)} t using (team_id)
join {at(DIM_POSITION)} o using (position_id)""",
        TEAM_MART: f"""select league, season, team_title, {figures}
from (select league_id, season_id, team_id, {by_key} from {at(FACT_TABLE)} group by league_id, season_id, team_id)
join {at(DIM_LEAGUE)} using (league_id) join {at(DIM_SEASON)} using (season_id) join {at(DIM_TEAM)} using (team_id)
group by league, season, team_title""",
    }


def _write_views(store: Warehouse, database: str) -> None:
    tables = {name: _dimension(store, name) for name in DIMENSIONS} | {FACT_TABLE: _fact(store)}
    for name, sql in (tables | _marts(database)).items():
        store.spark.sql(f"create or replace view `{database}`.`{name}` as {sql}")


def publish(store: Warehouse, database: str = "default") -> None:
    """Make tables and marts views of ``database``, and have later loads of any session keep them current."""
    _write_views(store, database)
    log = log_of(store.path(PUBLISHED))
    commits.commit(
        store.spark, log, lambda s: None if database in s.marks else replace(s, marks=s.marks | {database: 1})
    )


def refresh(store: Warehouse) -> None:
    """After a load: write the views anew wherever they were published."""
    for database in commits.state(store.spark, log_of(store.path(PUBLISHED))).marks:
        _write_views(store, database)
