"""The registered queries as plain SQL over the driver's tables, for comparison."""

from __future__ import annotations

from touchline.plans.registry import EARLY, FILE_LEAGUES
from touchline.schemas import CLEAN, FACT, FACT_KEYS, MEASURES, RAW, SHOT

_RAW = """
raw as (
select r_name as league,
  cast(year(o_orderdate) as varchar) || '-' || cast(year(o_orderdate) + 1 as varchar) as season,
  cast(c_custkey as int) as player_id, c_name as player_name,
  case when c_custkey % 11 = 0 then n_name || ',' || 'LOAN_' || r_name else n_name end as team_title,
  c_mktsegment as position,
  cast(count(distinct o_orderkey) as int) as games,
  cast(floor(sum(l_quantity) / 10) as int) as time,
  cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as int) as goals,
  cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as int) as assists,
  case when c_custkey % 13 in (0, 5) then cast(0 as double)
       else cast(sum(cast(round(l_discount * 100, 0) as int)) as double) / 100 end as xG,
  case when c_custkey % 13 in (0, 5) then cast(0 as double)
       else cast(sum(cast(round(l_tax * 100, 0) as int)) as double) / 100 end as xA,
  cast(count(*) as int) as shots,
  cast(sum(case when l_linestatus = 'O' then 1 else 0 end) as int) as key_passes,
  cast(sum(case when l_discount >= 0.075 then 1 else 0 end) as int) as yellow_cards,
  cast(sum(case when l_tax >= 0.075 then 1 else 0 end) as int) as red_cards,
  cast(sum(case when l_returnflag = 'R' and l_linestatus = 'F' then 1 else 0 end) as int) as npg,
  case when c_custkey % 13 in (0, 5) then cast(0 as double)
       else cast(sum(case when l_linestatus = 'F' then cast(round(l_discount * 100, 0) as int) else 0 end)
                 as double) / 100 end as npxG,
  cast(sum(l_linenumber) as double) / 10 as xGChain,
  cast(max(l_linenumber) as double) / 10 as xGBuildup
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by r_name, year(o_orderdate), c_custkey, c_name, n_name, c_mktsegment
)"""

_CLEAN = """
clean as (
select league, season, player_id, player_name, team_title, position, games, time, goals, assists, npg,
  coalesce(xG / nullif(xG + xA + npxG, 0) * 100, 0) as xG_percentage,
  coalesce(xA / nullif(xG + xA + npxG, 0) * 100, 0) as xA_percentage,
  coalesce(npxG / nullif(xG + xA + npxG, 0) * 100, 0) as npxG_percentage,
  shots, cast(shots - goals as int) as missed_shots, key_passes, yellow_cards, red_cards
from raw where not contains(team_title, ',')
)"""

_KEYED = """
keyed as (
select *,
  cast(dense_rank() over (order by league) - 1 as int) as league_id,
  cast(dense_rank() over (order by season) - 1 as int) as season_id,
  cast(dense_rank() over (order by team_title) - 1 as int) as team_id,
  cast(dense_rank() over (order by position) - 1 as int) as position_id
from clean
)"""

_ORDER = "season_id, league_id, player_id, team_id, position_id"
_LABEL_ORDER = "season, league, player_id, team_title, position"
_LINE = ", ".join(MEASURES)

_FACT = f"""
fact as (
select cast(row_number() over (order by {_ORDER}) - 1 as bigint) as pstatistics_id, * from keyed
)"""

_NUMBERED = f"""
placed as (select *, row_number() over (order by {_LABEL_ORDER}) as pos from keyed),
first_seen as (select *, min(pos) over (partition by {_LINE}) as first_pos from placed),
numbered as (
select *, cast(dense_rank() over (order by first_pos) - 1 as bigint) as pstatistics_id from first_seen
)"""

_SHOTS = """
shots as (
select least(value / 500.0, 1.0) as X, cast(event_id % 97 as double) / 97 as Y,
  cast(user_id % 3 as double) as a_goals, 'T' || cast((user_id + 7) % 20 as varchar) as a_team,
  cast(cast(ts as date) as varchar) || ' 20:00:00' as date,
  cast(user_id % 4 as double) as h_goals, 'T' || cast(user_id % 20 as varchar) as h_team,
  cast(event_id as double) as id, 'L' || cast(user_id % 5 as varchar) as league,
  cast(user_id as double) as match_id,
  case event_type when 'purchase' then 'Goal' when 'view' then 'SavedShot'
    when 'click' then 'MissedShots' when 'error' then 'BlockedShot' else 'ShotOnPost' end as result,
  cast(year(ts) as varchar) || '-W' || cast((dayofyear(ts) - 1) // 7 as varchar) as season
from events
)"""

_AWKWARD = """
awkward as (
select * replace (
  player_name || ' "Jr", N/A' as player_name,
  case when player_id % 7 <> 0 then position end as position,
  case when player_id % 17 <> 0 then xG end as xG,
  case when player_id % 19 <> 0 then games end as games)
from raw
)"""

_PARTS = {
    "raw": [_RAW],
    "clean": [_RAW, _CLEAN],
    "keyed": [_RAW, _CLEAN, _KEYED],
    "fact": [_RAW, _CLEAN, _KEYED, _FACT],
    "numbered": [_RAW, _CLEAN, _KEYED, _NUMBERED],
    "shots": [_SHOTS],
    "awkward": [_RAW, _AWKWARD],
}


def _sql(parts: str, select: str) -> str:
    return "with " + ",".join(_PARTS[parts]) + "\n" + select


_raw_cols = ", ".join(RAW.names)
_clean_cols = ", ".join(CLEAN.names)
_fact_cols = ", ".join(FACT.names)
_shot_cols = ", ".join(SHOT.names)
_scaled_cols = ", ".join(f"{c} * 100 as {c}" if c in ("X", "Y") else c for c in SHOT.names)

_all_raw = _sql("raw", f"select {_raw_cols} from raw")
_all_clean = _sql("clean", f"select {_clean_cols} from clean")
_all_fact = _sql("fact", f"select {_fact_cols} from fact")
# A player as compact JSON, without the braces; an id that is divisible by five is left out.
_api_item = " || ',' || ".join(
    f"""'"{f.name}":"' || {f.name} || '"'"""
    if f.dataType.simpleString() == "string"
    else f"""'"{f.name}":' || cast({f.name} as varchar)"""
    for f in RAW
    if f.name != "player_id"
).replace("""'"player_name":""", """case when player_id % 5 <> 0 then '"player_id":' || player_id || ',' else '' end || '"player_name":""")
_newest = "(select max(season) from {0})"

_team_mart = _sql(
    "fact",
    """select league, season, team_title,
  cast(sum(goals) as bigint) as total_goals, cast(sum(assists) as bigint) as total_assists,
  round(avg(xG_percentage), 6) as avg_xG_percentage, round(avg(xA_percentage), 6) as avg_xA_percentage,
  cast(sum(shots) as bigint) as total_shots, cast(sum(missed_shots) as bigint) as total_missed_shots,
  cast(sum(yellow_cards) as bigint) as total_yellow_cards, cast(sum(red_cards) as bigint) as total_red_cards
from fact group by league, season, team_title""",
)

_labels = ("league", "season", "team_title", "position")
_label_values = " union ".join(f"select '{c}' as kind, {c} as value from clean" for c in _labels)

_file_league = (
    "case league " + " ".join(f"when '{k}' then '{v}'" for k, v in FILE_LEAGUES.items()) + " end"
)

_foreign_keys = (
    ("DimLeague", "league_id"),
    ("DimSeason", "season_id"),
    ("DimPlayer", "player_id"),
    ("DimTeam", "team_id"),
    ("DimPosition", "position_id"),
)


def _table_counts(suffix: str) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, cast(count(distinct {key}) as bigint) as {suffix} from fact"
        for name, key in _foreign_keys
    )


_mart_after_loads = _sql(
        "keyed",
        f"""select season, team_title, cast(sum(goals + case when season = {_newest.format('clean')} then 1 else 0 end)
  as bigint) as total_goals from keyed group by season, team_title""",
)

_corrected_fact = _sql(
    "keyed",
    f"""select * replace (cast(goals + case when newest then 1 else 0 end as int) as goals) from (
  select cast(row_number() over (
  order by case when newest and player_id % 2 = 0 then 1 else 0 end, {_ORDER}) - 1 as bigint)
as pstatistics_id, {", ".join(FACT_KEYS)}, {_LINE}, newest
  from (select *, season = {_newest.format('clean')} as newest from keyed))""".replace(
        "select * replace", "select * exclude (newest) replace"
    ),
)

ORACLES: dict[str, str] = {
    # sources
    "scan_csv": _all_raw,
    "scan_csv_folder": _all_clean,
    "scan_csv_unlike_headers": _sql(
        "raw",
        """select * replace (
  case when player_id % 3 = 1 then null else xG end as xG,
  case when player_id % 3 = 2 then null else position end as position)
from raw""",
    ),
    "scan_league_tree": _sql("shots", f"select {_shot_cols} from shots"),
    "scan_jsonl": _all_raw,
    "scan_jsonl_quarantine": _sql(
        "raw",
        """select '{"torn": ' || cast(player_id as varchar) || ' ' || season as line
from raw where player_id % 13 = 0""",
    ),
    "scan_api_extract": _all_raw,
    "scan_api_pretty": _sql("raw", f"select {_raw_cols} from raw where cast(substr(season, 1, 4) as int) % 3 <> 0"),
    "scan_api_pretty_quarantine": _sql(
        "raw",
        """select season, count(*) as players from raw where cast(substr(season, 1, 4) as int) % 3 = 0
group by season, league""",
    ),
    "scan_optional": _all_raw,
    "scan_season": _sql("raw", f"select {_raw_cols} from raw where season = {_newest.format('raw')}"),
    "list_seasons": _sql("raw", "select distinct season from raw order by season"),
    "scan_legacy_lake": _all_raw,
    "list_legacy_seasons": _sql("raw", "select distinct season from raw"),
    "league_from_filename": _sql(
        "raw", f"select {_file_league} as league, player_id, games, goals from raw"
    ),
    "season_from_filename": _sql(
        "raw",
        """select '20' || substr(season, 3, 2) || '-20' || substr(season, 8, 2) as season,
  player_id, games, goals from raw""",
    ),
    # sinks
    "roundtrip_csv": _sql("awkward", f"select {_raw_cols} from awkward"),
    "roundtrip_json": _sql("awkward", f"select {_raw_cols} from awkward"),
    "lake_overwrite_season": _sql(
        "raw",
        f"""select * replace (
  cast(games + case when season = {_newest.format('raw')} then 1 else 0 end as int) as games)
from raw""",
    ),
    "export_season_csv": _all_clean,
    "load_league_table": _sql("raw", f"select {_raw_cols} from raw where league = 'MIDDLE EAST'"),
    "dim_insert_if_absent": _sql(
        "raw",
        f"""select player_id,
  player_name || case when min(season) <= '{EARLY}' then ' (old)' else '' end as player_name
from raw group by player_id, player_name""",
    ),
    "fact_insert_if_absent": _all_fact,
    "fact_insert_stat_line": _sql(
        "keyed",
        f"""select {_fact_cols} from (
  select *, cast(row_number() over (order by late, {_ORDER}) - 1 as bigint) as pstatistics_id
  from (
    select *, row_number() over (partition by {_LINE} order by {_ORDER}) as nth,
      case when season > '{EARLY}' then 1 else 0 end as late
    from keyed)
  where nth = 1)""",
    ),
    "upsert_last_record": _sql(
        "keyed",
        f"""select season_id, player_id,
  cast(goals + case when season = {_newest.format('clean')} then 2 else 0 end as int) as goals from keyed""",
    ),
    "scd1_upsert": _sql(
        "raw",
        f"""select player_id,
  player_name || case when max(season) >= '{EARLY}' then ' @' || max(season) else ' (old)' end as player_name
from raw group by player_id, player_name""",
    ),
    "scd1_fact_upsert": _corrected_fact,
    "scd1_fact_fold": _corrected_fact,
    "publish_json": _sql(
        "shots",
        f"""select {_shot_cols}, 'RightFoot' as "shotType", cast(id as bigint) % 90 as "minute",
  'OpenPlay' as situation, case when cast(id as bigint) % 3 <> 0 then 'A "B" C' end as player_assisted,
  'Pass' as "lastAction", cast(cast(id as bigint) % 100 as double) / 100 as "xG",
  'P' || cast(cast(id as bigint) % 50 as varchar) as player,
  case when cast(id as bigint) % 2 = 0 then 'h' else 'a' end as h_a, cast(id as bigint) % 50 as player_id
from shots""",
    ),
    # projections, filters, set operations
    "standardise_columns": _all_raw,
    "clean_players": _all_clean,
    "split_by_league": _sql(
        "raw",
        """select case when league in ('AFRICA', 'AMERICA') then 'csv' when league = 'EUROPE' then 'json'
  when league = 'MIDDLE EAST' then 'api' else 'unrouted' end as route, league, count(*) as rows
from raw group by 1, 2""",
    ),
    "drop_multi_team": _sql("raw", f"select {_raw_cols} from raw where not contains(team_title, ',')"),
    "unusable_rows": _sql(
        "raw",
        """select * from (select * replace (
  case when player_id % 7 <> 0 then team_title end as team_title,
  case when player_id % 10 <> 0 then player_id end as player_id) from raw)
where team_title is null or player_id is null""",
    ),
    "pct_share": _sql(
        "raw",
        """select season, player_id,
  coalesce(xG / nullif(xG + xA + npxG, 0) * 100, 0) as xG_percentage,
  coalesce(xA / nullif(xG + xA + npxG, 0) * 100, 0) as xA_percentage,
  coalesce(npxG / nullif(xG + xA + npxG, 0) * 100, 0) as npxG_percentage
from raw""",
    ),
    "missed_shots": _sql(
        "raw", "select season, player_id, shots, goals, cast(shots - goals as int) as missed_shots from raw"
    ),
    "union_sources": _sql(
        "raw",
        """select * replace (
  case when league in ('AFRICA', 'AMERICA', 'ASIA') then null else xGChain end as xGChain,
  case when league = 'EUROPE' then null else key_passes end as key_passes)
from raw""",
    ),
    "preview": _sql("raw", f"select {_raw_cols} from raw order by {_LABEL_ORDER} limit 5"),
    # ids, star schema, checks
    "assign_codes": _sql(
        "clean",
        f"""select kind, value, cast(row_number() over (partition by kind order by value) - 1 as int) as code
from ({_label_values})""",
    ),
    "assign_codes_stable": _sql(
        "clean",
        f"""select kind, value,
  cast(row_number() over (partition by kind order by case when known then 0 else 1 end, value) - 1 as int) as code
from (select kind, value, bool_or(old) as known from (
  {" union ".join(f"select '{c}' as kind, {c} as value, league in ('ASIA', 'EUROPE') as old from clean"
                  for c in _labels)}) group by kind, value)""",
    ),
    "factorize_stat_line": _sql("numbered", "select season, player_id, pstatistics_id from numbered"),
    "fact_keep_first": _sql("numbered", f"select {_fact_cols} from numbered where pos = first_pos"),
    "fact_build": _all_fact,
    "check_primary_keys": _sql(
        "fact",
        """select table_name, cast(duplicate_keys as bigint) as duplicate_keys, cast(0 as bigint) as null_keys
from (
  select 'DimPlayer' as table_name, count(distinct player_id) as duplicate_keys from fact where player_id % 10 = 0
  union all select t, 0 from (values ('DimLeague'), ('DimSeason'), ('DimTeam'), ('DimPosition'),
    ('FactPlayerStatistics')) v(t))""",
    ),
    "check_foreign_keys": _sql(
        "fact",
        """select 'DimTeam' as table_name, cast(count(distinct team_id) as bigint) as orphan_keys,
  cast(count(*) as bigint) as orphan_rows from fact where team_id % 5 = 0
union all select t, cast(0 as bigint), cast(0 as bigint)
from (values ('DimLeague'), ('DimSeason'), ('DimPlayer'), ('DimPosition')) v(t)""",
    ),
    # marts and dashboards
    "player_mart": _sql(
        "fact",
        f"select pstatistics_id, league, season, player_name, team_title, position, {_LINE} from fact",
    ),
    "team_mart": _team_mart,
    "top10_scoring_teams": _sql(
        "fact",
        """select team_title, cast(sum(goals) as bigint) as goals from fact
group by team_title order by goals desc, team_title limit 10""",
    ),
    "top5_card_teams": _sql(
        "fact",
        """select team_title, cast(sum(yellow_cards + red_cards) as bigint) as cards from fact
group by team_title order by cards desc, team_title limit 5""",
    ),
    "top10_chance_teams": _sql(
        "fact",
        """select team_title, cast(sum(key_passes) as bigint) as chances from fact
group by team_title order by chances desc, team_title limit 10""",
    ),
    "goals_per_league": _sql(
        "fact", "select league, cast(sum(goals) as bigint) as goals from fact group by league"
    ),
    "goals_missed_per_player": _sql(
        "fact",
        """select player_name, cast(sum(goals) as bigint) as goals,
  cast(sum(missed_shots) as bigint) as missed_shots from fact group by player_name""",
    ),
    "cards_per_player": _sql(
        "fact",
        """select player_name, cast(sum(red_cards) as bigint) as red_cards,
  cast(sum(yellow_cards) as bigint) as yellow_cards from fact group by player_name""",
    ),
    "top5_playing_time": _sql(
        "fact",
        """select player_name, cast(sum(time) as bigint) as time from fact
group by player_name order by sum(fact.time) desc, player_name limit 5""",
    ),
    # shots
    "parse_events": _sql("shots", f"select {_shot_cols} from shots"),
    "quarantine_events": _sql(
        "shots",
        """select 'not json ' || cast(cast(id as bigint) as varchar) as raw_message
from shots where cast(id as bigint) % 50 = 0""",
    ),
    "scan_bad_events": _sql(
        "shots",
        """select 'not json ' || cast(cast(id as bigint) as varchar) as raw_message
from shots where cast(id as bigint) % 50 = 0""",
    ),
    "scale_coords": _sql("shots", "select id, X * 100 as X, Y * 100 as Y from shots"),
    "stream_shots": _sql("shots", f"select {_scaled_cols} from shots"),
    "compact_events": _sql("shots", f"select {_scaled_cols} from shots"),
    "events_snapshot": _sql("shots", f"select {_scaled_cols} from shots where cast(id as bigint) % 3 < 2"),
    "stream_topic": _sql("shots", f"select {_scaled_cols} from shots"),
    "publish_report": _sql(
        "shots",
        """select cast(cast(id as bigint) as varchar) as key,
  case when cast(id as bigint) % 10 = 0 then 'no value' when cast(id as bigint) % 11 = 0 then '5000 bytes' end as error,
  cast(id as bigint) % 10 <> 0 and cast(id as bigint) % 11 <> 0 as sent from shots""",
    ),
    "stream_shots_deduped": _sql("shots", f"select {_scaled_cols} from shots where cast(id as bigint) % 17 <> 0"),
    "stream_into_memory": _sql("shots", "select league, count(*) as shots from shots group by league"),
    "scan_events": _sql("shots", "select id, match_id, season, league, result from shots"),
    "distinct_leagues": _sql("shots", "select distinct league from shots"),
    "distinct_seasons": _sql("shots", "select distinct season from shots"),
    "match_label": _sql(
        "shots",
        """select id, h_team || ' vs ' || a_team || ' (' || split_part(date, ' ', 1) || ')' as match_identifier
from shots""",
    ),
    "match_list": _sql(
        "shots",
        """select min_by(h_team || ' vs ' || a_team || ' (' || split_part(date, ' ', 1) || ')', id) as label,
  match_id as value from shots group by match_id""",
    ),
    "shot_map": _sql(
        "shots",
        """select league, season, match_id, id, X * 100 as X, Y * 100 as Y, result,
  case result when 'MissedShots' then 'red' when 'BlockedShot' then 'blue' when 'Goal' then 'orange'
    when 'SavedShot' then 'yellow' else 'gray' end as colour
from shots""",
    ),
    "first_match_shots": _sql(
        "shots",
        """select league, season, match_id, id, X, Y, result,
  case result when 'MissedShots' then 'red' when 'BlockedShot' then 'blue' when 'Goal' then 'orange'
    when 'SavedShot' then 'yellow' else 'gray' end as colour
from shots where match_id = (select min_by(match_id, id) from shots)
  and season = (select min_by(season, id) from shots) and league = (select min_by(league, id) from shots)""",
    ),
    "match_outcome": _sql(
        "shots",
        """select league, season, match_id, min_by(h_team || ' vs ' || a_team, id) as title,
  min_by(cast(cast(h_goals as int) as varchar) || ' - ' || cast(cast(a_goals as int) as varchar), id) as outcome
from shots group by league, season, match_id""",
    ),
    # jobs
    "warehouse_build": _sql(
        "fact",
        _table_counts("rows")
        + " union all select 'FactPlayerStatistics', cast(count(*) as bigint) from fact",
    ),
    "run_batch": _team_mart,
    "run_batch_quarantine": _sql(
        "raw",
        """select 'csv' as source, cast(0 as bigint) as rows, cast(0 as bigint) as set_aside
union all select 'jsonl', count(*), count(*) filter (player_id % 13 = 0) from raw where league = 'EUROPE'
union all select 'api', count(*) filter (player_id % 7 <> 0), count(*) filter (player_id % 7 = 0)
  from raw where league = 'MIDDLE EAST'
union all select 'lake', count(*) filter (league = 'EUROPE' or player_id % 7 <> 0),
  count(*) filter (league = 'MIDDLE EAST' and player_id % 7 <> 0 and player_id % 5 = 0)
  from raw where league in ('EUROPE', 'MIDDLE EAST')""",
    ),
    "batch_bad_lines": _sql(
        "raw",
        f"""select 'jsonl' as source, '{{"torn": ' || cast(player_id as varchar) || ' ' || season as line
from raw where league = 'EUROPE' and player_id % 13 = 0
union all
select 'api', '[{{' || {_api_item} || '}}' from raw where league = 'MIDDLE EAST' and player_id % 7 = 0""",
    ),
    "mart_after_loads": _mart_after_loads,
    "mart_in_catalog": _mart_after_loads,
}
