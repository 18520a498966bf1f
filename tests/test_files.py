from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import plan, raw_frame, raw_row, rows
from touchline.functions.values import NULL_TOKENS
from touchline.schemas import RAW
from touchline.sources import files, landing, pages


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def csv_text(*records, columns=None):
    columns = columns or RAW.names
    lines = [",".join(columns)]
    for given in records:
        values = dict(zip(RAW.names, raw_row(**{k: v for k, v in given.items() if k in RAW.names}))) | given
        lines.append(",".join("" if values[c] is None else str(values[c]) for c in columns))
    return "\n".join(lines) + "\n"


def test_csv_null_tokens(spark, tmp_path):
    path = write(tmp_path / "p.csv", csv_text(*({"position": t, "xG": t, "games": t} for t in NULL_TOKENS)))
    got = files.scan_csv(spark, path).select("position", "xG", "games").distinct()
    assert rows(got) == [(None, None, None)]


def test_csv_integers_written_as_floats(spark, tmp_path):
    path = write(tmp_path / "p.csv", csv_text({"games": "12.0", "shots": "abc"}))
    got = files.scan_csv(spark, path).first()
    assert (got.games, got.shots, got.goals) == (12, None, 1)


def test_csv_columns_go_by_name(spark, tmp_path):
    path = write(tmp_path / "p.csv", csv_text({"player_id": 7}, columns=[*reversed(RAW.names)]))
    assert rows(files.scan_csv(spark, path)) == [raw_row(player_id=7)]


def test_csv_missing_column_is_null(spark, tmp_path):
    path = write(tmp_path / "p.csv", csv_text({}, columns=[c for c in RAW.names if c != "xG"]))
    assert files.scan_csv(spark, path).first().xG is None


def test_csv_columns_in_another_order_go_by_name(spark, tmp_path):
    write(tmp_path / "f" / "a.csv", csv_text({}))
    write(tmp_path / "f" / "b.csv", csv_text({}, columns=[*reversed(RAW.names)]))
    got = files.scan_csv(spark, str(tmp_path / "f")).collect()
    assert len(got) == 2 and got[0] == got[1]


def test_csv_quotes_like_a_data_frame_writer(spark, tmp_path):
    text = csv_text({"player_name": '"O""Neil, ""Jr"""'})
    assert files.scan_csv(spark, write(tmp_path / "p.csv", text)).first().player_name == 'O"Neil, "Jr"'


def test_csv_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "p.csv", csv_text({"player_name": '"two\nlines"'}))
    assert files.scan_csv(spark, path, multi_line=True).first().player_name == "two\nlines"


def test_csv_folder_ignores_other_files(spark, tmp_path):
    for n in (1, 2):
        write(tmp_path / "f" / f"{n}.csv", csv_text({"player_id": n}))
    write(tmp_path / "f" / "notes.txt", "no table")
    assert sorted(r.player_id for r in files.scan_csv(spark, str(tmp_path / "f")).collect()) == [1, 2]


def test_csv_reads_only_needed_columns(spark, tmp_path):
    path = write(tmp_path / "p.csv", csv_text({}))
    assert "ReadSchema: struct<goals:string>" in plan(files.scan_csv(spark, path).select("goals"))


def test_league_tree_does_not_count_inputs_twice(spark, tmp_path):
    write(tmp_path / "epl" / "merged.csv", csv_text({}))
    write(tmp_path / "epl" / "shots" / "part.csv", csv_text({}))
    assert files.scan_csv_tree(spark, str(tmp_path), RAW).count() == 1


def test_tagged_files(spark, tmp_path):
    for name in ("shots_epl_14-15.csv", "shots_la_liga_15-16.csv"):
        write(tmp_path / name, csv_text({}, columns=[c for c in RAW.names if c not in ("league", "season")]))
    got = files.scan_tagged_csv(spark, str(tmp_path), RAW).select("league", "season")
    assert rows(got) == [("epl", "2014-2015"), ("la_liga", "2015-2016")]


def test_json_lines_and_quarantine(spark, tmp_path):
    good = '{"league":"epl","player_id":1,"games":12.0,"xG":NaN,"position":null}'
    path = write(tmp_path / "p.json", f"{good}\nnot json\n\n5\n" + '{"league":"epl"\n')
    got = files.scan_jsonl(spark, path)
    assert got.count() == 1
    assert got.select("league", "player_id", "games", "xG", "position", "npg").first() == ("epl", 1, 12, None, None, None)
    bad = files.bad_json_lines(spark, path)
    assert {r.line for r in bad.collect()} == {"not json", "5", '{"league":"epl"'}
    assert bad.count() == 3


def test_api_arrays(spark, tmp_path):
    path = write(tmp_path / "a.json", '[{"x":1,"goals":2,"league":"l"},{"league":"m"}]\n[{"league":"n"}]\n[]\n')
    got = files.scan_api_extract(spark, path).select("league", "goals")
    assert rows(got) == [("l", 2), ("m", None), ("n", None)]
    pretty = write(tmp_path / "b.json", '[\n  {"league": "l",\n   "goals": 2},\n  {"league": "m"}\n]\n')
    got = files.scan_api_extract(spark, pretty, pretty=True).select("league", "goals")
    assert rows(got) == [("l", 2), ("m", None)]


@pytest.mark.parametrize("read", [files.scan_csv, files.scan_jsonl, files.scan_api_extract])
def test_absent_source(spark, tmp_path, read):
    got = files.optional(read, spark, str(tmp_path / "nothing"))
    assert got.schema == RAW
    assert got.count() == 0


def test_optional_does_not_hide_other_errors(spark, tmp_path):
    def broken(spark, path, schema):
        return spark.range(1).select("no_such_column")

    with pytest.raises(Exception, match="no_such_column"):
        files.optional(broken, spark, str(tmp_path))


def test_json_writer_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    landing.write_jsonl(raw_frame(spark, {"position": None}), path)
    assert '"position":null' in spark.read.text(path).first().value


def test_lake_overwrites_only_seasons_that_come(spark, tmp_path):
    path = str(tmp_path / "lake")
    landing.write_lake(raw_frame(spark, {"season": "2014-2015"}, {"season": "2015-2016"}), path)
    landing.write_lake(raw_frame(spark, {"season": "2015-2016", "player_id": 5}), path)
    lake = files.scan_lake(spark, path)
    assert rows(lake.select("season", "player_id")) == [("2014-2015", 1), ("2015-2016", 5)]
    assert [r.season for r in files.list_seasons(spark, path).collect()] == ["2014-2015", "2015-2016"]
    assert files.list_seasons(spark, str(tmp_path / "none")).count() == 0
    text = plan(files.scan_season(spark, path, "2014-2015").select("goals"))
    assert "PartitionFilters: [isnotnull(season" in text
    assert "ReadSchema: struct<goals:int>" in text


def test_legacy_lake(spark, tmp_path):
    for season in ("2014-2015", "2015-2016"):
        folder = tmp_path / f"season{season}"
        folder.mkdir()
        columns = {name: [value] for name, value in zip(RAW.names, raw_row(season=season))}
        columns["games"] = [12.0 if season == "2014-2015" else 12]
        columns["__index_level_0__"] = [41]
        pq.write_table(pa.table(columns), folder / f"players_data_{season}.parquet")
    lake = files.scan_legacy_lake(spark, str(tmp_path))
    assert lake.columns == RAW.names
    assert rows(lake.select("season", "games")) == [("2014-2015", 12), ("2015-2016", 12)]
    assert rows(files.list_legacy_seasons(spark, str(tmp_path))) == [("2014-2015",), ("2015-2016",)]


def test_league_table_appends_one_league(spark, tmp_path):
    path = str(tmp_path / "t")
    df = raw_frame(spark, {"league": "serie_a"}, {"league": "epl"})
    landing.load_league_table(df, "serie_a", path)
    landing.load_league_table(df, "serie_a", path)
    assert [r.league for r in spark.read.parquet(path).collect()] == ["serie_a", "serie_a"]


def test_array_line_is_read_or_set_aside_never_both(spark, tmp_path):
    path = write(tmp_path / "p.json", '[{"league":"a"},{"league":"b"}]\n{"league":"c"}\n[{"league":"d"},5]\n')
    assert {r.league for r in files.scan_jsonl(spark, path).collect()} == {"a", "b", "c"}
    assert [r.line for r in files.bad_json_lines(spark, path).collect()] == ['[{"league":"d"},5]']


def test_files_with_unlike_headers(spark, tmp_path):
    write(tmp_path / "a.csv", "league,goals\nepl,1\n")
    write(tmp_path / "b.csv", "goals,player_name\n2,Ann\n")
    write(tmp_path / "c.csv", "league,goals\nbl,3\n")
    write(tmp_path / "empty.csv", "")
    got = files.scan_csv(spark, str(tmp_path)).select("league", "goals", "player_name")
    assert rows(got) == [("bl", 3, None), ("epl", 1, None), (None, 2, "Ann")]


def test_a_folder_without_files_has_no_rows(spark, tmp_path):
    assert files.optional(files.scan_csv, spark, str(tmp_path)).count() == 0
    assert files.optional(files.scan_jsonl, spark, str(tmp_path)).count() == 0
    assert files.optional(files.scan_csv, spark, str(tmp_path / "absent")).schema == RAW


def test_only_whole_numbers_are_integers(spark, tmp_path):
    path = write(tmp_path / "p.json", '{"games":12.0}\n{"games":12.7}\n{"games":"x"}\n{"games":1e30}\n')
    assert [r.games for r in files.scan_jsonl(spark, path).collect()] == [12, None, None, None]


def test_rows_know_when_they_were_landed(spark, tmp_path):
    for n, stamp in ((1, 1_000_000_000), (2, 1_000_000_100)):
        os.utime(write(tmp_path / f"{n}.csv", csv_text({"player_id": n})), (stamp, stamp))
    got = files.scan_csv(spark, str(tmp_path), landed=True)
    assert rows(got.select("player_id", "load_order")) == [(1, 10**15), (2, 10**15 + 10**8)]


def bytes_read(spark):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")


def test_headers_cost_the_first_block_of_a_file(spark, tmp_path):
    line = ",".join(["x" * 20] * 4) + "\n"
    for n in range(3):
        write(tmp_path / f"{n}.csv", ("league,goals,a,b\n" if n else "goals,league\n") + line * 150_000)
    before = bytes_read(spark)
    headers = sorted(r.header for r in files._first_lines(spark, str(tmp_path)).collect())
    assert headers == ["goals,league"] + ["league,goals,a,b"] * 2
    assert bytes_read(spark) - before < 1_500_000 < (tmp_path / "1.csv").stat().st_size / 8


def test_headers_of_odd_files(spark, tmp_path):
    write(tmp_path / "a.csv", "\n\nleague,goals,Goals,player_name\nepl,1,2,Ann,more\n")  # goals twice: neither counts
    write(tmp_path / "b b.csv", "goals,player_name\n\n7\n8,Bo\n")
    write(tmp_path / "c.csv", "league\n")
    write(tmp_path / "d.csv", 'player_name,"league",`x`\n"a, b",bl,\n')
    got = files.scan_csv(spark, str(tmp_path), landed=True).select("league", "goals", "player_name")
    assert rows(got) == [("bl", None, "a, b"), ("epl", None, "Ann"), (None, 7, None), (None, 8, "Bo")]
    assert rows(files.scan_csv(spark, str(tmp_path / "d.csv")).select("league")) == [("bl",)]


def test_headers_are_joined_whatever_their_number(spark, tmp_path, monkeypatch):
    for n in range(6):
        columns = ["league", "goals", f"extra{n}"][: 2 + n % 2]
        write(tmp_path / f"{n}.csv", ",".join(reversed(columns) if n % 3 else columns) + "\n" + f"{n},{n},{n}\n" * 40)
    want = rows(files.scan_csv(spark, str(tmp_path)).select("league", "goals"))
    monkeypatch.setattr(files, "fits_broadcast", lambda tables: dict.fromkeys(tables, False))
    got = files.scan_csv(spark, str(tmp_path)).select("league", "goals")
    assert rows(got) == want and len(want) == 240


def test_files_that_python_does_not_reach_are_scanned(spark, tmp_path):
    write(tmp_path / "a.csv", "\nleague,goals\nepl,1\n")
    write(tmp_path / "b.csv", "goals,league\n2,bl\n")
    write(tmp_path / "empty.csv", "\n")
    want = rows(files._headers(spark, str(tmp_path))[0])
    assert [r[1] for r in want] == ["league,goals", "goals,league"]
    assert rows(files._first_lines_by_scan(spark, str(tmp_path))) == want
    path = f"viewfs://store{tmp_path}"
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./tmp", "file:///tmp")
    assert sorted(map(tuple, files.scan_csv(spark, path).select("league", "goals").collect())) == [("bl", 2), ("epl", 1)]


def test_an_indented_page_is_read_or_set_aside_as_a_file(spark, tmp_path):
    good = '[\n  {"league": "l",\n   "goals": 2},\n  {"league": "m"}\n]\n'
    torn = '[\n  {"league": "n",\n   "goals": 3},\n  {"leag'
    write(tmp_path / "a.json", good)
    write(tmp_path / "b.json", torn)
    write(tmp_path / "c.json", '[{"league": "o"}, 5]')
    write(tmp_path / "d.json", ' \n\t\r\n')
    write(tmp_path / "e.json", '\n {"league": "p"}\n')
    path = str(tmp_path)
    assert {r.league for r in files.scan_api_extract(spark, path, pretty=True).collect()} == {"l", "m", "p"}
    bad = files.bad_json_lines(spark, path, pretty=True).collect()
    assert sorted((r.line, r.file[-6:]) for r in bad) == [('[\n  {"league": "n",\n   "goals": 3},\n  {"leag', "b.json"), ('[{"league": "o"}, 5]', "c.json")]


def test_only_files_with_bad_lines_are_read_again(spark, tmp_path):
    for n in range(5):
        write(tmp_path / f"{n}.json", '{"league":"a"}\n' + ("not json\n" if n == 3 else ""))
    lines, seen = files.json_lines(spark, str(tmp_path)), Observation()
    assert files.json_rows(lines.observe(seen, *files.bad_line_figures())).count() == 5
    assert seen.get["bad"] == 1
    buckets = files.buckets_of(seen.get["files"])
    assert len(buckets) == 1
    only = F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(files._BUCKETS)).isin(buckets)
    assert {r.file[-6:] for r in files.json_lines(spark, str(tmp_path), only=only).collect()} == {"3.json"}
    assert [r.line for r in files.bad_json_lines(spark, str(tmp_path), buckets=buckets).collect()] == ["not json"]


def test_a_large_indented_page_is_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_WHOLE", 40)
    monkeypatch.setattr(pages, "_BLOCK_BITS", 3)
    objects = [{"league": f'l{n} }}, {{ [ " \\', "goals": n, "extra": [{"a": [n]}, {}]} for n in range(200)]
    indented = json.dumps(objects, indent=2)
    texts = {
        "indented": indented + "\n",
        "late": "\n \n" + indented.replace("\n  {\n", "\n\n  {\n"),
        "jackson": "[ " + ", ".join(json.dumps(x, indent=2) for x in objects) + " ]",
        "comma_first": "[\n" + "\n, ".join(json.dumps(x, indent=2) for x in objects) + "\n]",
        "crlf": indented.replace("\n", "\r\n"),
        "one_line": json.dumps(objects),
    }
    for name, text in texts.items():
        write(tmp_path / "good" / f"{name}.json", text)
    write(tmp_path / "good" / "blank.json", " \n" * 50)
    write(tmp_path / "good" / "after.json", indented + "\n[\n{\n}\n,\n{\n}\n" + "x\n" * 30)  # as in one text: not looked at
    write(tmp_path / "good" / "object.json", json.dumps({"league": "o", "extra": objects}, indent=1))
    read = files.json_lines(spark, str(tmp_path / "good"), pretty=True)
    pieces = read.groupBy("file").agg(F.count("*"), F.count("items"), F.flatten(F.collect_list("items")).alias("items"))
    found = {r.file.split("/")[-1][:-5]: r for r in pieces.collect()}
    assert found.keys() == {*texts, "after", "object"}
    for name, (_, n, whole, items) in found.items():
        assert n == whole and (n > 10) == (name not in ("one_line", "object")), name
        want = [("o", None)] if name == "object" else sorted((x["league"], str(x["goals"])) for x in objects)
        assert sorted((x.league, x.goals) for x in items) == want, name
    torn = {
        "end": indented[:-2],
        "cut": indented[: len(indented) // 2],
        "comma": indented.replace("  },\n  {", "  }\n  {", 1),
        "commas": indented.replace("  },\n  {", "  },,\n  {", 1),
        "last": indented[:-2] + ",\n]",
        "number": indented[:-2] + ",\n  5\n]",
        "break": indented.replace("l77 ", "l77\n", 1),
    }
    for name, text in torn.items():
        write(tmp_path / "torn" / f"{name}.json", text)
    read = files.json_lines(spark, str(tmp_path / "torn"), pretty=True)
    for _, items, value, file in read.groupBy("file").agg(F.count("items"), F.collect_list("value"), F.first("file")).collect():
        text = torn[file.split("/")[-1][:-5]]
        assert items == 0 and len(value) > 10 and sorted("".join(value).split()) == sorted(text.split()), file
