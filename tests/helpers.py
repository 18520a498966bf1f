from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.schemas import CLEAN, RAW


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df: DataFrame, mode: str = "FORMATTED") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def raw_row(**given):
    base = dict(
        league="epl", season="2014-2015", player_id=1, player_name="Ann", team_title="A", position="F",
        games=1, time=90, goals=1, assists=0, xG=1.0, xA=1.0, shots=3, key_passes=2, yellow_cards=0,
        red_cards=0, npg=1, npxG=2.0, xGChain=0.1, xGBuildup=0.2,
    )
    return tuple((base | given)[name] for name in RAW.names)


def raw_frame(spark, *given) -> DataFrame:
    return spark.createDataFrame([raw_row(**g) for g in given], RAW)


def clean_row(**given):
    base = dict(
        league="epl", season="2014-2015", player_id=1, player_name="Ann", team_title="A", position="F",
        games=1, time=90, goals=1, assists=0, npg=1, xG_percentage=25.0, xA_percentage=25.0,
        npxG_percentage=50.0, shots=3, missed_shots=2, key_passes=2, yellow_cards=0, red_cards=0,
    )
    return tuple((base | given)[name] for name in CLEAN.names)


def clean_frame(spark, *given) -> DataFrame:
    return spark.createDataFrame([clean_row(**g) for g in given], CLEAN)
