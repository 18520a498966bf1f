"""Football-shaped views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.schemas import RAW, SHOT

# Routes of the stand-in leagues, in place of the real league names.
ROUTES = {"csv": ["AFRICA", "AMERICA", "ASIA"], "jsonl": ["EUROPE"], "api": ["MIDDLE EAST"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def player_seasons_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and order year.

    Order lines are summed per order before they meet the orders, and per customer and year before
    they meet the customers: the lines move once, on the key they are usually stored by, and every
    later step sees sums only. It also turns the distinct count of orders into a plain one.
    """

    def count_lines(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    discount = F.round(F.col("l_discount") * 100, 0).cast("int")
    tax = F.round(F.col("l_tax") * 100, 0).cast("int")
    finished = F.col("l_linestatus") == "F"
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            count_lines(F.col("l_returnflag") == "R").alias("goals"),
            count_lines(F.col("l_returnflag") == "A").alias("assists"),
            F.sum(discount).alias("xG"),
            F.sum(tax).alias("xA"),
            F.count("*").alias("shots"),
            count_lines(F.col("l_linestatus") == "O").alias("key_passes"),
            count_lines(F.col("l_discount") >= 0.075).alias("yellow_cards"),
            count_lines(F.col("l_tax") >= 0.075).alias("red_cards"),
            count_lines((F.col("l_returnflag") == "R") & finished).alias("npg"),
            F.sum(F.when(finished, discount).otherwise(0)).alias("npxG"),
            F.sum("l_linenumber").alias("chain"),
            F.max("l_linenumber").alias("buildup"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")
    )
    totals = ("quantity", "goals", "assists", "xG", "xA", "shots", "key_passes", "yellow_cards",
              "red_cards", "npg", "npxG", "chain")
    per_season = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "year")
        .agg(
            F.count("*").alias("games"),
            *(F.sum(c).alias(c) for c in totals),
            F.max("buildup").alias("buildup"),
        )
    )
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    idle = (F.col("c_custkey") % 13).isin(0, 5)

    def share(name):
        return F.when(idle, F.lit(0.0)).otherwise(F.col(name).cast("double") / 100)

    year = F.col("year")
    columns = {
        "league": F.col("r_name"),
        "season": F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string")),
        "player_id": F.col("c_custkey"),
        "player_name": F.col("c_name"),
        "team_title": F.when(
            F.col("c_custkey") % 11 == 0, F.concat("n_name", F.lit(",LOAN_"), "r_name")
        ).otherwise(F.col("n_name")),
        "position": F.col("c_mktsegment"),
        "time": F.floor(F.col("quantity") / 10),
        "xG": share("xG"),
        "xA": share("xA"),
        "npxG": share("npxG"),
        "xGChain": F.col("chain").cast("double") / 10,
        "xGBuildup": F.col("buildup").cast("double") / 10,
    }
    joined = per_season.join(places, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        *(columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RAW)
    )


def shot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shot per event, with coordinates from 0 to 1. A week of the year stands in for the season."""
    user = F.col("user_id")

    def team(shift):
        return F.concat(F.lit("T"), ((user + shift) % 20).cast("string"))

    kind = F.col("event_type")
    columns = {
        "X": F.least(F.col("value") / 500.0, F.lit(1.0)),
        "Y": (F.col("event_id") % 97).cast("double") / 97,
        "a_goals": user % 3,
        "a_team": team(7),
        "date": F.concat(F.col("ts").cast("date").cast("string"), F.lit(" 20:00:00")),
        "h_goals": user % 4,
        "h_team": team(0),
        "id": F.col("event_id"),
        "league": F.concat(F.lit("L"), (user % 5).cast("string")),
        "match_id": user,
        "result": F.when(kind == "purchase", "Goal")
        .when(kind == "view", "SavedShot")
        .when(kind == "click", "MissedShots")
        .when(kind == "error", "BlockedShot")
        .otherwise("ShotOnPost"),
        "season": F.concat(
            F.year("ts").cast("string"), F.lit("-W"), F.floor((F.dayofyear("ts") - 1) / 7).cast("string")
        ),
    }
    return table(spark, sf_dir, "events").select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in SHOT)
    )
