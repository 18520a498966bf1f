"""League and season from a file name such as ``shots_la_liga_14-15.csv``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First word of a league in a file name -> full league name.
LEAGUE_BY_WORD = {"la": "la_liga", "ligue": "ligue_1", "serie": "serie_a"}


def csv_name(path: Column) -> Column:
    """The ``*.csv`` part of a path: the file itself, or the folder Spark wrote under that name."""
    return F.regexp_extract(path, r"([^/=]+\.csv)(?:/|$)", 1)


def league_of(name: Column) -> Column:
    word = F.split_part(name, F.lit("_"), F.lit(2))
    known = F.create_map(*(F.lit(x) for pair in LEAGUE_BY_WORD.items() for x in pair))
    return F.coalesce(F.element_at(known, word), word)


def season_of(name: Column) -> Column:
    """``..._14-15.csv`` -> ``2014-2015``; null when the name carries no season."""

    def year(group: int) -> Column:
        digits = F.regexp_extract(name, r"_(\d\d)[^_.]*(\d\d)\.", group)
        return (digits.try_cast("int") + 2000).cast("string")

    return F.concat(year(1), F.lit("-"), year(2))
