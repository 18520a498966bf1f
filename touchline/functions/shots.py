"""Labels, scores and colours of the match view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker colour per shot result, and the colour of any other result.
RESULT_COLOURS = {
    "MissedShots": "red",
    "BlockedShot": "blue",
    "Goal": "orange",
    "SavedShot": "yellow",
}
OTHER_COLOUR = "gray"


def match_title() -> Column:
    return F.concat("h_team", F.lit(" vs "), "a_team")


def match_label() -> Column:
    """``home vs away (yyyy-mm-dd)``; null as soon as one part is null."""
    day = F.split_part("date", F.lit(" "), F.lit(1))
    return F.concat(match_title(), F.lit(" ("), day, F.lit(")"))


def score_line(home: Column, away: Column) -> Column:
    """``2.0, 1.0`` -> ``2 - 1``."""
    return F.concat(home.try_cast("int").cast("string"), F.lit(" - "), away.try_cast("int").cast("string"))


def result_colour() -> Column:
    colours = F.create_map(*(F.lit(x) for pair in RESULT_COLOURS.items() for x in pair))
    return F.coalesce(F.element_at(colours, F.col("result")), F.lit(OTHER_COLOUR))
