"""Star schema of the player seasons: five dimensions and one fact."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ids import (
    assign_codes,
    attach_codes,
    codes_of,
    dense_ids,
    keep_first,
    keep_last,
    line_hash,
)
from touchline.operators.joins import fits_broadcast
from touchline.schemas import (
    DIM_LEAGUE,
    DIM_PLAYER,
    DIM_POSITION,
    DIM_SEASON,
    DIM_TEAM,
    FACT,
    GRAIN_KEYS,
    KEY_ORDER,
    LABEL_KEYS,
    LOAD_ORDER,
    MEASURES,
    ROW_ORDER,
)
from touchline.session import materialise

LABEL_DIMENSIONS = {
    "league": DIM_LEAGUE,
    "season": DIM_SEASON,
    "team_title": DIM_TEAM,
    "position": DIM_POSITION,
}


def dim_player(clean: DataFrame) -> DataFrame:
    """Players by their own id, with the first name seen."""
    rows = clean.select("player_id", "player_name", *(c for c in ROW_ORDER if c != "player_id"))
    order = [c for c in ROW_ORDER if c != "player_id"]
    return keep_first(rows, ["player_id"], order).select("player_id", "player_name")


def label_dims(book: DataFrame) -> dict[str, DataFrame]:
    """The four dimensions with generated ids."""
    return {
        name: codes_of(book, column, LABEL_KEYS[column]) for column, name in LABEL_DIMENSIONS.items()
    }


def keyed_rows(clean: DataFrame, book: DataFrame, small: bool | None = None) -> DataFrame:
    """Clean rows with their four generated keys; no row moves while the codebook is small."""
    return attach_codes(clean, book, LABEL_KEYS, small)


def fact_rows_by_grain(keyed: DataFrame, last: bool = False) -> DataFrame:
    """One row per league, season, player, team and position, without a row id yet.

    If a grain comes more than once, the smallest measures stay, or with ``last`` the row that was
    loaded last; ``load_order`` tells, if ``keyed`` has it, and the greatest measures among equals.
    """
    if not last:
        return keep_first(keyed.select(*GRAIN_KEYS, *MEASURES), GRAIN_KEYS, [])
    order = [LOAD_ORDER] if LOAD_ORDER in keyed.columns else []
    rows = keep_last(keyed.select(*GRAIN_KEYS, *order, *MEASURES), GRAIN_KEYS, order)
    return rows.select(*GRAIN_KEYS, *MEASURES)


def fact_rows_by_line(keyed: DataFrame) -> DataFrame:
    """One row per distinct measure tuple, with the keys it appears with first; no row id yet."""
    first = F.min(F.struct(*KEY_ORDER)).alias("_at")
    return keyed.groupBy(line_hash(), *MEASURES).agg(first).select(*MEASURES, "_at.*")


def number_lines(lines: DataFrame) -> DataFrame:
    """Number the rows of :func:`fact_rows_by_line` by first appearance."""
    return dense_ids(lines, [*KEY_ORDER, *MEASURES], "pstatistics_id").select(*FACT.names)


def fact_keep_first(keyed: DataFrame, key: str = "grain") -> DataFrame:
    """The fact table with its row id.

    ``grain`` keeps every player season. ``stat_line`` numbers the distinct measure tuples and keeps
    the first row of each, so that players with equal numbers share one row; it exists for
    compatibility. Both number rows by first appearance. Keys rank like their labels, so the order
    is taken from the keys.
    """
    if key == "grain":
        rows = fact_rows_by_grain(keyed)
        return dense_ids(rows, KEY_ORDER, "pstatistics_id").select(*FACT.names)
    if key != "stat_line":
        raise ValueError(f"unknown fact key {key!r}")
    return number_lines(fact_rows_by_line(keyed))


class Star:
    """Dimensions and fact of one run, with ids from this run alone. Parts are built when asked for."""

    def __init__(self, clean: DataFrame, key: str = "grain") -> None:
        self.clean = clean
        self.key = key

    @cached_property
    def book(self) -> DataFrame:
        return assign_codes(self.clean, list(LABEL_KEYS))

    @cached_property
    def small(self) -> dict[str, bool]:
        """Which dimensions may be broadcast. One measure of the codebook answers for its four."""
        fits = fits_broadcast({"book": self.book})["book"]
        return {name: fits for name in LABEL_DIMENSIONS.values()}

    @cached_property
    def label_dims(self) -> dict[str, DataFrame]:
        return label_dims(self.book)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return self.label_dims | {DIM_PLAYER: materialise(dim_player(self.clean), "players")}

    @property
    def keyed(self) -> DataFrame:
        return keyed_rows(self.clean, self.book, all(self.small.values()))

    @property
    def rows(self) -> DataFrame:
        """Fact rows by grain without row ids."""
        return fact_rows_by_grain(self.keyed)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_keep_first(self.keyed, self.key)
