"""The warehouse: five dimensions, a fact by season, two marts.

All tables change by commits. The fact consists of folders, each with rows of one season. An insert adds
folders; an upsert adds folders with the changed rows alone, which lie over the others until
:meth:`Warehouse.fold` writes their seasons anew. A load that another one has overtaken in its seasons
is told so and begins again.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.ids import codes_of
from touchline.operators.joins import fits_broadcast
from touchline.operators.load import last_rows, overlaid, prune_to
from touchline.operators.marts import player_mart, team_mart
from touchline.operators.star import LABEL_DIMENSIONS
from touchline.schemas import (
    DIMENSIONS,
    FACT,
    FACT_IDS,
    FACT_TABLE,
    LABEL_KEYS,
    LOAD_REPORT,
    PLAYER_MART,
    REPORT,
    TEAM_MART,
)
from touchline.sources import commits
from touchline.sources.commits import Part, State
from touchline.sources.paths import children
from touchline.sources.tables import (
    RETENTION,
    create_empty,
    current_version,
    log_of,
    read_parts,
    read_version,
    replace_version,
    reserve,
)


# Session setting: the warehouse whose views the session has.
_VIEWS_OF = "touchline.views"
_SEASON = "season_id="
# Stands for the part of folders that lie in the table itself, from before it had a log.
_OLD = "old"
_FACT_WITH_PART = T.StructType([*FACT, T.StructField("part", T.StringType())])


def season_of(part: Part) -> str:
    """The season key in the name of a fact folder."""
    return part.id.rpartition("/")[2].removeprefix(_SEASON)


@dataclass(frozen=True)
class Warehouse:
    """Five dimensions and a fact below ``root``."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> None:
        """Create the tables that are absent, empty; existing ones are left alone.

        Loading does not need this: an absent table reads as an empty one.
        """
        for name in DIMENSIONS:
            create_empty(self.spark, self.path(name))
        create_empty(self.spark, self.path(FACT_TABLE))

    def version(self, name: str) -> int:
        return current_version(self.spark, self.path(name))

    def dim(self, name: str) -> DataFrame:
        return read_version(self.spark, self.path(name), DIMENSIONS[name])

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.dim(name) for name in DIMENSIONS}

    def fact_state(self) -> State:
        """The folders of the fact; those of a table that is older than its log are all plain."""
        path = self.path(FACT_TABLE)
        state = commits.state(self.spark, log_of(path))
        if state.version == 0:
            seasons = [n for n in children(self.spark, path) if n.startswith(_SEASON)]
            state = replace(state, parts=tuple(Part(f"{_OLD}/{n}") for n in sorted(seasons)))
        return state

    def fact_folder(self, part: Part) -> str:
        place = part.id.removeprefix(f"{_OLD}/") if part.id.startswith(f"{_OLD}/") else f"part={part.id}"
        return f"{self.path(FACT_TABLE)}/{place}"

    def _read_fact(self, parts: Sequence[Part]) -> DataFrame:
        path, frames = self.path(FACT_TABLE), []
        old = [p for p in parts if p.id.startswith(f"{_OLD}/")]
        new = [p for p in parts if not p.id.startswith(f"{_OLD}/")]
        if new or not old:
            frames.append(read_parts(self.spark, path, _FACT_WITH_PART, new))
        if old:
            reader = self.spark.read.schema(FACT).option("basePath", path)
            rows = reader.parquet(*map(self.fact_folder, old))
            frames.append(rows.withColumn("part", F.lit(_OLD)).select(*_FACT_WITH_PART.names))
        return reduce(DataFrame.unionByName, frames)

    def fact(self, seasons: DataFrame | None = None, state: State | None = None) -> DataFrame:
        """The fact, or the rows of ``seasons`` (a stored table of season_id), whose folders alone are read.

        Seasons without changed rows are a plain scan. In the others the last of the rows with one id counts.
        """
        state = state or self.fact_state()
        changed = {season_of(p) for p in state.parts if p.order}
        some = lambda parts: (
            self._read_fact(parts) if seasons is None else prune_to(self._read_fact(parts), seasons, "season_id")
        )
        plain = some([p for p in state.parts if season_of(p) not in changed]).select(*FACT.names)
        if not changed:
            return plain
        over = [p for p in state.parts if p.order]
        orders = {p.id.split("/")[0]: p.order for p in over}
        order = F.create_map(*(F.lit(x) for pair in orders.items() for x in pair))
        last = last_rows(some(over).withColumn("_order", order[F.col("part")]), "_order")
        under = some([p for p in state.parts if not p.order and season_of(p) in changed]).select(*FACT.names)
        return plain.unionByName(overlaid(under, last))

    def codebook(self) -> DataFrame:
        """The four label dimensions as one ``(kind, value, code)`` table."""
        parts = (
            self.dim(name).select(
                F.lit(column).alias("kind"),
                F.col(column).alias("value"),
                F.col(LABEL_KEYS[column]).alias("code"),
            )
            for column, name in LABEL_DIMENSIONS.items()
        )
        return reduce(DataFrame.unionByName, parts)

    def new_labels(self, book: DataFrame, column: str) -> DataFrame:
        """Rows of ``book`` that the dimension of ``column`` does not have yet."""
        key = LABEL_KEYS[column]
        return codes_of(book, column, key).join(self.dim(LABEL_DIMENSIONS[column]), key, "left_anti")

    def reserve_ids(self, count: int) -> int:
        """The first of ``count`` row ids that no load has used; the next load begins after them.

        Numbers are claimed by a commit before rows are written: two loads never get the same, and a load
        that dies leaves a gap. Only a fact from before there was a log of ids is looked through.
        """
        first = 0
        if current_version(self.spark, self.path(FACT_IDS)) == 0 and self.fact_state().parts:
            highest = self.fact().agg(F.max("pstatistics_id")).first()[0]
            first = 0 if highest is None else highest + 1
        return reserve(self.spark, self.path(FACT_IDS), count, first)

    def numbered(self, rows: DataFrame) -> DataFrame:
        """``rows``, whose ids count from 0 and which are stored, with ids of the warehouse."""
        start = self.reserve_ids(rows.count())
        return rows.withColumn("pstatistics_id", F.col("pstatistics_id") + start).select(*FACT.names)

    def add_to_fact(self, new: DataFrame, seen: State, over: DataFrame | None = None, whole: bool = False) -> bool:
        """Commit ``new`` rows, and rows that lie ``over`` those of equal id, as folders by season.

        ``seen`` is the state that the rows were made from. If another load has since changed a season that
        they have (with ``whole``, any season), nothing is committed and False returned.
        """
        path = self.path(FACT_TABLE)
        plain, changed = self._write_fact(new), [] if over is None else self._write_fact(over)
        if not plain and not changed:
            return True
        mine = {season_of(p) for p in (*plain, *changed)}

        def added(state: State) -> State | None:
            state = seen if state.version == 0 else state
            if any(whole or season_of(Part(i)) in mine for i in set(state.ids) ^ set(seen.ids)):
                return None
            on_top = (replace(p, order=state.version + 1) for p in changed)
            return replace(state, parts=(*state.parts, *plain, *on_top))

        done = commits.commit(self.spark, log_of(path), added) is not None
        commits.clean(self.spark, log_of(path), [path], RETENTION)
        return done

    def _write_fact(self, df: DataFrame) -> list[Part]:
        """A new folder for every season in ``df``, which no reader sees yet.

        The rebalance makes few large files per season; a season far above the others is split at run time.
        """
        path, part = self.path(FACT_TABLE), uuid.uuid4().hex
        df.hint("rebalance", "season_id").write.partitionBy("season_id").parquet(f"{path}/part={part}")
        names = (n for n in children(self.spark, f"{path}/part={part}") if n.startswith(_SEASON))
        return [Part(f"{part}/{n}") for n in sorted(names)]

    def fold(self, at_least: int = 1) -> int:
        """Write the seasons anew that have ``at_least`` folders of changed rows; how many were.

        Loads beside it that touch such a season win: the fold then changes nothing and can be run again.
        """
        seen = self.fact_state()
        often = Counter(season_of(p) for p in seen.parts if p.order)
        seasons = {season for season, n in often.items() if n >= at_least}
        if not seasons:
            return 0
        mine = [p for p in seen.parts if season_of(p) in seasons]
        new = self._write_fact(self.fact(state=replace(seen, parts=tuple(mine))))

        def folded(state: State) -> State | None:
            if any(season_of(Part(i)) in seasons for i in set(state.ids) ^ set(seen.ids)):
                return None
            rest = state.without({p.id for p in mine})
            return replace(rest, parts=(*rest.parts, *new))

        done = commits.commit(self.spark, log_of(self.path(FACT_TABLE)), folded)
        return len(seasons) if done else 0

    def player_mart(self) -> DataFrame:
        return player_mart(self.fact(), self.dims())

    def team_mart(self) -> DataFrame:
        return team_mart(self.fact(), self.dims())

    def register_views(self) -> None:
        """Make tables and marts known to SQL by name. Loads through this class refresh them."""
        dims, fact = self.dims(), self.fact()
        small = fits_broadcast(dims)
        views = dims | {
            FACT_TABLE: fact,
            PLAYER_MART: player_mart(fact, dims, small),
            TEAM_MART: team_mart(fact, dims, small),
        }
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        self.spark.conf.set(_VIEWS_OF, self.root)

    def refresh_views(self) -> None:
        """After a load: the views of this session see the new files, and joins the new sizes.

        Another session asks for its views again, as after any change of files behind a view.
        """
        if self.spark.conf.get(_VIEWS_OF, None) == self.root:
            self.register_views()

    def report(self, counts: DataFrame) -> None:
        """Keep what the last run read; see :func:`load_report`."""
        replace_version(counts, self.path(LOAD_REPORT))

    def load_report(self) -> DataFrame:
        """Per source of the last run: rows, and lines or rows that were set aside."""
        return read_version(self.spark, self.path(LOAD_REPORT), REPORT)
