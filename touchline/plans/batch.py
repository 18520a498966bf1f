"""The batch job: landed sources -> season lake -> cleaning -> warehouse."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.operators.clean import clean_players, union_sources, unusable_rows
from touchline.operators.ids import assign_codes_stable, attach_codes
from touchline.operators.load import (
    insert_if_absent,
    new_facts,
    new_lines,
    scd1,
    upserted_facts,
)
from touchline.operators.star import (
    LABEL_DIMENSIONS,
    fact_rows_by_grain,
    fact_rows_by_line,
    keyed_rows,
)
from touchline.plans import catalog
from touchline.plans.warehouse import Warehouse
from touchline.schemas import CLEAN, DIM_PLAYER, DIMENSIONS, LABEL_KEYS, LOAD_ORDER, RAW, REPORT, ROW_ORDER
from touchline.session import intermediates, materialise
from touchline.sources import files, landing
from touchline.sources.tables import MOST_PARTS, append_version, read_version, replace_version

log = logging.getLogger(__name__)

T = TypeVar("T")
# Times that a load begins again when others come first.
_TRIES = 20
_BEFORE_PLAYER = [c for c in ROW_ORDER if c != "player_id"]


@dataclass(frozen=True)
class BatchConfig:
    """Where a run reads and writes.

    ``seasons`` limits the run to some seasons of the lake; ``mode`` is ``insert`` (known keys stay)
    or ``upsert`` (the last record wins); ``key`` is ``grain`` or, for inserts only, ``stat_line``;
    ``pretty`` says that API responses are indented, one per file.
    """

    csv: str
    jsonl: str
    api: str
    lake: str
    warehouse: str
    export: str | None = None
    quarantine: str | None = None
    seasons: tuple[str, ...] | None = None
    key: str = "grain"
    mode: str = "insert"
    pretty: bool = False

    @property
    def unusable(self) -> str:
        """Rows without team or player; beside the lake unless ``quarantine`` names a folder."""
        return self.quarantine or f"{self.lake}-quarantine"

    @property
    def bad_lines(self) -> str:
        """Lines, or whole indented responses, that no reader could parse."""
        return f"{self.unusable}-lines"

    def __post_init__(self) -> None:
        if self.mode not in ("insert", "upsert"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.key not in ("grain", "stat_line") or (self.key, self.mode) == ("stat_line", "upsert"):
            raise ValueError(f"key {self.key!r} does not go with mode {self.mode!r}")


def ingest(spark: SparkSession, cfg: BatchConfig) -> list[tuple[str, int, int]]:
    """Union of the three landed sources into the lake; (source, rows, bad lines) of each.

    A source that is absent or empty is skipped. Rows are counted while they are written, and it is noted
    which files have lines that don't parse; only those files are read again, for the lines that go to
    ``cfg.bad_lines``. CSV has no such line: its fields become null one by one.
    """
    counted, frames, noted = [], [], []
    for name, path in (("csv", cfg.csv), ("jsonl", cfg.jsonl), ("api", cfg.api)):
        pretty = name == "api" and cfg.pretty
        if name == "csv":
            rows = files.present(files.scan_csv, spark, path, landed=True)
        else:
            rows = files.present(files.json_lines, spark, path, pretty=pretty)
            if rows is not None:
                noted.append((name, path, pretty, Observation(f"bad lines of {name}")))
                rows = files.json_rows(rows.observe(noted[-1][-1], *files.bad_line_figures()), landed=True)
        if rows is None:
            counted.append((name, None))
            continue
        seen = Observation(f"rows of {name}")
        frames.append(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        counted.append((name, seen))
    if frames:
        landing.write_lake(union_sources(*frames), cfg.lake)
    lines = [spark.createDataFrame([], files.BAD_LINES).withColumn("source", F.lit(""))]
    bad_by_source = {}
    for name, path, pretty, figures in noted:
        bad_by_source[name] = figures.get["bad"]
        if bad_by_source[name]:
            buckets = files.buckets_of(figures.get["files"])
            bad = files.bad_json_lines(spark, path, pretty=pretty, buckets=buckets)
            lines.append(bad.withColumn("source", F.lit(name)))
    union_sources(*lines).write.mode("overwrite").parquet(cfg.bad_lines)
    found = [(name, seen.get["rows"] if seen else 0, bad_by_source.get(name, 0)) for name, seen in counted]
    for name, rows, bad in found:
        log.info("source %s: %d rows, %d bad lines", name, rows, bad)
    return found


def retrieve(spark: SparkSession, cfg: BatchConfig) -> tuple[DataFrame, int]:
    """Clean rows of the lake, still lazy, and how many rows went to the quarantine.

    Rows without team or player are written to ``cfg.unusable``; exports are written if configured.
    """
    raw = files.scan_lake(spark, cfg.lake, landed=True)
    if cfg.seasons is not None:
        raw = raw.where(F.col("season").isin(list(cfg.seasons)))
    clean = raw.transform(clean_players)
    if cfg.export:
        landing.export_season_csv(clean.select(*CLEAN.names), cfg.export)
    unusable_rows(raw).select(*RAW.names).write.mode("overwrite").parquet(cfg.unusable)
    unusable = spark.read.parquet(cfg.unusable).count()
    if unusable:
        log.warning("%d rows without team or player are in %s", unusable, cfg.unusable)
    return clean, unusable


def counts_of(counts: Sequence[tuple[str, int, int]]) -> int:
    return sum(rows for _, rows, _ in counts)


def load_dimensions(clean: DataFrame, store: Warehouse, mode: str = "insert") -> DataFrame:
    """Bring the dimensions up to date and return the codebook of the four labels.

    In an upsert the name that was landed last wins (``load_order``, if the rows have it), among
    those of one landing the last season's.
    """
    book = _retried(lambda: _load_labels(clean, store))
    landed = [LOAD_ORDER] if LOAD_ORDER in clean.columns else []
    players = clean.select("player_id", "player_name", *landed, *_BEFORE_PLAYER)
    key = ["player_id"]

    def load_players() -> bool:
        path, seen = store.path(DIM_PLAYER), store.version(DIM_PLAYER)
        known = read_version(store.spark, path, DIMENSIONS[DIM_PLAYER], seen)
        if mode == "insert":
            new = insert_if_absent(known, players.drop(*landed), key, _BEFORE_PLAYER, null_safe=False)
            return append_version(new, path, seen)
        merged = scd1(known, players, key, [*landed, *_BEFORE_PLAYER], null_safe=False)
        return replace_version(merged, path, seen)

    _retried(load_players)
    return book


def _retried(attempt: Callable[[], T]) -> T:
    """Try until no other load comes first: ``attempt`` then gives something true."""
    for _ in range(_TRIES):
        if done := attempt():
            return done
    raise RuntimeError(f"other loads came first {_TRIES} times")


def _load_labels(clean: DataFrame, store: Warehouse) -> DataFrame | None:
    """The codebook with the labels of ``clean``, once all new ones are stored under these codes.

    None if another load has changed a label dimension meanwhile; what was stored by then is known next time.
    """
    seen = {name: store.version(name) for name in LABEL_DIMENSIONS.values()}
    book = assign_codes_stable(clean, list(LABEL_KEYS), store.codebook())
    stored = (
        append_version(store.new_labels(book, column), store.path(name), seen[name])
        for column, name in LABEL_DIMENSIONS.items()
    )
    return book if all(stored) else None


def load_fact(
    clean: DataFrame, book: DataFrame, store: Warehouse, key: str = "grain", mode: str = "insert"
) -> None:
    """Bring the fact up to date. Of the stored fact only the seasons that come in are looked at,
    or for ``stat_line``, whose tuples know no season, its measures.

    If another load changes these seasons meanwhile, it is done again from what is stored then.
    """
    keyed = keyed_rows(clean, book)
    if key == "stat_line":
        lines = fact_rows_by_line(keyed)

        def attempt() -> bool:
            seen = store.fact_state()
            return store.add_to_fact(store.numbered(new_lines(store.fact(state=seen), lines)), seen, whole=True)

    else:
        seasons = materialise(season_ids(clean, book), "seasons")
        rows = fact_rows_by_grain(keyed, last=mode == "upsert")

        def attempt() -> bool:
            seen = store.fact_state()
            touched = store.fact(seasons, seen)
            if mode == "insert":
                return store.add_to_fact(store.numbered(new_facts(touched, rows)), seen)
            known, fresh = upserted_facts(touched, rows)
            return store.add_to_fact(store.numbered(fresh), seen, over=known)

    _retried(attempt)


def season_ids(clean: DataFrame, book: DataFrame) -> DataFrame:
    """The season keys that come in: labels first, so that a few values meet the codebook."""
    return attach_codes(clean.select("season").distinct(), book, {"season": "season_id"}).select("season_id")


def load_warehouse(
    clean: DataFrame, store: Warehouse, key: str = "grain", mode: str = "insert"
) -> None:
    """Dimensions first, then the fact. Loading the same rows again changes nothing.

    A player without an id cannot be a key of the warehouse; such rows are left to the quarantine.
    """
    clean = clean.where(F.col("player_id").isNotNull())
    with intermediates(store.spark):
        book = load_dimensions(clean, store, mode)
        load_fact(clean, book, store, key, mode)
        store.fold(at_least=MOST_PARTS)
    store.refresh_views()
    catalog.refresh(store)


def run_batch(spark: SparkSession, cfg: BatchConfig) -> Warehouse:
    """Ingestion, retrieval and warehouse load, in this order."""
    store = Warehouse(spark, cfg.warehouse)
    counts = ingest(spark, cfg)
    log.info("lake %s is up to date", cfg.lake)
    clean, unusable = retrieve(spark, cfg)
    store.report(spark.createDataFrame([*counts, ("lake", counts_of(counts), unusable)], REPORT))
    load_warehouse(clean, store, cfg.key, cfg.mode)
    store.register_views()
    return store


def read_exported_seasons(spark: SparkSession, path: str) -> DataFrame:
    """The season CSV files as one clean table."""
    return files.scan_csv_tree(spark, path, CLEAN)
