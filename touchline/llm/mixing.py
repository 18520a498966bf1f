"""Mixing sources to target weights by hash thresholds.

Every row draws a fixed hash from its key and text. Per source the sizes are summed by the leading
digits of that hash; the running total tells in which bucket the budget ends, and only that bucket
is summed again by the next digits, until one hash value is left. The mix is then a filter
``hash <= threshold``: nothing is sorted, a larger budget takes a superset of a smaller one, and a
rerun takes the same rows. Rows equal in key and text draw the same hash; if the budget ends among them,
as many of them are taken as come nearest to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import table, word_count
from touchline.session import materialise

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
# Hexadecimal digits of the row hash, and how many of them one histogram resolves (4,096 buckets).
DIGITS = 15
STEP = 3


def row_hash(key: str, text: str) -> Column:
    """A row's draw: the leading digits of an MD5 over key and text."""
    whole = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.substring(F.md5(whole.cast("binary")), 1, DIGITS)


def source_targets(sized: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """Per source its size, target and number of whole epochs.

    Sources are in code-point order, null last, and take the weights in turn. Together they are to
    get the size of the whole input. No source gets more than ``max_epochs`` times its size; what it
    can't take goes to the others by weight. Sources by ascending ``capacity / weight`` are the order
    in which they fill up, so one running total finds who is full: no iteration. One row per source
    is in these windows, as many as the mix has weights for.
    """
    by_source = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    order = W.orderBy(F.col("_source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1)
    ranked = by_source.withColumn("_rank", F.row_number().over(order)).withColumn("_weight", weight)
    fill = W.orderBy(F.col("source_size") / F.col("_weight"), "_rank")
    rest = ranked.withColumns(
        {
            "_total": F.sum("source_size").over(W.partitionBy()),
            "_full": F.coalesce(
                F.sum(F.col("source_size") * max_epochs).over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
            "_weights": F.sum("_weight").over(fill.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    # The share per unit of weight if all sources before this one are full.
    share = (F.col("_total") - F.col("_full")).cast("double") / F.col("_weights").cast("double")
    over = share * F.col("_weight") >= (F.col("source_size") * max_epochs).cast("double")
    shared = rest.withColumns({"_share": share, "_over": over})
    # The first source that isn't full has the share that holds for all that aren't.
    first = F.first(F.when(~F.col("_over"), F.col("_share")), ignorenulls=True).over(
        fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    target = F.when(F.col("_over"), (F.col("source_size") * max_epochs).cast("double")).otherwise(
        F.col("_first") * F.col("_weight")
    )
    placed = shared.withColumn("_first", first).withColumn("target", target)
    size = F.col("source_size").cast("double")
    epochs = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(max_epochs))).otherwise(F.lit(0))
    return placed.withColumn("_epochs", epochs.cast("long")).select(
        "_source",
        "_rank",
        "source_size",
        "target",
        "_epochs",
        (F.col("target") - F.col("_epochs") * size).alias("_budget"),
    )


def _refine(rows: DataFrame, bounds: DataFrame, level: int) -> DataFrame:
    """One histogram further: of each source the bucket in which its budget ends.

    ``bounds`` has the bucket so far as ``_prefix`` and the size below it as ``_below``. Buckets
    whose end still fits the budget are below; the first that doesn't is the boundary. A source whose
    rows all fit has no boundary and drops out with its last bucket as threshold.
    """
    bucket = F.substring("_hash", 1, level * STEP)
    inside = F.substring("_hash", 1, (level - 1) * STEP) == F.col("_prefix")
    sums = (
        rows.join(bounds, "_rank")
        .where(inside)
        .groupBy("_rank", "_budget", "_below", bucket.alias("_bucket"))
        .agg(F.sum("_size").alias("_sum"), F.count("*").alias("_rows"))
    )
    by_hash = W.partitionBy("_rank").orderBy("_bucket")
    running = sums.withColumn("_end", F.col("_below") + F.sum("_sum").over(by_hash))
    boundary = running.where(F.col("_end").cast("double") > F.col("_budget"))
    first = F.min(F.struct("_bucket", (F.col("_end") - F.col("_sum")).alias("below"), "_sum", "_rows")).alias("first")
    return boundary.groupBy("_rank", "_budget").agg(first).select(
        "_rank",
        "_budget",
        F.col("first._bucket").alias("_prefix"),
        F.col("first.below").alias("_below"),
        F.col("first._sum").alias("_sum"),
        F.col("first._rows").alias("_rows"),
    )


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the hash below which rows are taken once more than the whole epochs.

    At the hash itself are ``_equal`` rows, equal in key and text and mostly one; of these ``_take`` are
    taken, the number that comes nearest to the budget and the lower of two. Sources without a budget
    beyond their whole epochs have no threshold.
    """
    bounds = targets.where("_budget > 0").select(
        "_rank", "_budget", F.lit("").alias("_prefix"), F.lit(0).cast("long").alias("_below")
    )
    for level in range(1, DIGITS // STEP + 1):
        # Written out: a table of one row per source whose size Spark knows when it plans the join.
        found = materialise(_refine(rows, bounds, level), f"threshold-{level}")
        bounds = found.drop("_sum", "_rows")
    each = F.expr("_sum div _rows")
    nearest = F.ceil((F.col("_budget") - F.col("_below")) / each - 0.5)
    return found.select("_rank", F.col("_prefix").alias("_threshold"), nearest.alias("_take"), F.col("_rows").alias("_equal"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_number``, from 0 without gaps for each ``_rank``.

    By the input split that a row came in (``_at``) and the counts of the splits before, so no task sees
    more of a source than one split has.
    """
    placed = rows.withColumn("_part", F.shiftright("_at", 33))
    before = W.partitionBy("_rank").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("_rank", "_part").agg(F.count("*").alias("_rows"))
    offsets = counts.select("_rank", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(W.partitionBy("_rank", "_part").orderBy("_at")) - 1
    numbered = placed.withColumn("_within", within).join(offsets, ["_rank", "_part"])
    return numbered.withColumn("_number", F.col("_offset") + F.col("_within"))


def _planned(
    df: DataFrame,
    kept: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Per row the columns ``kept`` in one struct (so that no name clashes), and the plan beside it."""
    sized = materialise(
        df.select(
            F.struct(*[F.col(c) for c in kept]).alias("_kept"),
            F.col(source).alias("_source"),
            word_count(F.col(text)).alias("_size"),
            row_hash(key, text).alias("_hash"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "mix-sizes",
    )
    targets = materialise(source_targets(sized, weights, max_epochs), "mix-targets")
    named = targets.withColumnRenamed("_source", "_named")
    rows = sized.join(named, F.col("_source").eqNullSafe(F.col("_named"))).select("_rank", "_size", "_hash")
    # Written out, so that the join with the whole rows is planned by its true size.
    bounds = materialise(named.join(thresholds(rows, targets), "_rank", "left"), "mix-bounds")
    planned = sized.join(bounds, F.col("_source").eqNullSafe(F.col("_named")))
    at = F.col("_hash") == F.col("_threshold")

    def with_copies(some: DataFrame, number: Column) -> DataFrame:
        extra = (F.col("_hash") < F.col("_threshold")) | (at & (number < F.col("_take")))
        copies = F.col("_epochs") + F.coalesce(extra.cast("int"), F.lit(0))
        return some.select("_kept", F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"))

    if bounds.where("_equal > 1").isEmpty():
        return with_copies(planned, F.lit(0))
    several = F.coalesce(at & (F.col("_equal") > 1), F.lit(False))
    tied = with_copies(_numbered(planned.where(several)), F.col("_number"))
    return with_copies(planned.where(~several), F.lit(0)).unionByName(tied)


def plan_mix(df: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``key`` of every row with its size in words, its source's size and target, and ``copies``.

    A null or empty text has size 0. Rows equal in key and text are told apart only where the budget ends
    among them; which of them are taken then follows their order in the input. A source whose texts are all empty has target 0; its rows are in the plan with no
    copies. An empty input gives an empty plan.
    """
    return _planned(df, [key], key, **options).select("_kept.*", "size", "source_size", "target", "copies")


def mix(df: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves: each row of ``df`` as often as the mix takes it, columns unchanged."""
    plan = _planned(df, df.columns, **options).where("copies > 0")
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return plan.select("_kept", repeats.alias("_repeat")).select("_kept.*")


def op2_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of each; see :func:`plan_mix`."""
    plan = plan_mix(table(spark, sf_dir, "documents"), key="doc_id")
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
