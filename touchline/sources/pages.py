"""Indented JSON arrays that are too large for one text, read in pieces of whole elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import LOAD_ORDER
from touchline.session import materialise

# A block is so many lines (a power of two); a piece is what begins in a block.
_BLOCK_BITS = 8
# The end of one element and the beginning of the next on one line; cut before the brace.
_NEXT = r"(?s)^(\s*\}?\s*,)(\s*\{.*)$"


def page_pieces(text: DataFrame, items: T.ArrayType) -> DataFrame:
    """(value, file, load order, torn, items): files cut between the elements of their array.

    ``text`` are their lines, cut at line feeds only, with ``file``, ``start`` (of the part of the file that
    a task read) and the load order. In JSON a line never begins inside a string, so each line tells alone
    how many brackets it opens and closes, and sums over blocks of lines, then over the lines of a block,
    tell how deep a line lies. A piece reaches from the first element that begins on a line of its block to
    the first such element of a later block. It is parsed alone, with the brackets of an array around it in
    place of its last comma: if all pieces of a file parse, so does the file, and if one doesn't, the file
    is torn and none of its pieces has items. A file that holds one object, or whose elements begin
    elsewhere on their lines, is one piece.
    """
    halves = F.array(F.concat(F.lit("\n"), F.regexp_extract("value", _NEXT, 1)), F.regexp_extract("value", _NEXT, 2))
    whole = F.array(F.concat(F.lit("\n"), "value"))
    value = F.explode(F.when(F.rlike("value", F.lit(_NEXT)), halves).otherwise(whole)).alias("value")
    # Without escapes first, then without strings.
    outside = F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r"\"[^\"]*+\"|'[^']*+'", "")
    step = F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))
    # Written first, as the places of lines must come from one and the same partitioning.
    lines = materialise(
        text.select("file", LOAD_ORDER, "start", value)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumns({"step": step, "head": F.regexp_extract("value", r"^\s*(\S?)", 1)})
        .withColumns({"block": F.shiftright("at", _BLOCK_BITS), "name": F.xxhash64("file")}),
        "page-lines",
    )
    # Files that share a block's number follow each other in one task; lines needn't carry their whole names.
    key = ["name", "start", "block"]
    blocks = W.partitionBy("file").orderBy("start", "block")
    earlier = blocks.rowsBetween(W.unboundedPreceding, -1)
    every = blocks.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    above = lines.groupBy("file", *key).agg(F.sum("step").alias("total"))
    above = above.select("file", *key, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("above"))
    upto = W.partitionBy(*key).orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    placed = lines.drop("file").join(above.drop("file"), key).withColumn("depth", F.col("above") + F.sum("step").over(upto))

    begins = (F.col("depth") - F.col("step") == 1) & (F.col("head") == "{")
    filled = F.col("head") != ""
    found = placed.groupBy(*key).agg(
        F.min(F.when(begins, F.col("at"))).alias("first"),
        F.min(F.when(filled & (F.col("depth") <= 0), F.col("at"))).alias("end"),  # of the array
        F.min(F.when(filled, F.struct("at", "head"))).getField("head").alias("head"),
    )
    ended = F.coalesce(F.max(F.col("end").isNotNull()).over(earlier), F.lit(False))
    root = F.first("head", ignorenulls=True).over(every)
    inside = (root == "[") & ~ended & (F.col("end").isNull() | (F.col("first") < F.col("end")))
    found = found.join(above.select("file", *key), key).withColumn("own", F.when(inside & F.col("first").isNotNull(), F.struct("start", "block")))
    cuts = found.select(
        "file",
        *key,
        "first",
        "own",
        F.last("own", ignorenulls=True).over(earlier).alias("open"),
        F.last("own", ignorenulls=True).over(every).alias("final"),
    )

    own = F.col("own").isNotNull() & (F.col("at") >= F.col("first"))
    members = F.array_sort(F.collect_list(F.struct("start", "at", "value")))
    pieces = (
        placed.join(cuts, key)
        .groupBy("file", F.when(own, F.col("own")).otherwise(F.col("open")).alias("piece"), "final")
        .agg(F.array_join(members["value"], "").alias("value"), F.max(LOAD_ORDER).alias(LOAD_ORDER))
    )
    head, last = F.col("piece").isNull(), F.col("piece").eqNullSafe(F.col("final"))
    bare = F.regexp_extract("value", r"^\s*(\S)\s*\z", 1) == "["
    closed = F.when(head & bare, F.lit("[]")).otherwise(F.regexp_replace("value", r",\s*\z", "]"))
    array = F.concat(F.when(head, "").otherwise("["), F.when(last, F.col("value")).otherwise(closed))
    parsed = F.from_json(array, items)
    several = ~head | F.rlike("value", F.lit(r"^\s*\["))
    torn = F.when(several, F.exists(parsed, lambda x: x.isNull())).otherwise(F.get(parsed, F.lit(0)).isNull())
    pieces = pieces.where(~(head & last & (F.regexp_extract("value", r"^\s*(\S?)", 1) == "")))
    judged = materialise(
        pieces.select("value", "file", LOAD_ORDER, array.alias("array"), F.coalesce(torn, F.lit(True)).alias("torn")),
        "page-pieces",
    )
    # A row for each large file.
    verdicts = F.broadcast(judged.groupBy("file").agg(F.max("torn").alias("torn")))
    return judged.drop("torn").join(verdicts, "file").select(
        "value", "file", LOAD_ORDER, F.when(~F.col("torn"), F.from_json("array", items)).alias("items")
    )
