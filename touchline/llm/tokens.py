"""Token counts by field or section.

A document is encoded once, as a whole, the way a model will read it. Every token covers a span of
the document; the spans are joined to the spans of its sections, and a token that crosses a border is
allocated by a stated rule:

* ``start``: to the section its first byte is in (the default);
* ``end``: to the section its last byte is in;
* ``share``: to every section by the share of its bytes there.

So the sections' counts always add up to the document's, which counts over separately encoded
sections don't.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table

RULES = ("start", "end", "share")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """A byte-level tokenizer and the byte length of each of its tokens."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes. The tokens cover the text without gap or overlap."""
        return np.cumsum(self.length[np.array(self.encoding.encode_ordinary(text), np.int64)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def allocate(ends: np.ndarray, borders: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and tokens that cross the section's end.

    ``borders`` are the sections' ends; the last is the text's. Sections without bytes get nothing,
    and a border at which several sections end is crossed out of the one that has the bytes before it.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(borders, starts, side="right")
    last = np.searchsorted(borders, ends, side="left")
    crossing = np.bincount(first[first != last], minlength=len(borders))
    if rule == "start":
        return np.bincount(first, minlength=len(borders)).astype(float), crossing
    if rule == "end":
        return np.bincount(last, minlength=len(borders)).astype(float), crossing
    if rule != "share":
        raise ValueError(f"no rule {rule!r}, one of {RULES}")
    # How many tokens lie before a border, a cut token counting by its share.
    at = np.searchsorted(ends, borders, side="left")
    inside = np.minimum(at, max(len(ends) - 1, 0))
    before = at.astype(float)
    if len(ends):
        cut = at < len(ends)
        size = ends[inside] - starts[inside]
        before += np.where(cut, (borders - starts[inside]) / size, 0.0)
    return np.diff(before, prepend=0.0), crossing


def sections(text: Column, separator: str = "\n") -> Column:
    """A text's sections in order; each keeps its separator, so that together they are the text."""
    cut = F.split(F.coalesce(text, F.lit("")), f"(?<={separator})", -1)
    return F.when(F.size(cut) > 1, F.filter(cut, lambda x: x != "")).otherwise(cut)


def attribute_tokens(
    df: DataFrame, keep: Sequence[str], parts: Column, rule: str = "start", ranks: str | None = None
) -> DataFrame:
    """``keep`` columns and section, n_tokens, n_crossing, doc_tokens: a row per element of ``parts``.

    ``parts`` is an array of texts that in a row are the document: sections, or the fields of a record
    with what stands between them. Null elements are empty. A null or empty array gives one empty
    section. ``n_tokens`` is whole for the rules ``start`` and ``end``. A long text is encoded whole, alone in
    its task: some 60 bytes of memory for each of its tokens.
    """
    if rule not in RULES:
        raise ValueError(f"no rule {rule!r}, one of {RULES}")
    path = ranks or default_ranks()
    empty = F.lit("")
    some = F.when(F.size(parts) > 0, F.transform(parts, lambda x: F.coalesce(x, empty))).otherwise(F.array(empty))
    given = df.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), some.alias("parts"))
    kept = given.schema["kept"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            rows, section, tokens, crossing, whole = [], [], [], [], []
            for at, value in enumerate(batch.column("parts")):
                texts = value.as_py()
                ends = known.ends("".join(texts))
                borders = np.cumsum([len(t.encode()) for t in texts])
                counts, over = allocate(ends, borders, rule)
                rows += [at] * len(texts)
                section += range(len(texts))
                tokens.append(counts)
                crossing.append(over)
                whole += [len(ends)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("kept").take(pa.array(rows, pa.int64())),
                    pa.array(section, pa.int32()),
                    pa.array(np.concatenate(tokens) if tokens else [], pa.float64()),
                    pa.array(np.concatenate(crossing) if crossing else [], pa.int64()),
                    pa.array(whole, pa.int64()),
                ],
                ["kept", "section", "n_tokens", "n_crossing", "doc_tokens"],
            )

    counted = given.mapInArrow(
        count, f"kept {kept}, section int, n_tokens double, n_crossing long, doc_tokens long"
    )
    return counted.select("kept.*", "section", "n_tokens", "n_crossing", "doc_tokens")


def op4_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by line, a token counting where it starts.

    A row per document and line; null and empty texts have one line without tokens.
    """
    lines = attribute_tokens(table(spark, sf_dir, "documents"), ["doc_id"], sections(F.col("text")))
    return lines.withColumn("n_tokens", F.col("n_tokens").cast("long"))
