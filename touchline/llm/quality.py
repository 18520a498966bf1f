"""Quality by a convolutional network over bytes.

A text is the bytes of its UTF-8 form. Every byte has a small learnt vector; learnt filters look at a few
bytes in a row, at every place. The places are cut into chunks that overlap by half and cover the whole
text. A chunk keeps the largest answer of every filter and a second layer looks at those answers together,
so it can also tell that a chunk has little variety. Of every unit of that layer the text keeps the
largest value over all chunks, and a logistic curve makes one probability of these.

The network learns where the texts are: a bounded sample of labelled rows (:data:`MAX_SAMPLE`) is dealt
into shards, every round each shard's task goes over its texts once, from the weights of the round before,
and the driver averages the weights that come back. Texts never reach the driver, and a task holds one
batch of Arrow rows at a time. All texts are learnt from and scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.session import materialise

# Labelled rows of each class that are learnt from, at most; those with the smallest key hashes.
MAX_SAMPLE = 1600
FOLDS, HELD_OUT = 4, 2
GOOD = 0.7
# Tasks of a round and rounds; a step of the optimiser is taken every BATCH texts.
SHARDS, ROUNDS, BATCH = 8, 12, 8
RATE, DECAY = 0.02, 0.9

VECTOR, WIDTH, FILTERS, UNITS = 8, 5, 32, 16
# Places in half a chunk. A chunk is two halves in a row, and the next chunk begins with the second of them.
HALF = 32
_PAD = 256
# Half chunks that are looked at together. Bounds memory only.
_HALVES = 2048

_SHAPES = {
    "vectors": (257, VECTOR),
    "filters": (WIDTH * VECTOR, FILTERS),
    "filter_bias": (FILTERS,),
    "units": (FILTERS, UNITS),
    "unit_bias": (UNITS,),
    "weights": (UNITS,),
    "bias": (1,),
}
_SIZE = sum(int(np.prod(shape)) for shape in _SHAPES.values())


def _parts(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the network's arrays in one flat array."""
    views, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        views[name] = flat[at : at + size].reshape(shape)
        at += size
    return views


def initial(seed: int = 20240229) -> np.ndarray:
    rng = np.random.default_rng(seed)
    flat = np.zeros(_SIZE, np.float32)
    parts = _parts(flat)
    parts["vectors"][:] = rng.normal(0, 0.5, parts["vectors"].shape)
    parts["filters"][:] = rng.normal(0, (WIDTH * VECTOR) ** -0.5, parts["filters"].shape)
    parts["units"][:] = rng.normal(0, FILTERS**-0.5, parts["units"].shape)
    parts["unit_bias"][:] = 0.1
    parts["weights"][:] = rng.normal(0, UNITS**-0.5, parts["weights"].shape)
    return flat


def _halves(n_bytes: int) -> int:
    """Half chunks of a text: one place for each byte, and a whole chunk at least."""
    return max(2, -(-n_bytes // HALF))


def _padded(data: bytes) -> np.ndarray:
    """The bytes, then padding to whole halves and the width of a filter beyond."""
    n = _halves(len(data)) * HALF + WIDTH - 1
    out = np.full(n, _PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


def _answers(parts: dict[str, np.ndarray], symbols: np.ndarray) -> np.ndarray:
    """Every filter's answer at every place (last axis but one), without bias."""
    seen = parts["vectors"][symbols]
    n = symbols.shape[-1] - WIDTH + 1
    windows = np.concatenate([seen[..., k : k + n, :] for k in range(WIDTH)], axis=-1)
    return windows @ parts["filters"]


@dataclass
class Model:
    """What scoring needs: the network's numbers, a few thousand whatever the corpus."""

    flat: np.ndarray

    def pooled(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Every unit's largest value over all chunks, and the first chunk that has it."""
        parts, symbols = _parts(self.flat), _padded(text.encode())
        halves = (len(symbols) - WIDTH + 1) // HALF
        best, where = np.full(UNITS, -np.inf, np.float32), np.zeros(UNITS, np.int64)
        for low in range(0, halves - 1, _HALVES):
            high = min(low + _HALVES + 1, halves)
            answers = _answers(parts, symbols[low * HALF : high * HALF + WIDTH - 1])
            largest = answers.reshape(high - low, HALF, FILTERS).max(axis=1)
            chunks = np.maximum(np.maximum(largest[:-1], largest[1:]) + parts["filter_bias"], 0)
            units = np.maximum(chunks @ parts["units"] + parts["unit_bias"], 0)
            at = units.argmax(axis=0)
            value = units[at, np.arange(UNITS)]
            where = np.where(value > best, low + at, where)
            best = np.maximum(best, value)
        return best, where

    def score(self, text: str) -> float:
        """The probability of good quality; an empty text is a chunk of padding."""
        parts = _parts(self.flat)
        return float(_curve(self.pooled(text)[0] @ parts["weights"] + parts["bias"][0]))


def _curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.float64(x), -30, 30)))


def gradient(flat: np.ndarray, texts: list[str], labels: np.ndarray) -> np.ndarray:
    """The gradient of the mean loss: back through the chunk that each unit took its value from, and
    through the place that each filter took its answer from."""
    parts, model = _parts(flat), Model(flat)
    out = np.zeros(_SIZE, np.float32)
    grads = _parts(out)
    for text, label in zip(texts, labels):
        pooled, where = model.pooled(text)
        off = (_curve(pooled @ parts["weights"] + parts["bias"][0]) - label) / len(texts)
        grads["weights"] += off * pooled
        grads["bias"] += off
        alive = pooled > 0
        if not alive.any():
            continue
        chunks, row = np.unique(where[alive], return_inverse=True)
        symbols = _padded(text.encode())
        span = 2 * HALF + WIDTH - 1
        symbols = symbols[(chunks * HALF)[:, None] + np.arange(span)]
        answers = _answers(parts, symbols)
        place = answers.argmax(axis=1)
        kept = np.take_along_axis(answers, place[:, None], axis=1)[:, 0] + parts["filter_bias"]
        d_units = np.zeros((len(chunks), UNITS), np.float32)
        d_units[row, np.flatnonzero(alive)] = off * parts["weights"][alive]
        grads["units"] += np.maximum(kept, 0).T @ d_units
        grads["unit_bias"] += d_units.sum(axis=0)
        d_kept = np.where(kept > 0, d_units @ parts["units"].T, 0)
        grads["filter_bias"] += d_kept.sum(axis=0)
        # The bytes under every filter's place: chunks by filters by width.
        under = symbols[np.arange(len(chunks))[:, None, None], place[:, :, None] + np.arange(WIDTH)]
        seen = parts["vectors"][under]
        kernels = parts["filters"].reshape(WIDTH, VECTOR, FILTERS)
        grads["filters"] += np.einsum("cfwv,cf->wvf", seen, d_kept, optimize=True).reshape(-1, FILTERS)
        d_seen = d_kept[:, :, None, None] * kernels.transpose(2, 0, 1)[None]
        np.add.at(grads["vectors"], under.ravel(), d_seen.reshape(-1, VECTOR))
    return out


@dataclass
class State:
    """Weights with the optimiser's running means of gradients and their squares."""

    flat: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    steps: int = 0

    def step(self, grad: np.ndarray, rate: float) -> None:
        self.steps += 1
        self.mean += 0.1 * (grad - self.mean)
        self.square += 0.01 * (grad * grad - self.square)
        mean, square = self.mean / (1 - 0.9**self.steps), self.square / (1 - 0.99**self.steps)
        self.flat -= np.float32(rate) * mean / (np.sqrt(square) + 1e-8)

    def learn(self, rows: Iterator[tuple[str, float]], rate: float) -> int:
        """One pass over (text, label), a step for every BATCH texts; how many there were."""
        seen, texts, labels = 0, [], []

        def close() -> None:
            if texts:
                self.step(gradient(self.flat, texts, np.array(labels)), rate)
                texts.clear(), labels.clear()

        for text, label in rows:
            texts.append(text)
            labels.append(label)
            seen += 1
            if len(texts) == BATCH:
                close()
        close()
        return seen

    def packed(self) -> bytes:
        return np.concatenate([self.flat, self.mean, self.square]).astype("<f4").tobytes()

    @classmethod
    def unpacked(cls, content: bytes, steps: int) -> State:
        flat, mean, square = np.frombuffer(content, "<f4").reshape(3, -1).copy()
        return cls(flat, mean, square, steps)


def _averaged(found: list[tuple[bytes, int, int]]) -> State:
    """The shards' (state, steps, texts) as one state, weighed by their texts."""
    states = [State.unpacked(content, steps) for content, steps, _ in found]
    weights = np.array([n for *_, n in found], np.float64)
    mean = lambda arrays: np.average(arrays, axis=0, weights=weights).astype(np.float32)
    return State(
        mean([s.flat for s in states]),
        mean([s.mean for s in states]),
        mean([s.square for s in states]),
        max(s.steps for s in states),
    )


# ---------------------------------------------------------------- on Spark


def held_out(key: Column) -> Column:
    """One row in four, by its key, is kept from all learning. Rows without key aren't held out."""
    remainder = F.crc32(key.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def _usable(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from, one for a key: (key, good). Of unlike labels the lower holds."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").alias("key")).agg(F.min("quality").cast("int").alias("good"))


def labelled_sample(documents: DataFrame, labels: DataFrame, size: int = MAX_SAMPLE) -> DataFrame:
    """Up to ``size`` labelled texts of each class, without held-out rows: (shard, at, good, text).

    Rows are chosen on the label table alone, by the smallest hashes of their keys; at most ``2 * size``
    keys are then broadcast to fetch the texts. A key that has several rows gives its smallest text.
    """
    usable, draw = _usable(labels), F.xxhash64("key")
    chosen = [usable.where(F.col("good") == c).orderBy(draw, "key").limit(size) for c in (0, 1)]
    keys = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = documents.select(F.col("doc_id").alias("key"), "text").join(keys, "key")
    texts = rows.groupBy("key", "good").agg(F.min("text").alias("text"))
    return texts.select(F.pmod(draw, F.lit(SHARDS)).cast("int").alias("shard"), draw.alias("at"), "good", "text")


def _round(sample: DataFrame, state: State, rate: float) -> State:
    """Every shard once over its texts, from ``state`` on; rows of a shard come in a fixed order."""
    given, steps = state.packed(), state.steps

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("shard", "good", "text")))
        )
        row = next(rows, None)
        while row is not None:
            shard, own, after = row[0], State.unpacked(given, steps), []

            def of_shard(first):
                yield first[2] or "", float(first[1])
                for other in rows:
                    if other[0] != shard:
                        after.append(other)
                        return
                    yield other[2] or "", float(other[1])

            seen = own.learn(of_shard(row), rate)
            yield pa.RecordBatch.from_pydict({"state": [own.packed()], "steps": [own.steps], "texts": [seen]})
            row = after[0] if after else None

    order = F.xxhash64("at", F.lit(steps))
    dealt = sample.repartition(SHARDS, "shard").sortWithinPartitions("shard", order, "at")
    found = dealt.select("shard", "good", "text").mapInArrow(learn, "state binary, steps long, texts long").collect()
    found = sorted((bytes(r.state), r.steps, r.texts) for r in found)
    return _averaged(found) if found else state


def train(documents: DataFrame, labels: DataFrame, size: int = MAX_SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit on the bounded sample.

    Both classes weigh alike while the network learns if both fill the sample; the curve's bias is then
    moved by the classes' shares among all labels that may be learnt from, so that scores are
    probabilities. Without labels of both classes nothing can be told apart: every text scores one half.
    """
    sizes = {r.good: r["count"] for r in _usable(labels).groupBy("good").count().collect()}
    if len(sizes) < 2:
        return Model(np.zeros(_SIZE, np.float32))
    sample = materialise(labelled_sample(documents, labels, size), "quality-sample")
    drawn = {r.good: r["count"] for r in sample.groupBy("good").count().collect()}
    if len(drawn) < 2:
        return Model(np.zeros(_SIZE, np.float32))
    zeros = np.zeros(_SIZE, np.float32)
    state = State(initial(), zeros.copy(), zeros.copy())
    for at in range(rounds):
        state = _round(sample, state, RATE * DECAY**at)
    _parts(state.flat)["bias"] += np.float32(np.log(sizes[1] / sizes[0] * drawn[0] / drawn[1]))
    return Model(state.flat)


def score(model: Model, text: Column) -> Column:
    """The probability that a text is good. A null text counts as an empty one."""

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(value.as_py() or "") for value in batch], pa.float64())

    return F.arrow_udf(scores, "double")(text)


def op12_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents by their text alone; see :func:`train` for what is learnt from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    scored = documents.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
