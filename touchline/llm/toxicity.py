"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts, one on toxic and one on ordinary ones, and every
window of a text is compressed with both. A window that reads like one kind becomes shorter with that
kind's dictionary: the difference of the two lengths is its distance.

Where a few words tell, most of that difference is chance. So there is a second pair, made of the same
content but for the end: the ordinary dictionary, and the same followed by what is frequent in toxic text
and foreign to ordinary text. A window without such wording compresses alike with both; the bytes saved
are counted above a threshold.

The figures of both pairs over all windows of a text go through one logistic curve, fitted on labelled
texts. For the fit the trained pair's figures come from dictionaries that haven't seen the text: trained
on the other half of the texts.

Labels are the only thing that is learnt from, and only from a bounded sample of rows
(:data:`MAX_SAMPLE`); every text is learnt from and scored whole.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table

# Labelled rows of each class that are learnt from, at most; those with the smallest key hashes.
MAX_SAMPLE = 2000
# Fragments with a smaller likelihood ratio are chance.
MIN_WEIGHT = 25.0
# Rarer fragments, as a share of the toxic texts, are chance too.
MIN_SHARE = 0.005
# Bytes that coding a match takes, and the least that the coder finds as one.
_MATCH = 3
_SHORTEST = 6
_PIECE = 4
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 768
LOOKALIKE_BYTES = 4_096
WINDOW_WORDS = 8
FOLDS = 5
# Bytes saved in a window that may be chance; the fit tries all numbers below.
MAX_THRESHOLD = 10
_LEVEL = 3
# Bytes of each trained dictionary.
TRAINED_BYTES = 32_768
# Of what the pipeline's stage drops, the share that is toxic by the texts learnt from.
STAGE_PRECISION = 0.95
# So many texts learnt from must lie above the cut.
CUT_TEXTS = 30
# The stage's cut if none is so precise: nothing scores as much, so nothing is dropped.
NO_CUT = 2.0

_log = logging.getLogger(__name__)


def windows(text: str) -> list[bytes]:
    """The text in runs of whole words, lower-cased, one space around each word."""
    words = text.lower().encode().split()
    return [b" " + b" ".join(words[at : at + WINDOW_WORDS]) + b" " for at in range(0, len(words), WINDOW_WORDS)]


def _fragments(text: str) -> Counter[bytes]:
    """Beginnings of the words of a text (a space and three to ten letters) and whole words."""
    words = Counter(text.lower().split())
    found: Counter[bytes] = Counter()
    for word, times in words.items():
        for end in range(3, min(len(word), 10) + 1):
            found[f" {word[:end]}"] += times
        found[f" {word} "] += times
    return found


def _different(texts: Sequence[str]) -> list[str]:
    """The texts without those of which half was in an earlier one: a family of copies counts once.

    Half is judged by a text's 32 smallest hashes of four-word runs.
    """
    seen: set[int] = set()
    kept = []
    for text in sorted(set(texts)):
        words = text.lower().split()
        runs = sorted({xxhash.xxh3_64_intdigest(" ".join(words[at : at + 4])) for at in range(max(1, len(words) - 3))})
        if sum(run in seen for run in runs[:32]) * 2 < len(runs[:32]):
            kept.append(text)
        seen.update(runs[:32])
    return kept


def _table(texts: Sequence[str]) -> tuple[int, Counter[str], Counter[str]]:
    """How many different texts there are, how many have each fragment, and how often in all."""
    having, times = Counter(), Counter()
    for text in (different := _different(texts)):
        found = _fragments(text)
        having.update(found.keys())
        times.update(found)
    return len(different), having, times


def toxic_wording(toxic: Sequence[str], ordinary: Sequence[str]) -> list[bytes]:
    """Fragments that tell toxic from ordinary texts, the most telling last.

    A fragment must tell by the texts that have it (likelihood ratio G). Its weight is what a match
    saves, times how often it occurs beyond thrice its rate in ordinary texts; of fragments that
    continue each other the heaviest stays. Copies count once.
    """
    inside, have, times = _table(toxic)
    outside, others_have, other_times = _table(ordinary)
    whole = lambda counts: sum(n for f, n in counts.items() if f[-1] == " ")
    scale = whole(times) / max(whole(other_times), 1)
    weights = {}
    for fragment, n in have.items():
        m, length = others_have[fragment], len(fragment.encode())
        if length < _SHORTEST or n < max(3, MIN_SHARE * inside) or n * outside <= 3 * m * inside:
            continue
        if _ratio(n, inside, m, outside) < MIN_WEIGHT:
            continue
        excess = times[fragment] - 3 * scale * (other_times[fragment] + 0.5)
        weight = excess * (length - _MATCH)
        if weight > 0:
            weights[fragment] = weight
    taken: list[str] = []
    for fragment in sorted(weights, key=lambda f: (-weights[f], f)):
        bare = fragment.rstrip()
        if not any(bare.startswith(t.rstrip()) or t.startswith(bare) for t in taken):
            taken.append(fragment)
    return [f.encode() for f in reversed(taken)]


def _ratio(n: int, inside: int, m: int, outside: int) -> float:
    """Likelihood ratio (G) of n of ``inside`` against m of ``outside`` texts."""
    share = (n + m) / (inside + outside)
    seen = np.array([n, m, inside - n, outside - m], float)
    even = np.array([inside * share, outside * share, inside * (1 - share), outside * (1 - share)])
    some = seen > 0
    return float(2 * np.sum(seen[some] * np.log(seen[some] / even[some])))


def _lookalikes(wording: Sequence[bytes], ordinary: Sequence[str]) -> bytes:
    """Ordinary words that have a small piece of a toxic fragment and no large one, the most frequent last.

    Both dictionaries get them: a chance likeness then saves nothing.
    """
    cut = lambda words, size: {w[at : at + size] for w in words for at in range(len(w) - size + 1)}
    small, large = cut(wording, _PIECE), cut(wording, _SHORTEST)
    words: Counter[bytes] = Counter()
    for text in set(ordinary):
        words.update(b" %b " % word for word in text.lower().encode().split())
    alike = [w for w in words if not small.isdisjoint(cut([w], _PIECE)) and large.isdisjoint(cut([w], _SHORTEST))]
    return b"".join(sorted(alike, key=lambda w: (words[w], w)))[-LOOKALIKE_BYTES:]


def _coder(content: bytes, raw: bool = False) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO
    known = zstandard.ZstdCompressionDict(content, dict_type=kind)
    known.precompute_compress(level=_LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)


def _shorter(longer: zstandard.ZstdCompressor, shorter: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    """By how many bytes every window is shorter with the second dictionary."""
    first, second = longer.compress, shorter.compress
    return np.fromiter((len(first(p)) - len(second(p)) for p in parts), np.int64, len(parts))


def trained(texts: Sequence[str], size: int = TRAINED_BYTES) -> bytes:
    """A dictionary trained on the windows of the different texts; their beginning if they are too few."""
    parts = [w for text in sorted(set(texts)) for w in windows(text)]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


@dataclass
class Model:
    """What scoring needs; a hundred kilobytes whatever the corpus."""

    ordinary: bytes
    toxic: bytes
    threshold: int = 0
    curve: list[float] = field(default_factory=lambda: [-4.0, *[0.0] * 5])
    # The pipeline's stage drops what scores as much; without anything learnt, nothing.
    cut: float = NO_CUT
    # The pair that is trained on toxic and on ordinary texts.
    trained_toxic: bytes = bytes(8)
    trained_ordinary: bytes = bytes(8)

    def __post_init__(self):
        self._coders: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"_coders": None}

    def _made(self) -> tuple:
        if self._coders is None:
            self._coders = (
                *(_coder(content, raw=True) for content in (self.ordinary, self.toxic)),
                *(_coder(content) for content in (self.trained_ordinary, self.trained_toxic)),
            )
        return self._coders

    def saved(self, text: str) -> np.ndarray:
        """Bytes that toxic wording saves in every window."""
        return _shorter(*self._made()[:2], windows(text))

    def distances(self, text: str) -> np.ndarray:
        """By how much every window is nearer to toxic than to ordinary text."""
        return _shorter(*self._made()[2:], windows(text))

    def score(self, text: str) -> float:
        """From 0 to 1; an empty text has the score of nothing saved."""
        figures = [*_figures(self.saved(text), self.threshold), *_distance_figures(self.distances(text))]
        return float(_curve(self.curve, np.array([figures]))[0])


def _figures(saved: np.ndarray, threshold: int) -> tuple[float, float]:
    """Bytes saved above the threshold: in all (as a logarithm), and per window."""
    above = np.maximum(saved - threshold, 0).sum()
    return float(np.log1p(above)), float(above / max(len(saved), 1))


def _distance_figures(distances: np.ndarray) -> tuple[float, float, float]:
    """The mean distance, the sum of what is over one byte (as a logarithm), the mean of what is over two."""
    n = max(len(distances), 1)
    over = [float(np.maximum(distances - k, 0).sum()) for k in (1, 2)]
    return float(distances.sum() / n), float(np.log1p(over[0])), over[1] / n


def _unseen_distances(texts: Sequence[str], labels: np.ndarray) -> np.ndarray:
    """The distance figures of all texts, by dictionaries trained on the other half of them.

    Halves are dealt by the texts, so copies are in one half. A half whose other half lacks a class has
    figures of nothing.
    """
    half = np.array([xxhash.xxh3_64_intdigest(text) % 2 for text in texts])
    found = np.zeros((len(texts), 3))
    for side in (0, 1):
        other = [[t for t, h, c in zip(texts, half, labels) if h != side and c == kind] for kind in (0, 1)]
        if all(other):
            pair = [_coder(trained(some)) for some in other]
            for at in np.flatnonzero(half == side):
                found[at] = _distance_figures(_shorter(*pair, windows(texts[at])))
    return found


def _curve(curve: Sequence[float], figures: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(curve[0] + figures @ np.array(curve[1:]), -30, 30)))


def _fit_curve(figures: np.ndarray, labels: np.ndarray) -> list[float]:
    """Logistic regression by Newton steps with a small ridge on figures of equal spread; classes keep
    their real shares."""
    middle, spread = figures.mean(axis=0), figures.std(axis=0)
    spread[spread == 0] = 1
    x = np.column_stack([np.ones(len(figures)), (figures - middle) / spread])
    beta, ridge = np.zeros(x.shape[1]), np.diag([0.0] + [0.01] * figures.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (labels - p) - ridge @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1]), grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slopes = beta[1:] / spread
    return [float(beta[0] - slopes @ middle), *slopes.tolist()]


def _cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, least: int = CUT_TEXTS) -> float:
    """The lowest cut from one half on above which STAGE_PRECISION of the weight is toxic.

    Above it must be ``least`` texts, lest a few at the top are toxic by chance. If no cut is so precise,
    what is toxic can't be told: the cut is above 1, which no score reaches.
    """
    order = np.argsort(-scores, kind="stable")
    falling = scores[order]
    precise = np.cumsum((labels * weights)[order]) / np.cumsum(weights[order])
    last = np.append(falling[1:] != falling[:-1], True) & (falling >= 0.5)  # equal scores fall together
    last &= np.arange(1, len(falling) + 1) >= least
    if last.any() and precise[last][-1] >= STAGE_PRECISION:
        return 0.5
    enough = falling[last & (precise >= STAGE_PRECISION)]
    return float(enough[-1]) if len(enough) else NO_CUT


def fit(toxic: Sequence[str], ordinary: Sequence[str], shares: tuple[int, int] | None = None) -> Model:
    """Dictionaries, threshold, curve and the stage's cut from labelled texts.

    ``shares`` are the sizes of both classes that the texts were drawn from, if not their own; the cut
    weighs the classes by them.

    Without texts of both classes nothing can be told apart: every text gets the same low score.
    """
    toxic, ordinary = [t or "" for t in toxic], [t or "" for t in ordinary]
    parts = [w for text in sorted(set(ordinary)) for w in windows(text)]
    if not toxic or not parts:
        return Model(bytes(8), bytes(8))
    known = {"trained_toxic": trained(toxic), "trained_ordinary": trained(ordinary)}
    plain = trained(ordinary, ORDINARY_BYTES)
    wording = toxic_wording(toxic, ordinary)
    plain += _lookalikes(wording, ordinary)
    for fragment in wording:  # so that only the toxic dictionary has them
        plain = plain.replace(fragment, bytes(len(fragment)))
    telling = (b"".join(wording) + b" ")[-TOXIC_BYTES:]
    # Of one length, so that what both know is equally far away and costs the same.
    model = Model(plain + bytes(len(telling)), plain + telling, **known)
    best, texts = np.inf, [*toxic, *ordinary]
    labels = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
    saved, distances = [model.saved(text) for text in texts], _unseen_distances(texts, labels)
    for threshold in range(MAX_THRESHOLD):
        figures = np.column_stack([np.array([_figures(s, threshold) for s in saved]), distances])
        curve = _fit_curve(figures, labels)
        p = _curve(curve, figures)
        loss = -np.mean(np.log(np.where(labels == 1, p, 1 - p)))
        if loss < best:
            best, model.threshold, model.curve = loss, threshold, curve
            fitted = p
    drawn = np.array([len(toxic), len(ordinary)], float)
    weights = np.repeat(np.array(shares or drawn) / drawn, drawn.astype(int))
    model.cut = _cut(fitted, labels, weights)
    return model


def held_out(key: Column) -> Column:
    """One row in five, by its key, is kept from all learning. Rows without key aren't held out."""
    remainder = F.crc32(key.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(False))


def _usable(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from, each once."""
    return labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()


def labelled_sample(documents: DataFrame, labels: DataFrame, size: int = MAX_SAMPLE) -> DataFrame:
    """Up to ``size`` labelled texts of each class, without held-out rows: text, toxic.

    A repeated key gives one text (the smallest), reduced in the map task. The rows are chosen on the label table alone, by the smallest hashes of their keys; at most
    ``2 * size`` keys are then broadcast to fetch the texts.
    """
    usable = _usable(labels)
    draw = F.xxhash64("doc_id")
    chosen = [usable.where(F.col("toxic") == c).orderBy(draw, "doc_id").limit(size) for c in (0, 1)]
    keys = chosen[0].unionByName(chosen[1])
    texts = documents.select("doc_id", "text").join(F.broadcast(keys), "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def train(documents: DataFrame, labels: DataFrame, size: int = MAX_SAMPLE) -> Model:
    """Fit on the bounded sample; its texts are all that reaches the driver. See :func:`fit`."""
    rows = labelled_sample(documents, labels, size).collect()
    by_class = {c: sorted(r.text or "" for r in rows if r.toxic == c) for c in (0, 1)}
    sizes = {r.toxic: r["count"] for r in _usable(labels).groupBy("toxic").count().collect()}
    return fit(by_class[1], by_class[0], (sizes.get(1, 0), sizes.get(0, 0)))


def score(model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1. A null text counts as an empty one."""

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t or "") for t in texts], dtype=float)

    return F.pandas_udf(scores, "double")(text)


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model, trained on them and their labels, scores below its cut for the stage.

    If no cut tells toxic from ordinary texts precisely enough, or there are no labels of both classes,
    all documents stay and a warning is logged.
    """
    model = train(documents, labels)
    if model.cut > 1:
        _log.warning("no cut is precise enough: no document is dropped as toxic")
    return documents.where(score(model, F.col("text")) < model.cut)


def op8_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of all documents by their text alone; see :func:`train` for what is learnt from.

    Empty and null texts have the score of a text in which nothing is saved.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    scored = documents.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
