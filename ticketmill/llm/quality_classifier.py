"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

The features of a text are its words, pairs and triples of neighbouring words, the shapes of its words
(letters, digits and capitals reduced to one symbol each, other characters kept), pairs of neighbouring
shapes, and whether a word repeats the one before it; each is hashed into `buckets` and counted as a share of the text. A score is a sparse dot
product. Training runs in shards: each shard of a bounded sample makes per-row updates from the same
state, and the states are averaged after every round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.samples import SEED, draw, known_by, sample_of_each
from ticketmill.llm.tables import remainder_of_id, stored
from ticketmill.llm.words import BYTE_VALUES, LOWER, Chunk, chunks, find_words, scramble, span_hashes, sums_by_text

SCALE = 18.0
KINDS = 6
STATE = "shard int, z binary, n binary"
SHAPES = np.arange(256, dtype=np.uint8)
SHAPES[65:91], SHAPES[97:123], SHAPES[48:58], SHAPES[128:] = 65, 97, 48, 97


@dataclass
class QualityModel:
    """State of FTRL-proximal: accumulated gradients z and squared gradients n, the last place the bias."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / step, 0.0)


def _features(chunk: Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a chunk's texts, `KINDS` for each word, and where each text's begin and end."""
    words = find_words(chunk.data, chunk.bounds)
    surface = span_hashes(BYTE_VALUES[LOWER[chunk.data]], words.start, words.end)
    shape = span_hashes(_collapsed(chunk.data), words.start, words.end)
    first = np.zeros(len(surface) + 1, bool)
    first[words.bounds] = True
    first = first[:-1]
    before = np.roll(shape, 1)
    before[first] = 0
    again = (surface == np.roll(surface, 1)) & ~first
    pair = scramble(before * np.uint64(3) + shape)
    repeat = np.where(again, np.uint64(0x1234567), np.uint64(0x7654321))
    one_before = np.roll(surface, 1)
    one_before[first] = 0
    two_before = np.roll(one_before, 1)
    two_before[first] = 0
    two = scramble(one_before * np.uint64(5) + surface)
    three = scramble((two_before * np.uint64(5) + one_before) * np.uint64(7) + surface)
    all_ = np.stack([surface, shape ^ np.uint64(0x5555), pair, scramble(repeat), two, three], axis=1)
    return (all_.ravel() & np.uint64(buckets - 1)).astype(np.int64), words.bounds * KINDS


def _collapsed(data: np.ndarray) -> np.ndarray:
    """Symbols of shapes in which a run of equal symbols counts once."""
    shapes = SHAPES[data]
    values = BYTE_VALUES[shapes].copy()
    values[1:][shapes[1:] == shapes[:-1]] = 0
    return values


def _fit(texts: pa.Array, labels: np.ndarray, model: QualityModel) -> None:
    buckets = len(model.z) - 1
    for chunk in chunks(texts):
        features, bounds = _features(chunk, buckets)
        for row in range(chunk.last - chunk.first):
            own = features[bounds[row] : bounds[row + 1]]
            at, counts = np.unique(own, return_counts=True)
            at = np.append(at, buckets)
            x = np.append(counts * (SCALE / max(len(own), 1)), 1.0)
            w = model.weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - labels[chunk.first + row]) * x
            n = model.n[at]
            model.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / model.alpha * w
            model.n[at] = n + g * g


def _shard_fit(start: Broadcast, seed: int):
    """A function that makes one pass over a shard, in an order of its own, from the broadcast state."""

    def fit(part: pa.Table) -> pa.Table:
        own = QualityModel(start.value.z.copy(), start.value.n.copy())
        part = part.sort_by([("text", "ascending"), ("label", "ascending")])
        part = part.take(np.random.default_rng(seed).permutation(len(part)))
        _fit(part.column("text"), part.column("label").to_numpy(), own)
        return _state(part.column("shard")[0].as_py(), own.z, own.n)

    return fit


def _state(shard: int, z: np.ndarray, n: np.ndarray) -> pa.Table:
    one = {"shard": pa.array([shard], pa.int32()), "z": pa.array([z.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary())}
    return pa.table(one)


def _mean_state(part: pa.Table) -> pa.Table:
    """One state for those of all shards, so that the driver gets no more than one."""
    part = part.sort_by("shard")
    z, n = (np.mean([np.frombuffer(x) for x in part.column(c).to_pylist()], axis=0) for c in ("z", "n"))
    return _state(-1, z, n)


def train_quality_model(
    labelled: DataFrame, rows_per_label: int = 6000, shards: int = 8, rounds: int = 3, buckets: int = 1 << 17
) -> QualityModel:
    """A model of `label` (0 or 1) by `text`; rows with another or no label are left out.

    At most about `rows_per_label` rows of each label are used: a documented bound of the sample. A null
    text counts as empty. Without rows the model scores 0.5.
    """
    by = known_by(labelled)
    own = labelled.where("label IN (0, 1)").select("text", "label", draw(by, SEED + 1).alias("drawn"), draw(by).alias("again"))
    rows, counts = sample_of_each(own, "label", rows_per_label, "quality-sample", ["again"])
    model = QualityModel(np.zeros(buckets + 1), np.zeros(buckets + 1))
    if not counts:
        return model
    rows = stored(rows.withColumn("shard", (F.col("drawn") % shards).cast("int")), "quality-shards")
    context = rows.sparkSession.sparkContext
    for turn in range(rounds):
        fit = _shard_fit(context.broadcast(model), SEED + turn)
        states = rows.groupBy("shard").applyInArrow(fit, STATE)
        for state in states.groupBy().applyInArrow(_mean_state, STATE).collect():
            model = QualityModel(np.frombuffer(state.z), np.frombuffer(state.n))
    return model


def quality_score(docs: DataFrame, model: QualityModel, text: str | Column = "text") -> Column:
    """Probability of label 1 for each text; null and empty texts have the score of the bias alone."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights())

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        w = weights.value
        found = [np.zeros(0)]
        for chunk in chunks(texts):
            features, bounds = _features(chunk, len(w) - 1)
            size = np.maximum(np.diff(bounds), 1)
            found.append(w[-1] + sums_by_text(w[features], bounds) * SCALE / size)
        return pa.array(1 / (1 + np.exp(-np.concatenate(found))))

    return score(F.col(text) if isinstance(text, str) else text)


def labels_of(docs: DataFrame, labels: DataFrame, label: str, rows: int = 20_000) -> DataFrame:
    """doc_id, text and label of documents that have one; of several labels of an id, the smallest.

    About `rows` ids of each label, at most, take part: a documented bound. Their list is broadcast, so
    the texts stay where they are.
    """
    least = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    chosen, _ = sample_of_each(least.where("label IN (0, 1)"), "label", rows, "label-sample", ["doc_id"])
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def predict_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from labels that are not held out.

    A null id is never held out and has no label. Nulls and empty texts have the score of the bias alone.
    Repeated rows are rows of their own; very long texts are read whole, in chunks; an empty table gives
    an empty one. Columns beside doc_id and text are not read, so their names may clash with anything.
    """
    out = F.coalesce(remainder_of_id("doc_id", folds) == held_out, F.lit(False))
    model = train_quality_model(labels_of(docs.where(~out), labels.where(~out), "quality"))
    return docs.select("doc_id", out.alias("held_out"), quality_score(docs, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def of_good_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` that score at least `threshold`, learned from all labels; their columns stay, whatever
    their names.

    Nulls and empty texts are judged by the bias alone; an empty table gives an empty one.
    """
    model = train_quality_model(labels_of(docs, labels, "quality"))
    return docs.where(quality_score(docs, model) >= threshold)
