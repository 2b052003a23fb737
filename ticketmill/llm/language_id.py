"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of lower-cased 1- to 3-grams, hashed into `buckets`, are taken in Spark tasks over a bounded
sample of the rows that have a language. The log-probabilities, languages x buckets, are broadcast;
batches of texts are scored in numpy by gathering the rows of each text's n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.samples import draw, known_by, sample_of_each
from ticketmill.llm.tables import free_name, remainder_of_id
from ticketmill.llm.words import Chunk, chunks, code_points, lower_points, scramble

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
MATRIX_BYTES = 128 << 20
LEAST_BUCKETS = 1 << 10


@dataclass
class LanguageModel:
    """Log-probabilities of a naive Bayes model: prior (languages) and weights (buckets x languages)."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


def _ngrams(chunk: Chunk, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: hashed n-grams of a chunk, and how many lie before each text's first."""
    points, bounds = code_points(chunk)
    points = lower_points()[points].astype(np.uint64)
    rolled = np.zeros(len(points), np.uint64)
    until = np.repeat(bounds[1:], np.diff(bounds))
    for order in ORDERS:
        ahead = np.zeros_like(points)
        ahead[: max(0, len(points) - order + 1)] = points[order - 1 :]
        rolled = rolled * np.uint64(0x100000001B3) + ahead + np.uint64(order)
        whole = np.arange(len(points)) + order <= until
        before = np.zeros(len(points) + 1, np.int64)
        np.cumsum(whole, out=before[1:])
        yield (scramble(rolled[whole]) & np.uint64(buckets - 1)).astype(np.int64), before[bounds]


def train_language_model(
    docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = 4000, buckets: int = 1 << 15,
    smoothing: float = 0.1,
) -> LanguageModel:
    """A model of the languages in `docs`; rows without text or language teach nothing.

    About `rows_per_language` rows of each language, at most, are counted; priors come from all rows. The
    broadcast matrix has 4 bytes for each bucket and language; where that would be more than `MATRIX_BYTES`,
    which some thousand languages take, n-grams share fewer buckets.
    """
    drawn = draw(known_by(docs, text)).alias("drawn")
    rows, counts = sample_of_each(
        docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), drawn),
        "lang", rows_per_language, "language-sample", ["drawn"],
    )
    languages = sorted(counts)
    while buckets > LEAST_BUCKETS and 4 * buckets * len(languages) > MATRIX_BYTES:
        buckets //= 2
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((buckets, 0), np.float32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            spoken = batch.column("lang").to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column("text")):
                for grams, bounds in _ngrams(chunk, buckets):
                    of = np.repeat(spoken[chunk.first : chunk.last], np.diff(bounds))
                    for name in set(spoken[chunk.first : chunk.last]):
                        total = found.setdefault(name, np.zeros(buckets, np.int64))
                        total += np.bincount(grams[of == name], minlength=buckets)
        names = list(found)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(names, pa.string()), "counts": pa.array([found[n].tobytes() for n in names], pa.binary())}
        )

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in part.column("counts").to_pylist())
        return pa.table({"lang": part.column("lang").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(count, "lang string, counts binary")
    summed = {r.lang: np.frombuffer(r.counts, np.int64) for r in parts.groupBy("lang").applyInArrow(add, parts.schema).collect()}
    table = np.array([summed.get(name, np.zeros(buckets, np.int64)) for name in languages], np.float64) + smoothing
    weights = np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32)
    prior = np.log(np.array([counts[name] for name in languages]) / sum(counts.values()))
    return LanguageModel(languages, prior, np.ascontiguousarray(weights))


def log_likelihoods(texts: pa.Array, model: LanguageModel) -> np.ndarray:
    """Log-probability of each text under each language, prior included."""
    found = []
    for chunk in chunks(texts):
        total = np.tile(model.prior, (chunk.last - chunk.first, 1))
        for grams, bounds in _ngrams(chunk, len(model.weights)):
            has = np.diff(bounds) > 0
            if has.any():
                rows = model.weights[grams]
                total[has] += np.add.reduceat(rows, bounds[:-1][has], axis=0, dtype=np.float64)
        found.append(total)
    return np.concatenate(found) if found else np.zeros((0, len(model.languages)))


def language(docs: DataFrame, model: LanguageModel, text: str | Column = "text") -> Column:
    """A struct of lang_pred and score: the likeliest language and its posterior probability.

    A text that is null or has no letter is `und` with score 0, as is every text of an empty model.
    Ties go to the first language by name.
    """
    text = F.col(text) if isinstance(text, str) else text
    nothing = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.languages:
        return nothing
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        scores = log_likelihoods(texts, model)
        best = scores.argmax(axis=1)
        top = scores[np.arange(len(best)), best]
        posterior = 1 / np.exp(scores - top[:, None]).sum(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(np.array(model.languages, object)[best], pa.string()), pa.array(posterior)], ["lang_pred", "score"]
        )

    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), predict(text)).otherwise(nothing)


def predict_languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows that are not held out.

    A null id is never held out. Nulls and empty texts are `und`; repeated rows are rows of their own; very
    long texts are read whole, in chunks; an empty table gives an empty one. Columns beside doc_id, text and
    lang are not read, so their names may clash with anything.
    """
    own = docs.select("doc_id", "text", "lang", F.coalesce(remainder_of_id("doc_id", folds) == held_out, F.lit(False)).alias("held_out"))
    model = train_language_model(own.where(~F.col("held_out")))
    return own.withColumn("found", language(own, model)).select("doc_id", "held_out", "found.*")


def in_known_language(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of `docs` whose language is recognised with at least `least_score`; their columns stay, whatever
    their names.

    Null texts and texts without a letter go; an empty table gives an empty one.
    """
    spoken = free_name("__language", docs)
    judged = docs.withColumn(spoken, language(docs, train_language_model(docs)))
    found = F.col(spoken)
    return judged.where((found["lang_pred"] != UNDETERMINED) & (found["score"] >= least_score)).select(docs.columns)
