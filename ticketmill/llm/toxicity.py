"""Toxicity: misspelled terms by Levenshtein automata over a lexicon trie, weighed by their context.

The lexicon is a trie. A state of the automaton is the set of (trie node, edits so far) that a prefix
of a word can stand at; it is made once, when a word first needs it, so all texts are scanned with
table look-ups. Terms of `LENGTHS[k]` letters and more may differ by k edits.

A hit counts by the weight of its (term, edits), learned from labels. Its context decides what it
counts for: within quotation marks or beside a reporting word it is a quotation, near a word of address
it is directed, and the hits around it tell a heated passage from a single mention.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.quality_classifier import labels_of
from ticketmill.llm.samples import draw, known_by, sample_of_each
from ticketmill.llm.tables import remainder_of_id, stored
from ticketmill.llm.words import Chunk, chunks, code_points, find_words, lower_points, span_hashes

LENGTHS = (1, 4, 9)
WINDOW = 6
MOST_STATES = 1 << 17
ADDRESS = ("you", "your", "you're", "u", "du", "dich", "dein", "ihr", "tu", "toi", "ton", "vous", "usted", "eres")
REPORTING = (
    "said", "says", "say", "called", "calls", "call", "quote", "quoted", "quotes", "word", "words", "term", "wrote",
    "sagte", "wort", "dit", "mot", "dijo", "palabra",
)
QUOTES = {0x22: 0, 0x201C: 1, 0x201D: -1, 0x201E: 1, 0xAB: 1, 0xBB: -1}
FEATURES = ("plain", "misspelled", "quoted", "directed", "heated")


class LexiconAutomaton:
    """Finds the terms that a word is, or is a few edits away from."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.letters = {point: k + 1 for k, point in enumerate(sorted({ord(c) for term in terms for c in term}))}
        self.of_point = np.zeros(0x110000, np.uint8 if len(self.letters) < 255 else np.uint16)
        self.of_point[list(self.letters)] = list(self.letters.values())
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        self.most: list[int] = [0]
        for k, term in enumerate(terms):
            allowed, node = sum(len(term) >= n for n in LENGTHS) - 1, 0
            self.most[0] = max(self.most[0], allowed)
            for c in term:
                step = self.children[node].setdefault(self.letters[ord(c)], len(self.children))
                if step == len(self.children):
                    self.children.append({})
                    self.ends.append(-1)
                    self.most.append(0)
                self.most[step] = max(self.most[step], allowed)
                node = step
            self.ends[node] = k
        self.width = len(self.letters) + 1
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.table = np.full((1024, self.width), -1, np.int32)
        self.table[0] = 0
        self.term, self.edits = np.full(1024, -1, np.int32), np.zeros(1024, np.int8)
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of a state, closed under leaving out letters of a term."""
        queue = list(reached.items())
        for node, edits in queue:
            for child in self.children[node].values():
                if edits + 1 <= self.most[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    queue.append((child, edits + 1))
        key = frozenset(reached.items())
        if key in self.states:
            return self.states[key]
        number = self.states[key] = len(self.sets)
        self.sets.append(key)
        if number == len(self.table):
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
            self.term = np.concatenate([self.term, np.full_like(self.term, -1)])
            self.edits = np.concatenate([self.edits, np.zeros_like(self.edits)])
        whole = [
            (edits, self.ends[node]) for node, edits in key
            if self.ends[node] >= 0 and edits <= sum(len(self.terms[self.ends[node]]) >= n for n in LENGTHS) - 1
        ]
        if whole:
            self.edits[number], self.term[number] = min(whole)
        return number

    def _step(self, state: int, letter: int) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.sets[state]:
            reach(node, edits + 1)
            for at, child in self.children[node].items():
                reach(child, edits + (at != letter))
        return self._state(reached)

    def scan(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words points[start:end] are hits, their terms and their edits; best term first."""
        letters = self.of_point[points].astype(np.int64)
        state, live = np.full(len(start), self.start, np.int32), np.arange(len(start))
        final = np.zeros(len(start), np.int32)
        at = start.copy()
        while len(live):
            over = at[live] >= end[live]
            final[live[over]] = state[live[over]]
            live = live[~over]
            if not len(live):
                break
            letter = letters[at[live]]
            after = self.table[state[live], letter]
            missing = np.flatnonzero(after < 0)
            if len(missing):
                for pair in np.unique(state[live[missing]].astype(np.int64) * self.width + letter[missing]):
                    own, by = divmod(int(pair), self.width)
                    step = self._step(own, by)
                    self.table[own, by] = step
                after = self.table[state[live], letter]
            state[live] = after
            at[live] += 1
            live = live[after > 0]
        hits = np.flatnonzero(self.term[final] >= 0)
        return hits, self.term[final[hits]], self.edits[final[hits]]


@dataclass
class ToxicityModel:
    """Terms, the weight of each (term, edits), and a logistic regression on `FEATURES`, bias last."""

    terms: list[str]
    weights: np.ndarray
    coefficients: np.ndarray = field(default_factory=lambda: np.array([2.0, 2.0, 0.0, 0.5, 0.5, -3.0]))


_automata: dict[tuple, LexiconAutomaton] = {}


def _automaton(terms: list[str]) -> LexiconAutomaton:
    """The automaton of a worker; begun anew when words have made more than `MOST_STATES` states of it."""
    key = tuple(terms)
    if key not in _automata or len(_automata[key].sets) > MOST_STATES:
        _automata.clear()
        _automata[key] = LexiconAutomaton(terms)
    return _automata[key]


def _hashes_of(words: tuple[str, ...]) -> np.ndarray:
    joined = " ".join(words)
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    return span_hashes(points.astype(np.uint64) * 2 + 1, end - np.array([len(w) for w in words]), end)


def _punctuation() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[p for p in range(128) if not chr(p).isalnum()]] = True
    table[[0xAB, 0xBB, 0xA1, 0xBF, *range(0x2010, 0x2040)]] = True
    return table


PUNCTUATION = _punctuation()


def _pieces(core: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, start and end of each piece of the words that punctuation cuts into several.

    `core` are the places of all points that are no punctuation, `starts` those where words begin.
    """
    word = np.searchsorted(starts, core, "right") - 1
    new = np.append(True, (np.diff(core) > 1) | (np.diff(word) > 0))[: len(core)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(core)) - 1
    word = word[first]
    several = (word >= 0) & (np.bincount(np.maximum(word, 0), minlength=1)[word] > 1)
    return word[several], core[first[several]], core[last[several]] + 1


def _hits(chunk: Chunk, automaton: LexiconAutomaton) -> dict[str, np.ndarray]:
    """The hits of a chunk: text, term, edits, quoted, directed, and hits near by (itself included)."""
    points, _ = code_points(chunk)
    before = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum((chunk.data & 0xC0) != 0x80, out=before[1:])
    words = find_words(chunk.data, chunk.bounds)
    low = lower_points()[points]
    n = len(points)
    core = np.flatnonzero(~PUNCTUATION[low])
    start, end = before[words.start], before[words.end]
    after, until = np.searchsorted(core, start), np.searchsorted(core, end)
    some = until > after
    raw = start
    start = np.where(some, np.append(core, n)[np.minimum(after, len(core))], start)
    end = np.where(some, np.append(core, n)[np.maximum(until - 1, 0)] + 1, start)
    hits, term, edits = automaton.scan(low, start, end)
    where = start[hits]
    piece_word, piece_start, piece_end = _pieces(core, raw)
    if len(piece_word):
        rest = ~np.isin(piece_word, hits)
        more, more_term, more_edits = automaton.scan(low, piece_start[rest], piece_end[rest])
        where = np.append(where, piece_start[rest][more])
        order = np.argsort(where, kind="stable")
        hits, where = np.append(hits, piece_word[rest][more])[order], where[order]
        term, edits = np.append(term, more_term)[order], np.append(edits, more_edits)[order]

    text = np.searchsorted(words.bounds, hits, "right") - 1
    first, last = words.bounds[text], words.bounds[text + 1]
    around = np.stack([np.maximum(first, hits - WINDOW), np.minimum(last, hits + WINDOW + 1)])
    values = low.astype(np.uint64) * 2 + 1
    hashes = span_hashes(values, start, end) if len(hits) else np.zeros(len(start), np.uint64)
    piece_hashes = span_hashes(values, piece_start, piece_end) if len(hits) else np.zeros(len(piece_word), np.uint64)
    near = []
    for marks in (_hashes_of(REPORTING), _hashes_of(ADDRESS)):
        flags = np.isin(hashes, marks)
        flags[piece_word[np.isin(piece_hashes, marks)]] = True
        so_far = np.append(0, np.cumsum(flags))
        near.append(so_far[around[1]] > so_far[around[0]])
    wide = np.stack([np.maximum(first, hits - 4 * WINDOW), np.minimum(last, hits + 4 * WINDOW + 1)])
    company = np.searchsorted(hits, wide[1]) - np.searchsorted(hits, wide[0])
    return {
        "text": text, "term": term, "edits": edits, "quoted": _in_quotes(points, where, before[words.start[first]]) | near[0],
        "directed": near[1], "near": company,
    }


def _in_quotes(points: np.ndarray, at: np.ndarray, since: np.ndarray) -> np.ndarray:
    """Whether marks opened in the same line and text, before each place, are still open there."""
    if not len(at):
        return np.zeros(0, bool)
    breaks = np.append(-1, np.flatnonzero(points == 10))
    since = np.maximum(since, breaks[np.searchsorted(breaks, at) - 1] + 1)
    plain = np.append(0, np.cumsum(points == 0x22))
    paired = np.zeros(len(points), np.int64)
    for point, step in QUOTES.items():
        if step:
            paired[points == point] = step
    paired = np.append(0, np.cumsum(paired))
    return ((plain[at] - plain[since]) % 2 == 1) | (paired[at] - paired[since] > 0)


def _features(hits: dict[str, np.ndarray], texts: int, weights: np.ndarray) -> np.ndarray:
    weight = weights[hits["term"], hits["edits"]]
    own, quoted, spelled = ~hits["quoted"], hits["quoted"], hits["edits"] == 0

    def total(mask: np.ndarray) -> np.ndarray:
        return np.bincount(hits["text"][mask], weight[mask], minlength=texts)

    heated = np.zeros(texts)
    np.maximum.at(heated, hits["text"], np.where(own, weight * hits["near"], 0.0))
    sums = [total(own & spelled), total(own & ~spelled), total(quoted), total(own & hits["directed"]), heated]
    return np.log1p(np.stack(sums, axis=1))


def _chance(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Log of the probability that at least `a` of a + b contexts fall to label 1, whose share is `share`."""
    found = np.zeros(len(a))
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        i = np.arange(x, x + y + 1)
        own = _log_factorials(1 << max((x + y).bit_length(), 16))
        terms = own[x + y] - own[i] - own[x + y - i] + i * np.log(share) + (x + y - i) * np.log1p(-share)
        found[k] = terms.max() + np.log(np.exp(terms - terms.max()).sum())
    return np.minimum(found, 0.0)


@lru_cache(maxsize=1)
def _log_factorials(size: int) -> np.ndarray:
    return np.append(0.0, np.cumsum(np.log(np.arange(1, size + 1))))


def mine_lexicon(labelled: DataFrame, sure_contexts: int = 6, ratio: float = 20.0, by_chance: float = 10.0) -> list[str]:
    """Words that mark label 1: at least `ratio` times as frequent there, and hardly so by chance.

    Uses are counted once for each preceding word, so a text with many copies counts as one. Words of
    three letters and more compete. A word needs as many contexts as let about `by_chance` words at most
    pass by chance: with few labelled rows two or three do, and `sure_contexts` always do. Words with too
    few contexts to pass at all are not counted among those tried (Tarone).
    """
    parts = F.regexp_replace(F.lower("text"), r"[\p{Punct}«»“”„¿¡&&[^']]+", " ")
    plain = F.regexp_replace(parts, r"(^|[\s])[\p{Punct}«»“”„¿¡]+|[\p{Punct}«»“”„]+(?=\s|$)", " ")
    words = labelled.select("label", F.split(F.trim(plain), r"\s+").alias("w"))
    uses = words.select("label", F.explode(F.arrays_zip("w", F.concat(F.array(F.lit("")), "w").alias("p"))).alias("use"))
    uses = uses.select("label", F.col("use.w").alias("word"), F.xxhash64("use.p").alias("previous"))
    counted = stored(
        uses.where(F.length("word") >= 3).groupBy("word", "previous", "label").agg(F.lit(1))
        .groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")),
        "toxicity-words",
    )
    sizes = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    whole = counted.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    share = (whole.a + 0.5) / (whole.a + whole.b + 1)
    uses_of = {r.n: r.words for r in counted.groupBy((F.col("a") + F.col("b")).alias("n")).agg(F.count("*").alias("words")).collect()}
    # A word of n contexts passes with log chance n * log(share) at best: the fewer are asked, the more words are tried.
    tried, bound = 0, np.log(by_chance)
    for n in sorted(uses_of, reverse=True):
        if n * np.log(share) > np.log(by_chance) - np.log(tried + uses_of[n]):
            break
        tried += uses_of[n]
    if tried:
        bound -= np.log(tried)
    rate = ((F.col("a") + 0.5) / (sizes.get(1, 0) + 1)) / ((F.col("b") + 0.5) / (sizes.get(0, 0) + 1))
    marking = counted.withColumn("rate", rate).where((F.col("rate") >= ratio) & (F.col("a") > 1)).select("word", "a", "b").toArrow()
    a, b = (marking.column(c).to_numpy().astype(np.int64) for c in ("a", "b"))
    kept = (a >= sure_contexts) | (_chance(a, b, share) <= bound)
    return sorted(w for w, keep in zip(marking.column("word").to_pylist(), kept) if keep)


def train_toxicity_model(labelled: DataFrame, rows_per_label: int = 4000, extra_terms: tuple[str, ...] = ()) -> ToxicityModel:
    """A model of `label` (0 or 1) by `text`; `extra_terms` join the mined lexicon.

    At most about `rows_per_label` rows of each label are used: a documented bound of the sample. Rows
    with another label or a null text teach nothing; without rows of both labels every text scores low.
    """
    own = labelled.where("label IN (0, 1) AND text IS NOT NULL").select("text", "label", draw(known_by(labelled)).alias("drawn"))
    rows, counts = sample_of_each(own, "label", rows_per_label, "toxicity-sample", ["drawn"])
    mined = mine_lexicon(rows) if len(counts) == 2 else []
    terms = sorted({*mined, *(t.lower() for t in extra_terms if t)})
    model = ToxicityModel(terms, np.tile([1.0, 0.7, 0.4], (len(terms), 1)))
    if not terms or len(counts) < 2:
        return model
    shared = rows.sparkSession.sparkContext.broadcast(terms)
    hit = "array<struct<term int, edits int, quoted boolean, directed boolean, near int>>"

    @F.arrow_udf(hit)
    def find(texts: pa.Array) -> pa.Array:
        automaton, found = _automaton(shared.value), []
        for chunk in chunks(texts):
            hits = _hits(chunk, automaton)
            rows = [[] for _ in range(chunk.last - chunk.first)]
            for text, *values in zip(*(hits[k].tolist() for k in ("text", "term", "edits", "quoted", "directed", "near"))):
                rows[text].append(dict(zip(("term", "edits", "quoted", "directed", "near"), values)))
            found += rows
        kind = pa.struct({"term": pa.int32(), "edits": pa.int32(), "quoted": pa.bool_(), "directed": pa.bool_(), "near": pa.int32()})
        return pa.array(found, pa.list_(kind))

    found = stored(rows.select("label", find("text").alias("hits")), "toxicity-hits")
    each = found.select("label", F.explode("hits").alias("hit")).select("label", "hit.term", "hit.edits")
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    ones, zeros = min(ones, rows_per_label), min(zeros, rows_per_label)
    for r in each.groupBy("term", "edits").agg(F.sum("label").alias("a"), F.count("*").alias("n")).collect():
        gain = np.log((r.a + 0.5) / (ones + 1)) - np.log((r.n - r.a + 0.5) / (zeros + 1))
        model.weights[r.term, r.edits] = float(np.clip(gain / 4, 0.0, 1.0))
    bare = found.where(F.size("hits") > 0).collect()
    x, y = [], []
    for row in bare:
        columns = zip(*((0, h.term, h.edits, h.quoted, h.directed, h.near) for h in row.hits))
        hits = dict(zip(("text", "term", "edits", "quoted", "directed", "near"), map(np.array, columns)))
        x.append(_features(hits, 1, model.weights)[0])
        y.append(row.label)
    without = found.where(F.size("hits") == 0).groupBy("label").agg(F.count("*").alias("n")).collect()
    weight = [1.0] * len(x)
    for r in without:
        x.append(np.zeros(len(FEATURES)))
        y.append(r.label)
        weight.append(float(r.n))
    model.coefficients = _logistic(np.array(x), np.array(y, float), np.array(weight))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, steps: int = 30) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        w -= np.linalg.solve(hessian, gradient)
    return w


def toxicity_score(docs: DataFrame, model: ToxicityModel, text: str | Column = "text") -> Column:
    """Probability that each whole text is toxic; a null or empty text scores as one without hits."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model, found = shared.value, [np.zeros(0)]
        automaton = _automaton(model.terms)
        for chunk in chunks(texts):
            x = _features(_hits(chunk, automaton), chunk.last - chunk.first, model.weights)
            found.append(1 / (1 + np.exp(-(x @ model.coefficients[:-1] + model.coefficients[-1]))))
        return pa.array(np.concatenate(found))

    return score(F.col(text) if isinstance(text, str) else text)


def predict_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from labels that are not held out.

    A null id is never held out and has no label. Nulls and empty texts score as texts without a hit.
    Repeated rows are rows of their own; very long texts are read whole, in chunks; an empty table gives
    an empty one. Columns beside doc_id and text are not read, so their names may clash with anything.
    """
    out = F.coalesce(remainder_of_id("doc_id", folds) == held_out, F.lit(False))
    model = train_toxicity_model(labels_of(docs.where(~out), labels.where(~out), "toxic"))
    return docs.select("doc_id", out.alias("held_out"), toxicity_score(docs, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
