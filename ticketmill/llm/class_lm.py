"""Language-model scoring by a class bigram model whose classes come from exchange clustering.

Each word belongs to one class: P(text) is the product over its tokens of P(class | class before) and
P(word | class). Words with `min_uses` uses are clustered, at most `clustered` of them, the most frequent
first; all other words, and words never seen, share one more class, and the end token is its own.

Exchange clustering moves words, one at a time, to the class where the likelihood of the word pairs gains
most. The pairs of neighbouring words are counted by Spark over all training texts and stored as one row
for each word, its neighbours on both sides. The `seeds` most frequent words are exchanged one at a time
on the driver, against a table of bounded size in which all other words stand as one for each class.
For the others tasks read the rows of their words, sum the neighbours by class against the broadcast
classes, and propose the best class of half of the words a sweep (drawn by a hash of word and sweep, as
neighbours that move at once would undo each other's gain). The proposals are kept if the likelihood
grows, else half of them is tried. Sweeps end when two in a row gain less than `tolerance` nats a token
each; there is no other limit to their number.

Counts cover all training texts. Words are known by 64-bit hashes. What is broadcast is bounded by
`clustered` and `broadcast_words`: a hash, a count and a class for each of these words. All others meet
their counts in a join, in which no word is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.tables import discard, remainder_of_id, stored
from ticketmill.llm.words import LOWER, Words, chunks, find_words, scramble, sums_by_text, word_hashes

DISCOUNT = 0.5
SMOOTHING = 0.1
END, REST = 0, 1
#: Pairs a task holds before it hands them on, pairs a group holds on average, words weighed at once.
HELD_PAIRS = 1 << 20
GROUP_PAIRS = 1 << 20
BLOCK_WORDS = 128
#: Sweeps over the seeds after each sweep over all other words.
SEED_SWEEPS = 2
NEIGHBOURS = "word int, after binary, after_n binary, before binary, before_n binary"


@dataclass
class ClassModel:
    """Frequent words in order of hash with counts and classes, and the tables of the class bigram.

    Class 0 is the end token, class 1 holds all words that are not clustered. `unclustered` is the
    log10 of the probability of a discounted count of one in class 1, `unknown` that of an unseen word.
    """

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    transitions: np.ndarray
    emissions: np.ndarray
    tokens: int
    types: int
    ends: int
    rest: float
    unknown: float


def _lowered(chunk) -> tuple[Words, np.ndarray]:
    data = LOWER[chunk.data]
    words = find_words(data, chunk.bounds)
    return words, word_hashes(data, words).view(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all words of the column text: hash and count, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_lowered(chunk)[1] for chunk in chunks(batch.column("text"))]
            word, n = np.unique(np.concatenate(words or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"word": word, "n": n.astype(np.int64)})

    return texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _find(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place of each word in a sorted table, or -1."""
    if not len(table):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(table, words), len(table) - 1)
    return np.where(table[at] == words, at, -1)


def _with_ends(ids: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
    """ids of each text, each followed by the end id."""
    return np.insert(ids, bounds[1:], end)


def pair_counts(texts: DataFrame, hashes: np.ndarray, ids: np.ndarray) -> DataFrame:
    """(pair, n): how often a token follows another, pair being 2**32 times the first id plus the second.

    `ids` are those of the words whose sorted hashes are given; the next id is any other word, the one
    after that the end of a text, which also stands before its first word.
    """
    shared = texts.sparkSession.sparkContext.broadcast((hashes, ids))
    rest, end = len(hashes), len(hashes) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids = shared.value
        for batch in batches:
            pairs = []
            for chunk in chunks(batch.column("text")):
                words, found = _lowered(chunk)
                at = _find(hashes, found)
                own = np.where(at < 0, rest, ids[at]) if len(ids) else np.full(len(at), rest)
                path = _with_ends(own, words.bounds, end).astype(np.int64)
                pairs.append((np.append(end, path[:-1]) << 32) | path)
            pair, n = np.unique(np.concatenate(pairs or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pair, "n": n.astype(np.int64)})

    return texts.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """values[bounds[i]:bounds[i + 1]] as one binary value each."""
    offsets = (bounds * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _numbers(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of `_binaries`, and where those of each row begin and end."""
    _, offsets, data = column.cast(pa.binary()).buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(dtype).itemsize
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(whole.tobytes(), dtype), (offsets - offsets[0]) // size


def neighbours_by_word(pairs: DataFrame, groups: int) -> DataFrame:
    """A row for each word: ids and counts of the words after it and before it, as `NEIGHBOURS`.

    Pairs are counted before, so a word has no more neighbours than there are ids. They travel in
    blocks, to one of `groups` groups of words.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def blocks() -> Iterator[pa.RecordBatch]:
            pair, n = (np.concatenate(x) for x in zip(*held))
            first, second = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
            for after, word, other in ((True, first, second), (False, second, first)):
                group = word % groups
                order = np.argsort(group, kind="stable")
                begin = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
                bounds = np.append(begin, len(order))
                columns = {"part": pa.array(group[order][begin]), "after": pa.array(np.full(len(begin), after))}
                for name, values in (("word", word), ("other", other), ("n", n)):
                    columns[name] = _binaries(values[order], bounds)
                yield pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("pair").to_numpy(), batch.column("n").to_numpy()))
            if sum(len(x) for x, _ in held) >= HELD_PAIRS:
                yield from blocks()
                held.clear()
        if held:
            yield from blocks()

    def merge(rows: pa.Table) -> pa.Table:
        sides = {}
        for after in (True, False):
            own = rows.filter(pc.equal(rows.column("after"), after))
            word, other, n = (
                np.frombuffer(b"".join(own.column(name).to_pylist()), dtype)
                for name, dtype in (("word", np.int32), ("other", np.int32), ("n", np.int64))
            )
            order = np.argsort(word, kind="stable")
            sides[after] = word[order], other[order], n[order]
        words = np.union1d(sides[True][0], sides[False][0])
        columns = {"word": pa.array(words.astype(np.int32))}
        for name, (word, other, n) in (("after", sides[True]), ("before", sides[False])):
            bounds = np.append(np.searchsorted(word, words), len(word))
            columns[name], columns[f"{name}_n"] = _binaries(other, bounds), _binaries(n, bounds)
        return pa.table(columns)

    parts = pairs.mapInArrow(split, "part int, after boolean, word binary, other binary, n binary")
    return parts.groupBy("part").applyInArrow(merge, NEIGHBOURS)


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class pairs, up to what no exchange changes; `table` counts pairs of classes."""
    return float(_entropy(table).sum() - _entropy(table.sum(axis=1)).sum() - _entropy(table.sum(axis=0)).sum())


def gains(after: np.ndarray, before: np.ndarray, itself: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Of each word (row) and class (column): what `likelihood` gains if the word, taken out, joins the class.

    `after` and `before` count the word's neighbours by class, `itself` how often it follows itself (not
    counted there), `own` is its class, and `table` holds the words as they are.
    """
    gain = np.zeros(after.shape)
    for own_side, other_side, pairs in ((after, before, table), (before, after, table.T)):
        word, of = np.nonzero(own_side)
        if not len(word):
            continue
        n, each = own_side[word, of], np.arange(len(word))
        cells = pairs[:, of].T.copy()
        cells[each, own[word]] -= n
        same = np.flatnonzero(of == own[word])
        cells[same] -= other_side[word[same]]
        cells[same, own[word[same]]] -= itself[word[same]]
        more = _entropy(cells + n[:, None]) - _entropy(cells)
        more[each, of] = 0.0
        begin = np.flatnonzero(np.append(True, np.diff(word) != 0))
        gain[word[begin]] += np.add.reduceat(more, begin)
    each = np.arange(len(own))
    both = after + before + itself[:, None]
    corner = np.tile(np.diagonal(table), (len(own), 1))
    corner[each, own] -= both[each, own]
    gain += _entropy(corner + both) - _entropy(corner)
    for side, sums in ((after, table.sum(axis=1)), (before, table.sum(axis=0))):
        uses = side.sum(axis=1) + itself
        whole = np.tile(sums, (len(own), 1))
        whole[each, own] -= uses
        gain -= _entropy(whole + uses[:, None]) - _entropy(whole)
    return gain


def best_classes(after: np.ndarray, before: np.ndarray, itself: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of each word that gains most; its own, if none gains more, then the lowest."""
    gain = gains(after, before, itself, own, table)
    gain[:, : REST + 1] = -np.inf
    best = np.argmax(gain, axis=1)
    each = np.arange(len(own))
    return np.where(gain[each, best] > gain[each, own] + 1e-9, best, own)


def _folded(pairs: np.ndarray, own: np.ndarray, width: int) -> np.ndarray:
    """`pairs` of words summed to pairs of classes."""
    member = np.zeros((len(own), width))
    member[np.arange(len(own)), own] = 1
    return member.T @ pairs @ member


def exchange(pairs: np.ndarray, own: np.ndarray, words: int, width: int, sweeps: int | None = None) -> np.ndarray:
    """The classes `own` after the first `words` ids were moved one at a time, in order of their uses.

    `pairs` counts the followers of each id. Ends after `sweeps`, or when a sweep moves none, which comes
    as every move raises the likelihood.
    """
    own = own.astype(np.int64)
    order = np.argsort(-pairs[:words].sum(axis=1), kind="stable")
    member = np.zeros((len(pairs), width))
    member[np.arange(len(pairs)), own] = 1
    forward, backward = pairs @ member, pairs.T @ member
    table = member.T @ forward
    done, moved = 0, True
    while moved and done != sweeps:
        done, moved = done + 1, False
        for word in order:
            a, itself = own[word], pairs[word, word]
            after, before = forward[word].copy(), backward[word].copy()
            after[a] -= itself
            before[a] -= itself
            b = int(best_classes(after[None], before[None], np.array([itself]), own[word : word + 1], table)[0])
            if b == a:
                continue
            for place, sign in ((a, -1), (b, 1)):
                table[place] += sign * after
                table[:, place] += sign * before
                table[place, place] += sign * itself
            forward[:, a] -= pairs[:, word]
            forward[:, b] += pairs[:, word]
            backward[:, a] -= pairs[word]
            backward[:, b] += pairs[word]
            own[word], moved = b, True
    return own


def exchange_clusters(pairs: np.ndarray, classes: int) -> np.ndarray:
    """Class of each word, 2 and up; the last two ids of `pairs` are other words (1) and the end (0)."""
    words = len(pairs) - 2
    own = np.append(np.zeros(words, np.int64), [REST, END])
    own[np.argsort(-pairs[:words].sum(axis=1), kind="stable")] = 2 + np.arange(words) % max(classes, 1)
    return exchange(pairs, own, words, max(classes, 1) + 2)[:words]


class Clusters(NamedTuple):
    """Class of each id, the counts of pairs of classes, and how many sweeps it took."""

    own: np.ndarray
    table: np.ndarray
    sweeps: int


def _summed_cells(cells: DataFrame, width: int) -> np.ndarray:
    """A table from (cell, n) rows, of which tasks gave sums."""
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(width * width)
    table[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(width, width)


def class_pairs(neighbours: DataFrame, own: np.ndarray, width: int) -> np.ndarray:
    """How often each class follows another, from the rows of `neighbours_by_word`."""
    shared = neighbours.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value, np.zeros(width * width, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            other, bounds = _numbers(batch.column("after"), np.int32)
            n, _ = _numbers(batch.column("after_n"), np.int64)
            first = np.repeat(own[batch.column("word").to_numpy()], np.diff(bounds))
            np.add.at(table, first.astype(np.int64) * width + own[other], n)
        cell = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict({"cell": cell, "n": table[cell]})

    found = _summed_cells(neighbours.select("word", "after", "after_n").mapInArrow(run, "cell long, n long"), width)
    shared.unpersist()
    return found


def _drawn(words: np.ndarray, sweep: int) -> np.ndarray:
    """Half of the words, another half in each of two sweeps, halves drawn anew after these."""
    mixed = scramble(words.astype(np.uint64) + np.uint64((sweep // 2 + 1) << 40))
    return (mixed & np.uint64(1)) == np.uint64(sweep % 2)


def proposals(
    neighbours: DataFrame, own: np.ndarray, table: np.ndarray, first: int, sweep: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """(id, class) of the words from `first` on that gain by moving: of half of them, or of all if no sweep is given."""
    shared = neighbours.sparkSession.sparkContext.broadcast((own, table))
    width, words = len(table), len(own) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value
        for batch in batches:
            word = batch.column("word").to_numpy()
            asked = (word >= first) & (word < words) & (sweep is None or _drawn(word, sweep))
            batch = batch.filter(pa.array(asked))
            word = word[asked]
            sides = []
            for name in ("after", "before"):
                other, bounds = _numbers(batch.column(name), np.int32) if len(word) else (None, None)
                sides.append((other, _numbers(batch.column(f"{name}_n"), np.int64)[0] if len(word) else None, bounds))
            moved = []
            for low in range(0, len(word), BLOCK_WORDS):
                block = word[low : low + BLOCK_WORDS]
                sums, itself = [], None
                for other, n, bounds in sides:
                    inside = slice(bounds[low], bounds[low + len(block)])
                    row = np.repeat(np.arange(len(block)), np.diff(bounds[low : low + len(block) + 1]))
                    alike = other[inside] == block[row]
                    itself = np.bincount(row[alike], n[inside][alike], len(block))
                    cell = row[~alike] * width + own[other[inside][~alike]]
                    sums.append(np.bincount(cell, n[inside][~alike], len(block) * width).reshape(len(block), width))
                moved.append(best_classes(*sums, itself, own[block].astype(np.int64), table))
            found = np.concatenate(moved or [np.zeros(0, np.int64)])
            to = np.flatnonzero(found != own[word])
            yield pa.RecordBatch.from_pydict({"word": pa.array(word[to], pa.int32()), "own": pa.array(found[to], pa.int16())})

    found = neighbours.mapInArrow(run, "word int, own short").toArrow()
    shared.unpersist()
    return found.column("word").to_numpy(), found.column("own").to_numpy()


def cluster_words(neighbours: DataFrame, words: int, classes: int, seeds: int, tolerance: float) -> Clusters:
    """Exchange clustering of the ids below `words`; see the head of this module.

    The driver holds a class for each id and the pairs of seeds and classes, both of bounded size.
    """
    width, first = max(classes, 1) + 2, min(seeds, words)
    own = np.full(words + 2, REST, np.int16)
    own[-1] = END
    own[:first] = 2 + np.arange(first) % max(classes, 1)

    def seeds_moved(own: np.ndarray, sweeps: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Classes after moves of the seeds, all other words standing as one for each class; pairs of classes."""
        places = own + np.int16(first)
        places[:first] = np.arange(first)
        pairs = class_pairs(neighbours, places, first + width)
        found = exchange(pairs, np.append(own[:first], np.arange(width)), first, width, sweeps)
        own = own.copy()
        own[:first] = found[:first]
        return own, _folded(pairs, found, width)

    own, table = seeds_moved(own, None)
    if first == words:
        return Clusters(own, table, 0)
    word, to = proposals(neighbours, own, table, first, None)
    own[word] = to
    own, table = seeds_moved(own, SEED_SWEEPS)
    score, idle, sweep = likelihood(table), 0, 0
    least = tolerance * table.sum()
    while idle < 2:
        word, to = proposals(neighbours, own, table, first, sweep)
        gain, cut = 0.0, 0
        while len(word):
            moved = own.copy()
            moved[word] = to
            moved, new = seeds_moved(moved, SEED_SWEEPS)
            gain = likelihood(new) - score
            if gain > 0:
                own, table, score = moved, new, score + gain
                break
            # Together these moves lose: try half of them. A single one always gains.
            half = (scramble(word.astype(np.uint64)) >> np.uint64(20 + cut % 40)) & np.uint64(1) == 0
            word, to, cut = (word[half], to[half], cut + 1) if half.any() else (word[:1], to[:1], cut + 1)
        idle = 0 if gain > least else idle + 1
        sweep += 1
    return Clusters(own, table, sweep)


def train_class_model(
    texts: DataFrame, counts: DataFrame, clustered: int = 1 << 20, classes: int = 64, broadcast_words: int = 1 << 16,
    min_uses: int = 3, seeds: int = 512, tolerance: float = 0.005,
) -> ClassModel:
    """A model of the column text of `texts`, whose word counts are `counts`."""
    whole = counts.agg(F.count("*").alias("types"), F.sum("n").alias("tokens")).first()
    ends, types, tokens = texts.count(), whole.types or 0, whole.tokens or 0
    most = max(clustered, broadcast_words)
    used = counts.where(F.col("n") >= min_uses) if types > broadcast_words else counts
    top = used.orderBy(F.col("n").desc(), "word").limit(most).toArrow()
    word, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    by_count = np.lexsort((word, -n))
    chosen = by_count[:clustered]
    chosen = chosen[n[chosen] >= min_uses]
    order = np.argsort(word[chosen])
    pairs = pair_counts(texts, word[chosen][order], order.astype(np.int32))
    groups = max(1, min((tokens + ends) // GROUP_PAIRS, 1 << 16))
    neighbours = stored(neighbours_by_word(pairs, groups), "word-neighbours")
    found = cluster_words(neighbours, len(chosen), classes, seeds, tolerance)
    discard(neighbours)

    order = np.argsort(word)
    hashes, frequent = word[order], n[order]
    own = np.full(len(word), REST, np.int16)
    own[chosen] = found.own[: len(chosen)]
    own = own[order]
    table = found.table
    number = len(table)
    size = table.sum(axis=0)
    share = (size + SMOOTHING) / (size + SMOOTHING).sum()
    mixed = (table + SMOOTHING * number * share) / (table.sum(axis=1, keepdims=True) + SMOOTHING * number)

    inside = np.bincount(own, frequent, number)
    rest = tokens - inside[2:].sum()
    rest_types = types - int((own > REST).sum())
    freed = DISCOUNT * rest_types
    unknown = np.log10(freed / rest) if rest > 0 and rest_types > 0 else 0.0
    rare = np.log10((np.maximum(frequent, 1) - DISCOUNT) / max(rest, 1.0))
    emissions = np.where(own > REST, np.log10(frequent / np.maximum(inside[own], 1)), rare)
    return ClassModel(hashes, frequent, own, np.log10(mixed), emissions, tokens + ends, types + (ends > 0), ends, float(rest), float(unknown))


def _scores(words: Words, hashes: np.ndarray, model: ClassModel):
    """Of each text: sums over the tokens whose counts are broadcast, and the other words."""
    at = _find(model.hashes, hashes)
    known = at >= 0
    at = np.maximum(at, 0)
    some = len(model.hashes) > 0
    count = np.where(known, model.counts[at] if some else 0, 0)
    own = np.where(known, model.classes[at] if some else 1, 1)
    path = _with_ends(own, words.bounds, 0)
    bounds = words.bounds + np.arange(len(words.bounds))
    before = np.append(0, path[:-1])
    steps = sums_by_text(model.transitions[before, path], bounds)
    total = np.log10(model.tokens + model.types + 1)
    base = sums_by_text(np.where(known, np.log10(count + 1.0), 0.0), words.bounds) + np.log10(model.ends + 1.0)
    base -= np.diff(bounds) * total
    score = steps + sums_by_text(np.where(known, model.emissions[at] if some else 0.0, 0.0), words.bounds)
    n_known = sums_by_text(known.astype(np.int64), words.bounds) + (model.ends > 0)
    return base, score, n_known, np.diff(bounds), np.flatnonzero(~known)


def score_texts(docs: DataFrame, folds: int = 7, held_out: int = 2, **settings: int) -> DataFrame:
    """Unigram and class-bigram log10 probabilities of every whole text, learned from those not held out.

    Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. A-Z are
    lower-cased; each text has an end token; a null text is empty. A null id is never held out. Rows that
    are equal in id and text are scored together and come out as often as they came in. Without training
    texts every word is unknown. Columns beside doc_id and text are not read.
    """
    spark = docs.sparkSession
    out = F.coalesce(remainder_of_id("doc_id", folds) == held_out, F.lit(False))
    own = docs.select("doc_id", out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    training = own.where(~F.col("held_out"))
    counts = stored(word_counts(training), "word-counts")
    model = train_class_model(training, counts, **settings)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                words, hashes = _lowered(chunk)
                base, score, n_known, n_tokens, rest = _scores(words, hashes, model)
                text = np.searchsorted(words.bounds, rest, "right") - 1
                order = np.lexsort((hashes[rest], text))
                text, word = text[order], hashes[rest][order]
                first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (word[1:] != word[:-1]))) if len(text) else np.zeros(0, np.int64)
                many = np.diff(np.append(first, len(text)))
                rows, n = chunk.last - chunk.first, len(first)
                ids = batch.column("doc_id").slice(chunk.first, rows)
                marks = batch.column("mark").slice(chunk.first, rows)
                at = pa.array(np.concatenate([np.arange(rows), text[first]]))
                nothing = np.zeros(n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids.take(at), "mark": marks.take(at),
                        "word": pa.array(np.concatenate([marks.to_numpy(zero_copy_only=False), word[first]])),
                        "times": pa.array(np.concatenate([np.zeros(rows, np.int64), many])),
                        "n_rows": pa.array(np.concatenate([np.ones(rows, np.int64), np.zeros(n, np.int64)])),
                        "n_tokens": pa.array(np.concatenate([n_tokens, np.zeros(n, np.int64)]).astype(np.int64)),
                        "n_known": pa.array(np.concatenate([n_known, np.zeros(n, np.int64)]).astype(np.int64)),
                        "base": pa.array(np.concatenate([base, nothing])), "score": pa.array(np.concatenate([score, nothing])),
                    }
                )

    schema = "doc_id long, mark long, word long, times long, n_rows long, n_tokens long, n_known long, base double, score double"
    parts = own.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark")).mapInArrow(run, schema)
    # A text's own row carries no word; its hash only deals the rows out.
    met = parts.join(counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    rare = F.log10((n - F.lit(DISCOUNT)) / F.lit(max(model.rest, 1.0)))
    scored = met.select(
        "doc_id", "mark", "n_rows", "n_tokens",
        (F.col("n_known") + F.when(n > 0, F.col("times")).otherwise(0)).alias("n_known"),
        (F.col("base") + F.col("times") * F.log10(n + F.lit(1.0))).alias("base"),
        (F.col("score") + F.col("times") * F.when(n > 0, rare).otherwise(F.lit(model.unknown))).alias("score"),
    )
    sums = ("n_rows", "n_tokens", "n_known", "base", "score")
    summed = scored.groupBy("doc_id", "mark").agg(*[F.sum(c).alias(c) for c in sums])
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    per_row = {c: (F.col(c) / F.col("n_rows")) for c in sums[1:]}
    return each.select(
        "doc_id", F.coalesce(remainder_of_id("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
        per_row["n_tokens"].cast("long").alias("n_tokens"), per_row["n_known"].cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        per_row["base"].alias("base_score"), per_row["score"].alias("score"),
    )
