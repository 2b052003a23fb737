"""Ranked lexical search: a batch of queries against every document, over a sharded inverted index.

Queries come in blocks. For a block, every whole document is read once: each task turns its documents
into shards, inverted lists of the block's terms with the documents' lengths. Counts over all documents
give the weights. Then each shard is searched, query by query, in two ways at once: the short lists are
summed term by term into accumulators, which from then on are one more list, sorted by document and
bounded by its largest sum; this list and the long ones are walked document by document, block after
block, and documents that cannot reach the best scores so far are skipped. Each task keeps the best of
all its shards, so the bar rises from one shard to the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.tables import stored
from ticketmill.llm.words import BYTE_VALUES, LOWER, chunks, span_hashes

SHARD_DOCUMENTS = 1 << 14
SHARD_POSTINGS = 1 << 21
BLOCK_BYTES = 8 << 20
SHORT = 32
STRIDE = 4096
MERGERS = 64
NO_ID = 2**63 - 1

TERM = np.zeros(256, bool)
for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    TERM[low : high + 1] = True


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of the texts data[bounds[i]:bounds[i + 1]], in order, and where each text's begin."""
    inside = TERM[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[bounds] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[bounds] = False
    start, end = np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1
    return span_hashes(BYTE_VALUES[LOWER[data]], start, end), np.searchsorted(start, bounds)


@dataclass
class Queries:
    """Distinct terms of a block of queries, and for each query its terms with how often it has them."""

    terms: np.ndarray
    wanted: list[tuple[np.ndarray, np.ndarray]]


def _queries(texts: list[str | None]) -> Queries:
    own = []
    for chunk in chunks(pa.array(texts, pa.large_string())):
        hashes, bounds = _terms(chunk.data, chunk.bounds)
        own += [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
    terms = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]))
    wanted = [np.unique(np.searchsorted(terms, x), return_counts=True) for x in own]
    return Queries(terms, wanted)


INDEX = "documents long, terms long, df binary, ids binary, has_id binary, lengths binary, lists binary, docs binary, tfs binary"


def _indexer(terms: np.ndarray):
    """Batches of (id, text) to shards: one row each."""

    def shard(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, has_id, lengths, keys, tfs = (np.concatenate(x) for x in zip(*((h[0], h[1], h[2], h[4], h[5]) for h in held)))
        first = np.cumsum([0] + [len(h[0]) for h in held])
        docs = np.concatenate([h[3] + f for h, f in zip(held, first)])
        order = np.lexsort((docs, keys))
        lists = np.searchsorted(keys[order], np.arange(len(terms) + 1))
        found = {
            "documents": int((lengths > 0).sum()), "terms": int(lengths.sum()), "df": np.diff(lists).astype("<i8"),
            "ids": ids, "has_id": has_id, "lengths": lengths, "lists": lists.astype("<i8"),
            "docs": docs[order].astype("<i4"), "tfs": tfs[order].astype("<i4"),
        }
        return pa.RecordBatch.from_pydict({
            k: pa.array([v if isinstance(v, int) else v.tobytes()], pa.int64() if isinstance(v, int) else pa.binary())
            for k, v in found.items()
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, postings = [], 0, 0
        for batch in batches:
            ids = batch.column("id")
            known = np.asarray(ids.is_valid())
            ids = ids.fill_null(NO_ID).to_numpy()
            for chunk in chunks(batch.column("text")):
                hashes, bounds = _terms(chunk.data, chunk.bounds)
                text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                key = np.searchsorted(terms, hashes)
                hit = key < len(terms)
                hit[hit] = terms[key[hit]] == hashes[hit]
                both, tf = np.unique(text[hit] * max(len(terms), 1) + key[hit], return_counts=True)
                own = slice(chunk.first, chunk.last)
                held.append((
                    ids[own].astype("<i8"), known[own], np.diff(bounds).astype("<i8"),
                    both // max(len(terms), 1), both % max(len(terms), 1), tf,
                ))
                documents, postings = documents + chunk.last - chunk.first, postings + len(both)
                if documents >= SHARD_DOCUMENTS or postings >= SHARD_POSTINGS:
                    yield shard(held)
                    held, documents, postings = [], 0, 0
        if held:
            yield shard(held)

    return run


@dataclass
class Best:
    """The best `k` of what was offered: highest scores, equal ones by ascending id, null ids last."""

    k: int
    score: np.ndarray
    id: np.ndarray
    known: np.ndarray

    def offer(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        bar = self.bar()
        may = (score >= bar) & (score > 0)
        score, ids, known = (np.concatenate([a, b[may]]) for a, b in ((self.score, score), (self.id, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, -score))[: self.k]
        self.score, self.id, self.known = score[order], ids[order], known[order]

    def bar(self) -> int:
        """A document needs at least this score to be among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1


def _nothing(k: int) -> Best:
    return Best(k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))


@dataclass
class List:
    """Documents of a list in order, their parts of the score, and the largest part."""

    docs: np.ndarray
    parts: np.ndarray
    bound: int

    def within(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.docs, (first, last))
        return self.docs[a:b], self.parts[a:b]

    def probe(self, docs: np.ndarray) -> np.ndarray:
        """The parts of `docs`, zero where a document is not in the list."""
        at = np.searchsorted(self.docs, docs)
        at[at == len(self.docs)] = 0
        return np.where(self.docs[at] == docs, self.parts[at], 0)


def accumulate(lists: list[List]) -> list[List]:
    """Term at a time: the lists summed into one, sorted by document."""
    if not lists:
        return []
    docs, at = np.unique(np.concatenate([x.docs for x in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, at, np.concatenate([x.parts for x in lists]))
    return [List(docs, sums, int(sums.max()))]


def search_lists(lists: list[List], n: int, short: int, best: Best, ids: np.ndarray, known: np.ndarray) -> int:
    """Offer to `best` what may be among the best of documents 0 to n - 1; returns how many were scored in full.

    Lists of at most `short` documents are accumulated. Of the accumulators and the long lists, those
    whose bounds together stay under the bar name no document by themselves; the others do, and the
    first are only probed for documents that can still reach the bar.
    """
    lists = [x for x in lists if len(x.docs)]
    walked = accumulate([x for x in lists if len(x.docs) <= short]) + [x for x in lists if len(x.docs) > short]
    walked.sort(key=lambda x: x.bound)
    upto = np.cumsum([0] + [x.bound for x in walked])
    scored = 0
    for first in range(0, n, STRIDE):
        idle = int(np.searchsorted(upto, best.bar(), "left")) - 1
        if idle >= len(walked):
            break
        parts = [x.within(first, first + STRIDE) for x in walked[idle:]]
        sums = np.zeros(min(STRIDE, n - first), np.int64)
        for docs, part in parts:
            sums[docs - first] += part
        docs = np.flatnonzero(sums)
        score = sums[docs]
        docs += first
        for k in range(idle - 1, -1, -1):
            may = score + upto[k + 1] >= best.bar()
            docs, score = docs[may], score[may]
            if not len(docs):
                break
            score = score + walked[k].probe(docs)
        scored += len(docs)
        best.offer(score, ids[docs], known[docs])
    return scored


def _searcher(queries: Queries, weights: np.ndarray, n_all: int, l_all: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_nothing(k) for _ in queries.wanted]
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
                known, lists = np.frombuffer(row["has_id"], bool), np.frombuffer(row["lists"], "<i8")
                docs, tfs = np.frombuffer(row["docs"], "<i4").astype(np.int64), np.frombuffer(row["tfs"], "<i4").astype(np.int64)
                norm = 12 * (100 - 25 + (25 * lengths * n_all) // max(l_all, 1))
                parts = (1_000_000_000 * tfs) // (1000 * tfs + norm[docs])
                short = max(k, len(ids) // SHORT)
                for (terms, times), own in zip(queries.wanted, best):
                    found = []
                    for term, weight in zip(terms.tolist(), (weights[terms] * times).tolist()):
                        a, b = lists[term], lists[term + 1]
                        if weight and b > a:
                            part = parts[a:b] * weight
                            found.append(List(docs[a:b], part, int(part.max())))
                    search_lists(found, len(ids), short, own, ids, known)
        for query, own in enumerate(best):
            if len(own.score):
                yield pa.RecordBatch.from_pydict({
                    "query": pa.array([query] * len(own.score), pa.int32()),
                    "doc_id": pa.array(own.id, mask=~own.known), "score": pa.array(own.score),
                })

    return run


def _search_block(docs: DataFrame, texts: list[str | None], k: int) -> DataFrame:
    """(query, rank, doc_id, score) of a block of queries, which are numbered from 0."""
    queries = _queries(texts)
    index = stored(docs.mapInArrow(_indexer(queries.terms), INDEX), "index")
    totals = index.agg(F.sum("documents"), F.sum("terms")).first()
    n_all, l_all = (int(x or 0) for x in totals)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries.terms), np.int64)
        for batch in batches:
            for df in batch.column("df"):
                total += np.frombuffer(df.as_py(), "<i8")
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int64()), "df": pa.array(total[held], pa.int64())})

    df = np.zeros(len(queries.terms), np.int64)
    for row in index.select("df").mapInArrow(counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_all + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    found = index.drop("documents", "terms", "df").mapInArrow(
        _searcher(queries, weights, n_all, l_all, k), "query int, doc_id long, score long"
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    merged = found.withColumn("merger", F.spark_partition_id() % MERGERS)
    merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query", "merger").orderBy(*order)))
    merged = merged.where(F.col("rank") <= k)
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row["id"], row["text"]))
        size += len(row["text"] or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item id, rank, doc_id, score): the `k` best documents with a score above 0 for every row of `items`.

    Every row of `items` is a query of its own, and every row of `docs` a document: repeated rows rank
    apart, equal scores by ascending id, null ids last. A null text, of either side, has no terms; an
    item without results has no rows, so empty tables give none. Very long texts are read whole. Other
    columns are not read, so their names may clash with anything. Items pass through the driver in
    blocks of `BLOCK_BYTES`, and each block reads the documents once.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    named = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    kind = named.schema["id"].dataType
    found = None
    for block in _blocks(named):
        ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"query int, {item_id} {kind.simpleString()}")
        part = _search_block(own, [t for _, t in block], k).join(F.broadcast(ids), "query")
        part = part.select(item_id, "rank", F.col("doc_id").alias(id_column), "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"{item_id} {kind.simpleString()}, rank int, {id_column} long, score long")
    return found
