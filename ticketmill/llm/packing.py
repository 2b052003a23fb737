"""Lexical retrieval packing: windows of related documents, found in a sharded BM25 index.

Texts become token ids once, in a written table. Documents are dealt to shards by the smallest hash of
their word pairs, so copies and near copies meet; hash ties are cut further by id, so a large group of
copies is spread over shards. Each shard builds an inverted index of all tokens of all its documents. A
window begins with a seed document and takes the seed's best neighbours that are not used yet; the one
that no longer fits is cut there, and what is left of it seeds the next window. Windows come out full
but for one a shard. Document frequencies and the mean length are those of all documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.samples import SEED
from ticketmill.llm.tables import stored
from ticketmill.llm.tokens import encoder
from ticketmill.llm.words import chunks, scramble

END = 0
K1, B = 1.2, 0.75
QUERY_TERMS = 24
SHARD_DOCUMENTS = 1024
LEAST_DOCUMENTS = 256
SHARD_TOKENS = 1 << 22
SHARDS_PER_PARTITION = 8
KEYS_PER_SHARD = 30
TIE_BITS = 20


@dataclass
class TermStatistics:
    """Weight of each token by its document frequency, and the mean length in tokens."""

    weight: np.ndarray
    mean_length: float


def _place(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The smallest hash of two neighbouring pieces of each text; zero for fewer than two."""
    if not len(hashes):
        return np.zeros(len(bounds) - 1, np.uint64)
    pairs = scramble(hashes * np.uint64(3) + np.roll(hashes, -1))
    has = np.diff(bounds) > 1
    least = np.zeros(len(bounds) - 1, np.uint64)
    if has.any():
        pairs[bounds[1:][np.diff(bounds) > 0] - 1] = np.uint64(2**64 - 1)
        starts = bounds[:-1][np.diff(bounds) > 0]
        least[np.diff(bounds) > 0] = np.minimum.reduceat(pairs, starts)
    return np.where(has, least, np.uint64(0))


def id_type(vocabulary: str, special: Mapping[str, int] = {}) -> np.dtype:  # noqa: B006
    """Little-endian type that holds every id: 16 bits where the vocabulary allows it."""
    with open(vocabulary, "rb") as lines:
        last = max([int(line.split()[1]) for line in lines] + list(special.values()))
    return np.dtype("<u2" if last < 1 << 16 else "<u4")


def token_table(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", special: Mapping[str, int] = {}  # noqa: B006
) -> DataFrame:
    """(doc_id, ids, key) of every row, written: ids as `id_type` with the end id, and the place among shards."""
    kind = id_type(vocabulary, special)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                ids, bounds, hashes, pieces = encoder(vocabulary).encode_texts(chunk, special)
                ids = ids.astype(kind)
                packed = [np.append(ids[a:b], kind.type(END)).tobytes() for a, b in zip(bounds, bounds[1:])]
                own = batch.column("id").slice(chunk.first, chunk.last - chunk.first)
                key = (_place(hashes, pieces) >> np.uint64(1)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"doc_id": own, "ids": pa.array(packed, pa.binary()), "key": pa.array(key)})

    tokens = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    made = tokens.mapInArrow(run, "doc_id long, ids binary, key long")
    ties = F.pmod(F.xxhash64("doc_id"), F.lit(1 << TIE_BITS))
    spread = F.shiftleft(F.shiftright("key", TIE_BITS), TIE_BITS).bitwiseOR(ties)
    return stored(made.withColumn("key", spread), "tokens")


def term_statistics(tokens: DataFrame, kind: np.dtype) -> TermStatistics:
    """Document frequencies and mean length over all documents; each task sums its own, one row a token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, documents, length = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for packed in batch.column("ids"):
                ids = np.unique(np.frombuffer(packed.as_buffer(), kind))
                if len(ids) and ids[-1] >= len(seen):
                    seen = np.append(seen, np.zeros(int(ids[-1]) + 1, np.int64))
                seen[ids] += 1
                documents += 1
                length += len(packed.as_buffer()) // kind.itemsize
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": np.append(at, [-1, -2]), "n": np.append(seen[at], [documents, length])})

    found = tokens.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r.term: r.n for r in found}
    documents, length = counts.pop(-1, 0), counts.pop(-2, 0)
    frequency = np.zeros(max(counts, default=0) + 1)
    frequency[list(counts)] = list(counts.values())
    return TermStatistics(np.log1p((documents - frequency + 0.5) / (frequency + 0.5)), length / max(documents, 1))


class ShardIndex:
    """BM25 over the documents of one shard, given as arrays of ids."""

    def __init__(self, documents: list[np.ndarray], statistics: TermStatistics):
        sizes = np.array([len(d) for d in documents])
        ids = np.concatenate(documents).astype(np.uint64)
        own = np.repeat(np.arange(len(documents)), sizes).astype(np.uint64)
        both, count = np.unique((own << np.uint64(32)) | ids, return_counts=True)
        document, term = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        unseen = statistics.weight.max(initial=1.0)
        weight = np.where(term < len(statistics.weight), statistics.weight[np.minimum(term, len(statistics.weight) - 1)], unseen)
        length = K1 * (1 - B + B * sizes[document] / max(statistics.mean_length, 1))
        score = weight * count * (K1 + 1) / (count + length)
        self.query_term, self.query_score = term, score
        self.query_bounds = np.searchsorted(document, np.arange(len(documents) + 1))
        order = np.argsort(term, kind="stable")
        self.document, self.score = document[order], score[order]
        terms = term[order]
        first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
        self.terms, self.bounds = terms[first], np.append(first, len(terms))
        self.documents = len(documents)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term with the seed, best first, ties by place in the shard."""
        own = slice(self.query_bounds[seed], self.query_bounds[seed + 1])
        terms, scores = self.query_term[own], self.query_score[own]
        if len(terms) > QUERY_TERMS:
            best = np.argpartition(-scores, QUERY_TERMS)[:QUERY_TERMS]
            terms = terms[best]
        at = np.searchsorted(self.terms, terms)
        spans = [slice(self.bounds[k], self.bounds[k + 1]) for k in at]
        total = np.bincount(
            np.concatenate([self.document[s] for s in spans]), np.concatenate([self.score[s] for s in spans]), self.documents
        )
        total[~unused] = 0
        found = np.flatnonzero(total)
        return found[np.argsort(-total[found], kind="stable")]


def pack_shard(documents: list[np.ndarray], statistics: TermStatistics, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); each id of each document lies in exactly one piece."""
    left = np.zeros(len(documents), np.int64)
    for k, ids in enumerate(documents):
        whole = len(ids) // window * window
        for start in range(0, whole, window):
            yield [(k, start, window)]
        left[k] = whole
    sizes = np.array([len(d) for d in documents])
    unused = sizes > left
    if not unused.any():
        return
    index = ShardIndex(documents, statistics)
    in_order, seed = iter(np.flatnonzero(unused).tolist()), None
    filled: list[tuple[int, int, int]] = []
    room = window

    def take(document: int) -> bool:
        """Put what is left of a document into the window; whether it all went in."""
        nonlocal room
        length = min(room, int(sizes[document] - left[document]))
        filled.append((document, int(left[document]), length))
        left[document] += length
        room -= length
        unused[document] = False
        return left[document] == sizes[document]

    while True:
        if seed is None:
            seed = next((k for k in in_order if unused[k]), None)
            if seed is None:
                break
        rest = None if take(seed) else seed
        if room:
            for near in index.neighbours(seed, unused).tolist():
                if not take(near):
                    rest = near
                if not room:
                    break
        if room:
            seed = None
            continue
        yield filled
        filled, room, seed = [], window, rest
    if filled:
        yield filled


def pack_documents(docs: DataFrame, vocabulary: str, window: int = 1024, special: Mapping[str, int] = {}) -> DataFrame:  # noqa: B006
    """Every piece of every row's ids, packed into sequences of at most `window` ids.

    Columns doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset. A null text is empty:
    its only id is the end. `special` has the texts that become one id wherever they stand. Repeated rows and
    null ids are packed as rows of their own, very long texts whole; an empty table gives an empty one.
    Columns beside doc_id and text are not read, so their names may clash with anything.
    """
    tokens, kind = token_table(docs, vocabulary, special=special), id_type(vocabulary, special)
    spark = docs.sparkSession
    statistics = spark.sparkContext.broadcast(term_statistics(tokens, kind))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = tokens.count()
    shards = max(1, min(partitions * SHARDS_PER_PARTITION, n // LEAST_DOCUMENTS))
    some = sorted(r.key for r in tokens.select("key").sample(min(1.0, KEYS_PER_SHARD * shards / max(n, 1)), SEED).collect())
    cuts = sorted(set(some[len(some) // shards :: max(1, len(some) // shards)]))

    @F.arrow_udf("int")
    def shard_of(keys: pa.Array) -> pa.Array:
        return pa.array([bisect_right(cuts, key) for key in keys.to_pylist()], pa.int32())

    def emit(shard: int, number: int, ids: list, texts: list[np.ndarray]) -> tuple[int, pa.RecordBatch]:
        rows = []
        for filled in pack_shard(texts, statistics.value, window):
            offset = 0
            for k, start, length in filled:
                crc = zlib.crc32(texts[k][start : start + length].astype("<u4").tobytes())
                rows.append((ids[k], start, length, crc, len(texts[k]), (shard << 32) + number, offset))
                offset += length
            number += 1
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
        return number, pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, size, ids, texts = None, 0, 0, [], []
        for batch in batches:
            rows = zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"))
            for own, doc_id, packed in rows:
                if texts and (own != shard or len(texts) >= SHARD_DOCUMENTS or size >= SHARD_TOKENS):
                    number, out = emit(shard, number, ids, texts)
                    yield out
                    size, ids, texts = 0, [], []
                if own != shard:
                    shard, number = own, 0
                ids.append(doc_id)
                texts.append(np.frombuffer(packed.as_buffer(), kind).copy())
                size += len(texts[-1])
        if texts:
            yield emit(shard, number, ids, texts)[1]

    dealt = tokens.withColumn("shard", shard_of("key")).repartition(partitions, "shard").sortWithinPartitions("shard", "key", "doc_id")
    return dealt.select("shard", "doc_id", "ids").mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
