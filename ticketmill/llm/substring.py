"""Substring dedup: words covered by passages that a document with a smaller id holds as well.

Every passage of `window` words has an anchor, the gram of `GRAM` words in it with the smallest hash;
consecutive passages with one anchor form a run. Equal passages have equal anchors, so they meet where
runs are dealt by anchor. Only runs whose anchor occurs in several documents travel, each different
run of a part of the table once. Where they meet, shards of them are indexed, an FM-index each, and
streamed past the index by backward search; its matching statistics tell the passages that match in
full, and the matching rows the smallest id that holds them.

Texts are written once, bucketed by part of the table, and never shuffled: both joins with them move
only lists of anchors and of answers to the part's own files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.fm_index import FMIndex
from ticketmill.llm.tables import stored
from ticketmill.llm.words import Chunk, Words, chunks, find_words, scramble, span_hashes, word_hashes
from ticketmill.plans.shared import new_folder

GRAM = 4
PART_ROWS_BITS = 15
SHARD_WORDS = 1 << 18
SAMPLE = 4096
COMMON_IN = 8
MOST_COMMON = 1 << 16
NO_ID = 2**63 - 1
LAST = np.uint64(1 << 63)


class Runs(NamedTuple):
    """Runs of passages of a chunk: passages first[i] to first[i] + n[i] - 1 (named by their first words)."""

    text: np.ndarray
    first: np.ndarray
    n: np.ndarray
    anchor: np.ndarray


def _grams(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A hash of the gram that begins at each word; grams in `common` come after all others."""
    size = max(len(hashes) - GRAM + 1, 0)
    mixed = np.zeros(size, np.uint64)
    for k in range(GRAM):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + size]
    mixed = scramble(mixed) >> np.uint64(1)
    if len(common) and size:
        at = np.searchsorted(common, mixed)
        at[at == len(common)] = 0
        mixed = np.where(common[at] == mixed, mixed | LAST, mixed)
    return mixed


def find_runs(words: Words, hashes: np.ndarray, window: int, common: np.ndarray) -> Runs:
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return Runs(none, none, none, np.zeros(0, np.uint64))
    grams, text = _grams(hashes, common), words.text_of_each()
    whole = text[window - 1 :] == text[: len(text) - window + 1]
    anchor = np.lib.stride_tricks.sliding_window_view(grams, window - GRAM + 1).argmin(axis=1) + np.arange(len(whole))
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(begins)
    n = np.bincount(np.cumsum(begins)[whole] - 1, minlength=len(first))
    return Runs(text[first], first, n, grams[anchor[first]])


def digests(hashes: np.ndarray, runs: Runs, window: int) -> np.ndarray:
    return span_hashes(hashes * np.uint64(2) + np.uint64(1), runs.first, runs.first + runs.n + window - 1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _chunk_runs(chunk: Chunk, window: int, common: np.ndarray) -> tuple[Words, np.ndarray, Runs]:
    words = find_words(chunk.data, chunk.bounds)
    hashes = word_hashes(chunk.data, words)
    return words, hashes, find_runs(words, hashes, window, common)


def _parts(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """The rows of `docs` as a table bucketed by part: rows of one task, 2 ** PART_ROWS_BITS at most."""
    spark = docs.sparkSession
    part = F.shiftright(F.monotonically_increasing_id(), PART_ROWS_BITS)
    name = f"parts_{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"), part.alias("part"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.format("parquet").option("path", new_folder(spark, name)).bucketBy(buckets, "part").saveAsTable(name)
    return spark.table(name)


def _common_grams(parts: DataFrame, window: int) -> np.ndarray:
    """Grams in `COMMON_IN` or more of about `SAMPLE` documents; they are made anchors only where nothing else is."""
    share = min(1.0, SAMPLE / max(parts.count(), 1))
    some = parts.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                words = find_words(chunk.data, chunk.bounds)
                mixed = _grams(word_hashes(chunk.data, words), np.zeros(0, np.uint64))
                text = words.text_of_each()
                inside = text[: len(mixed)] == text[GRAM - 1 :][: len(mixed)]
                both = np.unique(np.stack([mixed[inside], text[: len(mixed)][inside].astype(np.uint64)]), axis=1)
                yield pa.RecordBatch.from_pydict({"gram": _signed(both[0])})

    counted = some.mapInArrow(grams, "gram long").groupBy("gram").count().where(F.col("count") >= COMMON_IN)
    found = counted.orderBy(F.desc("count"), "gram").limit(MOST_COMMON).select("gram").collect()
    return np.unique(np.array([r["gram"] for r in found], np.int64).astype(np.uint64))


def _seen(window: int, common: np.ndarray):
    """The anchors of each part in a batch, and whether several documents of the batch have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            found = [
                (runs.anchor, runs.text + chunk.first)
                for chunk in chunks(batch.column("text"))
                for _, _, runs in [_chunk_runs(chunk, window, common)]
            ]
            if not found:
                continue
            anchor, row = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((row, anchor))
            anchor, row = anchor[order], row[order]
            change = np.ones(len(anchor), bool)
            change[1:] = anchor[1:] != anchor[:-1]
            many = np.zeros(len(anchor), bool)
            many[1:] = ~change[1:] & (row[1:] != row[:-1])
            group = np.cumsum(change) - 1
            known = np.bincount(group[many], minlength=int(change.sum())) > 0
            new = change.copy()
            new[1:] |= part[row[1:]] != part[row[:-1]]
            yield pa.RecordBatch.from_pydict({
                "anchor": _signed(anchor[new]), "part": pa.array(part[row[new]]), "known": pa.array(known[group[new]]),
            })

    return run


SEGMENT = "part long, anchor long, digest long, least long, greatest long, words string"


def _shared_runs(window: int, common: np.ndarray):
    """The different runs of a part whose anchors several documents have, with the ids that hold them."""

    def of(key: tuple, docs: pa.Table, open_: pa.Table) -> pa.Table:
        names = ["anchor", "digest", "least", "greatest", "words"]
        kinds = [pa.int64()] * 4 + [pa.string()]
        wanted = np.unique(open_.column("anchor").to_numpy().view(np.uint64)) if len(open_) else np.zeros(0, np.uint64)
        held: list[tuple] = []
        if len(wanted):
            ids = docs.column("id").fill_null(NO_ID).to_numpy()
            for chunk in chunks(docs.column("text")):
                words, hashes, runs = _chunk_runs(chunk, window, common)
                at = np.searchsorted(wanted, runs.anchor)
                at[at == len(wanted)] = 0
                runs = Runs(*(x[wanted[at] == runs.anchor] for x in runs))
                own = ids[chunk.first + runs.text]
                digest = digests(hashes, runs, window)
                distinct, kept, which = np.unique(digest, return_index=True, return_inverse=True)
                least, greatest = np.full(len(distinct), NO_ID), np.full(len(distinct), -NO_ID - 1)
                np.minimum.at(least, which, own)
                np.maximum.at(greatest, which, own)
                a, b = words.start[runs.first[kept]], words.end[runs.first[kept] + runs.n[kept] + window - 2]
                data = chunk.data.tobytes()
                held.append((runs.anchor[kept], distinct, least, greatest, [data[x:y] for x, y in zip(a, b)]))
        if not held:
            return pa.table([pa.array([], t) for t in [pa.int64(), *kinds]], ["part", *names])
        anchor, digest, least, greatest = (np.concatenate(x) for x in list(zip(*held))[:4])
        texts = pa.array([t for h in held for t in h[4]], pa.binary()).cast(pa.string())
        order = np.argsort(digest, kind="stable")
        first = np.flatnonzero(np.diff(digest[order], prepend=~digest[order[:1]]) != 0)
        least, greatest = np.minimum.reduceat(least[order], first), np.maximum.reduceat(greatest[order], first)
        kept = order[first]
        columns = [_signed(anchor[kept]), _signed(digest[kept]), pa.array(least), pa.array(greatest), texts.take(pa.array(kept))]
        return pa.table([pa.array(np.full(len(kept), key[0].as_py())), *columns], ["part", *names])

    return of


ANSWER = "part long, digest long, least binary"


def _matched(rows: pa.Table, window: int) -> pa.RecordBatch:
    """For the runs of a shard: the smallest id that holds each of their passages, where it is in several documents."""
    symbols, bounds = [], [np.zeros(1, np.int64)]
    for chunk in chunks(rows.column("words"), 1 << 22):
        words = find_words(chunk.data, chunk.bounds)
        symbols.append(word_hashes(chunk.data, words))
        bounds.append(words.bounds[1:] + bounds[-1][-1])
    bounds = np.concatenate(bounds)
    distinct, flat = np.unique(np.concatenate(symbols), return_inverse=True)
    flat = flat + 1
    run = np.repeat(np.arange(len(rows)), np.diff(bounds))
    spread = np.zeros(len(flat) + len(rows), np.int64)
    spread[np.arange(len(flat)) + run] = flat
    owner = np.repeat(np.arange(len(rows)), np.diff(bounds) + 1)

    index = FMIndex(spread, len(distinct) + 1)
    length, row = index.matching_statistics(flat, bounds, window)
    groups, held_by = index.groups(window), owner[index.order]
    least = np.minimum.reduceat(rows.column("least").to_numpy()[held_by], groups)
    greatest = np.maximum.reduceat(rows.column("greatest").to_numpy()[held_by], groups)
    full = np.flatnonzero(length == window)
    group = np.searchsorted(groups, row[full], "right") - 1
    answer = least[group].astype("<i8")
    shared = np.bincount(run[full][answer < greatest[group]], minlength=len(rows)) > 0
    upto = np.searchsorted(full, bounds)
    found = [answer[a:b].tobytes() for a, b, s in zip(upto, upto[1:], shared) if s]
    own = rows.select(["part", "digest"]).filter(pa.array(shared)).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [*(c.combine_chunks() for c in own.columns), pa.array(found, pa.binary())], ["part", "digest", "least"]
    )


def _search_shards(window: int):
    """Rows sorted by anchor, cut between anchors into shards of about `SHARD_WORDS` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            anchors = rows.column("anchor").to_numpy()
            spaces = rows.column("words").combine_chunks()
            sizes = np.diff(np.frombuffer(spaces.cast(pa.large_string()).buffers()[1], np.int64)[spaces.offset :][: len(rows) + 1])
            upto = size + np.cumsum(sizes) // 6
            last = None if not held else held[-1].column("anchor")[-1].as_py()
            begin = 0
            edges = np.flatnonzero(np.diff(anchors, prepend=anchors[0] if last is None else last) != 0)
            for edge in edges.tolist():
                words_held = (upto[edge - 1] if edge else size) - (0 if not begin else upto[begin - 1])
                if words_held >= SHARD_WORDS:
                    held.append(rows.slice(begin, edge - begin))
                    yield _matched(pa.concat_tables(held).combine_chunks(), window)
                    held, begin = [], edge
            held.append(rows.slice(begin))
            size = int(upto[-1] - (upto[begin - 1] if begin else 0))
        held = [h for h in held if len(h)]
        if held:
            yield _matched(pa.concat_tables(held).combine_chunks(), window)

    return run


RESULT = "id long, n_words long, removed array<struct<start: long, stop: long>>, kept string"


def _kept(window: int, common: np.ndarray):
    """The documents of a part without the words that passages of smaller ids cover."""

    def of(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("digest").to_numpy().view(np.uint64)) if len(answers) else np.zeros(0, np.int64)
        digest = answers.column("digest").to_numpy().view(np.uint64)[order] if len(answers) else np.zeros(0, np.uint64)
        blobs = answers.column("least").combine_chunks().take(pa.array(order)) if len(answers) else None
        ids = docs.column("id").fill_null(NO_ID).to_numpy()
        n_words, removed, spans, kept = [], [], [], []
        for chunk in chunks(docs.column("text")):
            words, hashes, runs = _chunk_runs(chunk, window, common)
            step = np.zeros(len(hashes) + 1, np.int64)
            if len(digest) and len(runs.first):
                own = digests(hashes, runs, window)
                at = np.searchsorted(digest, own)
                at[at == len(digest)] = 0
                hit = np.flatnonzero(digest[at] == own)
                if len(hit):
                    least = np.frombuffer(b"".join(blobs.take(pa.array(at[hit])).to_pylist()), "<i8")
                    passage = np.repeat(runs.first[hit], runs.n[hit]) + np.arange(len(least))
                    passage -= np.repeat(np.cumsum(runs.n[hit]) - runs.n[hit], runs.n[hit])
                    gone = passage[least < np.repeat(ids[chunk.first + runs.text[hit]], runs.n[hit])]
                    np.add.at(step, gone, 1)
                    np.add.at(step, gone + window, -1)
            cover = np.cumsum(step[:-1]) > 0
            n_words.append(np.diff(words.bounds))
            removed.append(_spans(cover, words))
            kept.append(_joined(chunk, words, ~cover))
        columns = [
            docs.column("id"), pa.array(np.concatenate(n_words)),
            pa.chunked_array(removed), pa.chunked_array(kept, pa.string()),
        ]
        return pa.table(columns, ["id", "n_words", "removed", "kept"])

    return of


def _spans(cover: np.ndarray, words: Words) -> pa.Array:
    """Maximal runs of covered words of each text, as word numbers from 0."""
    text = words.text_of_each()
    begins, ends = cover.copy(), cover.copy()
    begins[1:] &= ~cover[:-1] | (text[1:] != text[:-1])
    ends[:-1] &= ~cover[1:] | (text[1:] != text[:-1])
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    base = words.bounds[text[start]]
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(start, words.bounds).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(start - base), pa.array(stop - base)], ["start", "stop"]),
    )


def _joined(chunk: Chunk, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by single spaces."""
    start, end = words.start[kept], words.end[kept]
    bounds = np.searchsorted(np.flatnonzero(kept), words.bounds)
    size = end - start + 1
    upto = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - upto[:-1], size) + np.arange(upto[-1])
    out = np.append(chunk.data, np.uint8(32))[np.minimum(at, len(chunk.data))]
    out[upto[1:] - 1] = 32
    some = np.diff(bounds) > 0
    inside = np.ones(len(out), bool)
    inside[upto[bounds[1:][some]] - 1] = False
    sizes = np.where(some, np.diff(upto[bounds]) - 1, 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    joined = pa.py_buffer(np.ascontiguousarray(out[inside]))
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), joined).cast(pa.string())


def drop_repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """(id, n_words, removed, kept) for every row of `docs`.

    A passage is `window` words in a row (`window` 4 to 16). Words covered by a passage that begins in a document with
    a smaller id as well are removed; passages are judged on the input. removed has the spans of removed
    words, numbered from 0, kept the other words joined by single spaces. Ids are whole numbers. A null
    text has no words; a null id counts as greater than any other and as equal to a null id, so rows of
    one id never remove each other's words. Repeated rows are judged alike. Other columns are not
    read, so their names may clash with anything. An empty table gives an empty one. A task holds a
    part of the table (at most 32,768 rows of one task that reads it) and its longest text.
    """
    parts = _parts(docs, id_column, text)
    common = _common_grams(parts, window)
    seen = parts.mapInArrow(_seen(window, common), "anchor long, part long, known boolean")
    of_anchor = Window.partitionBy("anchor")
    open_ = (
        seen.withColumn("n", F.count("*").over(of_anchor)).withColumn("any", F.max("known").over(of_anchor))
        .where("n > 1 OR any").select("part", "anchor")
    )
    by_part = parts.select("id", "text", "part").groupBy("part")
    runs = by_part.cogroup(open_.groupBy("part")).applyInArrow(_shared_runs(window, common), SEGMENT)
    dealt = runs.repartition("anchor").sortWithinPartitions("anchor")
    answers = stored(dealt.mapInArrow(_search_shards(window), ANSWER), "answers")
    made = by_part.cogroup(answers.groupBy("part")).applyInArrow(_kept(window, common), RESULT)
    return made.withColumnRenamed("id", id_column)
