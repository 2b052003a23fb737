"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line, cut after sentence ends and after `PIECE_WORDS` words. Its digest, together with
how often it occurred before in the text, is one element of a set. A sketch adds each element to three
cells that hold a count, the xor of the digests and the xor of their checks. The sketch of one version
minus that of another holds only what differs: cells with a single element are peeled off until the
digests of all differing paragraphs are known. If peeling gets stuck, both versions are sketched again
with four times the cells.
"""

from __future__ import annotations

import base64
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.neighbours import map_with_next
from ticketmill.llm.words import BYTE_VALUES, Chunk, chunks, find_words, scramble, span_hashes

PIECE_WORDS = 8
CELLS = 24
GROWTH = 4
HASHES = 3
ENOUGH = 16
SALTS = np.array([0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0xFF51AFD7ED558CCD], np.uint64)
CHECK = np.uint64(0xD6E8FEB86659FD93)
CELL = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
SENTENCE_ENDS = np.isin(np.arange(256), [33, 46, 63])


class Elements(NamedTuple):
    """Digests of the paragraphs of some texts; those of text i are digests[bounds[i]:bounds[i + 1]]."""

    digests: np.ndarray
    bounds: np.ndarray

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The digests of the texts listed, and the place in the list that each belongs to."""
        sizes = np.diff(self.bounds)[texts]
        place = np.repeat(np.arange(len(texts)), sizes)
        first = np.repeat(self.bounds[texts], sizes)
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.digests[first + within], place


def _elements(chunk: Chunk) -> Elements:
    data = chunk.data
    words = find_words(data, chunk.bounds)
    n = len(words.start)
    if not n:
        return Elements(np.zeros(0, np.uint64), np.zeros(len(chunk.bounds), np.int64))
    lines = np.append(0, np.cumsum(data == 10))
    opens = np.zeros(n, bool)
    opens[words.bounds[:-1][np.diff(words.bounds) > 0]] = True
    opens[1:] |= lines[words.start[1:]] > lines[words.start[:-1]]
    opens[1:] |= SENTENCE_ENDS[data[words.end[:-1] - 1]]
    at = np.arange(n)
    opens |= (at - np.maximum.accumulate(np.where(opens, at, 0))) % PIECE_WORDS == 0
    first = np.flatnonzero(opens)
    last = np.append(first[1:], n) - 1
    digests = span_hashes(BYTE_VALUES[data], words.start[first], words.end[last])
    bounds = np.searchsorted(first, words.bounds)

    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((digests, text))
    new = np.ones(len(order), bool)
    new[1:] = (digests[order][1:] != digests[order][:-1]) | (text[order][1:] != text[order][:-1])
    place = np.arange(len(order))
    earlier = np.empty(len(order), np.int64)
    earlier[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return Elements(scramble(digests + earlier.astype(np.uint64) * CHECK), bounds)


def elements(texts: pa.Array) -> Elements:
    """The set of paragraph digests of each text; none for a null or blank text."""
    parts = [_elements(chunk) for chunk in chunks(texts)] or [Elements(np.zeros(0, np.uint64), np.zeros(1, np.int64))]
    shift = np.cumsum([0] + [p.bounds[-1] for p in parts])
    bounds = np.concatenate([[0], *(p.bounds[1:] + s for p, s in zip(parts, shift))])
    return Elements(np.concatenate([p.digests for p in parts]), bounds.astype(np.int64))


def _cells_of(digests: np.ndarray, row: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each digest, one for each hash, in rows of `cells`."""
    part = cells // HASHES
    spots = [scramble(digests ^ salt) % np.uint64(part) + np.uint64(k * part) for k, salt in enumerate(SALTS)]
    return np.stack(spots).astype(np.int64) + row * cells


def _checks(digests: np.ndarray) -> np.ndarray:
    return (scramble(digests + CHECK) >> np.uint64(32)).astype(np.uint32)


def _change(table: np.ndarray, digests: np.ndarray, row: np.ndarray, sign: np.ndarray | int) -> None:
    if not len(digests):
        return
    spots = _cells_of(digests, row, table.shape[1]).ravel()
    order = np.argsort(spots)
    spots, which = spots[order], order % len(digests)
    first = np.flatnonzero(np.append(True, spots[1:] != spots[:-1]))
    flat, at = table.reshape(-1), spots[first]
    flat["count"][at] += np.add.reduceat(np.broadcast_to(sign, len(digests))[which], first)
    flat["key"][at] ^= np.bitwise_xor.reduceat(digests[which], first)
    flat["check"][at] ^= np.bitwise_xor.reduceat(_checks(digests)[which], first)


def sketches(sets: Elements, texts: np.ndarray, cells: int) -> np.ndarray:
    table = np.zeros((len(texts), cells), CELL)
    digests, row = sets.of(texts)
    _change(table, digests, row, 1)
    return table


def peel(difference: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, digest and sign of all that could be peeled off, and which rows came out empty.

    A cell is pure if its check is that of its key and it is one of the key's own cells. A mixed cell may
    still look so by chance, and would be peeled off and come back in turns; no sketch gives back more
    digests than it has cells, so peeling ends after as many rounds, and such a row does not come out empty.
    """
    table, found = difference.copy(), []
    cells = table.shape[1]
    for _ in range(cells):
        row, cell = np.nonzero((np.abs(table["count"]) == 1))
        own = table[row, cell]
        pure = own["check"] == _checks(own["key"])
        row, cell, own = row[pure], cell[pure], own[pure]
        mine = (_cells_of(own["key"], row, cells) == row * cells + cell).any(axis=0)
        row, own = row[mine], own[mine]
        if not len(row):
            break
        _, once = np.unique(scramble(row.astype(np.uint64)) ^ own["key"], return_index=True)
        row, digests, sign = row[once], own["key"][once], own["count"][once]
        _change(table, digests, row, -sign)
        found.append((row, digests, sign))
    empty = ~(table["count"].any(axis=1) | table["key"].any(axis=1) | table["check"].any(axis=1))
    row, digests, sign = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return row, digests, sign, empty


def differences(
    old: Elements, new: Elements, of_old: np.ndarray, of_new: np.ndarray, cells: int = CELLS,
    made: tuple[np.ndarray, np.ndarray] | None = None,
):
    """For each pair of texts: digests only in the old, digests only in the new, and the cells it took.

    `made` has the sketches of both sides with `cells` cells, if they are there. Sketches grow until they can
    be peeled; a pair that cannot be with `ENOUGH` cells for each of its digests holds a digest twice, and
    its digests are compared one by one.
    """
    removed, added = [None] * len(of_old), [None] * len(of_old)
    took, open_ = np.zeros(len(of_old), np.int64), np.arange(len(of_old))
    while len(open_):
        sizes = np.diff(old.bounds)[of_old[open_]] + np.diff(new.bounds)[of_new[open_]]
        for k in open_[cells > ENOUGH * sizes + CELLS * GROWTH**2]:
            own, other = (x.digests[x.bounds[t[k]] : x.bounds[t[k] + 1]] for x, t in ((old, of_old), (new, of_new)))
            removed[k], added[k], took[k] = np.setdiff1d(own, other), np.setdiff1d(other, own), cells
        open_ = open_[cells <= ENOUGH * sizes + CELLS * GROWTH**2]
        if not len(open_):
            break
        left = made[0][of_old[open_]] if made else sketches(old, of_old[open_], cells)
        right = made[1][of_new[open_]] if made else sketches(new, of_new[open_], cells)
        made = None
        left["count"] -= right["count"]
        left["key"] ^= right["key"]
        left["check"] ^= right["check"]
        row, digests, sign, empty = peel(left)
        order = np.argsort(row, kind="stable")
        row, digests, sign = row[order], digests[order], sign[order]
        edges = np.searchsorted(row, np.arange(len(open_) + 1))
        for k in np.flatnonzero(empty):
            part = slice(edges[k], edges[k + 1])
            removed[open_[k]], added[open_[k]] = digests[part][sign[part] > 0], digests[part][sign[part] < 0]
            took[open_[k]] = cells
        open_, cells = open_[~empty], cells * GROWTH
    return removed, added, took


def likeness(
    old: Elements, new: Elements, of_old: np.ndarray, of_new: np.ndarray, made: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """Share of paragraphs in both texts among those in either, from the peeled difference."""
    removed, added, _ = differences(old, new, of_old, of_new, made=made)
    size = np.diff(old.bounds)[of_old].astype(float)
    less, more = np.array([len(x) for x in removed], float), np.array([len(x) for x in added], float)
    either = size + more
    return np.where(either > 0, (size - less) / np.maximum(either, 1), 1.0)


def _all_sketches(sets: Elements, cells: int = CELLS) -> np.ndarray:
    return sketches(sets, np.arange(len(sets.bounds) - 1), cells)


def as_text(sets: Elements, cells: int = CELLS) -> list[str]:
    return _texts_of(_all_sketches(sets, cells))


def _texts_of(tables: np.ndarray) -> list[str]:
    return [base64.b64encode(table.tobytes()).decode() for table in tables]


def paragraph_sketch(text: str | Column, cells: int = CELLS) -> Column:
    """The sketch of each whole text, base64; equal texts have equal sketches, null is as empty."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(as_text(elements(texts), cells), pa.string())

    return of(F.col(text) if isinstance(text, str) else text)


def version_difference(old: str, new: str) -> Column:
    """removed and added (digests of paragraphs, longs in order), likeness, and cells of two versions of a text."""
    kind = pa.struct({"removed": pa.list_(pa.int64()), "added": pa.list_(pa.int64()), "likeness": pa.float64(), "cells": pa.int64()})

    @F.arrow_udf("removed array<long>, added array<long>, likeness double, cells long")
    def of(before: pa.Array, after: pa.Array) -> pa.Array:
        a, b, at = elements(before), elements(after), np.arange(len(before))
        removed, added, cells = differences(a, b, at, at)
        near = likeness(a, b, at, at)
        rows = zip(removed, added, near.tolist(), cells.tolist())
        return pa.array(
            [{"removed": np.sort(r.view(np.int64)), "added": np.sort(n.view(np.int64)), "likeness": x, "cells": c} for r, n, x, c in rows],
            kind,
        )

    return of(old, new)


def _edit(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _compare(ids: pa.Array, texts: pa.Array, after: pa.Array) -> pa.RecordBatch:
    own, following = ([t or "" for t in column.to_pylist()] for column in (texts, after))
    edited = [_edit(a, b) for a, b in zip(own, following)]
    sets, edits, next_ = (elements(pa.array(x, pa.large_string())) for x in (own, edited, following))
    at = np.arange(len(own))
    mine, changed, others = (_all_sketches(x) for x in (sets, edits, next_))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": ids,
            "n_chars": pa.array([len(t) for t in own], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": pa.array(_texts_of(mine), pa.string()),
            "edited_fingerprint": pa.array(_texts_of(changed), pa.string()),
            "near_edited": pa.array(likeness(sets, edits, at, at, (mine, changed))),
            "near_next": pa.array(likeness(sets, next_, at, at, (mine, others))),
        }
    )


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and their likeness.

    The edited text has its last half replaced by the beginning of the next document, in descending
    order of doc_id (after the last: the first; null ids last, equal ids in the order of a text hash). A
    null text is empty; two texts without a paragraph are alike, 1. A text is its own next document if
    it is alone. An empty table gives an empty one. Very long texts are taken whole, one at a time. Columns
    beside doc_id and text are not read, so their names may clash with anything.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    own = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_with_next(own, _compare, schema)
