"""Token ids of whole texts by a byte-level BPE vocabulary, each distinct piece encoded once.

Byte-level BPE cuts a text into pieces (words with the blank before them, numbers, other characters,
blanks) and encodes each by itself. The cuts are found for many texts at a time in numpy; a piece that
was seen before takes its ids from a cache. The ids are those of `tokenizers` with the same vocabulary.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken

from ticketmill.llm.words import Chunk, chunks, code_points, span_hashes

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
OTHER, LETTER, NUMBER, BLANK = range(4)
MOST_CACHED = 1 << 18
SLOTS = 1 << 19


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """What each code point is to the pattern."""
    table = np.zeros(0x110000, np.uint8)
    every = np.arange(0x110000, dtype="<u4")
    every = every[(every < 0xD800) | (every >= 0xE000)].tobytes().decode("utf-32-le")
    for kind, cls in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for run in regex.finditer(cls, every):
            table[np.frombuffer(run[0].encode("utf-32-le"), "<u4")] = kind
    return table


def piece_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts points[bounds[i]:bounds[i + 1]] begin."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _kinds()[points]
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    edges = bounds[:-1][np.diff(bounds) > 0]
    first[edges] = True
    last[np.append(edges[1:], n) - 1] = True
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    start = change.copy()
    before_word = np.zeros(n, bool)
    before_word[:-1] = (kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~last[:-1]
    start |= before_word
    joined = np.zeros(n, bool)
    joined[1:] = before_word[:-1] & (points[:-1] == 32)
    start &= ~joined
    for at in np.flatnonzero(start & (points == 39) & ~last):
        tail = points[at + 1 : at + 3]
        for ending in CONTRACTIONS:
            size = len(ending)
            if [ord(c) for c in ending] == tail[:size].tolist() and not first[at + 1 : at + 1 + size].any():
                start[at + 1] = False
                if at + 1 + size < n and kind[at + 1 + size] == LETTER:
                    start[at + 1 + size] = True
                break
    return np.flatnonzero(start)


class Encoder:
    """Encodes batches of texts; keeps the ids of up to `MOST_CACHED` distinct pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.line_break = self.bpe.encode_ordinary("\n")[0]
        self.forget()

    def forget(self) -> None:
        self.place: dict[int, int] = {}
        self.ids, self.size = np.zeros(1 << 20, np.uint32), 0
        self.begins = np.zeros(MOST_CACHED + 1, np.int64)
        self.slot_hash, self.slot_place = np.zeros(SLOTS, np.uint64), np.full(SLOTS, -1, np.int64)

    def _learn(self, hashes: list[int], pieces: list[str]) -> None:
        """Encode new pieces in one call: between line breaks each is cut as it was."""
        blank = np.array([not piece.strip() for piece in pieces], bool)
        words = [piece for piece, b in zip(pieces, blank) if not b]
        joined = np.asarray(self.bpe.encode_ordinary("\n".join(words)), np.uint32)
        own = joined != self.line_break
        cut = np.cumsum(own)[~own]
        sizes = np.diff(np.concatenate([[0], cut, [int(own.sum())]])) if words else np.zeros(0, np.int64)
        blanks = [self.bpe.encode_ordinary(piece) for piece, b in zip(pieces, blank) if b]
        ids = np.concatenate([joined[own], *(np.array(x, np.uint32) for x in blanks)])
        sizes = np.concatenate([sizes, [len(x) for x in blanks]]).astype(np.int64)
        order = np.argsort(blank, kind="stable")

        base = len(self.place)
        self.place.update(zip((hashes[k] for k in order.tolist()), range(base, base + len(pieces))))
        while self.size + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while base + len(pieces) >= len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.ids[self.size : self.size + len(ids)] = ids
        self.begins[base + 1 : base + 1 + len(pieces)] = self.size + np.cumsum(sizes)
        self.size += len(ids)

    def _places(self, points: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The cached place of each piece; new pieces are encoded first."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        place = np.where(self.slot_hash[slot] == hashes, self.slot_place[slot], -1)
        missing = np.flatnonzero(place < 0)
        if not len(missing):
            return place
        distinct, at, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > MOST_CACHED and self.place:
            self.forget()
            return self._places(points, start, end, hashes)
        known, at = distinct.tolist(), missing[at]
        new = [k for k, h in enumerate(known) if h not in self.place]
        text = points.astype("<u4").tobytes()
        self._learn(
            [known[k] for k in new], [text[4 * start[at[k]] : 4 * end[at[k]]].decode("utf-32-le") for k in new]
        )
        found = np.fromiter((self.place[h] for h in known), np.int64, len(known))
        slot = (distinct & np.uint64(SLOTS - 1)).astype(np.int64)
        self.slot_hash[slot], self.slot_place[slot] = distinct, found
        place[missing] = found[which]
        return place

    def encode_with(self, text: str, special: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one text in which special tokens are ids of their own, and the hashes of its other pieces."""
        ids, hashes = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint64)]
        for part in regex.split("(" + "|".join(map(regex.escape, special)) + ")", text):
            if part in special:
                ids.append(np.array([special[part]], np.uint32))
                continue
            for chunk in chunks(pa.array([part])):
                own, _, pieces, _ = self.encode(chunk)
                ids.append(own)
                hashes.append(pieces)
        return np.concatenate(ids), np.concatenate(hashes)

    def encode_texts(self, chunk: Chunk, special: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As `encode`; texts that hold a special token are cut there first."""
        data = chunk.data.tobytes()
        if not any(token.encode() in data for token in special):
            return self.encode(chunk)
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(chunk.bounds, chunk.bounds[1:])]
        found = [self.encode_with(text, special) for text in texts]
        bounds, pieces = (np.cumsum([0] + [len(x[k]) for x in found]) for k in (0, 1))
        return np.concatenate([x[0] for x in found]), bounds, np.concatenate([x[1] for x in found]), pieces

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a chunk, where each text's begin, the hashes of its pieces, and where each text's begin."""
        points, bounds = code_points(chunk)
        start = piece_starts(points, bounds)
        if not len(start):
            none = np.zeros(len(bounds), np.int64)
            return np.zeros(0, np.uint32), none, np.zeros(0, np.uint64), none
        end = np.append(start[1:], len(points))
        hashes = span_hashes(points.astype(np.uint64) * 2 + 1, start, end)
        place = self._places(points, start, end, hashes)
        begin, size = self.begins[place], self.begins[place + 1] - self.begins[place]
        upto = np.append(0, np.cumsum(size))
        ids = self.ids[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        texts = np.searchsorted(start, bounds)
        return ids, upto[texts], hashes, texts


def special_tokens(path: str) -> dict[str, int]:
    """The special tokens of a `tokenizers` file: texts that become one id wherever they stand."""
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"] if token["special"]}


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_all(texts: pa.Array, path: str) -> list[np.ndarray]:
    """The ids of each text; a null text has none."""
    found = []
    for chunk in chunks(texts):
        ids, bounds, _, _ = encoder(path).encode(chunk)
        found += [ids[a:b] for a, b in zip(bounds, bounds[1:])]
    return found
