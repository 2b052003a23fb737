"""Fill-in-the-middle texts: each text is cut in three, its parts change places, and can be put back.

Outputs are built for a whole batch of bytes at a time. The cuts of all texts are scanned to byte
places; a difference array holds, where a part begins, by how much more or less than the part before
it its bytes move; the running sum is every byte's displacement, and one scatter writes all outputs.
Restoring finds the markers in the outputs, sums displacements the same way and gathers the bytes back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.words import Chunk, chunks

PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = np.array([PLAIN, PSM, SPM])
MARKERS = (b"<P>", b"<S>", b"<M>")
WIDTH = 3
PART = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


@dataclass
class Cuts:
    """Bytes first[i]:middle[i] are text i's prefix, middle[i]:suffix[i] its middle, suffix[i]:last[i] the rest."""

    first: np.ndarray
    middle: np.ndarray
    suffix: np.ndarray
    last: np.ndarray
    form: np.ndarray


def marker_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where markers stand in the texts data[bounds[i]:bounds[i + 1]]: the text, the byte, the letter."""
    open_ = np.flatnonzero(data[: max(len(data) - 2, 0)] == ord("<"))
    letter = data[open_ + 1]
    found = (data[open_ + 2] == ord(">")) & np.isin(letter, [m[1] for m in MARKERS])
    at, letter = open_[found], letter[found]
    text = np.searchsorted(bounds, at, "right") - 1
    whole = at + WIDTH <= bounds[text + 1]
    return text[whole], at[whole], letter[whole]


def _displaced(size: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Where each of `size` bytes goes: parts are (first bytes, their new places), in text order.

    Parts of one text that begin at the same byte are empty but for the last, whose place holds.
    """
    begin = np.stack([b for b, _ in parts], axis=1).ravel()
    shift = np.stack([to - b for b, to in parts], axis=1).ravel()
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, begin, np.diff(shift, prepend=0))
    return np.arange(size) + np.cumsum(step[:size])


def _layout(cuts: Cuts) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Bounds of the outputs, and where in them the parts and the markers of every text begin."""
    prefix, middle, suffix = cuts.middle - cuts.first, cuts.suffix - cuts.middle, cuts.last - cuts.suffix
    marked = cuts.form > 0
    bounds = np.concatenate([[0], np.cumsum(cuts.last - cuts.first + 3 * WIDTH * marked)])
    start, gap = bounds[:-1], WIDTH * marked
    psm = cuts.form == 1
    p = np.where(psm, start, start + gap + suffix)
    s = np.where(psm, start + gap + prefix, start)
    p, s = np.where(marked, p, start), np.where(marked, s, start + prefix + middle)
    m = np.where(marked, start + 2 * gap + prefix + suffix, start + prefix)
    return bounds, {"P": p, "S": s, "M": m, "prefix": p + gap, "suffix": s + gap, "middle": m + gap}


def scatter(data: np.ndarray, cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all outputs, and their bounds."""
    bounds, place = _layout(cuts)
    to = _displaced(
        len(data), [(cuts.first, place["prefix"]), (cuts.middle, place["middle"]), (cuts.suffix, place["suffix"])]
    )
    out = np.empty(bounds[-1], np.uint8)
    out[to] = data
    marked = cuts.form > 0
    for name, marker in zip("PSM", MARKERS):
        out[place[name][marked][:, None] + np.arange(WIDTH)] = np.frombuffer(marker, np.uint8)
    return out, bounds


def gather(output: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that outputs were made of, from the outputs and their forms alone; and their bounds."""
    text, at, letter = marker_places(output, bounds)
    found = {name: np.zeros(len(form), np.int64) for name in "PSM"}
    for name, marker in zip("PSM", MARKERS):
        own = (letter == marker[1]) & (form[text] > 0)
        found[name][text[own]] = at[own]
    marked, psm = form > 0, form == 1
    size = np.diff(bounds) - 3 * WIDTH * marked
    end = bounds[1:]
    prefix = np.where(psm, found["S"], found["M"]) - found["P"] - WIDTH
    middle = end - found["M"] - WIDTH
    prefix, middle = np.where(marked, prefix, size), np.where(marked, middle, 0)
    first = np.concatenate([[0], np.cumsum(size)])
    cuts = Cuts(first[:-1], first[:-1] + prefix, first[:-1] + prefix + middle, first[1:], form)
    _, place = _layout(cuts)
    to = _displaced(
        int(first[-1]), [(cuts.first, place["prefix"]), (cuts.middle, place["middle"]), (cuts.suffix, place["suffix"])]
    )
    return output[to], first


def _cut(chunk: Chunk, draws: np.ndarray, plain_percent: int, spm_percent: int) -> tuple[Cuts, np.ndarray, np.ndarray]:
    """Cuts of a chunk; the code points of each text; and those of prefix and middle (texts by two)."""
    data, bounds = chunk.data, chunk.bounds
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(begins, bounds)
    n = np.diff(first)
    units = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    places = np.append(begins, len(data))[first[:-1, None] + units]
    form = np.where(draws[:, 3] % 100 < spm_percent, 2, 1)
    form[(n == 0) | (draws[:, 2] % 100 >= 100 - plain_percent)] = 0
    form[marker_places(data, bounds)[0]] = 0
    return Cuts(bounds[:-1], places[:, 0], places[:, 1], bounds[1:], form), n, np.diff(units, prepend=0, axis=1)


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    ).cast(pa.string())


def _draws(id_column: str | Column, seed: str) -> Column:
    """Four unsigned 32-bit numbers of each id, from the SHA-256 of seed and id; those of a null id are of no digits."""
    ident = F.col(id_column) if isinstance(id_column, str) else id_column
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])


def infill(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    plain_percent: int = 10, spm_percent: int = 20, seed: str = "1:",
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row of `docs`.

    n counts code points. Two of them, drawn by the id's digest, cut the text; a third draw leaves
    `plain_percent` of texts as they are, a fourth gives `spm_percent` of the others the form that
    begins with the suffix. A null text counts as empty; an empty text, and one that holds a marker
    already, stays plain: its output is the text and its two counts are null. A null id draws like an
    id of no digits. Repeated rows are formed alike. Other columns are not read, so their names may
    clash with anything. An empty table gives an empty one. A batch is formed in chunks, a very long
    text in one of its own.
    """

    @F.arrow_udf(PART)
    def formed(texts: pa.Array, draws: pa.Array) -> pa.Array:
        drawn = draws.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
        parts = []
        for chunk in chunks(texts):
            cuts, n, units = _cut(chunk, drawn[chunk.first : chunk.last], plain_percent, spm_percent)
            plain = cuts.form == 0
            parts.append([
                pa.array(n, pa.int64()), pa.array(FORMS[cuts.form], pa.string()),
                pa.array(units[:, 0], pa.int64(), mask=plain), pa.array(units[:, 1], pa.int64(), mask=plain),
                _strings(*scatter(chunk.data, cuts)),
            ])
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.chunked_array(x, t).combine_chunks() for x, t in zip(zip(*parts) if parts else [[]] * 5, kinds)]
        return pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"])

    own = docs.select(F.col(id_column), formed(F.col(text), _draws(id_column, seed)).alias("made"))
    return own.select(id_column, "made.*")


def restore(output: str | Column, form: str | Column) -> Column:
    """The text that an output of `infill` was made of. A null output gives an empty text."""

    @F.arrow_udf("string")
    def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        kinds = forms.to_numpy(zero_copy_only=False).astype(str)
        kind = np.where(kinds == PSM, 1, np.where(kinds == SPM, 2, 0))
        found = [
            _strings(*gather(chunk.data, chunk.bounds, kind[chunk.first : chunk.last])) for chunk in chunks(outputs)
        ]
        return pa.chunked_array(found, pa.string()).combine_chunks()

    return restored(*(F.col(c) if isinstance(c, str) else c for c in (output, form)))
