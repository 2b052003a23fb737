"""Near duplicates by SimHash: fingerprints that differ in few bits, found by a ring of segments.

A fingerprint is cut into 2 * distance + 1 segments, arranged in a ring. If two fingerprints differ in
at most `distance` bits, then from some segment on, every chain of l consecutive segments differs in
at most floor(l * distance / segments) bits (pigeonring principle). Candidates therefore agree on the
segments that must be clean in a chain of `CHAIN` segments, whatever the others hold; they are found
by equality, pruned by the budgets of all longer chains, and then counted bit by bit.

Buckets of fingerprints that share a key fill up as the table grows. Where all pairs of one are needed,
it is cut further by what a longer chain must also agree on: a pair within the budgets of `LONG_CHAIN`
segments agrees on one of a few sets of further segments, so it still meets in one of the parts. A row
goes into several parts, so a bucket is cut only if `CUT_FROM` rows or more would each meet all of it.

Copies are never expanded into pairs. Equal fingerprints are one row. In a bucket of fingerprints
that share a key, all are first compared with one of them; then only those are compared with the rest
that the links so far have not joined to the bucket's largest component. A group of thousands of near
copies so costs a few links for each, while every link between different components is found.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.components import components
from ticketmill.llm.tables import discard, free_name, stored
from ticketmill.llm.words import LOWER, SPACES, Chunk, chunks, find_words

BITS = 64
SEED = 42
CHAIN = 6
LONG_CHAIN = 8
CUT_FROM = 16
SLICE = 1 << 16
BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _simhash(chunk: Chunk, width: int) -> np.ndarray:
    data = LOWER[chunk.data]
    words = find_words(data, chunk.bounds)
    kept = ~SPACES[data]
    kept[words.end[words.end < len(data)]] = True
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kept, out=place[1:])
    joined = np.where(SPACES[data], np.uint8(32), data)[kept].tobytes()
    start, end = place[words.start], place[words.end]

    n = np.diff(words.bounds)
    shingles = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(shingles, out=bounds[1:])
    text = np.repeat(np.arange(len(n)), shingles)
    first = words.bounds[text] + np.arange(bounds[-1]) - bounds[text]
    last = first + np.minimum(n, width)[text] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.empty(len(first), np.uint64)
    for at in range(0, len(first), SLICE):
        part = slice(at, at + SLICE)
        spans = zip(start[first[part]].tolist(), end[last[part]].tolist())
        hashes[part] = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)

    ones = np.empty((len(n), BITS), np.int64)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        counts = np.bincount(text * 256 + octets[:, k], minlength=len(n) * 256).reshape(len(n), 256)
        ones[:, 8 * k : 8 * k + 8] = counts @ BIT_OF_BYTE
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<u8").ravel()


def simhash(text: str | Column, shingle_words: int = 4) -> Column:
    """The 64-bit fingerprint of each whole text as a long.

    A-Z are lower-cased, words joined by single spaces into shingles, repeats included; a text of fewer
    words has its whole sequence as one shingle. A bit is set if it is set in over half of the
    shingles' XXH64 (UTF-8, seed 42). A null text, like one without words, has fingerprint zero.
    """

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = [_simhash(chunk, shingle_words) for chunk in chunks(texts)]
        return pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64))

    return of(F.col(text) if isinstance(text, str) else text)


def as_hex(fingerprint: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


@cache
def segment_masks(segments: int) -> list[int]:
    edges = [BITS * k // segments for k in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def chain_budgets(distance: int, segments: int) -> list[int]:
    """Bits that a chain of 1, 2, ... segments may differ in."""
    return [length * distance // segments for length in range(1, segments + 1)]


@cache
def clean_sets(distance: int, segments: int, chain: int) -> list[tuple[int, ...]]:
    """Sets of places in a chain, one of which is clean whenever the chain keeps within its budgets."""
    budgets = chain_budgets(distance, segments)[:chain]
    allowed = [
        set(dirty)
        for size in range(budgets[-1] + 1)
        for dirty in combinations(range(chain), size)
        if all(sum(d <= place for d in dirty) <= budget for place, budget in enumerate(budgets))
    ]
    widest = [dirty for dirty in allowed if not any(dirty < other for other in allowed)]
    return [tuple(sorted(set(range(chain)) - dirty)) for dirty in widest]


def _patterns(distance: int) -> list[tuple[int, int]]:
    """(first segment of the chain, mask of the segments that must agree) of every key."""
    segments = 2 * distance + 1
    masks, chain = segment_masks(segments), min(CHAIN, segments)
    return [
        (first, sum(masks[(first + place) % segments] for place in clean))
        for first in range(segments)
        for clean in clean_sets(distance, segments, chain)
    ]


@cache
def _cuts(distance: int) -> list[list[int]]:
    """For every key, masks of further segments; fingerprints of a linked pair agree on one of them whole."""
    segments = 2 * distance + 1
    masks, chain, longer = segment_masks(segments), min(CHAIN, segments), min(LONG_CHAIN, segments)
    found = []
    for first in range(segments):
        for clean in clean_sets(distance, segments, chain):
            more = [frozenset(long) - frozenset(clean) for long in clean_sets(distance, segments, longer)]
            least = sorted({tuple(sorted(own)) for own in more if not any(other < own for other in more)})
            found.append([_signed(sum(masks[(first + place) % segments] for place in own)) for own in least])
    return found


def _cut(members: DataFrame, distance: int) -> DataFrame:
    """Rows of buckets with the part (cut, held) of the bucket that they are in, or each of several parts.

    `apart` counts the rows outside the bucket's main component; a bucket with few of them is one part.
    """
    masks = F.element_at(F.array(*[F.array(*map(F.lit, own)) for own in _cuts(distance)]), F.col("pattern").cast("int") + 1)
    parts = F.transform(masks, lambda mask, k: F.struct(k.alias("cut"), F.col("fp").bitwiseAND(mask).alias("held")))
    full = members.where(F.col("apart") >= CUT_FROM).select("*", F.explode(parts).alias("part"))
    whole = members.where(F.col("apart") < CUT_FROM).withColumns({"cut": F.lit(0), "held": F.lit(0).cast("long")})
    return whole.unionByName(full.select(*members.columns, "part.*"))


def _keys(fingerprints: DataFrame, distance: int) -> DataFrame:
    keys = [
        F.struct(F.lit(k).cast("short").alias("pattern"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("shared"))
        for k, (_, mask) in enumerate(_patterns(distance))
    ]
    return fingerprints.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.*")


def _linked(a: Column, b: Column, pattern: Column, distance: int) -> Column:
    """Within the budgets of every chain from the pattern's first segment, then within the distance."""
    segments = 2 * distance + 1
    masks, firsts = segment_masks(segments), [first for first, _ in _patterns(distance)]
    differ = a.bitwiseXOR(b)
    within = F.lit(True)
    for length, budget in enumerate(chain_budgets(distance, segments)[:-1], 1):
        reach = [_signed(sum(masks[(first + k) % segments] for k in range(length))) for first in firsts]
        mask = F.element_at(F.array(*map(F.lit, reach)), pattern.cast("int") + 1)
        within = within & (F.bit_count(differ.bitwiseAND(mask)) <= budget)
    return within & (F.bit_count(differ) <= distance)


def near_components(fingerprints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root) for every fingerprint that has another within `distance` bits.

    `fingerprints` has distinct longs in column fp; root is the smallest fingerprint reachable.
    """
    bucket = ["pattern", "shared"]
    keys = _keys(fingerprints, distance)
    shared = stored(
        keys.groupBy(bucket).agg(F.count("*").alias("members"), F.min("fp").alias("pivot")).where("members > 1"),
        "buckets",
    )
    # Merged at every size: the list of buckets grows with the data, and so the plan is one.
    members = stored(keys.join(shared.hint("merge"), bucket).select("fp", *bucket, "pivot"), "members")
    discard(shared)
    linked = _linked(F.col("fp"), F.col("pivot"), F.col("pattern"), distance)
    stars = stored(members.where(linked & F.expr("fp <> pivot")).select("fp", "pivot").distinct(), "stars")
    so_far = components(stars.select(F.col("fp").alias("a"), F.col("pivot").alias("b")))

    placed = members.join(so_far, F.col("fp") == F.col("node"), "left").select(
        "fp", *bucket, F.coalesce("root", "fp").alias("root")
    )
    open_ = (
        placed.groupBy(*bucket, "root").agg(F.count("*").alias("n")).groupBy(bucket)
        .agg(
            F.max_by("root", F.struct("n", "root")).alias("main"),
            (F.sum("n") - F.max("n")).alias("apart"),
            F.count("*").alias("roots"),
        )
        .where("roots > 1")
    )
    unsettled = stored(placed.join(open_, bucket).select("fp", *bucket, "root", "main", "apart"), "unsettled")
    part = [*bucket, "cut", "held"]
    parts = _cut(unsettled, distance)
    rest = parts.where("root <> main").select(*part, F.col("fp").alias("own"), F.col("root").alias("own_root"))
    apart = (F.col("own_root") != F.col("root")) & ((F.col("root") == F.col("main")) | (F.col("own") < F.col("fp")))
    pairs = rest.join(parts, part).where(
        apart & _linked(F.col("own"), F.col("fp"), F.col("pattern"), distance)
    )
    cross = pairs.select(F.col("own").alias("a"), F.col("fp").alias("b"))
    links = stars.select(F.col("fp").alias("a"), F.col("pivot").alias("b")).unionByName(cross)
    return components(links).select(F.col("node").alias("fp"), "root")


def _rooted(docs: DataFrame, id_column: str, text: str, shingle_words: int, distance: int) -> DataFrame:
    """(id, fp, root, component_id) of every row; root is the smallest fingerprint of the component."""
    own = stored(docs.select(F.col(id_column).alias("id"), simhash(text, shingle_words).alias("fp")), "simhash")
    distinct = stored(own.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    roots = stored(near_components(distinct.select("fp"), distance), "roots")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = placed.join(roots.select(F.col("root").alias("fp")).distinct(), "fp", "left_semi").where("root = fp")
    joined = placed.where("root <> fp").unionByName(heads)
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = joined.select("fp", "root").join(named, "root").select("fp", "root", "component_id")
    alone = distinct.join(grouped.select("fp"), "fp", "left_anti").select(
        "fp", F.col("fp").alias("root"), F.col("least").alias("component_id")
    )
    return own.join(grouped.unionByName(alone), "fp").select("id", "fp", "root", "component_id")


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle_words: int = 4, distance: int = 4
) -> DataFrame:
    """(id, fp, component_id) for every row of `docs`.

    Fingerprints link at `distance` or fewer differing bits; component_id is the smallest id that links
    reach, the row's own included. Repeated rows and equal ids stay as rows. A null id belongs to a
    component but cannot name it; a component without any id has a null component_id. Other columns
    of `docs` are not read, so their names may clash with anything. An empty table gives an empty one.
    """
    found = _rooted(docs, id_column, text, shingle_words, distance)
    return found.select(F.col("id").alias(id_column), "fp", "component_id")


def one_of_each_group(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of `docs` that stand for their group of near duplicates: one for each component.

    The row with the smallest doc_id stays; of several such rows in a component, any one. A component
    without ids keeps one row. All columns of `docs` are kept.
    """
    groups = stored(_rooted(docs, "doc_id", "text", shingle_words, distance), "groups")
    stands = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    by_id = groups.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows"), F.max(stands).alias("stands"))
    kept = stored(by_id.where("stands").select(F.col("id").alias("doc_id"), "rows"), "kept")
    rows = docs.join(kept.where("rows = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")

    # Ids of several rows, and rows without id, are told apart by their fingerprints.
    ident, own, top, fp = (free_name(name, docs) for name in ("__id", "__own", "__top", "__fp"))
    several = docs.join(kept.where("rows > 1").select("doc_id"), "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    heads = groups.where(stands).join(kept.where("rows > 1").select(F.col("doc_id").alias("id")), "id", "left_semi")
    heads = heads.unionByName(groups.where("component_id IS NULL")).distinct().select(
        F.col("id").alias(ident), F.col("fp").alias(own), F.col("root").alias(top)
    )
    several = several.withColumn(fp, simhash("text", shingle_words))
    again = several.join(heads, several["doc_id"].eqNullSafe(heads[ident]) & (F.col(fp) == F.col(own)))
    return rows.unionByName(again.dropDuplicates([ident, top]).select(*docs.columns))
