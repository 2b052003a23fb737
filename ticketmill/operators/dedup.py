"""Keep-latest deduplication that survives hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions.text import digest
from ticketmill.operators.lookup import same_key

#: Bits of the filter of repeated keys: 16 MiB.
FILTER_BITS = 1 << 27


def keep_latest(df: DataFrame, keys: Sequence[str], newest: str, tie: Sequence[str]) -> DataFrame:
    """The newest row of each key; equal times keep the smallest tie values. Null keys are equal.

    Filtering on rank 1 lets Spark cut every map task to one row per key before the shuffle
    (partial WindowGroupLimit), so a key that holds a third of the table costs one row per task.
    """
    latest = Window.partitionBy(*keys).orderBy(F.col(newest).desc(), *[F.col(c).asc() for c in tie])
    return df.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


def latest_row_ids(
    df: DataFrame, scope: Sequence[str], keys: Sequence[str], newest: str, row_id: str
) -> DataFrame:
    """The row id of the newest row per scope and text key.

    Groups on a digest, so only (scope, digest, time, id) is shuffled, after map-side aggregation.
    """
    order = F.struct(F.col(newest), -F.col(row_id))
    return (
        df.groupBy(*scope, digest(*[F.col(k) for k in keys]).alias("_key"))
        .agg(F.max_by(row_id, order).alias(row_id))
        .drop("_key")
    )


def mark_superseded(
    df: DataFrame,
    scope: Sequence[str],
    keys: Sequence[str],
    newest: str,
    row_id: str,
    eligible: Column,
    flag: str,
) -> DataFrame:
    """Flag each eligible row that is not the newest of its key; keeps every row.

    A window over the key would bring all copies of a hot key into one task. Here the newest ids
    come from an aggregate and meet the rows on the row id, which is unique and so spreads evenly.
    `row_id` must be a stored value, unique within the scope: both sides read it.
    """
    on = [*scope, row_id]
    newest_ids = latest_row_ids(df.where(eligible), scope, keys, newest, row_id).withColumn("_newest", F.lit(True))
    joined = df.join(newest_ids, on, "left")
    return joined.select(*df.columns, (eligible & F.col("_newest").isNull()).alias(flag))


def _filter_place(scope: Sequence[str], keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*scope, *keys), F.lit(bits)) + 1


def repeated_key_filter(df: DataFrame, scope: Sequence[str], keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the keys that occur more than once, as pages of 32,768 bits.

    A key that occurs once may hit the place of another, one that repeats is always found. The filter has
    `bits` bits however many rows there are, so it may be broadcast; in a table of more rows than bits it
    finds most keys, and saves nothing.
    """
    place = F.col("_place")
    repeated = df.select(_filter_place(scope, keys, bits).alias("_place")).groupBy("_place").agg(
        F.count(F.lit(1)).alias("_rows")
    ).where("_rows > 1")
    return repeated.groupBy(F.bitmap_bucket_number(place).alias("_page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )


def maybe_repeated(
    df: DataFrame, pages: DataFrame, scope: Sequence[str], keys: Sequence[str], flag: str, bits: int = FILTER_BITS
) -> DataFrame:
    """Flag the rows whose key the filter holds."""
    place = _filter_place(scope, keys, bits)
    at = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    named = df.withColumn("_own_page", F.bitmap_bucket_number(place))
    joined = named.join(F.broadcast(pages), F.col("_own_page") == F.col("_page"), "left")
    return joined.select(*df.columns, hit.alias(flag))


def drop_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose text key does not occur in the known table (null-safe), compared by digest."""
    key = digest(*[F.col(k) for k in keys])
    stored = known.select(key.alias("_known_key")).distinct()
    offered = df.withColumn("_key", key)
    return offered.join(stored, same_key(offered, "_key", stored, "_known_key"), "left_anti").drop("_key")
