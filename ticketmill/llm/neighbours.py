"""The next row of a table in the order of an id, without one task that sees all rows."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.samples import SEED
from ticketmill.llm.tables import stored

RANGES_PER_PARTITION = 16
MOST_RANGES = 1 << 16
KEYS_PER_RANGE = 30
LAST = 2**63 - 1


def map_with_next(
    docs: DataFrame, use: Callable[[pa.Array, pa.Array, pa.Array], pa.RecordBatch], schema: str, rows: int = 512
) -> DataFrame:
    """`use`(ids, texts, next texts) over slices of `docs` (id long, text string), at most `rows` each.

    Rows are in descending order of id, null ids last, equal ids in the order of a hash of the text;
    after the last row comes the first. Ranges of this order, cut at keys of a sample, are dealt to
    tasks and sorted there; the first row of each range is sent to the range before it as well. A
    frequent id is cut between texts. The driver sees two keys for each range.
    """
    spark = docs.sparkSession
    mark = F.xxhash64("text")
    down = F.coalesce(-F.col("id"), F.lit(LAST))
    keys = stored(docs.select(down.alias("down"), mark.alias("mark")), "order")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, min(MOST_RANGES, partitions * RANGES_PER_PARTITION))
    n = keys.count()
    some = sorted(map(tuple, keys.sample(min(1.0, KEYS_PER_RANGE * ranges / max(n, 1)), SEED).collect()))
    cuts = sorted(set(some[len(some) // ranges :: max(1, len(some) // ranges)]))

    @F.arrow_udf("int")
    def own_range(ids: pa.Array, marks: pa.Array) -> pa.Array:
        return pa.array([bisect_right(cuts, key) for key in zip(ids.to_pylist(), marks.to_pylist())], pa.int32())

    placed = keys.withColumn("range", own_range("down", "mark"))
    least = placed.groupBy("range").agg(F.min(F.struct("down", "mark")).alias("key")).orderBy("range").collect()
    guest_in = {tuple(row["key"]): least[k - 1]["range"] for k, row in enumerate(least)}

    @F.arrow_udf("array<struct<range: int, guest: boolean>>")
    def places(ids: pa.Array, marks: pa.Array) -> pa.Array:
        found = []
        for key in zip(ids.to_pylist(), marks.to_pylist()):
            own = [{"range": bisect_right(cuts, key), "guest": False}]
            found.append(own + [{"range": guest_in[key], "guest": True}] if key in guest_in else own)
        return pa.array(found, pa.list_(pa.struct({"range": pa.int32(), "guest": pa.bool_()})))

    spread = (
        docs.select("id", "text", down.alias("down"), mark.alias("mark"))
        .withColumn("place", F.explode(places("down", "mark")))
        .select("id", "text", "down", "mark", "place.*")
        .repartition(partitions, "range")
        .sortWithinPartitions("range", "guest", "down", "mark")
    )
    return spread.select("id", "text", "guest").mapInArrow(_with_next(use, rows), schema)


def _with_next(use: Callable, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = pa.Table.from_batches([batch.slice(at, rows)])
                part = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
                held = part.slice(len(part) - 1)
                own = pc.invert(part.column("guest").slice(0, len(part) - 1))
                pairs = part.slice(0, len(part) - 1).append_column("next", part.column("text").slice(1)).filter(own)
                if len(pairs):
                    yield use(*(pairs.column(c).combine_chunks() for c in ("id", "text", "next")))

    return run
