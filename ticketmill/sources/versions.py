"""A stored table with one row for each key, loaded again and again: the newest copy wins.

Rows are dealt to a fixed number of buckets by a hash of their key. A load writes the buckets it touches
into a folder of its own and then publishes a new manifest, a small file that names the folders of every
bucket, by one rename. Files are never changed, so readers of an older version, or of the one before
a load that fails, are not disturbed; of two loads at the same time, the second to publish fails.

Layout below the path: `versions/00000007.json` and `data/<folder of a load>/_bucket=<n>/`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.functions.text import digest
from ticketmill.operators.dedup import keep_latest
from ticketmill.sources import files

BUCKET, LOAD = "_bucket", "_load"


@dataclass
class Manifest:
    """What a version consists of: for each bucket, the folders that hold its rows and how many each has."""

    version: int
    buckets: int
    keys: list[str]
    newest: str
    tie: list[str]
    schema: str
    parts: dict[str, list[list]]

    def folders(self, buckets: Sequence[str]) -> dict[str, list[str]]:
        """The paths of the rows of some buckets, as folder of the load: sub-folders."""
        found: dict[str, list[str]] = {}
        for bucket in buckets:
            for folder, _ in self.parts.get(bucket, []):
                found.setdefault(folder, []).append(bucket)
        return found


def _file(path: str, version: int) -> str:
    return f"{path}/versions/{version:08d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions, oldest first."""
    found = files.names(spark, f"{path}/versions")
    return [int(name.removesuffix(".json")) for name in found if name.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise ValueError(f"no version {'' if version is None else version} of {path}")
    return Manifest(**json.loads(files.read_text(spark, _file(path, known[-1] if version is None else version))))


def _schema(found: Manifest) -> T.StructType:
    own = T.StructType.fromJson(json.loads(found.schema))
    return T.StructType([*own.fields, T.StructField(LOAD, T.LongType()), T.StructField(BUCKET, T.IntegerType())])


def _rows(spark: SparkSession, path: str, found: Manifest, buckets: Sequence[str]) -> DataFrame:
    """The rows of some buckets as they are stored, with bucket and load."""
    reader = spark.read.schema(_schema(found))
    paths = [f"{path}/data/{folder}/{BUCKET}={b}" for folder, own in found.folders(buckets).items() for b in own]
    if not paths:
        return spark.createDataFrame([], _schema(found))
    by_load: dict[str, list[str]] = {}
    for one in paths:
        by_load.setdefault(one.rsplit("/", 1)[0], []).append(one)
    tables = [reader.option("basePath", base).parquet(*own) for base, own in by_load.items()]
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows


def _newest(rows: DataFrame, found: Manifest) -> DataFrame:
    """One row for each key; of equally new copies that with the smallest tie values, then that of the latest load."""
    later = rows.withColumn("_before", -F.col(LOAD))
    return keep_latest(later, [BUCKET, *found.keys], found.newest, [*found.tie, "_before"]).drop("_before")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row for each key, of the latest version or an older one.

    Buckets in one folder are read as they are; only those that loads have left in several are merged.
    """
    found = manifest(spark, path, version)
    single = [b for b, parts in found.parts.items() if len(parts) == 1]
    several = [b for b, parts in found.parts.items() if len(parts) > 1]
    rows = _rows(spark, path, found, single)
    if several:
        rows = rows.unionByName(_newest(_rows(spark, path, found, several), found))
    return rows.drop(LOAD, BUCKET)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest(*[F.col(k).cast("string") for k in keys])), F.lit(buckets)).cast("int")


def upsert(
    df: DataFrame, path: str, keys: Sequence[str], newest: str, tie: Sequence[str] = (), buckets: int = 64,
    merge_at: float = 0.0,
) -> int:
    """Load rows; returns the new version. A key keeps the copy with the largest `newest` over all loads.

    Of equally new copies the one with the smallest values of `tie` stays, then that of the later load, so
    with a `tie` that tells all copies apart the order of loads has no say. Null keys are equal.
    A touched bucket is merged with its older rows and written anew, unless these are so many that
    the new ones are less than `merge_at` times as many: then the new rows stay beside them, and meet them
    when they have grown, or when the bucket is read. At 0 every touched bucket is rewritten and
    reading merges nothing; at 0.5, a row is rewritten some times the logarithm of the table's growth
    only, so the cost of a load follows the load. Only the touched buckets are read, and only the counts
    by bucket reach the driver. Loads that repeat change nothing; without rows there is a version, too.
    Number of buckets and keys are those of the first load.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    own = T.StructType([f for f in df.schema.fields if f.name not in (LOAD, BUCKET)])
    if known:
        before = manifest(spark, path, known[-1])
        if (before.keys, before.newest, before.tie) != (list(keys), newest, list(tie)):
            raise ValueError(f"the table has keys {before.keys}, newest {before.newest} and tie {before.tie}")
        df = df.select(*[f.name for f in T.StructType.fromJson(json.loads(before.schema)).fields])
    else:
        before = Manifest(0, buckets, list(keys), newest, list(tie), own.json(), {})
    version = before.version + 1
    folder = f"{version:08d}-{uuid.uuid4().hex[:12]}"

    offered = df.withColumns({BUCKET: bucket_of(keys, before.buckets), LOAD: F.lit(version).cast("long")})
    added = f"{path}/data/{folder}-new"
    _newest(offered, before).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(added)
    counts = _counts(spark.read.schema(_schema(before)).parquet(added)) if _has_rows(spark, added) else {}

    parts, merged = dict(before.parts), {}
    for bucket, rows in counts.items():
        older, total = list(parts.get(bucket, [])), rows
        gone = []
        while older and (merge_at <= 0 or total >= merge_at * older[-1][1]):
            gone.append(older.pop())
            total += gone[-1][1]
        parts[bucket] = [*older, [f"{folder}-new", rows]]
        if gone:
            merged[bucket] = [*gone, [f"{folder}-new", rows]]
            parts[bucket] = [*older, [f"{folder}-merged", total]]
    if merged:
        sources = Manifest(version, before.buckets, before.keys, newest, before.tie, before.schema, merged)
        rows = _newest(_rows(spark, path, sources, list(merged)), before)
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}-merged")
        stored = spark.read.schema(_schema(before)).parquet(f"{path}/data/{folder}-merged")
        for bucket, rows_now in _counts(stored).items():
            parts[bucket][-1][1] = rows_now
    after = Manifest(version, before.buckets, before.keys, newest, before.tie, before.schema, parts)
    files.write_text(spark, _file(path, version), json.dumps(asdict(after)))
    return version


def _has_rows(spark: SparkSession, folder: str) -> bool:
    return any(name.startswith(f"{BUCKET}=") for name in files.names(spark, folder))


def _counts(rows: DataFrame) -> dict[str, int]:
    return {str(r[BUCKET]): r["n"] for r in rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Forget all but the last `keep` versions and delete the folders that none of them needs; returns these.

    Not while a load runs: its folders are not yet in any version.
    """
    known = versions(spark, path)
    kept = [manifest(spark, path, v) for v in known[-keep:]]
    used = {folder for m in kept for parts in m.parts.values() for folder, _ in parts}
    for version in known[:-keep]:
        files.delete(spark, _file(path, version))
    unused = [name for name in files.names(spark, f"{path}/data") if name not in used]
    for name in unused:
        files.delete(spark, f"{path}/data/{name}")
    return unused
