"""Sessions: options for a large cluster, and a local session for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024


def cluster_options(input_bytes: int, cores: int, partition_bytes: int = 256 * MIB) -> dict[str, str]:
    """Options for a job over `input_bytes` on `cores` cores, to be set when the session is built.

    The operators shuffle each row once at most in full width, so the input size stands for the
    largest shuffle. Partitions start at a size that sorts in memory and are merged by adaptive
    execution where a stage turns out smaller; a shuffle has at least two waves of tasks to even out.
    A join whose measured partitions on one side are small, such as the newest row ids of the dedup,
    is hashed instead of sorting the full rows of the other side; the limit is a quarter of a
    partition, since measured sizes are compressed.
    """
    partitions = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(partition_bytes // 4),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ticketmill")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", 64 * MIB)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
