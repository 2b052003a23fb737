"""Mixing sources to target weights by Poisson replication.

A source that should fill the share w of a corpus of `total` characters, and has `size` of its own, is
repeated at the mean rate w * total / size. Each document gets a count from the Poisson distribution of
that rate, by inverting it at a number that a hash of the seed and the document gives; so a document's
count does not depend on where or how often it is computed. Each copy then goes to a place that a
second hash gives, which shuffles the corpus as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.tables import free_name, stored

SEED = 20240501
PART = 500.0


def _hash(*parts: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, digits), 16, 10).cast("long")


def identity(id_column: str = "doc_id", text: str = "text") -> Column:
    """What hashes know a row by: its id, or the MD5 of its text where it has none."""
    return F.coalesce(F.col(id_column).cast("string"), F.md5(F.coalesce(text, F.lit(""))), F.lit(""))


def poisson_count(rate: Column, row: Column, seed: int = SEED) -> Column:
    """The smallest k whose Poisson probability of k or less exceeds the row's uniform number.

    A rate above `PART` is a sum of equal parts, each inverted at a number of its own.
    """
    parts = F.greatest(F.ceil(rate / PART), F.lit(1)).cast("int")
    mean = rate / parts

    def of_part(part: Column) -> Column:
        uniform = (_hash(F.lit(str(seed)), row, part.cast("string"), digits=13) + 0.5) / float(2**52)
        state = F.struct(F.exp(-mean).alias("chance"), F.exp(-mean).alias("below"), F.lit(0).alias("count"), uniform.alias("uniform"))

        def step(at: Column, k: Column) -> Column:
            chance = at["chance"] * mean / k
            more = at["below"] <= at["uniform"]
            return F.struct(
                chance.alias("chance"), (at["below"] + chance).alias("below"),
                (at["count"] + more.cast("int")).alias("count"), at["uniform"].alias("uniform"),
            )

        most = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
        return F.aggregate(F.sequence(F.lit(1), most), state, step, lambda at: at["count"])

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts), of_part), F.lit(0), lambda a, b: a + b)


def target_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5) -> DataFrame:
    """(source, rate): how often the documents of each source are repeated on average.

    Weights are shares of the characters of the mixed corpus, which keeps the size of `docs`; a source
    that `weights` does not name gets none. Without weights, a source's is its size to `power`. A source
    without any character keeps its documents once.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("size"))
    if weights is None:
        size = F.col("size").cast("double")
        weighted = sizes.withColumn("weight", F.sqrt(size) if power == 0.5 else F.pow(size, F.lit(power)))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        weighted = sizes.join(named, F.col("source").eqNullSafe(F.col("name")), "left").drop("name").fillna(0.0, ["weight"])
    weighted = stored(weighted, "source-sizes")
    total = weighted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    share = F.lit(float(total["size"] or 0)) * F.col("weight") / F.lit(float(total["weight"] or 1) or 1.0)
    return stored(weighted.select("source", F.when(F.col("size") > 0, share / F.col("size")).otherwise(1.0).alias("rate")), "rates")


def mix_sources(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5, seed: int = SEED
) -> DataFrame:
    """Every copy of every document, shuffled: the columns of `docs`, copy (from 1) and shuffle_key.

    Columns of `docs` with the last two names are replaced, all others stay whatever their names. A null source
    is a source of its own, a null text has no characters. Rows with the same id get the same count. An empty
    table gives an empty one.
    """
    own, rate, row, count = (free_name(name, docs) for name in ("__source", "__rate", "__row", "__count"))
    rates = target_rates(docs, weights, power).select(F.col("source").alias(own), F.col("rate").alias(rate))
    rated = docs.join(rates, F.col("source").eqNullSafe(F.col(own)))
    counted = rated.withColumn(row, identity()).withColumn(count, poisson_count(F.col(rate), F.col(row), seed))
    copies = counted.where(F.col(count) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(count))))
    keyed = copies.withColumn("shuffle_key", _hash(F.lit("order"), F.lit(str(seed)), F.col(row), F.col("copy").cast("string"), digits=15))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = keyed.select(*[c for c in docs.columns if c not in ("copy", "shuffle_key")], "copy", "shuffle_key")
    return out.repartition(partitions, "shuffle_key").sortWithinPartitions("shuffle_key")
