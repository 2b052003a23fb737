"""Polarity modifiers by hand, and a lexicon made in the session, whose words must not be shuffled."""

from __future__ import annotations

import random
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from ticketmill.operators.enrichment import Modifiers, lexicon_polarity, score_by_lexicon

LEXICON = {"good": 1.0, "bad": -0.7, "not": 0.3, "fine": 0.25}


def by_hand(text, modifiers):
    words, total, hits = re.findall(r"[a-z0-9']+", text.lower()), Decimal(0), 0
    for i, word in enumerate(words):
        if word in LEXICON:
            before = words[max(i - modifiers.reach, 0) : i]
            strong = [Decimal(str(modifiers.strengtheners[w])) for w in before if w in modifiers.strengtheners]
            factor = strong[-1] if strong else Decimal(1)
            if any(w in modifiers.negations for w in before):
                factor *= Decimal(str(modifiers.negated))
            total, hits = total + Decimal(str(LEXICON[word])) * factor, hits + 1
    return float((total / hits).quantize(Decimal("0.1"), ROUND_HALF_UP)) if hits else 0.0


@pytest.mark.parametrize("reach", [0, 1, 3, 5])
def test_modifiers_by_hand(spark, reach):
    """One word both negates and strengthens, another is in the lexicon itself."""
    modifiers = Modifiers(["not", "hardly"], {"very": 1.5, "hardly": 0.5, "so": 1.25}, reach)
    rng = random.Random(reach)
    pool = [*LEXICON, "very", "hardly", "so", "it", "is", "a"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 30))) for _ in range(150)]
    df = spark.createDataFrame([*enumerate(texts), (999, None)], "id long, t string")
    table = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    both = score_by_lexicon(df.withColumn("inline", lexicon_polarity(F.col("t"), LEXICON, modifiers)), "t", "id", table, "tabled", modifiers)
    expected = {i: by_hand(t, modifiers) for i, t in enumerate(texts)} | {999: 0.0}
    rows = both.collect()
    assert {r.id: r.inline for r in rows} == expected and {r.id: r.tabled for r in rows} == expected


def test_words_meet_a_small_lexicon_without_a_shuffle(spark, tmp_path):
    """Spark takes a table made in the session for a large one; the words of all texts were sorted for it."""
    spark.range(1000).select("id", F.lit("a good day").alias("t")).write.parquet(str(tmp_path / "texts"))
    table = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    texts = spark.read.parquet(str(tmp_path / "texts"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500b")
        plan = physical_plan(score_by_lexicon(texts, "t", "id", table, "s"))
        assert not re.search(r"Exchange hashpartitioning\(xxhash64\(_word", plan) and "BuildRight" in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10b")
        plan = physical_plan(score_by_lexicon(texts, "t", "id", table, "s"))
        assert re.search(r"Exchange hashpartitioning\(xxhash64\(_word", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
