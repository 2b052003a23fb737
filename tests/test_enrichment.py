from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import enrichment, scoring
from ticketmill.operators.enrichment import (
    build_prompt,
    enrich_tickets,
    enrichment_summary,
    lexicon_polarity,
    parse_replies,
    score_by_lexicon,
    with_keyword_category,
)

REPLIES = [
    ("0.4|Billing", 0.4, "Billing"),
    ("  0.4|Billing \n", 0.4, "Billing"),
    ("0.4| Billing", 0.4, "General"),
    (" 0.4 |Billing", 0.4, "Billing"),
    ("0.3|Unknown", 0.3, "General"),
    ("0.3|billing", 0.3, "General"),
    ("2.5|Account", 0.0, "Account"),
    ("-1.0|Account", -1.0, "Account"),
    ("-1.01|Account", 0.0, "Account"),
    ("nan|Billing", 0.0, "Billing"),
    ("-inf|Billing", 0.0, "Billing"),
    ("1e999|Billing", 0.0, "Billing"),
    ("garbage", 0.0, "General"),
    ("", 0.0, "General"),
    ("|Billing", 0.0, "General"),
    ("high|Billing", 0.0, "General"),
    ("0.5f|Billing", 0.0, "General"),
    ("0.2|Billing|x", 0.2, "General"),
    ("0.2|", 0.2, "General"),
    ("0.2|General", 0.2, "General"),
    (None, None, None),
]


def test_replies(spark, categories):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(REPLIES)], "id int, reply string")
    parsed = parse_replies(df, "reply", categories).orderBy("id").collect()
    assert [(r.reply, r.model_score, r.model_category) for r in parsed] == REPLIES


@pytest.mark.parametrize(
    "text, expected",
    [
        ("How do I reset my password?", "How-To Question"),
        ("HOW TO get a refund", "How-To Question"),
        ("I was charged, error 500", "Technical"),
        ("Ref 500", "Technical"),
        ("I want to download it", "Technical"),
        ("please reset it", "Account"),
        ("cannot log in", "Feedback"),
        ("my Invoice", "Billing"),
        ("nice", "Feedback"),
    ],
)
def test_keyword_category(spark, text, expected):
    df = spark.createDataFrame([(text,)], "customer_text string")
    assert with_keyword_category(df).first().category == expected


def brute_force(text, lexicon):
    import re
    from decimal import ROUND_HALF_UP, Decimal

    hits = [Decimal(str(lexicon[w])) for w in re.split(r"[^a-z0-9']+", text.lower()) if w in lexicon]
    if not hits:
        return 0.0
    return float((sum(hits) / len(hits)).quantize(Decimal("0.1"), ROUND_HALF_UP))


def test_both_lexicon_forms_agree_with_brute_force(spark):
    rng = random.Random(3)
    lexicon = {f"w{i}": round(rng.uniform(-1, 1), rng.choice([1, 2, 6])) for i in range(300)} | {"w7": 1e-06, "w8": -1.0}
    texts = [" ".join(f"W{rng.randrange(500)}" for _ in range(rng.randrange(0, 40))) + "!" for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    expected = [brute_force(t, lexicon) for t in texts]
    inline = df.withColumn("s", lexicon_polarity(F.col("t"), lexicon)).orderBy("id").collect()
    joined = score_by_lexicon(df, "t", "id", table, "s").orderBy("id").collect()
    assert [r.s for r in inline] == expected
    assert [r.s for r in joined] == expected


def test_inline_lexicon_of_any_size_scores_as_the_table(spark):
    lexicon = {f"Wort{i}": (i % 21 - 10) / 10 for i in range(50_000)} | {"überlastet": -1.0, "ПЛОХО": 0.5, "big": 5000.0}
    texts = ["Wort7 wort49999, x", "Überlastet!", "плохо überlastet", "BIG", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    inline = df.select("id", enrichment.lexicon_polarity(F.col("text"), lexicon).alias("sentiment_score"))
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    by_table = enrichment.score_by_lexicon(df, "text", "id", table).select("id", "sentiment_score")
    assert sorted(map(tuple, inline.collect())) == sorted(map(tuple, by_table.collect()))
    assert [r.sentiment_score for r in inline.orderBy("id").collect()][1:4] == [-1.0, -0.3, 5000.0]
    for bad in (float("nan"), float("inf"), 1e7):
        with pytest.raises(ValueError, match="odd"):
            enrichment.lexicon_polarity(F.col("text"), {"odd": bad})


def test_empty_lexicon_and_null_text(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string")
    assert [r[0] for r in df.select(lexicon_polarity(F.col("t"), {})).collect()] == [0.0, 0.0]
    assert [r[0] for r in df.select(lexicon_polarity(F.col("t"), {"a": 0.25})).collect()] == [0.3, 0.0]


def test_prompt(spark):
    prompt = spark.range(1).select(build_prompt(F.lit("It broke"))).first()[0]
    assert prompt.startswith("\n    Analyze the sentiment") and prompt.endswith('Ticket: "It broke"\n    ')


def tickets(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, customer_text string")


def test_fallback_after_the_last_attempt(spark, categories):
    def score(prompt):
        if "down" in prompt:
            raise TimeoutError
        return None if "none" in prompt else "0.7|Billing"

    slept = spark.sparkContext.accumulator(0)
    scored = scoring.score_tickets(
        tickets(spark, ["is down", "fine", "none"]), score, max_retries=3, delay_seconds=100, sleep=lambda s: slept.add(int(s))
    )
    stored = scored.persist()
    assert [r.model_reply for r in stored.orderBy("id").collect()] == [None, "0.7|Billing", None]
    assert slept.value == 2 * (2 + 4 + 8) + 100
    silver = enrich_tickets(stored, categories, F.lit(-0.5)).orderBy("id").collect()
    assert [(r.sentiment_score, r.category, r.analysis_source) for r in silver] == [
        (-0.5, "Technical", "textblob"),
        (0.7, "Billing", "gemini"),
        (-0.5, "Feedback", "textblob"),
    ]
    stored.unpersist()


def test_a_flaky_model_is_asked_again(spark):
    def flaky():
        calls = []

        def score(prompt):
            calls.append(prompt)
            if len(calls) % 2:
                raise ConnectionError
            return "0.1|Account"

        return score

    scored = scoring.score_tickets(
        tickets(spark, ["a"] * 6), flaky(), max_retries=2, delay_seconds=0, parallel_callers=2, sleep=lambda s: None
    )
    assert scored.rdd.getNumPartitions() == 2
    assert [r.model_reply for r in scored.collect()] == ["0.1|Account"] * 6


def test_no_rows_are_enriched_to_no_rows(spark, categories):
    empty = tickets(spark, ["x"]).where("false").withColumn("model_reply", F.lit(None).cast("string"))
    silver = enrich_tickets(empty, categories, F.lit(0.0))
    assert silver.isEmpty() and "sentiment_score" in silver.columns
    summary = enrichment_summary(silver).first()
    assert (summary.rows_enriched, summary.gemini_percentage) == (0, None)
