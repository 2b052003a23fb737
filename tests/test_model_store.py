"""The reply store: what is asked, what is asked again, and how fast."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import scoring
from ticketmill.operators.enrichment import Modifiers, build_prompt, lexicon_polarity, score_by_lexicon


def tickets(spark, n, repeat=1):
    rows = [(i, f"text {i // repeat}" if i % 10 else None) for i in range(n)]
    return spark.createDataFrame(rows, "_row_id long, customer_text string").repartition(3)


def caller(folder, fails=lambda text: False, answers=lambda text: f"0.1|{len(text)}"):
    """A model that notes every call in a file of its own."""

    def score(prompts):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            file.write("\n@@".join(prompts))
        if any(fails(p) for p in prompts):
            raise TimeoutError("no answer")
        return [answers(p) for p in prompts]

    return score


def asked(folder):
    return [p for name in glob.glob(f"{folder}/*") for p in open(name).read().split("\n@@")]


OPTIONS = {"max_retries": 1, "sleep": lambda seconds: None, "parallel_callers": 2}


def test_a_second_run_asks_for_the_rest_only(spark, tmp_path):
    store, first, second = (str(tmp_path / n) for n in ("store", "first", "second"))
    for folder in (first, second):
        (tmp_path / folder.rsplit("/", 1)[1]).mkdir()
    valid = tickets(spark, 40, repeat=2)
    half = caller(first, answers=lambda p: None if "text 7" in p else "0.1|x")
    once = scoring.score_tickets_from_store(valid, half, store, slices=3, batch_size=4, **OPTIONS)
    missing = sorted(r._row_id for r in once.where("model_reply IS NULL").collect())
    assert missing == sorted([0, 10, 20, 30, 14, 15]) and len(asked(first)) == 20
    both = scoring.score_tickets_from_store(valid, caller(second), store, slices=3, **OPTIONS)
    assert sorted(asked(second)) == [r.p for r in valid.where("_row_id = 15").select(build_prompt(F.col("customer_text")).alias("p")).collect()]
    assert both.where("model_reply IS NULL").count() == 4 and both.count() == 40
    assert scoring.ask_model(valid.select(build_prompt(F.col("customer_text")).alias("prompt")), caller(second), store, **OPTIONS) == 0


def test_a_failing_slice_keeps_the_slices_before(spark, tmp_path):
    store, calls = str(tmp_path / "store"), tmp_path / "calls"
    calls.mkdir()
    prompts = tickets(spark, 50).select(F.col("customer_text").alias("prompt"))

    def stop(batch):
        raise SystemExit("the cluster is gone")

    keys = prompts.select(scoring.prompt_key(F.col("prompt")).alias("k")).where("k IS NOT NULL")
    scoring.ask_model(prompts.where("prompt < 'text 3'"), caller(str(calls)), store, slices=4, **OPTIONS)
    before = scoring.stored_replies(prompts, store).count()
    with pytest.raises(Exception, match="gone"):
        scoring.ask_model(prompts, stop, store, slices=4, **OPTIONS)
    assert before and scoring.stored_replies(prompts, store).count() == before < keys.count()


def test_a_batch_is_asked_again_for_what_it_lacks():
    calls = []

    def score(prompts):
        calls.append(list(prompts))
        if len(calls) == 1:
            raise TimeoutError
        return [None if p == "b" and len(calls) == 2 else p.upper() for p in prompts]

    pauses = []
    assert scoring._answers(["a", "b"], score, None, 4, pauses.append) == ["A", "B"]
    assert calls == [["a", "b"], ["a", "b"], ["b"]] and pauses == [2, 4]
    assert scoring._answers(["a"], lambda prompts: [], None, 2, lambda s: None) == [None]


def test_the_bucket_keeps_the_rate():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    bucket = scoring.TokenBucket(2, burst=3, clock=lambda: now[0], sleep=sleep)
    for _ in range(7):
        bucket.take()
    assert slept == [0.5] * 4 and now[0] == 2.0
    now[0] += 100
    for _ in range(3):
        bucket.take()
    assert len(slept) == 4


# Polarity with modifiers


TEXTS = ["not good", "very good", "not a very good", "never x y z good", "GOOD bad", None, "", "not", "very very bad not good good", "Not GOOD"]


def by_hand(text, lexicon, modifiers):
    words, scores = (text or "").lower().split(), []
    for i, word in enumerate(words):
        if word in lexicon:
            before = words[max(0, i - modifiers.reach) : i]
            factor = next((modifiers.strengtheners[b] for b in reversed(before) if b in modifiers.strengtheners), 1)
            scores.append(lexicon[word] * factor * (modifiers.negated if set(before) & set(modifiers.negations) else 1))
    return round(sum(scores) / len(scores) + (1e-9 if sum(scores) > 0 else -1e-9), 1) if scores else 0.0


def test_negation_and_strength_in_both_forms(spark):
    modifiers = Modifiers(["Not", "never"], {"very": 1.3, "Very": 1.3})
    hand = Modifiers(["not", "never"], {"very": 1.3})
    lexicon = {"good": 0.7, "bad": -0.6}
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    df = df.withColumn("inline", lexicon_polarity(F.col("t"), lexicon, modifiers))
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    for r in score_by_lexicon(df, "t", "i", table, "tabled", modifiers).collect():
        assert r.inline == r.tabled == by_hand(r.t, lexicon, hand), r
    only = score_by_lexicon(df, "t", "i", table, "s", modifiers, F.col("i") > 3)
    assert [r.s for r in only.orderBy("i").collect()][:4] == [0.0] * 4


def test_twins_in_case_agree(spark):
    lexicon = [("refund", -0.2), ("Refund", 0.4)]
    df = spark.createDataFrame([(1, "REFUND refund")], "i int, t string")
    table = spark.createDataFrame(lexicon, "word string, polarity double")
    for pairs in (lexicon, lexicon[::-1]):
        inline = df.select(lexicon_polarity(F.col("t"), dict(pairs)).alias("s")).first().s
        assert inline == score_by_lexicon(df, "t", "i", table, "s").first().s == 0.4


def test_a_look_up_costs_the_same_in_a_large_lexicon(spark):
    import time

    texts = spark.range(20000).select(F.concat_ws(" ", *[F.concat(F.lit("w"), (F.col("id") * k % 50000).cast("string")) for k in range(1, 30)]).alias("t")).cache()
    texts.count()
    seconds = {}
    for size in (500, 50000, 500, 50000):
        score = lexicon_polarity(F.col("t"), {f"w{i}": (i % 21 - 10) / 10 for i in range(size)})
        start = time.perf_counter()
        texts.select(score.alias("s")).agg(F.sum("s")).collect()
        seconds[size] = time.perf_counter() - start
    assert seconds[50000] < 6 * seconds[500] + 3
