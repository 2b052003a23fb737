"""Batch scoring of tickets by a model the caller supplies."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions.text import digest
from ticketmill.operators.enrichment import build_prompt
from ticketmill.operators.lookup import same_key
from ticketmill.plans.shared import new_folder
from ticketmill.sources.files import exists

PROMPT_KEY = "prompt_key"
REPLIES = f"{PROMPT_KEY} string, model_reply string"


def model_reply(
    prompt: Column,
    score: Callable[[str], str | None],
    max_retries: int = 3,
    delay_seconds: float = 3,
    sleep: Callable[[float], None] = time.sleep,
) -> Column:
    """The model's answer per prompt; null once every attempt has failed.

    `score` takes one prompt and returns the reply; it fails by raising or by returning None. After
    the n-th failure the task waits 2**n seconds, after a success `delay_seconds`. Only the prompt
    crosses to Python, in Arrow batches. The result is marked nondeterministic so Spark neither
    repeats nor moves the calls.
    """

    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            yield pd.Series([answer(text) for text in prompts], dtype="object")

    def answer(text: str | None) -> str | None:
        for attempt in range(1, max_retries + 1):
            try:
                reply = score(text)
                if reply is None:
                    raise ValueError("empty answer")
            except Exception:  # noqa: BLE001 - whatever a model client raises counts as a failed attempt
                sleep(2**attempt)
            else:
                sleep(delay_seconds)
                return reply
        return None

    answers.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(answers, "string").asNondeterministic()(prompt)


def score_tickets(
    valid: DataFrame,
    score: Callable[[str], str | None],
    max_retries: int = 3,
    delay_seconds: float = 3,
    parallel_callers: int | None = None,
    text: str = "customer_text",
    output: str = "model_reply",
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Add the reply column. `parallel_callers` bounds how many tasks call the model at once.

    Calls cost time and money and a lost executor repeats its tasks, so write the result to a table
    before using it.
    """
    spread = valid.repartition(parallel_callers) if parallel_callers else valid
    return spread.withColumn(output, model_reply(build_prompt(F.col(text)), score, max_retries, delay_seconds, sleep))


class TokenBucket:
    """Lets `rate` calls a second through on average, `burst` of them at once."""

    def __init__(
        self, rate: float, burst: float = 1, clock: Callable[[], float] = time.monotonic,
        sleep: Callable[[float], None] = time.sleep,
    ):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = burst, clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            now = self.clock()
            self.tokens, self.at = max(1.0, min(self.burst, self.tokens + (now - self.at) * self.rate)), now
        self.tokens -= 1


def prompt_key(prompt: Column) -> Column:
    """A prompt's name in the reply store: 256 bits of its text, as hex."""
    return F.lower(F.hex(digest(prompt)))


def stored_replies(df: DataFrame, store: str) -> DataFrame:
    """One reply for each prompt that the store holds."""
    spark = df.sparkSession
    found = spark.read.schema(REPLIES).parquet(store) if exists(spark, store) else spark.createDataFrame([], REPLIES)
    return found.groupBy(PROMPT_KEY).agg(F.min("model_reply").alias("model_reply"))


def ask_model(
    prompts: DataFrame,
    score_batch: Callable[[Sequence[str]], Sequence[str | None]],
    store: str,
    prompt: str = "prompt",
    slices: int = 1,
    parallel_callers: int | None = None,
    batch_size: int = 16,
    calls_per_second: float | None = None,
    max_retries: int = 3,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Ask the model for every prompt without a stored reply; returns how many there were.

    Equal prompts are asked once. The work is done in `slices`, by a hash of the prompt, and the replies of a
    slice are committed together, so a run that fails repeats the calls of one slice at most. `score_batch`
    takes up to `batch_size` prompts and returns a reply for each, None where it has none; it fails by raising.
    What failed is asked again, `max_retries` times in all with a pause of 2**n seconds after the n-th, and
    is left without a reply after that: the next run asks again. `calls_per_second` is for all
    `parallel_callers` tasks together.
    """
    spark = prompts.sparkSession
    offered = prompts.where(F.col(prompt).isNotNull()).select(F.col(prompt).alias("_prompt"))
    offered = offered.withColumn(PROMPT_KEY, prompt_key(F.col("_prompt"))).dropDuplicates([PROMPT_KEY])
    known = stored_replies(prompts, store).select(F.col(PROMPT_KEY).alias("_known"))
    missing = offered.join(known, same_key(offered, PROMPT_KEY, known, "_known"), "left_anti")
    folder = new_folder(spark, "prompts")
    missing.withColumn("_slice", F.pmod(F.xxhash64(PROMPT_KEY), F.lit(slices)).cast("int")).write.partitionBy(
        "_slice"
    ).parquet(folder)
    pending = spark.read.schema(f"_prompt string, {PROMPT_KEY} string, _slice int").parquet(folder)
    tasks = parallel_callers or spark.sparkContext.defaultParallelism
    rate = calls_per_second / tasks if calls_per_second else None
    ask = _asker(score_batch, batch_size, rate, max_retries, sleep)
    for number in range(slices):
        own = pending.where(F.col("_slice") == number).select(PROMPT_KEY, "_prompt").repartition(tasks)
        own.mapInArrow(ask, REPLIES).where(F.col("model_reply").isNotNull()).write.mode("append").parquet(store)
    return pending.count()


def _asker(score_batch: Callable, batch_size: int, rate: float | None, max_retries: int, sleep: Callable[[float], None]):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TokenBucket(rate, sleep=sleep) if rate else None
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                part = batch.slice(at, batch_size)
                replies = _answers(part.column("_prompt").to_pylist(), score_batch, bucket, max_retries, sleep)
                yield pa.RecordBatch.from_arrays(
                    [part.column(PROMPT_KEY), pa.array(replies, pa.string())], [PROMPT_KEY, "model_reply"]
                )

    return ask


def _answers(
    prompts: list[str], score_batch: Callable, bucket: TokenBucket | None, max_retries: int, sleep: Callable[[float], None]
) -> list[str | None]:
    replies: list[str | None] = [None] * len(prompts)
    for attempt in range(1, max_retries + 1):
        open_ = [k for k, reply in enumerate(replies) if reply is None]
        if attempt > 1:
            sleep(2 ** (attempt - 1))
        if bucket:
            bucket.take()
        try:
            answers = list(score_batch([prompts[k] for k in open_]))
            if len(answers) != len(open_):
                raise ValueError(f"{len(answers)} replies to {len(open_)} prompts")
        except Exception:  # noqa: BLE001 - whatever a model client raises counts as a failed attempt
            continue
        for k, answer in zip(open_, answers):
            replies[k] = answer
        if all(reply is not None for reply in replies):
            break
    return replies


def score_tickets_from_store(
    valid: DataFrame,
    score_batch: Callable[[Sequence[str]], Sequence[str | None]],
    store: str,
    text: str = "customer_text",
    output: str = "model_reply",
    **asking: object,
) -> DataFrame:
    """Add the reply column from a store of replies, after asking the model for those it lacks.

    Tickets meet their replies on the digest of the prompt; a ticket whose prompt has no reply gets null, and
    so does one without text.
    """
    with_prompt = valid.withColumn("_prompt", build_prompt(F.col(text)))
    ask_model(with_prompt, score_batch, store, "_prompt", **asking)
    keyed = valid.withColumn("_key", F.when(F.col(text).isNotNull(), prompt_key(build_prompt(F.col(text)))))
    replies = stored_replies(valid, store).select(F.col(PROMPT_KEY).alias("_reply_key"), F.col("model_reply").alias(output))
    return keyed.join(replies, same_key(keyed, "_key", replies, "_reply_key"), "left").drop("_key", "_reply_key")
