"""Preference formatting: pairs of conversations as one prompt and two masked completions.

The longest common prefix of turns is rendered once. What follows in each conversation is its
completion, with the character spans that a loss may count: the texts of the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
TURN = "array<struct<role:string,text:string>>"


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two conversations (arrays of role and text) share from the start; nulls are equal."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.array_min(F.filter(places, lambda i: ~a[i].eqNullSafe(b[i]))), shorter)


def _part(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"), F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    """The turns as one text: role, text and end of each. A null role or text is empty."""
    return F.array_join(F.transform(turns, _part), "")


def completion_spans(turns: Column) -> Column:
    """(start, stop) in the rendered turns of each assistant's text with its end mark, in code points."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(so_far: Column, turn: Column) -> Column:
        start = so_far["at"] + F.length(F.coalesce(turn["role"], F.lit(""))) + 5
        stop = so_far["at"] + F.length(_part(turn)) - 1
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        mine = F.coalesce(turn["role"] == ASSISTANT, F.lit(False))
        return F.struct((stop + 1).alias("at"), F.when(mine, F.concat(so_far["spans"], span)).otherwise(so_far["spans"]).alias("spans"))

    return F.aggregate(turns, state, step, lambda so_far: so_far["spans"])


def format_preferences(pairs: DataFrame) -> DataFrame:
    """`pairs` with its columns chosen and rejected, arrays of (role, text), made training text.

    Adds n_common, prompt, chosen_completion, rejected_completion, chosen_spans and rejected_spans. A
    null conversation is one without turns. Two equal conversations have empty completions. A column of
    `pairs` that is named as one of these gives way to it; all others stay. Repeated rows are formatted
    alike, turns without text are empty, long ones whole; an empty table gives an empty one.
    """
    empty = F.array().cast(TURN)
    sides = ("chosen", "rejected")
    made = ["n_common", "prompt", *[f"{s}_{part}" for part in ("completion", "spans") for s in sides]]
    whole = pairs.withColumns({side: F.coalesce(F.col(side).cast(TURN), empty) for side in sides})
    whole = whole.withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")))
    rest = {side: F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side), F.lit(1))) for side in sides}
    return whole.select(
        *[c for c in whole.columns if c not in (*sides, *made)], "n_common",
        render(F.slice("chosen", F.lit(1), F.col("n_common"))).alias("prompt"),
        *[render(turns).alias(f"{side}_completion") for side, turns in rest.items()],
        *[completion_spans(turns).alias(f"{side}_spans") for side, turns in rest.items()],
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order; equal rows count once.

    Turns of equal number follow role and text, a null number comes first. A row without conv_id belongs
    to no conversation.
    """
    row = F.struct("turn", "role", "text")
    grouped = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_set(row)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def replies_of_others(turns: DataFrame) -> DataFrame:
    """Pairs (conv_id, chosen, rejected): a conversation up to its last reply, and with another's reply.

    Conversations are partners whose ids differ in the last bit. The rejected side has the partner's last
    reply in the place of the last one; it ends before it where there is no partner or no reply there. A
    conversation without a reply of its own is compared with itself, and so has empty completions.
    """
    own = conversations_of(turns)
    reply = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i)))
    placed = own.withColumn("at", reply)
    last = placed.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("partner"), F.when(F.col("at").isNotNull(), F.array(F.get("turns", F.col("at")))).otherwise(F.array().cast(TURN)).alias("reply"))
    both = placed.join(last, placed.conv_id == last.partner, "left")
    before = F.slice("turns", F.lit(1), F.col("at"))
    upto = F.slice("turns", F.lit(1), F.col("at") + 1)
    has = F.col("at").isNotNull()
    return both.select(
        "conv_id",
        F.when(has, upto).otherwise(F.col("turns")).alias("chosen"),
        F.when(has, F.concat(before, F.coalesce("reply", F.array().cast(TURN)))).otherwise(F.col("turns")).alias("rejected"),
    )
