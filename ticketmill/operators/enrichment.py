"""Sentiment score and category: a model's reply first, local rules where there is none."""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.fixed_values import (
    KEYWORD_DEFAULT,
    KEYWORD_RULES,
    LOCAL_SOURCE,
    MODEL_SOURCE,
    PROMPT_AFTER_TEXT,
    PROMPT_BEFORE_TEXT,
    REPLY_DELIMITER,
    UNKNOWN_CATEGORY,
)
from ticketmill.functions.numeric import (
    names_not_finite,
    number_or_zero,
    percentage,
    round_half_up,
    to_double,
    within_unit,
)
from ticketmill.functions.text import contains_any, strip
from ticketmill.operators.lookup import flag_members, reference_mapping, same_key

WORD = r"[\p{L}\p{N}']+"
LARGEST_POLARITY = 10**6
POLARITY = "decimal(13,6)"
POLARITY_SUM = "decimal(28,6)"
FACTOR = "decimal(9,4)"
#: Bytes of a lexicon's row beside its word.
ENTRY_BYTES = 32


def build_prompt(text: Column, before: str = PROMPT_BEFORE_TEXT, after: str = PROMPT_AFTER_TEXT) -> Column:
    return F.concat(F.lit(before), text, F.lit(after))


def keyword_category(
    lowered: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = KEYWORD_RULES,
    default: str = KEYWORD_DEFAULT,
) -> Column:
    """The first category one of whose keywords occurs in the text, which must be lower-cased.

    The text is read once per keyword, so lower it in a step of its own, as `with_keyword_category` does.
    """
    return F.coalesce(*[F.when(contains_any(lowered, words), name) for name, words in rules], F.lit(default))


def with_keyword_category(
    df: DataFrame,
    text: str = "customer_text",
    rules: Sequence[tuple[str, Sequence[str]]] = KEYWORD_RULES,
    default: str = KEYWORD_DEFAULT,
    output: str = "category",
) -> DataFrame:
    lowered = df.withColumn("_lowered", F.lower(text))
    return lowered.withColumn(output, keyword_category(F.col("_lowered"), rules, default)).drop("_lowered")


def words(text: Column) -> Column:
    """Lower-cased words. Extracting them is several times faster than splitting between them: split
    compiles its pattern per row, and Java matches the negated class slowly."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Modifiers:
    """Words that change the polarity of the `reach` words after them.

    After a negation a polarity is multiplied by `negated`, after a strengthener by its factor; of
    several strengtheners the nearest counts. Both may hold for one word.
    """

    negations: Sequence[str] = ()
    strengtheners: Mapping[str, float] = field(default_factory=dict)
    reach: int = 3
    negated: float = -0.5


def _with_noted(text: Column, modifiers: Modifiers | None, use: Callable[[Column, Callable[[Column], Column]], Column]) -> Column:
    """What `use` makes of the words of a text and of a function that gives the factor at a place of them.

    Each word is looked up among the modifiers once and noted as a small number: the place of its strength, doubled,
    and one more for a negation. A factor is then read from the notes before its place, out of a constant table of
    all products, so no decimal is computed for a word.
    """
    one = F.lit(1).cast(FACTOR)
    # Words and notes are bound to variables, or a lambda would make them again for each word.
    if modifiers is None or modifiers.reach < 1 or not (modifiers.negations or modifiers.strengtheners):
        return F.element_at(F.transform(F.array(words(text)), lambda every: use(every, lambda i: one)), 1)
    negations = {w.lower() for w in modifiers.negations}
    strength = {w.lower(): Decimal(str(f)) for w, f in modifiers.strengtheners.items()}
    strong = [one, *[F.lit(f).cast(FACTOR) for f in strength.values()]]
    turned = F.lit(Decimal(str(modifiers.negated))).cast(FACTOR)
    factors = F.array(*[f for s in strong for f in (s, (s * turned).cast(FACTOR))])
    places = {word: place for place, word in enumerate(strength, 1)}
    codes = {word: 2 * places.get(word, 0) + (word in negations) for word in [*strength, *sorted(negations - set(strength))]}
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])

    def use_noted(every: Column, notes: Column) -> Column:
        def factor(i: Column) -> Column:
            before = [F.get(notes, i - k) for k in range(1, modifiers.reach + 1)]
            nearest = F.coalesce(*[F.when(code >= 2, F.shiftright(code, 1)) for code in before], F.lit(0))
            turns = reduce(lambda a, b: a.bitwiseOR(b), [F.coalesce(code.bitwiseAND(F.lit(1)), F.lit(0)) for code in before])
            return F.when(F.coalesce(*before).isNull(), one).otherwise(F.get(factors, nearest * 2 + turns))

        return use(every, factor)

    def note(every: Column) -> Column:
        notes = F.transform(every, lambda word: F.try_element_at(table, word))
        return F.element_at(F.transform(F.array(notes), lambda noted: use_noted(every, noted)), 1)

    return F.element_at(F.transform(F.array(words(text)), note), 1)


def weighted_words(text: Column, modifiers: Modifiers | None = None) -> Column:
    """The words of a text in order, each with the factor that the words before it give to its polarity."""

    def weigh(every: Column, factor: Callable[[Column], Column]) -> Column:
        return F.transform(every, lambda word, i: F.struct(word.alias("word"), factor(i).alias("factor")))

    return _with_noted(text, modifiers, weigh)


def lexicon_polarity(text: Column, lexicon: Mapping[str, float], modifiers: Modifiers | None = None) -> Column:
    """Mean polarity of the words found in the lexicon, one place; 0.0 when none is.

    The lexicon becomes one constant table, so the score is a plain expression: no shuffle, and usable on
    streams. It is an array of small maps, and a word's CRC-32 tells its map, so a look-up costs the same in
    a lexicon of any size. Case does not matter on either side; of twins in case the largest polarity
    counts, as in `score_by_lexicon`. A polarity that is no number below `LARGEST_POLARITY` is refused with
    its word. `modifiers` names words that turn or strengthen the polarity of the words after them.
    """
    entries: dict[str, Decimal] = {}
    for word, polarity in lexicon.items():
        if not math.isfinite(polarity) or abs(polarity) >= LARGEST_POLARITY:
            raise ValueError(f"polarity of {word!r} is {polarity}")
        entries[word.lower()] = max(round(Decimal(str(polarity)), 6), entries.get(word.lower(), Decimal("-inf")))
    if not entries:
        return F.when(text.isNotNull(), F.lit(0.0)).otherwise(F.lit(0.0))
    size = max(1, len(entries) // 2)
    maps: list[dict[str, str]] = [{} for _ in range(size)]
    for word, polarity in entries.items():
        maps[zlib.crc32(word.encode()) % size][word] = str(polarity)
    table = F.from_json(F.lit(json.dumps(maps, ensure_ascii=False)), f"array<map<string,{POLARITY}>>")

    def found(every: Column, factor: Callable[[Column], Column]) -> Column:
        def weigh(word: Column, i: Column) -> Column:
            own = F.element_at(table, (F.crc32(word.cast("binary")) % size + 1).cast("int"))
            # The product asks for a factor only where the word has a polarity.
            return (F.try_element_at(own, word) * factor(i)).cast(POLARITY)

        return F.filter(F.transform(every, weigh), lambda polarity: polarity.isNotNull())

    start = F.struct(F.lit(0).cast(POLARITY_SUM).alias("total"), F.lit(0).alias("hits"))

    def add(state: Column, polarity: Column) -> Column:
        total = (state["total"] + polarity).cast(POLARITY_SUM)
        return F.struct(total.alias("total"), (state["hits"] + 1).alias("hits"))

    return F.coalesce(F.aggregate(_with_noted(text, modifiers, found), start, add, _mean), F.lit(0.0))


def _mean(state: Column) -> Column:
    return F.coalesce(
        round_half_up(F.try_divide(state["total"].cast("double"), state["hits"].cast("double")), 1), F.lit(0.0)
    )


def score_by_lexicon(
    df: DataFrame, text: str, row_id: str, lexicon: DataFrame, output: str = "sentiment_score",
    modifiers: Modifiers | None = None, only: Column | None = None,
) -> DataFrame:
    """The same score with the lexicon (`word`, `polarity`) as a table of any size.

    Rows for which `only` does not hold are not read word by word; their score is 0.0.

    Words of one row sit in one partition, so with a lexicon that is broadcast the partial aggregate leaves
    one small record per row before the shuffle; a larger lexicon is joined by shuffle, where adaptive
    execution splits a hot word. Spark has no size of a table made in the session and would shuffle every word
    of every text for it, so the lexicon is counted first. The score returns over the unique row id.
    """
    entries = reference_mapping(lexicon.withColumn("word", F.lower("word")), "word", "polarity").select(
        F.col("word").alias("_entry"), F.col("polarity").cast(POLARITY).alias("_polarity")
    )
    entries = F.broadcast(entries) if _fits_broadcast(entries, "_entry") else entries
    wanted = df if only is None else df.where(only)
    weighted = wanted.select(row_id, F.explode(weighted_words(F.col(text), modifiers)).alias("_weighted"))
    tokens = weighted.select(row_id, F.col("_weighted.word").alias("_word"), F.col("_weighted.factor").alias("_factor"))
    scores = (
        tokens.join(entries, same_key(tokens, "_word", entries, "_entry"))
        .groupBy(row_id)
        .agg(F.sum((F.col("_polarity") * F.col("_factor")).cast(POLARITY)).cast(POLARITY_SUM).alias("total"), F.count(F.lit(1)).alias("hits"))
        .select(row_id, _mean(F.struct("total", "hits")).alias(output))
    )
    return df.join(scores, row_id, "left").select(*df.columns, F.coalesce(output, F.lit(0.0)).alias(output))


def _fits_broadcast(entries: DataFrame, word: str) -> bool:
    """Is the table under the size up to which Spark broadcasts? A job over the table, which returns one number."""
    limit = re.fullmatch(r"(\d+) *([kmgtp]?)b?", entries.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower())
    if limit is None:
        return False
    size = entries.agg(F.sum(F.octet_length(word) + F.lit(ENTRY_BYTES))).first()[0] or 0
    return size <= int(limit[1]) * 1024 ** " kmgtp".index(limit[2] or " ")


def parse_replies(
    df: DataFrame, reply: str, categories: DataFrame, category_column: str = "category_name"
) -> DataFrame:
    """Read `score|category` replies into `model_score` and `model_category`; null reply, null result.

    No delimiter or no number: 0.0 and the unknown category. Otherwise each half falls back on its
    own: a score outside [-1, 1] becomes 0.0, a category not in the table the unknown one. The
    category is compared as written, so a blank after the delimiter makes it unknown.
    """
    halves = F.split(strip(F.col(reply)), rf"\{REPLY_DELIMITER}", 2)
    split = df.withColumns({"_score_text": F.get(halves, 0), "_category": F.get(halves, 1)})
    # The score stands in a step of its own, as the lines below it read it several times.
    scored = split.withColumn("_score", to_double(F.col("_score_text")))
    known = flag_members(scored, "_category", categories, category_column, "_known_category")
    score, category = F.col("_score"), F.col("_category")
    readable = category.isNotNull() & (score.isNotNull() | names_not_finite(F.col("_score_text")))
    answered = F.col(reply).isNotNull()
    return known.withColumns(
        {
            "model_score": F.when(answered, F.when(category.isNotNull(), within_unit(score)).otherwise(F.lit(0.0))),
            "model_category": F.when(
                answered, F.when(F.col("_known_category") & readable, category).otherwise(UNKNOWN_CATEGORY)
            ),
        }
    ).drop("_score_text", "_category", "_score", "_known_category")


def enrich_tickets(
    valid: DataFrame,
    categories: DataFrame,
    local_score: Column,
    reply: str = "model_reply",
    text: str = "customer_text",
    model_source: str = MODEL_SOURCE,
    local_source: str = LOCAL_SOURCE,
    rules: Sequence[tuple[str, Sequence[str]]] = KEYWORD_RULES,
) -> DataFrame:
    """Silver rows: `sentiment_score`, `category`, `analysis_source` from the reply or the fallback.

    `local_score` is any expression over the row, for instance `lexicon_polarity`, or a column that
    `score_by_lexicon` added. One projection per row; nothing is shuffled.
    """
    answered = F.col(reply).isNotNull()
    replied = parse_replies(valid, reply, categories).withColumn("_lowered", F.lower(text))
    return replied.withColumns(
        {
            "sentiment_score": number_or_zero(F.when(answered, F.col("model_score")).otherwise(local_score)),
            "category": F.when(answered, F.col("model_category")).otherwise(keyword_category(F.col("_lowered"), rules)),
            "analysis_source": F.when(answered, model_source).otherwise(local_source),
        }
    ).drop("model_score", "model_category", "_lowered", reply)


def enrichment_summary(
    silver: DataFrame,
    by: Sequence[str] = (),
    model_source: str = MODEL_SOURCE,
    local_source: str = LOCAL_SOURCE,
) -> DataFrame:
    """Rows enriched, how many by the model and by the local rules, the model's share in percent."""
    return with_model_share(silver.groupBy(*by).agg(*enrichment_counts(model_source, local_source)))


def enrichment_counts(model_source: str = MODEL_SOURCE, local_source: str = LOCAL_SOURCE) -> list[Column]:
    """The counts of the summary as aggregates, which a write may observe as well."""
    total = F.count(F.lit(1))
    return [
        total.alias("rows_read"),
        total.alias("rows_enriched"),
        F.count_if(F.col("analysis_source") == model_source).alias("gemini_enrichments"),
        F.count_if(F.col("analysis_source") == local_source).alias("textblob_enrichments"),
    ]


def with_model_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("gemini_percentage", percentage(F.col("gemini_enrichments"), F.col("rows_read")))
