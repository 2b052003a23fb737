"""Quality rules as a short-circuit cascade: what rejects most for its cost is asked first.

A rule is a condition on measures of a text. On a sample, each rule is run alone: the share it rejects
and the time it takes, measures included and the time of a job without a rule taken off, give its
rejection per cost, and the rules are ordered by it. The cascade is one CASE expression, so a text that a rule rejects is not asked any further and
measures that only later rules need are not taken. A text passes if no rule rejects it, so the verdict
does not depend on the order; which rule is named first does.

All expressions are Spark's own. Windows of three words are told apart by their 64-bit hashes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.samples import PARTS, draw, known_by
from ticketmill.llm.tables import stored

BLANK = r"[\x20\x09-\x0D]"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"
BULLET = rf"^{BLANK}*[-*\x{{2022}}]"
OPEN_END = rf"(\.\.\.|\x{{2026}}){BLANK}*\z"
WINDOW = 3
LEAST_SECONDS = 1e-7


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column) -> Column:
    """How many words stand in windows that occur twice or more."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)]))

    def marked(hash_of: Column) -> Column:
        both = F.array_sort(F.transform(hash_of, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(both, covered)

    def covered(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        twin = F.filter(
            ordered,
            lambda x, k: ((k > 0) & (F.get(ordered, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(ordered, k + 1)["h"] == x["h"])),
        )
        places = F.array_sort(F.transform(twin, lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        step = lambda so_far, at: F.struct(
            at.alias("last"), (so_far["total"] + F.least(F.lit(WINDOW), at - so_far["last"])).alias("total")
        )
        return F.aggregate(places, start, step, lambda so_far: so_far["total"])

    any_twice = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(bound(hashes, any_twice))


def measures(text: str | Column = "text") -> dict[str, Column]:
    """Expressions of the measures that rules may use. A null text measures as an empty one."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words_of(text)).cast("long"),
        "word_chars": F.length(F.translate(text, "\x20\x09\x0a\x0b\x0c\x0d", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": bound(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long"),
        "n_repeat_words": bound(words_of(text), _repeated).cast("long"),
        "n_letter_words": F.size(F.filter(words_of(text), lambda word: word.rlike(LETTER))).cast("long"),
        "n_bullet_lines": F.size(F.filter(lines, lambda line: line.rlike(BULLET))).cast("long"),
        "n_open_lines": F.size(F.filter(lines, lambda line: line.rlike(OPEN_END))).cast("long"),
    }


@dataclass(frozen=True)
class Rule:
    """A name, the measures it reads, and the condition under which it rejects."""

    name: str
    reads: tuple[str, ...]
    rejects: Callable[[Mapping[str, Column]], Column]


RULES = (
    Rule("few_words", ("n_words",), lambda m: m["n_words"] < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", ("n_words", "n_symbols"), lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda m: 10 * m["n_dup_lines"] > 5 * m["n_lines"]),
    Rule("short_words", ("n_words", "word_chars"), lambda m: 2 * m["word_chars"] < 3 * m["n_words"]),
    Rule("long_words", ("n_words", "word_chars"), lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule("few_letters", ("n_words", "n_letter_words"), lambda m: 10 * m["n_letter_words"] < 6 * m["n_words"]),
    Rule("bullets", ("n_lines", "n_bullet_lines"), lambda m: 10 * m["n_bullet_lines"] > 9 * m["n_lines"]),
    Rule("open_lines", ("n_lines", "n_open_lines"), lambda m: 10 * m["n_open_lines"] > 3 * m["n_lines"]),
)
BASE = ("few_words", "repeated_words")
#: Measures that `judge_documents` gives of every text; all others are taken where a rule asks for them.
GIVEN = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def rejection_per_cost(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = 2000, text: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds a row) of each rule on about `rows` sampled rows, best first.

    Rows are drawn by a hash of their id and text. The bound of the sample is a parameter; it decides the
    order of rules and no verdict. An empty table gives the rules by name.
    """
    n = docs.count()
    drawn = docs.where(draw(known_by(docs, text)) < min(1.0, rows / max(n, 1)) * PARTS)
    chosen = stored(drawn.select(F.col(text).alias("text")), "rule-sample")

    def asked(condition: Column) -> tuple[float, float, int]:
        """Share of rows that meet a condition, seconds of the faster of two runs, rows."""
        ask = chosen.agg(F.count("*").alias("n"), F.sum(F.coalesce(condition, F.lit(False)).cast("int")).alias("bad"))
        took = []
        for _ in range(2):
            start = time.perf_counter()
            row = ask.first()
            took.append(time.perf_counter() - start)
        return (row.bad or 0) / max(row.n, 1), min(took), row.n

    nothing = F.col("text") == ""
    asked(nothing)  # the first job of a table also reads its footers
    _, idle, n_chosen = asked(nothing)
    found = []
    for rule in rules:
        share, seconds, _ = asked(rule.rejects(measures("text")))
        found.append((rule, share, max((seconds - idle) / max(n_chosen, 1), LEAST_SECONDS)))
    return sorted(found, key=lambda x: (-x[1] / x[2], x[0].name))


def first_rejection(rules: Sequence[Rule], of: Mapping[str, Column]) -> Column:
    """Name of the first rule that rejects, null if all pass; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(of), F.lit(rule.name)).otherwise(verdict)
    return verdict


def rule_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = 2000) -> DataFrame:
    """`docs` with rejected_by, the rule of the ordered cascade that rejects the row, or null."""
    ordered = [rule for rule, _, _ in rejection_per_cost(docs, rules, rows, text)]
    return docs.withColumn("rejected_by", first_rejection(ordered, measures(text)))


def judge_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = 2000) -> DataFrame:
    """doc_id, the `GIVEN` measures of every whole text, base_failed, and kept: no rule of the cascade rejects.

    Texts that fail the base are asked nothing more; the others are asked rule by rule, best first, until
    one rejects, and measures that are not given are taken for the rules that are reached only.
    Null and empty texts have no words and fail the base; repeated rows and null ids stay as rows;
    an empty table gives an empty one; columns beside doc_id and text are not read.
    """
    ordered = [rule for rule, _, _ in rejection_per_cost(docs, rules, rows)]
    taken = measures("text")
    own = docs.select("doc_id", "text", *[taken[name].alias(name) for name in GIVEN])
    of = {name: F.col(name) if name in GIVEN else column for name, column in taken.items()}
    base = F.lit(False)
    for rule in RULES:
        if rule.name in BASE:
            base = base | rule.rejects(of)
    further = first_rejection([rule for rule in ordered if rule.name not in BASE], of)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(further.isNull())
    return own.withColumn("base_failed", base).withColumn("kept", kept).drop("text")
