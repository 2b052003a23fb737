"""The training-data operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
import corpus_pipeline
from ticketmill.llm import (
    class_lm, components, fingerprints, language_id, mixing, packing, preferences, quality_classifier, rule_cascade,
    simhash, tokens, toxicity,
)
from ticketmill.llm.oracles import ORACLES
from ticketmill.llm.queries import QUERIES
from tests.llm.conftest import MEDIUM, SMALL, odd_rows
from verification.compare import connect, duckdb_rows, spark_rows

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, name, sf=MEDIUM):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bag(rows):
    return collections.Counter(map(tuple, rows))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, MEDIUM)) == duckdb_rows(connect(MEDIUM), ORACLES[name])


def test_ten_operators_and_the_pipeline_are_registered():
    names = set(entry_file.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


# 1: fingerprints


def test_sketches_give_back_all_differences():
    old = ["a b c.\nd e f.\nd e f.\n" + "\n".join(f"line {i}" for i in range(200)), "", "same", None]
    new = ["a b c.\nd e f.\nx\n" + "\n".join(f"line {i}" for i in range(100, 260)), "one.\ntwo.", "same", ""]
    a, b = (fingerprints.elements(pa.array(x)) for x in (old, new))
    at = np.arange(len(old))
    removed, added, cells = fingerprints.differences(a, b, at, at)
    for k in range(len(old)):
        own, other = (set(x.digests[x.bounds[k] : x.bounds[k + 1]].tolist()) for x in (a, b))
        assert set(removed[k].tolist()) == own - other and set(added[k].tolist()) == other - own
    assert cells[0] > fingerprints.CELLS == cells[2]
    assert fingerprints.as_text(a)[2] == fingerprints.as_text(b)[2]


def test_peeling_ends_at_a_cell_that_only_looks_pure():
    """A cell whose check fits its key by chance, among its key's own cells or not."""
    key = np.array([12345], np.uint64)
    for spot in fingerprints._cells_of(key, np.zeros(1, np.int64), 24).ravel().tolist() + [0, 1, 2]:
        table = np.zeros((2, 24), fingerprints.CELL)
        table[0, spot] = (1, key[0], fingerprints._checks(key)[0])
        good = np.array([7, 8, 9], np.uint64)
        fingerprints._change(table, good, np.ones(3, np.int64), 1)
        row, digests, _, empty = fingerprints.peel(table)
        assert empty.tolist() == [False, True] and set(digests[row == 1].tolist()) == {7, 8, 9}


def test_a_digest_that_a_text_holds_twice_is_compared_one_by_one():
    twice = fingerprints.Elements(np.array([5, 5, 6], np.uint64), np.array([0, 3]))
    once = fingerprints.Elements(np.array([6, 7], np.uint64), np.array([0, 2]))
    at = np.zeros(1, np.int64)
    removed, added, _ = fingerprints.differences(twice, once, at, at)
    assert removed[0].tolist() == [5] and added[0].tolist() == [7]


def test_likeness_by_hand(odd):
    rows = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: -r[0] if r[0] is not None else math.inf)
    found = {r.doc_id: r for r in fingerprints.fingerprint_edits(odd).collect()}

    def near(a, b):
        a, b = (fingerprints.elements(pa.array([t], pa.large_string())).digests.tolist() for t in (a, b))
        return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0

    ids = collections.Counter(r[0] for r in rows)
    for (doc_id, text), (after_id, after) in zip(rows, rows[1:]):
        if doc_id is not None and after_id is not None and ids[doc_id] == ids[after_id] == 1:
            edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
            assert found[doc_id].near_next == pytest.approx(near(text, after))
            assert found[doc_id].near_edited == pytest.approx(near(text, edited))


def test_scores_do_not_depend_on_files(spark):
    """The same rows in other files and another order give the same samples, and so the same scores."""
    docs, labels = table(spark, "documents"), table(spark, "labels")
    other = docs.repartition(7, "text").sortWithinPartitions(F.desc("doc_id"))

    def scores(f, d):
        return {tuple(round(x, 7) if isinstance(x, float) else x for x in r) for r in f(d).collect()}

    assert scores(lambda d: quality_classifier.predict_quality(d, labels), docs) == scores(
        lambda d: quality_classifier.predict_quality(d, labels.repartition(3)), other
    )
    assert scores(language_id.predict_languages, docs) == scores(language_id.predict_languages, other)


def test_samples_are_bounded_and_repeatable(spark):
    from ticketmill.llm.samples import sample_of_each

    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 10 == 0, "rare").otherwise("often"))
    one, counts = sample_of_each(df, "g", 300, "s", ["id"])
    two, _ = sample_of_each(df.repartition(9).orderBy(F.desc("id")), "g", 300, "s", ["id"])
    assert counts == {"rare": 500, "often": 4500} and bag(one.collect()) == bag(two.collect())
    assert all(200 < n < 400 for n in collections.Counter(r.g for r in one.collect()).values())


def test_quality_scores_by_hand(spark):
    """The score of the trained state as a plain sparse dot product of n-grams of words and shapes."""
    texts = ["Good words are good words", "a b a b", "", None, "  one  "]
    rows = [(i, t, i % 2) for i, t in enumerate(texts * 6)]
    model = quality_classifier.train_quality_model(spark.createDataFrame(rows, "doc_id int, text string, label int"), buckets=1 << 10)
    weights = model.weights()
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in docs.select("text", quality_classifier.quality_score(docs, model).alias("s")).collect():
        chunk = next(quality_classifier.chunks(pa.array([r.text or ""])))
        features, bounds = quality_classifier._features(chunk, 1 << 10)
        counts = collections.Counter(features.tolist())
        assert len(features) == 6 * len(words(r.text)) == bounds[-1]
        z = weights[-1] + sum(weights[k] * n * quality_classifier.SCALE / max(len(features), 1) for k, n in counts.items())
        assert r.s == pytest.approx(1 / (1 + math.exp(-z)))


def test_language_scores_by_hand(spark):
    rows = [(1, "ab abc", "x"), (2, "ba cab", "y"), (3, "Aé", "x"), (4, None, "x"), (5, "zz", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language_id.train_language_model(docs, buckets=1 << 16, smoothing=0.5)
    counts = {"x": collections.Counter(), "y": collections.Counter()}

    def grams(text):
        text = (text or "").lower()
        return [text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)]

    for _, text, lang in rows:
        if lang and text:
            counts[lang].update(grams(text))
    for text in ("ab", "cab", "éa", "q"):
        logs = []
        for k, lang in enumerate(["x", "y"]):
            prior = math.log([2, 1][k] / 3)
            total = sum(counts[lang].values()) + 0.5 * (1 << 16)
            logs.append(prior + sum(math.log((counts[lang][g] + 0.5) / total) for g in grams(text)))
        assert language_id.log_likelihoods(pa.array([text]), model)[0].tolist() == pytest.approx(logs, abs=1e-3)


def test_many_languages_share_fewer_buckets(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MATRIX_BYTES", 1 << 16)
    rows = [(i, f"{chr(0x4E00 + i)} {chr(0x4E00 + i)}x", f"l{i:03d}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language_id.train_language_model(docs)
    assert len(model.weights) == 1024 and [r.lang_pred for r in docs.select(language_id.language(docs, model).alias("f")).select("f.*").collect()] == [r[2] for r in rows]


def test_filters_of_the_pipeline_on_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20, 50)], "doc_id long, quality int")
    for stage in (language_id.in_known_language, lambda d: quality_classifier.of_good_quality(d, labels)):
        assert stage(empty).count() == 0
        kept = stage(odd.withColumnRenamed("k", "__score") if "k" in odd.columns else odd)
        assert set(kept.columns) >= {"doc_id", "text", "lang"} and kept.count() <= odd.count()
    assert language_id.in_known_language(odd).where("text IS NULL").count() == 0


def test_preferences_keep_other_columns_and_replace_their_own(spark):
    turn = [("user", "hi"), ("assistant", "yes")]
    rows = [(1, turn, [("user", "hi"), ("assistant", "x" * 5000)], "p", 9, "kept"), (2, None, turn, "p", 9, "kept"), (3, [(None, None)], [], "p", 9, "kept")]
    kind = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame(rows, f"id int, chosen {kind}, rejected {kind}, prompt string, n_common int, other string")
    made = {r.id: r for r in preferences.format_preferences(pairs).collect()}
    columns = preferences.format_preferences(pairs).columns
    assert len(columns) == len(set(columns)) and all(r.other == "kept" for r in made.values())
    assert (made[1].n_common, made[1].prompt) == (1, "<|user|>\nhi<|end|>\n") and len(made[1].rejected_completion) > 5000
    assert (made[2].n_common, made[2].prompt, made[2].chosen_completion) == (0, "", "")
    assert made[3].chosen_completion == "<||>\n<|end|>\n" and preferences.format_preferences(pairs.limit(0)).count() == 0


def test_fingerprints_of_edits(odd, empty):
    found = fingerprints.fingerprint_edits(odd).collect()
    assert fingerprints.fingerprint_edits(empty).collect() == []
    rows = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: -r[0] if r[0] is not None else math.inf)
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(r[0] for r in rows)
    edits = {(r.doc_id, r.n_chars, r.edited_sha256) for r in found}
    alone = [k for k, r in enumerate(rows) if sum(x[0] == r[0] for x in rows) == 1]
    for k in alone:
        if rows[(k + 1) % len(rows)][0] is not None and sum(x[0] == rows[(k + 1) % len(rows)][0] for x in rows) == 1:
            (doc_id, text), after = rows[k], rows[(k + 1) % len(rows)][1]
            edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
            assert (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()) in edits
    by_text = collections.defaultdict(set)
    for r in found:
        by_text[next(t for i, t in rows if i == r.doc_id and len(t) == r.n_chars)].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


# 2, 6, 8: classifiers


def test_quality_is_learned(spark, odd, empty):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    found = quality_classifier.predict_quality(docs, labels).join(labels, "doc_id").where("held_out")
    assert found.where("quality = predicted").count() >= 0.95 * found.count() > 0
    few = quality_classifier.predict_quality(odd, labels)
    assert few.count() == odd.count() and few.where("score BETWEEN 0 AND 1").count() == odd.count()
    assert quality_classifier.predict_quality(empty, labels).count() == 0
    assert quality_classifier.predict_quality(odd, labels.limit(0)).where("score <> 0.5").count() == 0


def test_languages_are_learned(spark, odd, empty):
    docs = table(spark, "documents")
    found = language_id.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count() > 0
    few = {(r.doc_id, r.lang_pred) for r in language_id.predict_languages(odd).collect()}
    assert {(0, "und"), (1, "und"), (2, "und")} <= few and all(lang in ("en", "de") for i, lang in few if i not in (0, 1, 2))
    assert language_id.predict_languages(empty).count() == 0


def test_toxicity_is_learned(spark, odd, empty):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    found = toxicity.predict_toxicity(docs, labels).join(labels, "doc_id").where("held_out AND toxic = 0")
    assert found.where("predicted = 0").count() >= 0.97 * found.count() > 0
    assert toxicity.predict_toxicity(odd, labels).where("score BETWEEN 0 AND 1").count() == odd.count()
    assert toxicity.predict_toxicity(empty, labels).count() == 0


def test_toxic_rows_are_found_with_few_labels_too(spark):
    planted = {"worthless", "scum", "disgusting", "moron", "trash", "stupid", "loser", "idiot", "clown", "pathetic"}
    for sf, terms, recall in ((SMALL, 7, 0.4), (MEDIUM, 10, 0.75)):
        docs, labels = table(spark, "documents", sf), table(spark, "labels", sf)
        out = toxicity.remainder_of_id("doc_id", 3) == 1
        rows = toxicity.labels_of(docs.where(~out), labels.where(~out), "toxic")
        assert len(planted & set(toxicity.mine_lexicon(rows))) >= terms
        found = toxicity.predict_toxicity(docs, labels).join(labels, "doc_id").where("held_out AND toxic = 1")
        assert found.where("predicted = 1").count() >= recall * found.count() > 0


def test_lexicon_has_no_limit_of_terms(spark):
    marks = [f"w{k:04}" for k in range(600)]
    rows = [(1, " ".join(f"c{k}{i} {m}" for i, m in enumerate(marks))) for k in range(12)] + [(0, f"plain{k} text") for k in range(12)]
    assert set(marks) <= set(toxicity.mine_lexicon(spark.createDataFrame(rows, "label int, text string")))


def test_terms_are_found_beside_punctuation_and_misspelled():
    model = toxicity.ToxicityModel(["idiot", "moron", "scum"], np.ones((3, 3)))
    texts = pa.array(["moron/idiot", "x you,idiot", "a scvm", "idi*t", "the 'u-moron' (moron's)", "a-b c/d"])
    hits = toxicity._hits(next(iter(toxicity.chunks(texts))), toxicity._automaton(model.terms))
    found = list(zip(hits["text"].tolist(), hits["term"].tolist(), hits["edits"].tolist()))
    assert found == [(0, 1, 0), (0, 0, 0), (1, 0, 0), (2, 2, 1), (3, 0, 1), (4, 1, 0), (4, 1, 0)]
    assert hits["directed"].tolist()[2]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    terms = ["rat", "idiot", "pathetic", "worthless", "übel"]
    tries = [*terms, "rats", "idi0t", "idot", "idiots", "xidiots", "pathetc", "pathetics", "worthles", "wrthles", "wortles", "wrthls", "übl", "", "中"]
    allowed = {t: sum(len(t) >= n for n in toxicity.LENGTHS) - 1 for t in terms}
    points = np.frombuffer("".join(tries).encode("utf-32-le"), "<u4")
    end = np.cumsum([len(t) for t in tries])
    hits, term, count = toxicity.LexiconAutomaton(terms).scan(points, end - [len(t) for t in tries], end)
    found = {tries[h]: (terms[t], e) for h, t, e in zip(hits.tolist(), term.tolist(), count.tolist())}
    for word in tries:
        best = [(edits(word, t), t) for t in terms if edits(word, t) <= allowed[t]]
        assert (word in found) == bool(best) and (not best or found[word][1] == min(best)[0])


def test_quotations_are_told_from_abuse():
    model = toxicity.ToxicityModel(["idiot"], np.ones((1, 3)))
    texts = pa.array(['you idiot', 'the word "idiot" here', "he said idiot", "«idiot» a", "a\nidiot"])
    chunk = next(iter(toxicity.chunks(texts)))
    hits = toxicity._hits(chunk, toxicity._automaton(model.terms))
    assert hits["quoted"].tolist() == [False, True, True, True, False]
    assert hits["directed"].tolist() == [True, False, False, False, False]


# 3: packing


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = tokens.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    cut = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", " it's<|endoftext|>'s \n<|endoftext|>", "<|endoftext", "", "中<|endoftext|>é"]
    encoder = tokens.encoder(VOCABULARY)
    (chunk,) = tokens.chunks(pa.array(cut))
    ids, bounds, hashes, pieces = encoder.encode_texts(chunk, special)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in plain.encode_batch(cut, add_special_tokens=False)]
    assert ids[0] == 50256 and len(hashes) == pieces[-1]
    plain.encode_special_tokens = True
    texts = [r[1] or "" for r in odd_rows()] + ["it's", "'s", "''s I'll've", " 's 'S", "\n's \n\n  a", "<|endoftext|>", "a　b 12½"]
    assert [x.tolist() for x in tokens.encode_all(pa.array(texts), VOCABULARY)] == [
        e.ids for e in plain.encode_batch(texts, add_special_tokens=False)
    ]


@pytest.mark.parametrize("window", [16, 1024])
def test_every_id_lies_in_one_piece(odd, empty, window):
    assert packing.pack_documents(empty, VOCABULARY).count() == 0
    pieces = packing.pack_documents(odd, VOCABULARY, window).collect()
    sequences = collections.defaultdict(list)
    whole = collections.Counter()
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id] += p.length
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= window
    ids = {k: x for k, x in zip([r[0] for r in odd_rows()], tokens.encode_all(pa.array([r[1] for r in odd_rows()]), VOCABULARY))}
    expected = collections.Counter()
    for row, own in zip(odd_rows(), tokens.encode_all(pa.array([r[1] for r in odd_rows()]), VOCABULARY)):
        expected[row[0]] += len(own) + 1
    assert whole == expected
    for p in pieces:
        if p.doc_id is not None and p.doc_id != 7:
            own = np.append(ids[p.doc_id], 0)[p.start : p.start + p.length].astype("<u4")
            assert p.ids_crc32 == zlib.crc32(own.tobytes()) and p.doc_tokens == len(ids[p.doc_id]) + 1


def test_neighbours_against_plain_bm25():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 40, rng.integers(5, 30)).astype("<u2") for _ in range(30)]
    weight = rng.random(50)
    index = packing.ShardIndex(docs, packing.TermStatistics(weight, 15.0))

    def bm25(terms, doc):
        total = 0.0
        for t in terms:
            tf = int((doc == t).sum())
            total += weight[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(doc) / 15.0))
        return total

    unused = np.ones(len(docs), bool)
    unused[[0, 4]] = False
    for seed in range(len(docs)):
        terms = np.unique(docs[seed])
        plain = [(-bm25(terms, d), k) for k, d in enumerate(docs) if unused[k] and bm25(terms, d) > 0]
        if len(terms) <= packing.QUERY_TERMS:
            got = index.neighbours(seed, unused).tolist()
            assert np.allclose([bm25(terms, docs[k]) for k in got], [-s for s, _ in sorted(plain)])


def test_document_frequencies_count_every_document(spark):
    n = 30_000
    rows = spark.range(n).select(F.when(F.col("id") == 7, F.unhex(F.lit("0500"))).otherwise(F.unhex(F.lit("030003000400"))).alias("ids"))
    found = packing.term_statistics(rows, np.dtype("<u2"))
    seen = np.array([0, 0, 0, n - 1, n - 1, 1])
    assert np.allclose(found.weight, np.log1p((n - seen + 0.5) / (seen + 0.5)))
    assert found.mean_length == (3 * (n - 1) + 1) / n


# 4: rule cascade


def test_verdict_does_not_depend_on_the_order(odd, empty):
    ordered = rule_cascade.rejection_per_cost(odd, rows=50)
    assert {r.name for r, _, _ in ordered} == {r.name for r in rule_cascade.RULES}
    per_cost = [share / max(cost, 1e-12) for _, share, cost in ordered]
    assert per_cost == sorted(per_cost, reverse=True)
    judged = rule_cascade.judge_documents(odd, rows=50)
    assert judged.count() == odd.count() and judged.where("doc_id <= 2 AND (kept OR n_words > 0)").count() == 0
    named = rule_cascade.rule_cascade(odd, tuple(reversed(rule_cascade.RULES)), rows=50)
    assert named.where("rejected_by IS NULL").count() == judged.where("kept").count()
    assert rule_cascade.judge_documents(empty).count() == 0


def test_rejected_texts_are_asked_nothing_more(spark):
    docs = table(spark, "documents")
    ordered = [rule for rule, share, _ in rule_cascade.rejection_per_cost(docs) if rule.name != "trap"]
    place = {rule.name: k for k, rule in enumerate(ordered)}
    named = rule_cascade.rule_cascade(docs).groupBy("rejected_by").count().collect()
    asked = sum(r["count"] * (place[r.rejected_by] + 1 if r.rejected_by else len(ordered)) for r in named)
    assert asked < len(ordered) * docs.count()

    def caught(m):
        seen_before = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        return F.when(seen_before, F.raise_error(F.lit("asked again"))).otherwise(m["n_open_lines"] < 0).cast("boolean")

    trap = rule_cascade.Rule("trap", ("n_words", "n_repeat_words", "n_open_lines"), caught)
    base = [rule for rule in rule_cascade.RULES if rule.name in rule_cascade.BASE]
    verdict = rule_cascade.first_rejection([*base, trap], rule_cascade.measures("text"))
    short = docs.where("text IS NOT NULL").unionByName(docs.limit(3).withColumn("text", F.lit("too short")))
    assert short.select(verdict.alias("by")).where("by = 'few_words'").count() >= 3


def test_further_measures_by_hand(spark):
    texts = [None, "", "- a\n* b\nc", "1 2 é x3 --", "so...\nso ... \t\nno\n\u2026\n... x", "\u2022 one\r\n  - two\n\n", "end...\u2028"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    taken = rule_cascade.measures("text")
    names = ("n_letter_words", "n_bullet_lines", "n_open_lines")
    found = [tuple(r) for r in frame.select(*[taken[n].alias(n) for n in names]).collect()]
    assert found == [(0, 0, 0), (0, 0, 0), (3, 2, 0), (2, 0, 0), (4 + 1, 0, 3), (3, 2, 0), (1, 0, 0)]


# 5: mixing


def test_copies_follow_the_rates(spark, odd, empty):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("source"))
    mixed = mixing.mix_sources(docs, {"big": 0.5, "small": 0.5})
    sizes = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert all(abs(n - 10000) < 400 for n in sizes.values())
    assert bag(mixed.collect()) == bag(mixing.mix_sources(docs.repartition(5), {"big": 0.5, "small": 0.5}).collect())
    fast = docs.limit(50).withColumn("n", mixing.poisson_count(F.lit(1200.0), F.col("doc_id").cast("string")))
    assert abs(fast.agg(F.avg("n")).first()[0] - 1200) < 30
    assert mixing.mix_sources(empty).count() == 0 and "key" in mixing.mix_sources(odd).columns
    assert mixing.mix_sources(odd, {None: 1.0}).where("source IS NOT NULL").count() == 0


# 7: preferences


def test_common_prefix_is_rendered_once(spark):
    turn = lambda role, text: {"role": role, "text": text}
    pairs = [
        (1, [turn("user", "hi"), turn("assistant", "yes")], [turn("user", "hi"), turn("assistant", "no é"), turn("user", None)]),
        (2, [], None), (3, [turn("user", "a")], [turn("user", "a")]), (4, [turn("user", "a")], [turn("user", "a"), turn("assistant", "b")]),
    ]
    rows = {r.id: r for r in preferences.format_preferences(spark.createDataFrame(pairs, f"id int, chosen {preferences.TURN}, rejected {preferences.TURN}")).collect()}
    assert [rows[k].n_common for k in (1, 2, 3, 4)] == [1, 0, 1, 1]
    assert rows[1].prompt == "<|user|>\nhi<|end|>\n" and rows[1].chosen_completion == "<|assistant|>\nyes<|end|>\n"
    start, stop = rows[1].rejected_spans[0]
    assert len(rows[1].rejected_spans) == 1 and rows[1].rejected_completion[start:stop] == "no é<|end|>"
    assert (rows[2].prompt, rows[2].chosen_completion, rows[3].rejected_completion, rows[4].chosen_completion) == ("", "", "", "")


def test_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string, turns string"
    rows = [(1, 0, "user", "q", "x"), (1, 1, "assistant", None, "x"), (1, 1, "assistant", None, "x"), (None, 0, "user", "q", "x"), (2, None, None, None, "x")]
    made = preferences.format_preferences(preferences.replies_of_others(spark.createDataFrame(rows, schema))).collect()
    assert {r.conv_id for r in made} == {1, 2}
    assert preferences.format_preferences(preferences.replies_of_others(spark.createDataFrame([], schema))).count() == 0


# 9: SimHash


def plain_simhash(text, width=4):
    w = words(lowered(text))
    shingles = [" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, distance):
    own = np.array(fps, np.uint64)
    group = list(range(len(own)))
    for k in range(len(own)):
        for other in np.flatnonzero(np.bitwise_count(own ^ own[k]) <= distance).tolist():
            a, b = group[k], group[other]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {g: min((i for i, h in zip(ids, group) if h == g and i is not None), default=None) for g in set(group)}
    return [least[g] for g in group]


def test_groups_against_all_pairs(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents", SMALL).collect()] + [(r[0], r[1]) for r in odd_rows()]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, fp string").repartition(4)
    fps = [plain_simhash(t) for _, t in docs]
    expected = bag((i, f"{fp:016x}", c) for (i, _), fp, c in zip(docs, fps, plain_components(fps, [i for i, _ in docs], 4)))
    found = simhash.simhash_groups(frame).select("doc_id", simhash.as_hex("fp"), "component_id")
    assert bag(found.collect()) == expected
    kept = simhash.one_of_each_group(odd)
    own = [plain_simhash(r[1]) for r in odd_rows()]
    assert kept.columns == odd.columns and kept.count() == len(set(plain_components(own, list(range(len(own))), 4)))
    assert simhash.simhash_groups(empty).count() == 0 and simhash.one_of_each_group(empty).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_ring_loses_no_link(spark, distance):
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 2**64, 12, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(40):
            for bit in rng.integers(0, 64, rng.integers(1, 9)).tolist():
                c ^= 1 << bit
            fps.add(c)
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    found = dict(simhash.near_components(spark.createDataFrame([(x,) for x in signed], "fp long"), distance).collect())
    expected = plain_components(np.array(signed, np.int64).view(np.uint64), signed, distance)
    assert [found.get(x, x) for x in signed] == expected


@pytest.mark.parametrize("distance", [1, 3, 4])
def test_full_buckets_lose_no_link(spark, distance):
    """All fingerprints agree on most segments, so every bucket holds groups that must meet each other."""
    rng = np.random.default_rng(10 + distance)
    fixed, free = int(rng.integers(0, 2**63)), (1 << 22) - 1
    spread = [fixed & ~(free << 20) | (int(x) << 20) for x in rng.integers(0, 1 << 22, 1500)]
    fps = set(spread)
    for c in spread[:300]:
        for bit in rng.integers(0, 64, distance).tolist():
            fps.add(c ^ (1 << bit))
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    found = dict(simhash.near_components(spark.createDataFrame([(x,) for x in signed], "fp long"), distance).collect())
    expected = plain_components(np.array(signed, np.int64).view(np.uint64), signed, distance)
    assert [found.get(x, x) for x in signed] == expected


def test_every_linked_pair_meets_in_a_part_of_a_bucket():
    """Each pair within the distance shares a key and one of the key's cuts; unlike pairs of a key mostly share none."""
    rng = np.random.default_rng(5)
    mask = (1 << 64) - 1
    keys = list(zip([m for _, m in simhash._patterns(4)], simhash._cuts(4)))
    for _ in range(3000):
        differ = sum(1 << b for b in set(rng.integers(0, 64, rng.integers(1, 5)).tolist()))
        assert any(differ & m == 0 and any(differ & (c & mask) == 0 for c in cuts) for m, cuts in keys)
    apart = rng.integers(0, 2**64, 4000, dtype=np.uint64).tolist()
    meet = sum(any(x & ~m & (c & mask) == 0 for c in cuts) for x in apart for m, cuts in keys[:5])
    assert meet < 0.06 * 5 * len(apart)


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)]
    links = [*chain, (100, 101), (100, 102), (103, 100), (5, 5), (200, 200), (None, 3), (101, 100)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 104)}, 200: 200}


# 10: class language model


def test_base_score_is_exact(odd, empty):
    rows = [(r[0], r[1]) for r in odd_rows()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = collections.Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            counts.update([*words(lowered(text)), None])
    n, v = sum(counts.values()), len(counts)
    expected = collections.Counter()
    for (i, text), out in zip(rows, held):
        own = [*words(lowered(text)), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        expected[(i, out, len(own), sum(counts[w] > 0 for w in own), n, round(base, 4))] += 1
    for settings in ({}, {"clustered": 4, "classes": 2, "broadcast_words": 8}):
        found = class_lm.score_texts(odd, **settings).collect()
        assert bag((*r[:5], round(r.base_score, 4)) for r in found) == expected
        assert all(r.score < 0 for r in found)
    assert class_lm.score_texts(empty).count() == 0


def test_class_model_is_a_distribution_and_better_than_the_base(spark):
    found = class_lm.score_texts(table(spark, "documents")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def training_texts(frame):
    return frame.where(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(True))).select(F.coalesce("text", F.lit("")).alias("text"))


def hash_of(word):
    chunk = next(class_lm.chunks(pa.array([word])))
    return int(class_lm._lowered(chunk)[1][0])


def test_class_scores_by_hand(odd):
    texts = training_texts(odd)
    model = class_lm.train_class_model(texts, class_lm.word_counts(texts))
    plain = [words(lowered(r.text)) for r in texts.collect()]
    counts = collections.Counter(w for own in plain for w in own)
    known = dict(zip(model.hashes.tolist(), model.classes.tolist()))
    of = {w: known.get(hash_of(w), 1) if n >= 3 else 1 for w, n in counts.items()}
    assert all(of[w] > 1 for w, n in counts.items() if n >= 3)
    steps = collections.Counter(step for own in plain for path in [[0, *[of[w] for w in own], 0]] for step in zip(path, path[1:]))
    width = len(model.transitions)
    size, after, inside = collections.Counter(), collections.Counter(), collections.Counter()
    for (a, b), n in steps.items():
        after[a] += n
        size[b] += n
    for w, n in counts.items():
        inside[of[w]] += n
    share = [(size[b] + 0.1) / (sum(size.values()) + 0.1 * width) for b in range(width)]
    assert np.allclose((10**model.transitions).sum(axis=1), 1)

    def log_p(text):
        own = words(lowered(text))
        path = [0, *[of.get(w, 1) for w in own], 0]
        total = sum(math.log10((steps[a, b] + 0.1 * width * share[b]) / (after[a] + 0.1 * width)) for a, b in zip(path, path[1:]))
        for w in own:
            if of.get(w, 1) > 1:
                total += math.log10(counts[w] / inside[of[w]])
            elif w in counts:
                total += math.log10((counts[w] - 0.5) / inside[1])
            else:
                total += math.log10(0.5 * sum(c == 1 for c in of.values()) / inside[1])
        return total

    found = bag((r.doc_id, round(r.score, 5)) for r in class_lm.score_texts(odd).collect())
    assert found == bag((r[0], round(log_p(r[1]), 5)) for r in odd_rows())


def test_neighbours_are_all_pairs_of_tokens(odd):
    texts = training_texts(odd)
    plain = [words(lowered(r.text)) for r in texts.collect()]
    vocabulary = [w for w, n in collections.Counter(w for own in plain for w in own).items() if n >= 3]
    hashes = sorted(hash_of(w) for w in vocabulary)
    ids = {w: hashes.index(hash_of(w)) for w in vocabulary}
    rest, end = len(ids), len(ids) + 1
    expected = collections.Counter()
    for own in plain:
        path = [end, *[ids.get(w, rest) for w in own], end]
        expected.update(zip(path, path[1:]))
    pairs = class_lm.pair_counts(texts, np.array(hashes), np.arange(len(hashes), dtype=np.int32))
    rows = class_lm.neighbours_by_word(pairs, 5).collect()
    assert len({r.word for r in rows}) == len(rows)
    both = collections.Counter(), collections.Counter()
    for r in rows:
        for b, n in zip(np.frombuffer(r.after, np.int32).tolist(), np.frombuffer(r.after_n, np.int64).tolist()):
            both[0][r.word, b] += n
        for a, n in zip(np.frombuffer(r.before, np.int32).tolist(), np.frombuffer(r.before_n, np.int64).tolist()):
            both[1][a, r.word] += n
    assert both == (expected, expected)


def test_gains_against_counting_anew():
    rng = np.random.default_rng(11)
    pairs = rng.integers(0, 4, (12, 12)).astype(float)
    own = np.append(rng.integers(2, 5, 10), [1, 0])

    def fold(of):
        member = np.eye(5)[of]
        return member.T @ pairs @ member

    table = fold(own)
    member = np.eye(5)[own]
    word = np.arange(10)
    itself = np.diagonal(pairs)[:10].copy()
    after, before = (pairs @ member)[:10], (pairs.T @ member)[:10]
    after[word, own[:10]] -= itself
    before[word, own[:10]] -= itself
    found = class_lm.gains(after, before, itself, own[:10], table)
    for w in word:
        for b in range(2, 5):
            moved = own.copy()
            moved[w] = b
            change = class_lm.likelihood(fold(moved)) - class_lm.likelihood(table)
            assert np.isclose(found[w, b] - found[w, own[w]], change)


def test_words_beyond_the_seeds_are_exchanged_in_tasks(spark):
    rng = np.random.default_rng(13)
    rows = [" ".join(f"{'ab'[(k + start) % 2]}{rng.integers(20)}" for k in range(400)) for start in (0, 1, 0, 1, 0, 1, 0, 1)]
    texts = spark.createDataFrame([(t,) for t in rows], "text string")
    counts = class_lm.word_counts(texts)
    model = class_lm.train_class_model(texts, counts, classes=2, seeds=4)
    classes = [{model.classes[np.searchsorted(model.hashes, hash_of(f"{kind}{k}"))] for k in range(20)} for kind in "ab"]
    assert len(classes[0]) == len(classes[1]) == 1 and classes[0] != classes[1]


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(5)
    kinds = np.arange(40) % 2
    pairs = np.zeros((42, 42))
    for _ in range(6000):
        a = rng.integers(40)
        pairs[a, rng.choice(np.flatnonzero(kinds != kinds[a]))] += 1
    found = class_lm.exchange_clusters(pairs, 2)
    assert len(set(found[kinds == 0])) == len(set(found[kinds == 1])) == 1 and found[0] != found[1]


# the pipeline


def test_pipeline_stages(spark, odd):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_classifier", "simhash_dedup", "poisson_mix", "retrieval_packing"]
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == odd.columns
    pieces = corpus_pipeline.run(spark, SMALL)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0 < pieces.count()
