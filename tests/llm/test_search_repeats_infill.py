"""Ranked search, substring dedup and fill-in-the-middle against SQL, brute force and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES, SCHEMA, SMALL, odd_rows
from ticketmill.llm import infill, search, substring
from ticketmill.llm.fm_index import FMIndex, WaveletMatrix
from ticketmill.llm.oracles import ORACLES
from verification.compare import connect, duckdb_rows, spark_rows

ITEMS = [(1, "alma bevex corto"), (2, "alma alma alma elsó"), (3, None), (4, ""), (5, "nothingofthis"), (6, "Corvex DUNRI, dunri; 中文"),
         (None, "one two"), (8, "one one"), (9, "el中 " * 3000)]


def duck(rows, items=ITEMS):
    con = duckdb.connect()
    table = pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "text"])
    con.register("documents", table)
    asked = pa.table([pa.array([i for i, _ in items], pa.int64()), pa.array([t for _, t in items], pa.string())], ["item_id", "text"])
    con.register("benchmark", asked)
    return con


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# 11: ranked search


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 3, "x") for i, t in ITEMS], "item_id long, text string, query int, score string")


def test_search_of_odd_rows_is_that_of_sql(spark, odd, items):
    assert spark_rows(search.search(odd, items)) == duckdb_rows(duck(odd_rows()), ORACLES["op11_ranked_search"])


def test_search_in_small_shards_and_blocks(spark, odd, items, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 20)
    index = search._indexer(search._queries([t for _, t in ITEMS]).terms)
    monkeypatch.setattr(search, "SHARD_DOCUMENTS", 1)
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, None, 3], pa.int64()), "text": pa.array(["alma", None, "one two"])})
    assert sum(len(b) for b in index(iter([batch]))) == 1
    assert spark_rows(search.search(odd, items)) == duckdb_rows(duck(odd_rows()), ORACLES["op11_ranked_search"])


def test_search_of_empty_tables(spark, odd, empty, items):
    assert search.search(empty, items).collect() == []
    found = search.search(odd, items.limit(0))
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("seed", range(6))
def test_skipping_finds_the_best_and_scores_fewer(seed):
    pick = np.random.default_rng(seed)
    n, k = 20_000, 20
    lists, total = [], np.zeros(n, np.int64)
    for size, top in ((5, 900), (40, 700), (3000, 30), (9000, 12), (15000, 3), (18000, 2)):
        docs = np.sort(pick.choice(n, size, replace=False))
        parts = pick.integers(1, top + 1, size)
        lists.append(search.List(docs, parts, int(parts.max())))
        total[docs] += parts
    best = search._nothing(k)
    scored = search.search_lists(lists, n, 100, best, np.arange(n), np.ones(n, bool))
    order = np.lexsort((np.arange(n), -total))[:k]
    assert best.id.tolist() == order.tolist() and best.score.tolist() == total[order].tolist()
    assert scored < (total > 0).sum() / 4


def test_accumulators_are_one_bounded_list():
    a = search.List(np.array([1, 5]), np.array([2, 3]), 3)
    b = search.List(np.array([5, 9]), np.array([4, 1]), 4)
    (both,) = search.accumulate([a, b])
    assert both.docs.tolist() == [1, 5, 9] and both.parts.tolist() == [2, 7, 1] and both.bound == 7


# 12: substring dedup


def by_hand(rows, window=13):
    first = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if doc_id is not None:
                first[g] = min(first.get(g, doc_id), doc_id)
    found = []
    for doc_id, text, *_ in rows:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            least = first.get(tuple(w[i : i + window]))
            if least is not None and (doc_id is None or least < doc_id):
                gone.update(range(i, i + window))
        found.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(found, key=str)


def removed(df):
    n = lambda spans: sum(s["stop"] - s["start"] for s in spans)
    return sorted(((r.doc_id, r.n_words, n(r.removed), r.kept) for r in df.collect()), key=str)


def test_repeats_of_odd_rows(odd):
    assert removed(substring.drop_repeated(odd)) == by_hand(odd_rows())


def test_repeats_of_short_and_overlapping_passages(spark):
    pick = random.Random(3)
    base = [f"w{pick.randint(0, 400)}" for _ in range(400)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(pick.randint(0, 6)):
            a = pick.randint(0, 380)
            parts += base[a : a + pick.randint(8, 30)] + [f"x{pick.randint(0, 10**6)}"] * pick.randint(0, 3)
        rows.append((i if i % 9 else 7, " ".join(parts) if i % 11 else None, None, None, 1, *CLASHES))
    rows += [(500, "la la la " * 40, None, None, 1, *CLASHES), (501, "la " * 14, None, None, 1, *CLASHES), (499, "la " * 12, None, None, 1, *CLASHES)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for window in (13, 5):
        assert removed(substring.drop_repeated(docs, window=window)) == by_hand(rows, window)


def test_repeats_in_small_shards_with_common_grams(spark, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 1)
    monkeypatch.setattr(substring, "COMMON_IN", 2)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"a{i} {passage} b{i} c{i}" + " the end of it all" * (i % 3), None, None, 1, *CLASHES) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert removed(substring.drop_repeated(docs)) == by_hand(rows)


def test_spans_are_the_removed_words(odd):
    for r in substring.drop_repeated(odd).where("doc_id >= 7").collect():
        assert all(0 <= s["start"] < s["stop"] <= r.n_words for s in r.removed)
        assert len(words(r.kept)) + sum(s["stop"] - s["start"] for s in r.removed) == r.n_words


def test_repeats_of_an_empty_table(empty):
    found = substring.drop_repeated(empty)
    assert found.collect() == [] and found.columns == ["doc_id", "n_words", "removed", "kept"]


def test_wavelet_matrix_counts():
    pick = np.random.default_rng(1)
    symbols = pick.integers(0, 37, 5000)
    matrix = WaveletMatrix(symbols, 37)
    symbol, at = pick.integers(0, 37, 300), pick.integers(0, 5001, 300)
    assert matrix.rank(symbol, at).tolist() == [int((symbols[:a] == s).sum()) for s, a in zip(symbol, at)]


@pytest.mark.parametrize("most", [3, 13])
def test_matching_statistics_of_other_texts(most):
    pick = random.Random(most)
    held = [[pick.randint(1, 4) for _ in range(pick.randint(1, 40))] for _ in range(30)]
    asked = [[pick.randint(1, 5) for _ in range(pick.randint(0, 30))] for _ in range(25)]
    flat = np.array([s for h in held for s in [*h, 0]])
    index = FMIndex(flat, 5)
    stream = np.array([s if s < 5 else 0 for a in asked for s in a])
    bounds = np.cumsum([0] + [len(a) for a in asked])
    length, row = index.matching_statistics(stream, bounds, most)
    grams = {tuple(h[i : i + n]) for h in held for n in range(1, most + 1) for i in range(len(h) - n + 1)}
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, b):
            own = tuple(stream[i:b].tolist())
            longest = max((n for n in range(1, most + 1) if own[:n] in grams and n <= len(own)), default=0)
            assert length[i] == longest
            if longest:
                at = index.order[row[i]]
                assert tuple(flat[at : at + longest].tolist()) == own[:longest]


# 13: fill in the middle


def formed(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(text), "plain", None, None, text)
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return (doc_id, len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_forms_by_hand_and_back(spark, odd):
    pick = random.Random(5)
    odd_parts = ["<", "<P", "P>", ">", "S", "M>", "<M", "é", "中", "𝄞", " ", "a"]
    rows = [(1000 + i, "".join(pick.choice(odd_parts) for _ in range(pick.randint(0, 12))), "en", "s", 1, *CLASHES) for i in range(400)]
    docs = odd.unionByName(spark.createDataFrame(rows, SCHEMA))
    made = infill.infill(docs).withColumn("back", infill.restore("output", "form")).collect()
    every = [*odd_rows(), *rows]
    assert sorted((tuple(r)[:6] for r in made), key=str) == sorted((formed(r[0], r[1]) for r in every), key=str)
    assert sorted(((r.doc_id, r.back) for r in made), key=str) == sorted(((r[0], r[1] or "") for r in every), key=str)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_forms_of_an_empty_table_and_of_nulls(spark, empty):
    assert infill.infill(empty).collect() == []
    back = spark.createDataFrame([(None, None), ("text", None)], "o string, f string").select(infill.restore("o", "f").alias("t"))
    assert [r.t for r in back.collect()] == ["", "text"]


def test_all_are_plain_or_none(odd):
    assert {r.form for r in infill.infill(odd, plain_percent=100).select("form").distinct().collect()} == {"plain"}
    forms = infill.infill(odd.where("length(text) > 0"), plain_percent=0, spm_percent=100).select("form").distinct().collect()
    assert {r.form for r in forms} == {"spm"}


def test_queries_read_whole_tables(spark):
    from ticketmill.llm.queries import QUERIES

    for name in ("op12_substring_dedup", "op13_infill"):
        found = QUERIES[name](spark, SMALL)
        assert found.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert spark_rows(QUERIES["op11_ranked_search"](spark, SMALL).where(F.lit(True))) == duckdb_rows(connect(SMALL), ORACLES["op11_ranked_search"])
