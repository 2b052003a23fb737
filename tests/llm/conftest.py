from __future__ import annotations

import random

import pytest

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, fp long, root string, word int, copy string, label string"
CLASHES = ("k", 7, "r", 1, "c", "l")


def odd_rows():
    """Nulls in any column, empty, blank and long texts, repeated rows and ids, copies and near copies."""
    pick = random.Random(7)
    vocabulary = [f"{a}{b}" for a in ("al", "be", "cor", "dun", "el") for b in ("ma", "ri", "to", "vex", "só", "中")]

    def prose(n, seed):
        return " ".join(random.Random(seed).choice(vocabulary) for _ in range(n))

    copy = prose(80, 1)
    words = copy.split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    texts = [None, "", "  \n\t ", "one", "one two three", "x" * 5000, prose(20000, 2), copy, copy, near, "Ünïcode 中文 ’s it's\n\nit's"]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (7, prose(30, 3), "de", "s0", 1), (None, copy, None, None, None), (None, prose(60, 4), "en", "s1", 2)]
    rows += [(20 + i, prose(pick.randint(1, 90), 100 + i), pick.choice(["en", "de"]), "hot", 3) for i in range(40)]
    return [(*row, *CLASHES) for row in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
