"""Periodic runs against a search of every period in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quayside.llm import periodic_runs as P
from quayside.llm import queries as Q
from tests.llm.conftest import SCHEMA, as_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_runs(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1) if j == i else j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(3)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 50, ["a", "b"] * 4, ["a", "b"] * 4 + ["a"], ["a", "b"] * 3]
    out += [(["a"] * 6 + ["b"]) * 6, ["b"] + ["a", "b", "a"] * 7 + ["b"], list("abaab" * 9 + "abaababaab")]
    for _ in range(60):
        out.append([rng.choice("ab") for _ in range(rng.randint(0, 60))])
    for _ in range(60):
        words = []
        while len(words) < 80:
            unit = [rng.choice("abcd") for _ in range(rng.randint(1, 7))]
            words += unit * rng.randint(1, 6) + unit[:rng.randint(0, len(unit))]
        out.append(words)
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    return out + [list(fib[-1]), list((fib[-2] * 5)[:900])]


def test_runs_of_a_block():
    texts = sequences()
    numbers = {}
    word = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    base = np.cumsum([0] + [len(t) for t in texts])
    got = [[] for _ in texts]
    for s, e, q in zip(*(x.tolist() for x in P.find_runs(word, owner))):
        got[owner[s]].append((s - int(base[owner[s]]), e - s, q))
    assert got == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("least,exponent", [(2, 2), (9, 3), (4, 2), (30, 4)])
def test_other_limits(least, exponent):
    for words in sequences()[::3]:
        word = np.array([ord(w[0]) for w in words], dtype=np.int64)
        got = P.find_runs(word, np.zeros(len(words), dtype=np.int64), least, exponent)
        assert [(s, e - s, q) for s, e, q in zip(*(x.tolist() for x in got))] == brute_runs(words, least, exponent)


def test_tests_of_suffixes_stay_few_on_one_word():
    word = np.zeros(200_000, dtype=np.int64)
    assert [x.tolist() for x in P.find_runs(word, word)] == [[0], [200_000], [1]]


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_equals_brute_force(spark, odd_rows, tmp_path):
    rng = random.Random(8)
    rows = odd_rows + [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(1, 120))), "en", "s", 0)
                       for i in range(100, 260)]
    rows += [(7, "a " * 9, None, None, 0), (7, "a " * 9, None, None, 0), (None, "x y " * 8, "en", "s", 0)]
    folder = as_table(spark, tmp_path, spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = sorted(map(tuple, Q.op11_branching_tandems(spark, folder).collect()), key=str)
    want, edited = [], 0
    for doc_id, text, *_ in rows:
        words = planted(doc_id, text)
        edited += words != WORD.findall(text or "")
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                     sha(brute_collapse(words, runs))))
    assert edited > 5
    assert got == sorted(want, key=str)


def test_other_columns_and_no_rows(spark, nothing):
    assert P.periodic_runs(nothing).count() == 0
    df = spark.createDataFrame([(5, "go " * 7 + "on", "x", [1])], "id long, body string, text string, runs array<int>")
    row = P.periodic_runs(df, "id", "body").first()
    assert (row.doc_id, row.n_words, row.text) == (5, 8, "go on")
    assert [tuple(r) for r in row.runs] == [(0, 7, 1)] and tuple(row.strongest) == (0, 7, 1)


def test_one_long_text(spark):
    words = [f"w{i % 1000}" for i in range(6000)] + [f"u{i}" for i in range(200_000)] + ["z"] * 50
    row = P.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 6000, 1000), (206_000, 50, 1)]
    assert row.text == " ".join(words[:1000] + words[6000:206_001])
