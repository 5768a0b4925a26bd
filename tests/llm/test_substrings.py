"""Substring deduplication and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import fingerprints, phrases, suffix_dedup
from quayside.llm import kernel as K
from quayside.llm import queries as Q
from tests.llm.conftest import SCHEMA, as_table, make_text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def passages(odd_rows):
    """Texts that share passages of many lengths, with themselves too, around every limit."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(3000)] + ["é", "日本", "naïve"]
    fresh = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [fresh(n) for n in (12, 13, 14, 30, 60, 200)] + ["x" * 199, "y" * 200, "z" * 201, "ab" * 300]
    texts = [fresh(rng.randint(0, 40)) + " " + rng.choice(shared) + " " + fresh(rng.randint(0, 40))
             + rng.choice(["", " " + rng.choice(shared)]) for _ in range(60)]
    line = fresh(16)
    texts += [fresh(rng.randint(0, 9)) + " " + line + " " + fresh(rng.randint(0, 60)) for _ in range(40)]
    texts += [texts[0], texts[0], shared[5] + " " + shared[5], shared[3] * 7, "q" * 1000, "", None, line, "é" * 300]
    texts += [make_text(rng, 150)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(1000 + r[0], *r[1:]) for r in odd_rows]


def brute_bytes(rows, width=200):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = defaultdict(int)
    for _, raw in texts:
        for k in range(len(raw) - width + 1):
            seen[raw[k:k + width]] += 1
    out = {}
    for i, raw in texts:
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - width + 1):
            if seen[raw[k:k + width]] > 1:
                gone[k:k + width] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), int(gone.sum()), spans, sha(kept))
    return out


def brute_phrases(rows, width=13):
    texts = [(i, WORD.findall((t or "").encode())) for i, t, *_ in rows]
    least = {}
    for i, words in texts:
        for k in range(len(words) - width + 1):
            w = tuple(words[k:k + width])
            least[w] = min(least.get(w, i), i)
    out = {}
    for i, words in texts:
        gone = set()
        for k in range(len(words) - width + 1):
            if least[tuple(words[k:k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(words), len(gone), sha(b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


@pytest.mark.parametrize("limits", [{}, {"hot_passages": 3, "shard_passages": 20}])
def test_suffixes(spark, passages, nothing, limits):
    docs = spark.createDataFrame(passages, SCHEMA).withColumn("t", F.lit("clash")).repartition(6)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeated_substrings(docs, **limits).collect()}
    want = brute_bytes(passages)
    assert {i: (got[i], want[i]) for i in want if got.get(i) != want[i]} == {}
    if not limits:
        assert suffix_dedup.remove_repeated_substrings(nothing).count() == 0


def test_repeated_rows_are_copies(spark):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(500))
    rows = [(1, text, "en", "s", 0), (1, text, "en", "s", 0), (None, text[:300] + "Z" * 100, "en", "s", 0)]
    got = suffix_dedup.remove_repeated_substrings(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in got) == [(0, 300, 1), (1, 500, 1), (1, 500, 1)]


@pytest.mark.parametrize("seed", range(4))
def test_construction(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(6)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(3, 9))).encode() for _ in range(25)] + [b"a" * 250, b"c" * 200]
    texts = [t for t in texts if len(t) >= 200]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = suffix_dedup.repeated_windows(data, offsets)
    seen = defaultdict(int)
    for t in texts:
        for k in range(len(t) - 199):
            seen[t[k:k + 200]] += 1
    want = np.concatenate([[k <= len(t) - 200 and seen[t[k:k + 200]] > 1 for k in range(len(t))] for t in texts])
    assert (got == want).all()


def test_phrases(spark, passages, nothing):
    docs = spark.createDataFrame(passages, SCHEMA).withColumn("t", F.lit("clash")).repartition(6)
    got = {r.doc_id: tuple(r)[1:] for r in phrases.remove_repeated_phrases(docs).collect()}
    want = brute_phrases(passages)
    assert {i: (got[i], want[i]) for i in want if got.get(i) != want[i]} == {}
    assert phrases.remove_repeated_phrases(nothing).count() == 0


def test_phrases_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, "en", "s", 0), (5, text, "en", "s", 0), (5, text, "en", "s", 0), (7, "a " + text, "en", "s", 0)]
    got = phrases.remove_repeated_phrases(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (5, 0), (5, 0), (7, 20)]


def located_in(texts, ids):
    """``phrases.located`` on one block of texts, with every window as a phrase."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    _, _, text, hashes = phrases._words(data, offsets)
    window, place = K.grams(hashes, text, phrases.WINDOW)
    keys, group = np.unique(window, return_inverse=True)
    smallest = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(smallest, group, np.array(ids, dtype=np.int64)[text[place]])
    return phrases.located(data, offsets, np.array(ids, dtype=np.int64), keys.view(np.int64), smallest)


@pytest.mark.parametrize("first", [7, (1 << 31) - 1, 3_000_000_000, (1 << 33) + 5, -(1 << 33), -(1 << 31) - 2, (1 << 62) + 1])
def test_phrases_of_wide_ids(spark, first):
    shared = " ".join(f"w{i}" for i in range(20))
    texts = [f"{name} {shared} {name}" for name in "abc"]
    ids = [first, first + 1, first + 2]
    gone = located_in([t.encode() for t in texts], ids).reshape(3, 22)
    assert gone.sum(axis=1).tolist() == [0, 20, 20]
    rows = [(i, t, "en", "s", 0) for i, t in zip(ids, texts)]
    got = phrases.remove_repeated_phrases(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_phrases(rows)


@pytest.mark.parametrize("run", [700, 5000])
def test_phrases_across_runs(passages, monkeypatch, run):
    monkeypatch.setattr(phrases, "RUN_WORDS", run)
    texts = [" ".join(w.decode() for w in WORD.findall((t or "").encode())).encode() for _, t, *_ in passages]
    gone = located_in(texts, [i for i, *_ in passages])
    want, at = brute_phrases(passages), 0
    for (i, *_), text in zip(passages, texts):
        words = text.split(b" ") if text else []
        flags, at = gone[at:at + len(words)], at + len(words)
        assert (len(words), int(flags.sum()), sha(b" ".join(w for w, g in zip(words, flags) if not g))) == want[i], i
    assert at == len(gone)


def test_phrases_in_a_text_with_more_words_than_code_points():
    shared = [f"s{i}" for i in range(20)]
    long = [f"{i:x}" for i in range(1_250_000)]
    cut = 5 * phrases.RUN_WORDS
    long = long[:cut - 5] + shared + long[cut - 5:] + shared
    gone = located_in([" ".join(shared).encode(), " ".join(long).encode()], [1, 2])[len(shared):]
    where = np.flatnonzero(gone)
    assert where.tolist() == [*range(cut - 5, cut + 15), *range(len(long) - 20, len(long))]


def brute_edit(rows):
    order = sorted(rows, key=lambda r: r[0])
    out = {}
    for (i, t, *_), (_, nxt, *_) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        out[i] = (t, t[:len(t) - half] + nxt[:half], nxt)
    return out


def true_likeness(a, b):
    def shingles(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, passages, nothing, monkeypatch, tmp_path):
    monkeypatch.setattr(fingerprints, "RANGE", 16)
    monkeypatch.setattr(fingerprints, "SPAN", 3)
    got = {r.doc_id: r for r in Q.op7_scaled_sketches(
        spark, as_table(spark, tmp_path, spark.createDataFrame(passages, SCHEMA).repartition(4))).collect()}
    want = brute_edit(passages)
    prints = defaultdict(set)
    errors = []
    for i, (text, edited, after) in want.items():
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), sha(edited.encode()))
        prints[text].add(got[i].fingerprint)
        prints[edited].add(got[i].edited_fingerprint)
        if text == edited:
            assert got[i].near_edited == 1.0
        errors += [(got[i].near_edited - true_likeness(text, edited)), (got[i].near_next - true_likeness(text, after))]
    assert all(len(p) == 1 for p in prints.values())
    assert abs(np.mean(errors)) < 0.05
    # With every hash kept the sketch is the whole set.
    exact = fingerprints.edited_fingerprints(spark.createDataFrame(passages, SCHEMA), scale=1)
    for r in exact.collect():
        text, edited, after = want[r.doc_id]
        assert r.near_edited == pytest.approx(true_likeness(text, edited))
        assert r.near_next == pytest.approx(true_likeness(text, after))
    assert fingerprints.edited_fingerprints(nothing).count() == 0
    single = fingerprints.edited_fingerprints(spark.createDataFrame([(3, "abcd", "x", "y", 4)], SCHEMA)).first()
    assert single.edited_sha256 == sha(b"abab") and single.near_next == 1.0


def test_sketches_merge(spark):
    rng = random.Random(2)
    words = [rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(3000)]
    big, small = " ".join(words), " ".join(words[1000:1400])
    rows = spark.createDataFrame([(big, small, " ".join(words[:1500]), " ".join(words[1496:]))], "b string, s string, l string, r string")
    for c in "bslr":
        rows = fingerprints.with_sketch(rows, c, f"k_{c}")
    row = rows.select(fingerprints.containment(F.col("k_s"), F.col("k_b")), fingerprints.merged(F.col("k_l"), F.col("k_r")) == F.col("k_b")).first()
    assert row[0] == 1.0 and row[1]
