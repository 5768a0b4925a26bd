"""Filter interactions: tries against dictionaries, counts against applying every order."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from quayside.llm import filter_audit as A
from quayside.llm import queries as Q
from tests.llm.conftest import SCHEMA, as_table


def ascii_words(text):
    return (text or "").encode().split()


def brute_mask(text, doc_id, least):
    text, words = text or "", ascii_words(text)
    flags = [len(words) < 100, 100 * len(set(words)) < 80 * len(words),
             100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), any(c in "#$%&*|" for c in text),
             doc_id is not None and doc_id > least]
    return "".join(f for f, bad in zip("ABCDE", flags) if bad)


def smallest(rows):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    return least


def brute_report(rows, labels):
    least, good, toxic = smallest(rows), set(), set()
    for i, quality, bad in labels:
        good |= {i} if quality == 1 else set()
        toxic |= {i} if bad == 1 else set()
    parts = defaultdict(list)
    for i, text, lang, *_ in rows:
        parts[lang or ""].append((i, brute_mask(text, i, least.get(text or ""))))
    out = set()
    for part, docs in parts.items():
        shapley = defaultdict(int)
        lines = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                failing = sum(f in m for _, m in docs)
                lines.append((part, order, step, f, len(left), len(gone), failing - len(gone),
                              sum(m == f for _, m in docs), sum(i in good for i, _ in gone if i is not None),
                              sum(i in toxic for i, _ in gone if i is not None)))
        out |= {(p, o, s, *rest, shapley[f]) for p, o, s, f, *rest in lines}
    return out


def crowd():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.sample(words, 130)) for _ in range(6)]
    head = "the same long opening of every text " * 8
    texts = base * 4 + [b.upper() for b in base] + [b + " #1" for b in base] + ["ab " * 140, "Ab " * 140]
    texts += [head + b for b in base] * 3 + [head, head[:-1], head[:70], "é" * 30, "é" * 29 + "è"] * 2
    rows = [(i, t, ["en", "fr", None, ""][i % 4], "s", 0) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "s", 0)] * 5 + [(None, texts[0], "en", "s", 0), (None, "only here", "de", "s", 0)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, len(texts), 2)]
    return rows, labels + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (10**6, 1, 1)]


def test_query_equals_applying_every_order(spark, odd_rows, tmp_path):
    rows, labels = crowd()
    rows = rows + [(1000 + r[0], *r[1:]) for r in odd_rows]
    as_table(spark, tmp_path, spark.createDataFrame(rows, SCHEMA).repartition(7))
    folder = as_table(spark, tmp_path, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")
    got = Q.op12_radix_text_tries(spark, folder)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                           "good_lost", "toxic_lost", "shapley"]
    assert set(map(tuple, got.collect())) == brute_report(rows, labels)
    assert got.count() == 600 * len({r[2] or "" for r in rows})


def test_masks_with_tiny_blocks_and_ranges(spark, monkeypatch):
    rows, _ = crowd()
    least = smallest(rows)
    want = defaultdict(int)
    for i, text, lang, *_ in rows:
        want[i, lang or "", brute_mask(text, i, least.get(text or ""))] += 1
    for limit in (1 << 10, 1 << 30):
        held = A.by_prefix(spark.createDataFrame(rows, SCHEMA).where("doc_id is not null"), limit)
        where = held.select("text", F.spark_partition_id().alias("p")).distinct().groupBy("text").count()
        assert where.where("count > 1 and text is not null").count() == 0
        assert held.count() == sum(r[0] is not None for r in rows)
    got = defaultdict(int)
    for r in A.failure_masks(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        got[r.doc_id, r.part, "".join(f for n, f in enumerate("ABCDE") if r.mask >> n & 1)] += r.copies
    assert got == want


def test_shared_openings_spread(spark):
    head = "x" * 600
    rows = [(i, head + f"{i:05d}" + "y" * 400, "en", "s", 0) for i in range(300)]
    dealt = A.by_prefix(spark.createDataFrame(rows, SCHEMA), 20_000)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 100 and sum(sizes) == 300


def test_trie_against_a_dictionary():
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(600)]
    texts += [b"ab" * n for n in range(200)] + [b"ab" * 150 + b"b"]
    trie, want = A.Trie(), defaultdict(list)
    for i, text in enumerate(rng.sample(texts, len(texts))):
        assert trie.add(text, 1000 - i, "p", 0) == (text not in want)
        want[text].append(1000 - i)
    found = {text: (least, sorted(r[0] for r in rows)) for text, least, rows in trie.strings()}
    assert found == {t: (min(ids), sorted(ids)) for t, ids in want.items()}
    assert sorted(least for least, _ in trie.terminals()) == sorted(min(ids) for ids in want.values())


def test_blocks_send_each_text_once(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [5, 3, 3, 9, None], "part": ["a"] * 5, "text": ["t"] * 4 + ["t"]})
    rows = sorted(tuple(r.values()) for b in A._in_blocks(iter([batch])) for r in b.to_pylist() if r["doc_id"])
    assert rows == [(3, "a", 1, 2, "t"), (5, "a", 17, 1, None), (9, "a", 17, 1, None)]


def test_no_rows_and_other_columns(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.interactions(A.failure_masks(nothing), labels).count() == 0
    df = spark.createDataFrame([(1, "t", 2, "m"), (2, "t", 2, "m")], "id int, body string, part int, mask string")
    got = A.failure_masks(df, "id", "body", "part").collect()
    assert sorted(map(tuple, got)) == [(1, "2", 1, 1), (2, "2", 17, 1)]
