"""Words that hashes modulo a power of two take for equal; pieces, tables and stages that must not lose anything."""

from __future__ import annotations

import random

import numpy as np
import pytest

from quayside.llm import kernel as K
from quayside.llm import near_duplicates, phrases, quality_rules, sentencepiece_codec, suffix_dedup, token_counts
from quayside.llm import queries as Q
from tests.llm.conftest import SCHEMA


def thue_morse(n=1024):
    word = "a"
    while len(word) < n:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)


@pytest.mark.parametrize("lane", [0, 1])
def test_spans_differ(lane):
    one, two = thue_morse()
    data = np.frombuffer((one + two + one).encode(), dtype=np.uint8)
    start = np.array([0, 1024, 2048])
    a, b, c = K.span_hash(K.prefix_hash(data, lane=lane), start, start + 1024)
    assert a == c != b


def test_span_hashes_do_not_depend_on_the_place(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, size=5000, dtype=np.uint8)
    data[3000:3400] = data[100:500]
    for run in (1 << 23, 64):
        monkeypatch.setattr(K, "_RUN", run)
        a, b = K.span_hash(K.prefix_hash(data), np.array([100, 3000]), np.array([500, 3400]))
        alone = K.span_hash(K.prefix_hash(data[100:500]), np.array([0]), np.array([400]))[0]
        assert a == b == alone
    every = K.span_hash(K.prefix_hash(data), np.arange(4900), np.arange(4900) + 3)
    assert len(set(every.tolist())) == len({data[i:i + 3].tobytes() for i in range(4900)})


def test_operators_tell_them_apart(spark):
    one, two = thue_morse()
    row = quality_rules.quality_measures(docs(spark, [f"{one}\n{two}\n{one}"])).first()
    assert row.n_dup_lines == 1
    found = near_duplicates.near_duplicates(docs(spark, [one, two, one])).orderBy("doc_id").collect()
    assert [r.component_id for r in found] == [0, 1, 0]
    rest = " ".join(f"w{i}" for i in range(12))
    gone = phrases.remove_repeated_phrases(docs(spark, [f"{one} {rest}", f"{two} {rest}", f"x {one} {rest}"]))
    assert {r.doc_id: r.n_removed for r in gone.collect()} == {0: 0, 1: 0, 2: 13}
    cut = suffix_dedup.remove_repeated_substrings(docs(spark, [one[:300], two[:300]]))
    assert {r.n_bytes for r in cut.collect()} == {300}


def test_encoding_of_colliding_chunks_and_one_pass(spark):
    model = Q.tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece_codec.load(model)
    one, two = thue_morse()
    texts = [f"{one} {two} {one}", "", None, " ", "  a  b ", "▁▁x ▁ y", f"{two} é 日本 \n", "plain words here"] * 40
    got = sentencepiece_codec.encode_and_decode(docs(spark, texts).repartition(3), model).collect()
    want = [library.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    assert len(got) == len(texts)
    for r in got:
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == want[r.doc_id]
        assert r.text == library.decode(want[r.doc_id])
    clash = spark.createDataFrame([(1, "a b", b"x", 3)], "id int, body string, ids binary, text int")
    row = sentencepiece_codec.encode_and_decode(clash, model, "id", "body").first()
    assert (row.doc_id, row.text) == (1, "a b")
    empty = sentencepiece_codec.encode_and_decode(docs(spark, []), model)
    assert empty.count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_pieces_lose_no_repeated_window(seed):
    rng = random.Random(seed)
    fresh = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    shared = [fresh(n) for n in (199, 200, 201, 260, 500)]
    passages = [fresh(rng.randint(0, 90)) + rng.choice(shared) + fresh(rng.randint(0, 90)) for _ in range(30)]
    passages += [shared[1], b"z" * 300, fresh(230)]
    data = np.frombuffer(b"".join(passages), dtype=np.uint8)
    offsets = np.cumsum([0] + [len(p) for p in passages])
    flags = suffix_dedup.repeated_windows(data, offsets)
    seen: dict[bytes, list[int]] = {}
    for p, at in zip(passages, offsets):
        for k in range(len(p) - 199):
            seen.setdefault(p[k:k + 200], []).append(int(at) + k)
    want = sorted(k for places in seen.values() if len(places) > 1 for k in places)
    assert np.flatnonzero(flags).tolist() == want


def test_repeated_limits(spark):
    lengths = spark.createDataFrame([(1, 5), (2, 9)], "doc_id long, n_tokens long")
    got = token_counts.context_report(token_counts.length_histogram(lengths), [8, 4, 8]).orderBy("context").collect()
    assert [tuple(r) for r in got] == [(4, 2, 8, 14), (8, 1, 13, 14)]
