"""The pipeline against a brute-force version, and its stages' contracts."""

from __future__ import annotations

import hashlib
import random
import struct

import corpus_pipeline
from quayside.llm import pii
from quayside.llm import queries as Q
from tests.llm.conftest import SCHEMA, as_table
from tests.llm.test_operators import brute_mix, brute_near, brute_quality


def corpus():
    rng = random.Random(8)
    words = [f"word{i}" for i in range(2500)]

    def prose(n):
        text, line = [], []
        for _ in range(n):
            line.append(rng.choice(words))
            if rng.random() < 0.12:
                text.append(" ".join(line) + ".")
                line = []
        return "\n".join([*text, " ".join(line) + "."])
    bodies = [prose(rng.randint(70, 200)) for _ in range(60)]
    texts = bodies + [bodies[0], bodies[1], bodies[1].replace("word1", "wort1", 1), prose(10), None, ""]
    texts += [bodies[2] + "\nhome | shop | cart", "a | b\n" * 60, bodies[3] + "\nmail me@there.org now, or +49 30 1234567."]
    texts += [prose(3000), "same words again. " * 50]
    return [(i, t, ["en", "fr", "de", None][i % 4], [f"src{i % 5}", None][i % 9 == 8], None if t is None else len(t))
            for i, t in enumerate(texts)]


def cleaned(text):
    keep = []
    for line in (text or "").split("\n"):
        words = brute_quality(line)
        keep += [line] if not words["n_failed_lines"] else []
    return "\n".join(keep)


def brute_run(rows):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_file("piece_bpe_32k.model"))
    rows = [(i, cleaned(t), lang, src, n) for i, t, lang, src, n in rows if brute_quality(t)["kept"]]
    classes = brute_near(rows)
    rows = [r for r in rows if classes[r[0]][1] == r[0]]
    rows = [(i, pii.masked(t), lang, src, n) for i, t, lang, src, n in rows]
    chosen = brute_mix(rows, Q.MIX_WEIGHTS, 50, 1, 7)
    out = {}
    for i, text, *_ in rows:
        if i in chosen:
            ids = model.encode(text, add_bos=True, add_eos=True)
            out[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                      hashlib.sha256(model.decode(ids).encode()).hexdigest())
    return out


def test_run_equals_brute_force(spark, tmp_path):
    rows = corpus()
    folder = as_table(spark, tmp_path, spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, folder).collect()}
    want = brute_run(rows)
    assert len(want) > 20 and got == want


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame(corpus()[:12], SCHEMA)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "pii", "mixing", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.dtypes == spark.createDataFrame([], SCHEMA).dtypes


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
