"""Operators against brute force in plain Python, on rows with every oddity."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import (
    components, mixing, near_duplicates, pii, quality_rules, sentencepiece_codec, token_counts, url_filters,
)
from quayside.llm import queries as Q
from tests.llm.conftest import SCHEMA, as_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# --- connected components and near duplicates ---------------------------------

def brute_components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    pairs += pairs[:5] + [(7, 7), (99, 99)]
    rng.shuffle(pairs)
    got = components.connected_components(spark.createDataFrame(pairs + [(None, 3)], "u bigint, v bigint"))
    nodes = {n for p in pairs for n in p}
    assert {r.node: r.component for r in got.collect()} == brute_components(nodes, pairs)


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_near(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    ids = sorted(i for i in sets if sets[i])
    pairs = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    found = brute_components(ids, pairs)
    return {i: (len(s), found.get(i, i)) for i, s in sets.items()}


def test_near_duplicates(spark, odd, odd_rows, nothing):
    got = by_id(near_duplicates.near_duplicates(odd.withColumn("class", F.lit(1))))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_near(odd_rows)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert near_duplicates.near_duplicates(nothing).count() == 0


def test_chains_of_near_copies_keep_every_link(spark):
    """A chain whose ends are far apart, a wheel around a text, and two groups that nearly touch."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(200)]
    rows, chain = [], list(base)
    for i in range(60):
        chain = list(chain)
        chain[(i * 7) % 200] = f"c{i}"
        rows.append(" ".join(chain))
    for i in range(80):
        rim = list(base)
        for at in rng.sample(range(200), 6):
            rim[at] = f"r{i}-{at}"
        rows.append(" ".join(rim))
    rows += [" ".join(base)] * 3
    order = list(range(len(rows)))
    rng.shuffle(order)
    table = [(n, rows[k]) for n, k in enumerate(order)]
    got = by_id(near_duplicates.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string")))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_near(table)


def test_rows_without_id_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (4, text), (4, "other words here now then again"), (2, "other words here now then again")]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [
        (-1, -1, True), (2, 2, True), (4, 2, False), (4, 2, False)]


def test_signature_estimates_similarity():
    import numpy as np
    from quayside.llm import kernel as K
    rng = np.random.default_rng(1)
    pool = K.mix(rng.integers(0, 2**63, 1500, dtype=np.uint64))
    items = np.concatenate([np.sort(pool[:1000]), np.sort(pool[500:])])
    sheet = near_duplicates.super_minhash(items, np.repeat([0, 1], 1000), 2, 1024)
    assert abs((sheet[0] == sheet[1]).mean() - 1 / 3) < 0.05
    one = near_duplicates.super_minhash(items[:1], np.zeros(1, np.int64), 1, 128)
    assert sorted(int(v) >> 32 for v in one[0]) == list(range(128))  # each slot by another rank


# --- quality rules ---------------------------------------------------------------

def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    lost = 0
    failed = 0
    for x in lines:
        own = WORD.findall(x)
        marks = sum(c in "#*$%&|<>" for c in x)
        upper, lower = sum("A" <= c <= "Z" for c in x), sum("a" <= c <= "z" for c in x)
        bad = any(p in "".join(c.lower() if c < "\x80" else c for c in x) for p in quality_rules.BOILERPLATE) \
            or 100 * sum(w in "|>" for w in own) >= 25 * len(own) or (marks >= 3 and 100 * marks > 30 * len(own)) \
            or (upper >= 5 and upper > lower) or (len(own) < 3 and own[-1][-1] not in ".!?:;\"')]")
        failed += bad
        lost += bad * sum(map(len, own))
    chars = sum(map(len, words))
    base = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return {"n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": dup, "n_repeat_words": len(hit), "n_lines": len(lines), "n_failed_lines": failed,
            "lost_chars": lost, "base_failed": base, "kept": not base and 100 * lost <= 50 * chars}


def test_quality_measures(spark, odd, odd_rows, nothing):
    extra = [(900, "Sign IN here\nreal words of a sentence.\n" * 9), (901, "ONE TWO THREE\n" * 3 + "fine words."),
             (902, "home | shop | cart\nA line that says something of use."), (903, "$$$ now *** now"), (904, "x\ry")]
    rows = odd_rows + [(i, t, None, None, 0) for i, t in extra]
    got = by_id(quality_rules.quality_measures(spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit(-1))))
    for i, text, *_ in rows:
        want = brute_quality(text)
        assert {k: got[i][k] for k in want} == want, (i, text)
    assert quality_rules.quality_measures(nothing).count() == 0


def test_clean_documents(spark):
    body = "".join(f"A{i} line{i} that{i} says{i} something{i} of use.\n" for i in range(12))
    rows = [(1, body + "home | shop | cart\n", "en", "s", 0), (2, "home | shop\n" * 40, "en", "s", 0), (3, None, "en", "s", None)]
    out = quality_rules.clean_documents(spark.createDataFrame(rows, SCHEMA))
    assert [(r.doc_id, r.text, r.n_chars) for r in out.collect()] == [(1, body, len(body))]
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


# --- tokens ------------------------------------------------------------------------

def test_sentencepiece_equals_library(spark, odd, odd_rows, nothing, tmp_path):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_file("piece_bpe_32k.model"))
    rng = random.Random(9)
    letters = ["a", "the", "▁", " ", "  ", "\n", "é", "\u2003", "日", "😀", "<s>", "\x00", "\ufeff", "ing", "\t", "ﬁ", "Ⅷ"]
    extra = [(1000 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))), "en", "s", 0) for i in range(300)]
    extra += [(2000, " ", "en", "s", 0), (2001, "▁", "en", "s", 0), (2002, "a ", "en", "s", 0), (2003, "a▁", "en", "s", 0),
              (2004, " " * 3000, "en", "s", 0), (2005, "x" * 5000 + " " + "y " * 5000, "en", "s", 0)]
    rows = odd_rows + extra
    folder = as_table(spark, tmp_path, spark.createDataFrame(rows, SCHEMA))
    got = by_id(Q.op3_distinct_chunk_table(spark, folder))
    for i, text, *_ in rows:
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        want = (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(model.decode(ids)))
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want, text
    assert sentencepiece_codec.encode(nothing, Q.tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_length_histogram(spark, odd, odd_rows, nothing, tmp_path):
    import public_tokenizers as P
    encoder = token_counts.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    lengths = [len(encoder.encode_ordinary(t or "")) for _, t, *_ in odd_rows]
    got = {r.n_tokens: r for r in Q.op4_length_histogram(spark, as_table(spark, tmp_path, odd)).collect()}
    assert set(got) == set(lengths)
    for n, row in got.items():
        assert row.docs == lengths.count(n)
        assert row.docs_from == sum(x >= n for x in lengths) and row.tokens_from == sum(x for x in lengths if x >= n)
        assert row.docs_to == sum(x <= n for x in lengths) and row.truncated_total == sum(min(x, n) for x in lengths)
    histogram = spark.createDataFrame(list(got.values()))
    report = {r.context: r for r in token_counts.context_report(histogram, [0, 7, 100, 5000, 10**6]).collect()}
    for limit, row in report.items():
        assert (row.docs_over, row.tokens_kept, row.total) == (
            sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths), sum(lengths))
    ranked = sorted(lengths)
    for r in token_counts.length_quantiles(histogram, [0, 25, 50, 99, 100]).collect():
        assert r.n_tokens == min(n for n in ranked if sum(x <= n for x in ranked) * 100 >= r.percent * len(ranked))
    assert token_counts.length_histogram(spark.createDataFrame([], "n_tokens bigint")).count() == 0


# --- personal data --------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) \
                    or kind == "card" and not (16 <= len(digits) <= 19 and double % 10 == 0) \
                    or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark, odd, nothing, tmp_path):
    rng = random.Random(11)
    parts = ["a", "@", ".", "b-c", "1", "42", "255", "256", "+", "(", ")", "-", " ", "4111 1111 1111 1111", "é", "😀",
             "192.168.0.1", "+49 (30) 123456", "x@y.z", "_", "%", "0", "5500005555555559", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    texts += ["a" * 100_000, "1" * 100_000, "@" * 5000, "1." * 50_000, "+1" * 20_000, "+1" + " " * 50_000, None, ""]
    for text in texts:
        got = [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]
        if len(text or "") < 1000:
            assert got == brute_base(text), text
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts[:300])]
    got = by_id(Q.op8_checked_spans(spark, as_table(spark, tmp_path, spark.createDataFrame(rows, SCHEMA))))
    for i, t, *_ in rows:
        want = brute_base(t)
        assert got[i]["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want))
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(w[0] == k for w in want) for k in BASE]
    assert pii.pii_spans(nothing).count() == 0


@pytest.mark.parametrize("text, want", [
    ("DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32",
     ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]),
    ("IBAN DE89 3704 0044 0532 0130 00 AND IBAN GB82 WEST 1234 5698 7654 32",
     ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]),
    ("NO9386011117947 BE68539007547034", ["NO9386011117947", "BE68539007547034"]),
    ("INVOICE AB12 PAY TO IBAN GB82 WEST 1234 5698 7654 32", ["GB82 WEST 1234 5698 7654 32"]),
    ("AB12 CD34 EF56 GH78 GB82 WEST 1234 5698 7654 33", []),
])
def test_ibans_in_lists_and_upper_case(text, want):
    spans = pii.find_spans(text)
    assert [text[a:b] for k, a, b, _ in spans if k == "iban"] == want
    assert not any(x in pii.masked(text) for x in want)


def test_checksums_and_context(spark):
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 NOW please") == ["iban"]
    assert kinds("pay to GB82 WEST 1234 5698 7654 33") == []
    assert kinds("her social security number is 123-45-6789") == ["ssn"]
    assert kinds("part 123-45-6789 of it") == [] and kinds("ssn 000-45-6789") == []
    assert kinds("amex 378282246310005") == ["account"] and kinds("item 378282246310005") == []
    assert pii.masked("mail a@b.co or +49 30 1234567!") == "mail [EMAIL] or [PHONE]!"
    rows = [(1, "ip 10.0.0.1", "en", "s", 11), (2, None, "en", "s", None)]
    assert [(r.text, r.n_chars) for r in pii.redact(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()] == [
        ("ip [IP]", 7), (None, None)]


# --- mixing ---------------------------------------------------------------------------

def brute_divide(budget, children):
    """children: name -> (weight, cap); returns the quota of each."""
    out = {n: 0 for n in children}
    room = {n: c for n, (w, c) in children.items() if w > 0 and c > 0}
    left = min(budget, sum(room.values()))
    while True:
        weight = sum(children[n][0] for n in room)
        full = [n for n in room if room[n] * weight <= left * children[n][0]]
        if not full:
            break
        for n in full:
            out[n] = room.pop(n)
        left = min(budget, sum(c for w, c in children.values() if w > 0 and c > 0)) - sum(out.values())
        if not room:
            break
    weight = sum(children[n][0] for n in room)
    for n in room:
        out[n] = left * children[n][0] // weight
    spare = left - sum(out[n] for n in room)
    for n in sorted(room)[:spare]:
        out[n] += 1
    return out


def brute_mix(rows, weights, share, epochs, seed):
    def weight(path):
        best = 1
        for key, value in weights.items():
            if tuple(path[len(path) - len(key):]) == key:
                best = value
        return best
    leaves = defaultdict(list)
    for i, text, lang, source, _ in rows:
        domain = "(none)" if source is None else f"d{ord(source[-1]) % 4}"
        leaves[domain, lang or "(none)", source or "(none)"].append((i, len(WORD.findall(text or ""))))
    cap = {p: sum(n for _, n in v) * epochs for p, v in leaves.items()}
    total = sum(cap.values()) // epochs * share // 100
    quota = {}

    def spend(prefix, budget, depth):
        if depth == 3:
            quota[prefix] = budget
            return
        kids = {p[depth] for p in cap if p[:depth] == prefix}
        given = brute_divide(budget, {k: (weight((*prefix, k)), sum(
            c for p, c in cap.items() if p[:depth + 1] == (*prefix, k))) for k in kids})
        for k in kids:
            spend((*prefix, k), given[k], depth + 1)
    spend((), total, 0)
    out = {}
    for path, docs in leaves.items():
        tokens = sum(n for _, n in docs)
        whole, rest = divmod(quota[path], tokens) if tokens else (0, 0)
        key = lambda d: hashlib.md5(f"{seed}:{whole + 1}:{d[0]}".encode()).hexdigest()  # noqa: B023,E731
        used = 0
        open_ = True
        for doc in sorted((d for d in docs if d[1]), key=key):
            used += doc[1]
            open_ = open_ and used <= rest
            if whole + open_:
                out[doc[0]] = (doc[1], quota[path], whole + open_)
    return out


@pytest.mark.parametrize("share,epochs", [(50, 2), (100, 1), (130, 2), (0, 1), (7, 3)])
def test_mixing(spark, odd, odd_rows, share, epochs):
    clash = odd.withColumns({c: F.lit("clash") for c in ("domain", "quota", "whole", "cut", "id", "n", "mix_epochs")})
    got = mixing.mix(clash, Q.domain_of(F.col("source")), F.col("lang"),
                     F.col("source"), Q.MIX_WEIGHTS, share_percent=share, max_epochs=epochs, seed=7)
    found = {r.doc_id: (r.mix_tokens, r.mix_quota, r.mix_epochs) for r in got.collect()}
    assert found == brute_mix(odd_rows, Q.MIX_WEIGHTS, share, epochs, 7)


def test_shortage_stays_among_siblings(spark, nothing):
    rows = [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("b", "y", "s3", 1000)]
    leaves = spark.createDataFrame(rows, "domain string, language string, leaf string, tokens bigint").withColumn("cap", F.col("tokens"))
    got = {r.leaf: r.quota for r in mixing.budgets(leaves, {("a",): 1, ("b",): 1}, 400, None).collect()}
    assert got == {"s1": 10, "s2": 190, "s3": 200}
    got = {r.leaf: r.quota for r in mixing.budgets(leaves, {("b",): 9}, 1500, None).collect()}
    assert got == {"s1": 10, "s2": 490, "s3": 1000}
    assert mixing.mix(nothing, F.col("source"), F.col("lang"), F.col("source"), {}).count() == 0


# --- urls -------------------------------------------------------------------------------

def test_url_verdicts(spark):
    def canonical(href):
        return f'<head><link rel="canonical" href="{href}"></head>'
    rows = [
        (1, "http://A.b.NET/x?q#f", ""), (2, "http://example.net/en/1", ""), (3, "https://x.example.com/de/1", None),
        (4, "https://free.example.com/page", canonical("https://x.example.com/de/1")),
        (5, "https://also.example.com/page", '<meta http-equiv="refresh" content="0; url=/other">'),
        (6, "https://also.example.com/other", canonical("//free.example.com/page")),
        (7, "https://both.example.com/p", canonical("http://example.net/en/1")),
        (8, "https://both.example.com/p/#again", canonical("http://other.net/")),
        (9, None, ""), (10, "no scheme", canonical("http://a.net/")), (11, "net://net", ""), (12, "http://net/?a://b", ""),
        (13, "https://free.example.com/page?utm_source=feed", ""), (14, "http://nets/", ""), (15, "http://x.org/fr/", ""),
        (15, "http://x.org/fr/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("host", "said", "class", "node", "heard", "row", "u")})
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           url_filters.url_verdicts(pages, url_filters.rule_table(pages, Q.URL_RULES)).collect()}
    assert got == {
        1: ("a.b.net", "/x", "net/", "block"), 2: ("example.net", "/en/1", "example.net/en/", "allow"),
        3: ("x.example.com", "/de/1", "example.com/de/", "block"), 4: ("free.example.com", "/page", None, "block"),
        5: ("also.example.com", "/page", None, "block"), 6: ("also.example.com", "/other", None, "block"),
        7: ("both.example.com", "/p", None, "allow"), 8: ("both.example.com", "/p/", None, "allow"),
        9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("net", "", None, "allow"),
        12: ("net", "/", "net/", "block"), 13: ("free.example.com", "/page", None, "block"),
        14: ("nets", "/", None, "allow"), 15: ("x.org", "/fr/", "org/fr/", "allow")}
    moved = spark.createDataFrame([("http://z.io/", "http://q.net/")], "src string, dst string")
    some = spark.createDataFrame([(1, "http://z.io", None), (2, "http://q.net/", None)], "page_id bigint, url string, html string")
    out = url_filters.url_verdicts(some, url_filters.rule_table(some, Q.URL_RULES), moved)
    assert {r.page_id: (r.verdict, r.inherited) for r in out.collect()} == {1: ("block", True), 2: ("block", False)}
    assert url_filters.url_verdicts(some.limit(0), url_filters.rule_table(some, Q.URL_RULES)).count() == 0
