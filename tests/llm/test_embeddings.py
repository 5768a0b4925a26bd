"""Near duplicates among embeddings against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from quayside.llm import embedding_dedup as D
from quayside.llm import queries as Q
from tests.llm.conftest import as_table

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, threshold=0.98):
    """By row number: links and the smallest id reachable."""
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        u = np.array(v, dtype=float)
        u /= np.abs(u).max()
        good[k] = (label, u / np.linalg.norm(u))
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) \
                    and good[a][1] @ good[b][1] >= threshold:
                links[a].add(b)
                links[b].add(a)
    least = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least[k] = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
    return sorted(((i, len(links[k]), least[k], i is None or i == least[k]) for k, (i, _, _) in enumerate(rows)), key=str)


def vectors(seed=1, groups=12, size=9, noise=0.02, dims=24):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(rng.integers(1, size)):
            v = centre / np.linalg.norm(centre) + rng.normal(size=dims) * noise
            rows.append((v * rng.uniform(0.1, 9)).tolist())
    rows += [rng.normal(size=dims).tolist() for _ in range(40)]
    return rows


@pytest.fixture(scope="module")
def odd_vectors():
    found = vectors()
    rows = [(100 - i, v, i % 2) for i, v in enumerate(found)]
    rows += [(200 + i, found[0], 0) for i in range(30)] + [(300, [2 * x for x in found[0]], 0), (301, found[0], 1)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 24, 0), (403, [float("nan")] + [1.0] * 23, 0),
             (404, [float("inf")] + [1.0] * 23, 0), (405, [None] + [1.0] * 23, 0), (406, found[0], None),
             (407, [1e200] * 24, 0), (408, [1e-200] * 24, 0), (409, [-1e200] * 24, 0), (410, [1.0] * 23, 0),
             (411, [2.0] * 23, 0), (412, [-0.0, 1.0], 0), (413, [0.0, 3.0], 0), (None, found[0], 0),
             (200, found[0], 0), (5000, found[3], 1), (5000, found[4], 0)]
    return rows


def test_query_equals_all_pairs(spark, odd_vectors, tmp_path):
    folder = as_table(spark, tmp_path, spark.createDataFrame(odd_vectors, SCHEMA).repartition(5), "embeddings")
    got = Q.op13_pstable_hashing(spark, folder)
    assert dict(got.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert sorted(map(tuple, got.collect()), key=str) == brute(odd_vectors)


def test_large_groups_in_small_blocks(spark, monkeypatch):
    """A bucket over several chunks; the workers take the limits from the closure of the check."""
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.12).tolist(), 1) for i in range(260)]
    monkeypatch.setattr(D, "BLOCK", 40)
    got = D.near_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    links = sum(w[1] for w in want)
    assert links > 2000
    assert sum(r.n_links for r in got) >= 0.99 * links
    assert all(r.n_links <= w[1] for r, w in zip(sorted(got, key=lambda r: str(tuple(r))), want) if r.vec_id == w[0])


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold share a key about as often as stated."""
    rng = np.random.default_rng(3)
    u = rng.normal(size=(4000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.normal(size=(4000, 64))
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    v = 0.98 * u + np.sqrt(1 - 0.98 ** 2) * w
    a, b = (D.table_keys(x, 0, D.TABLES, 0.2) for x in (u, v))
    assert ((a == b).any(axis=1)).mean() > 0.995
    assert 0.17 < (a == b).mean() < 0.21
    assert (a == np.roll(a, 1, axis=0)).mean() < 1e-5


def test_keys_do_not_depend_on_the_round():
    u = np.random.default_rng(4).normal(size=(50, 8))
    whole = D.table_keys(u, 0, D.TABLES, 0.2)
    assert (whole[:, 8:16] == D.table_keys(u, 8, 16, 0.2)).all()


def test_other_columns_and_no_rows(spark):
    assert D.near_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, [1.0, 0.0], "x", 7, "n"), (2, [1.0, 0.1], "x", 7, "n"), (3, [1.0, 0.0], "y", 7, "n")],
                               "id int, v array<float>, kind string, n int, class string")
    got = D.near_embeddings(df, "id", "v", "kind").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
