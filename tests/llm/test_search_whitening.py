"""Embedding whitening and ranked search against brute force."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from feedkit.llm import ranked_search, whitening

# -- whitening ---------------------------------------------------------------------------------


def vectors(spark, rows, entry="float"):
    schema = T.StructType.fromDDL(f"vec_id long, embedding array<{entry}>, label int, x string, id string, n string")
    return spark.createDataFrame([(*r, 1, "x", "x", "x") for r in rows], schema)


def whitened(rows):
    """By numpy: for each distinct vector of integers its deviation and projections (without sign)."""
    x = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return n, {i: sum((n * a - b) ** 2 for a, b in zip(v, s)) for i, v in x.items()}, {
        i: np.abs((np.array([n * a - b for a, b in zip(v, s)], float) / n) @ axes[:, :4] / np.sqrt(values[:4])) for i, v in x.items()}, values / values.sum()


def test_whitening(spark):
    rng = np.random.default_rng(1)
    spread = rng.normal(size=(120, 7)).astype(np.float32) * np.arange(1, 8, dtype=np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(spread)] + [(200 + i, [float(c) for c in spread[0]]) for i in range(60)]
    odd = [(900, None), (901, []), (902, [1.0] * 6 + [None]), (903, [float("nan")] + [1.0] * 6), (904, [float("inf")] + [1.0] * 6), (905, [1.0, 2.0])]
    got = whitening.whiten(vectors(spark, rows + odd).repartition(5)).collect()
    n, deviations, projected, shares = whitened(rows)
    assert n == 120 and len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    for r in got:
        assert r.deviation == deviations[r.vec_id]
        assert abs(abs(r.whitened) - projected[r.vec_id][r.component - 1]) < 1e-9
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    of_first = {(r.component, r.whitened) for r in got if r.vec_id in (0, 200, 259)}
    assert len(of_first) == 4  # the same sign and value in all rows


def test_whitening_odd_tables(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [None])])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no variance
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)] + [(None, [3.0, 6.0, 5.0])])).collect()
    assert len(flat) == 10 and {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12  # one direction only
    big = whitening.whiten(vectors(spark, [(i, [i * 2.0**40, 1.0 * (i % 3)]) for i in range(5)], "double")).collect()
    assert {r.deviation for r in big} >= {None}  # beyond 64 bits


def test_exact_square_sums():
    rng = np.random.default_rng(2)
    for most in (2**20, 2**40, 2**45, 2**55):
        values = rng.integers(-most, most, (3, 2048))
        assert whitening.square_sums(values) == [sum(int(v) ** 2 for v in row) for row in values]
    assert whitening._row_sums(np.full((1, 4), 2**62)) == [2**64]


def test_covariance_is_exact(spark):
    rows = [(i, [i / 256, (i * i % 11) / 256, -i / 256]) for i in range(40)]
    given = vectors(spark, rows, "double")
    fit = given.select(whitening.integers(given["embedding"]).alias("x"))
    n, sums, v = whitening.covariance(fit)
    x = np.array([[i, i * i % 11, -i] for i in range(40)])
    assert n == 40 and sums == x.sum(axis=0).tolist() and np.allclose(v, np.cov(x.T, bias=True), rtol=1e-15)


# -- ranked search -----------------------------------------------------------------------------

def items(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "item_id long, text string, item string, rid string, score string")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def best(asked, docs, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in asked:
        found = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, q in Counter(terms(text)).items() if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:top], 1)]
    return out


def corpus(seed, n):
    random.seed(seed)
    words = [f"W{i}" for i in range(80)] + ["über", "straße", "日本語", "x_y", "it's"]
    texts = [" ".join(random.choices(words, weights=[1 + 300 / (i + 1) for i in range(len(words))], k=random.choice((3, 8, 20, 20, 60, 300)))) for _ in range(n)]
    docs = [(i, t) for i, t in enumerate(texts + texts[:15] + texts[:15])]
    docs += [(500, None), (501, ""), (502, " ... !?"), (503, "w1 " * 30000), (7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2 w3")]
    asked = [(i, random.choice(texts)) for i in range(12)] + [(20, None), (21, "-- !"), (22, "nothing-of-it here"), (23, "w1 W1 w1 w2"), (24, "w1 W1 w1 w2")]
    return asked, docs


@pytest.mark.parametrize("block, rows", [(ranked_search.BLOCK_ITEMS, ranked_search.SLICE_ROWS), (4, 10)])
def test_search(spark, make_docs, monkeypatch, block, rows):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", block)
    monkeypatch.setattr(ranked_search, "SLICE_ROWS", rows)
    asked, docs = corpus(4, 150)
    got = ranked_search.search(items(spark, asked), make_docs(docs).repartition(4)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, best(asked, docs, 20)))


def test_search_empty_tables(spark, make_docs):
    asked, docs = corpus(5, 20)
    assert ranked_search.search(items(spark, []), make_docs(docs)).collect() == []
    assert ranked_search.search(items(spark, asked), make_docs([])).collect() == []


def test_strata_are_left_out_by_their_bounds():
    """Visiting fewer strata must not change the best, and must happen."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = sorted((int(m), int(i)) for i, m in enumerate(rng.integers(80, 140, 600)))
    held = [sorted(set(rng.integers(0, 30, 6).tolist())) for _ in rows]
    tfs = [rng.integers(1, 4, len(h)).tolist() for h in held]
    index = pa.table({"m": [m for m, _ in rows], "id": [i for _, i in rows], "rid": [i for _, i in rows],
                      "terms": pa.array(held, pa.list_(pa.int32())), "tfs": pa.array(tfs, pa.list_(pa.int64()))})
    weights = np.arange(1, 31) * 100
    flat = ranked_search._Items([(0, Counter({1: 1, 5: 2, 29: 1})), (1, Counter({3: 1}))], weights)
    visited, scores = [], ranked_search.Stratum.scores
    try:
        ranked_search.Stratum.scores = lambda self, h, g: visited.append(1) or scores(self, h, g)
        out = pa.Table.from_batches(ranked_search._searcher(flat, 30, 5)(index.to_batches()))
    finally:
        ranked_search.Stratum.scores = scores
    assert 2 <= len(visited) < 2 * len({m for m, _ in rows})
    for item, wanted in ((0, {1: 1, 5: 2, 29: 1}), (1, {3: 1})):
        every = sorted((-sum(q * int(weights[t]) * ranked_search.impact(f, m) for t, f in zip(h, tf) if (q := wanted.get(t))), i)
                       for (m, i), h, tf in zip(rows, held, tfs))
        got = [(-r["score"], r["id"]) for r in out.to_pylist() if r["item"] == item]
        assert got == every[:5]
