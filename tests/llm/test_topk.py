import math

import numpy as np
import pytest

from rollscore.llm import topk
from rollscore.llm.queries import QUERIES


def brute(rows, k=20):
    best = {}
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        best[i] = min(best.get(i, e), e)
    v = {i: [math.floor(64 * x) for x in e] for i, e in best.items()}
    out = []
    for q in sorted(v):
        if q % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q and len(v[c]) == len(v[q]) and len(v[q]))
            out += [(q, r + 1, c, -x) for r, (x, c) in enumerate(s[:k])]
    return out


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_against_brute_force_with_ties_copies_and_unusable_rows(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", max(2, block // 4))
    rng = np.random.default_rng(block)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8) * (1 + i % 3))]) for i in range(200)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(60)]  # copies: ties
    rows += [(5, rows[9][1]), (None, [1.0] * 8), (301, None), (302, [1.0, None] * 4), (303, [float("nan")] * 8), (304, [float("inf")] * 8)]
    rows += [(320, [0.5] * 3), (321, [0.25] * 3), (322, []), (340, []), (-20, [0.0] * 8)]
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in topk.report(df).collect())
    assert got == sorted(brute(rows))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.report(df).collect() == []


def test_too_large_component_raises(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        topk.report(df).collect()


@pytest.mark.parametrize("block", [7, 8192])
def test_large_components_are_scored_exactly(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8) * 10.0 ** (i % 7))]) for i in range(80)]
    # Its product with itself is no result and leaves 64 bits, those with all others stay.
    rows += [(80, [2.0**28, 3.0] + [0.5] * 6), (81, [rows[0][1][0]] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.report(df).collect()) == sorted(brute(rows))


def test_scores_beyond_64_bits_raise(spark):
    df = spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="leave 64 bits"):
        topk.report(df).collect()


def test_query_reads_few_exact_vectors():
    rng = np.random.default_rng(0)
    v = np.floor(64 * rng.normal(size=(4000, 64)) / 8).astype(np.int64)
    low = v.min(axis=0)
    width = (v.max(axis=0) - low) // topk.CELLS + 1
    cells = topk._cell_matrix(v, low, width)
    for q, at, score in topk.nearest(v[:5], cells, v, np.arange(4000), np.arange(5), low, width, 20):
        exact = v @ v[q]
        exact[q] = -(1 << 40)
        assert sorted(score, reverse=True) == sorted(exact, reverse=True)[:20]
    assert "op5_topk" in QUERIES
