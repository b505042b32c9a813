"""op12: whitened vectors against plain numpy over the expanded rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.llm import whitening

SF01 = "/root/testdata/sf0.01"


def brute(vectors, components=32):
    x = np.array([[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype="int64")
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return ((n * x - s) ** 2).sum(axis=1), centred @ vecs / np.sqrt(values), values / np.trace(cov)


def check(got, ids, vectors, components=32):
    dev, z, share = brute(vectors, components)
    table = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(ids) * z.shape[1]
    for c in range(z.shape[1]):
        column = np.array([table[i, c + 1].whitened for i in ids])
        sign = np.sign(np.dot(column, z[:, c]))
        assert np.allclose(column * sign, z[:, c], atol=1e-6)
    for i, d in zip(ids, dev):
        assert table[i, 1].deviation == d and table[i, 1].n == len(ids)
    assert np.allclose([table[ids[0], c + 1].explained for c in range(z.shape[1])], share, rtol=1e-8)
    assert 0 <= got[0].identity_error < 1e-8


def test_whole_table_against_numpy(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    data = [r for r in emb.collect() if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(whitening.whiten(emb).collect(), [r.vec_id for r in data], [r.embedding for r in data])


def test_hot_vector_and_left_out_rows(spark):
    rng = np.random.default_rng(5)
    hot = [0.5, -1.25, 3.0]
    vectors = [hot] * 300 + [list(map(float, v)) for v in rng.normal(size=(150, 3))]
    bad = [(1000, None, 1), (1001, [1.0, None, 2.0], 1), (1002, [float("nan"), 0.0, 0.0], 1),
           (1003, [float("inf"), 0.0, 0.0], 1), (1004, [1.0, 2.0], 1), (1005, [], 1)]
    data = [(i, v, 7) for i, v in enumerate(vectors)] + bad
    emb = spark.createDataFrame(data, "vec_id long, embedding array<double>, w int").withColumn("x", F.lit("clash"))
    got = whitening.whiten(emb).collect()
    check(got, list(range(len(vectors))), vectors)
    assert len({r.whitened for r in got if r.vec_id < 300 and r.component == 1}) == 1


def test_repeated_rows_and_null_ids_stay(spark):
    emb = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 0.0]), (4, [1.0, 5.0])],
                                "vec_id long, embedding array<float>")
    got = whitening.whiten(emb).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 4, 1), (False, 4, 2), (True, 0, 1), (True, 0, 2)]


def test_components_without_variance_are_null(spark):
    emb = spark.createDataFrame([(1, [0.0, 1.0, 2.0]), (2, [1.0, 1.0, 2.0])], "vec_id long, embedding array<float>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(emb).collect()}
    assert abs(got[1, 1].whitened) == pytest.approx(1.0) and got[1, 1].explained == pytest.approx(1.0)
    assert got[1, 2].whitened is None and got[2, 3].whitened is None and got[1, 1].identity_error < 1e-12
    same = whitening.whiten(emb.where("vec_id = 1")).collect()
    assert len(same) == 3 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same)


def test_empty_table(spark):
    emb = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got = whitening.whiten(emb)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_large_entries_stay_exact(spark):
    big = float(1 << 40)
    emb = spark.createDataFrame([(1, [big, 0.0]), (2, [-big, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    x = [[int(64 * big) + 10**6, 10**6], [-int(64 * big) + 10**6, 64 + 10**6], [10**6, 128 + 10**6]]
    sums = [sum(c) for c in zip(*x)]
    wide = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    got = {r.vec_id: r.deviation for r in whitening.whiten(emb).where("component = 1").collect()}
    assert got == {i: (v if v < 1 << 63 else None) for i, v in wide.items()}
