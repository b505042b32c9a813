"""Retry-safe sinks (S6-S8), exact report lines, and merged moments."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.operators import losses as LO
from rollscore.operators import metrics as M
from rollscore.plans import catalog
from rollscore.session import scratch_dir
from rollscore.sources import sinks as SK

SF001 = "/root/testdata/sf0.001"


def metric_rows(spark, rows):
    return spark.createDataFrame(rows, "run_id long, step long, tag string, value double, text string")


def read(spark, path):
    return sorted((r.run_id, r.step, r.tag, r.value, r.writer, r.batch) for r in SK.read_metrics(spark, path).collect())


def test_a_batch_is_replaced_whole(spark):
    path = scratch_dir(spark, "sink")
    first = metric_rows(spark, [(7, 1, "a", 1.0, None), (8, 1, "a", 2.0, None)])
    SK.write_metrics(first, path, "train", 0)
    SK.write_metrics(metric_rows(spark, [(7, 2, "a", 3.0, None)]), path, "train", 1)
    SK.write_metrics(metric_rows(spark, [(7, 1, "e", 4.0, "t")]), path, "eval", 0)
    before = read(spark, path)
    SK.write_metrics(first, path, "train", 0)
    assert read(spark, path) == before and len(before) == 4
    # a retry whose rows differ leaves nothing of the first attempt, run 8 included
    SK.write_metrics(metric_rows(spark, [(7, 1, "a", 9.0, None)]), path, "train", 0)
    assert read(spark, path) == [(7, 1, "a", 9.0, "train", 0), (7, 1, "e", 4.0, "eval", 0), (7, 2, "a", 3.0, "train", 1)]
    assert dict(SK.read_metrics(spark, path).dtypes)["run_id"] == "bigint"


def test_reader_prunes_by_run(spark):
    path = scratch_dir(spark, "sink")
    SK.write_metrics(metric_rows(spark, [(1, 1, "a", 1.0, None), (2, 1, "a", 2.0, None)]), path, "train", 0)
    plan = SK.read_metrics(spark, path).where("run_id = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_writer_names_and_empty_batches(spark):
    path = scratch_dir(spark, "sink")
    with pytest.raises(ValueError):
        SK.write_metrics(metric_rows(spark, []), path, "a/b", 0)
    SK.write_metrics(metric_rows(spark, [(1, 1, "a", 1.0, None)]), path, "train", 0)
    SK.write_metrics(metric_rows(spark, []), path, "train", 0)
    assert read(spark, path) == []


def test_manifest_round_trip(spark):
    path = os.path.join(scratch_dir(spark, "sink"), "m")
    best = spark.createDataFrame([(1, "c", 5, 0.5)], "run_id long, category string, step long, score double")
    for _ in range(2):
        SK.write_manifest(SK.checkpoint_manifest(best), path, "trainer", 3)
    row = SK.read_manifest(spark, path).collect()
    assert [(r.run_id, r.step, r.path, r.batch) for r in row] == [(1, 5, "./output/best_models/best_c_step_5", 3)]


def test_moments_equal_numpy(spark):
    rng = np.random.default_rng(2)
    rows, flat = [], {}
    for i in range(200):
        n = int(rng.integers(0, 9))
        p, o = rng.normal(1e3 if i % 2 else 0, 1, n), rng.normal(1e3 if i % 2 else 0, 1, n)
        m = rng.random(n) < 0.6
        rows.append((i % 2, p.tolist(), o.tolist(), m.tolist()))
        flat.setdefault(i % 2, []).append((p - o, m))
    rows += [(5, [], [], []), (6, [1.0], [1.0], [True]), (7, [1.0], [0.5], [False]), (8, None, None, None)]
    df = spark.createDataFrame(rows, "k int, p array<double>, o array<double>, m array<boolean>").repartition(5)
    for mask in (None, "m"):
        got = {r.k: r for r in LO.ratio_stats(df, "p", "o", ["k"], mask=mask).collect()}
        for k, parts in flat.items():
            lr = np.concatenate([d[m] if mask else d for d, m in parts])
            ratio = np.exp(lr)
            want = [ratio.mean(), ratio.std(ddof=1), ratio.min(), ratio.max(), lr.mean(), lr.max()]
            assert np.allclose([got[k][c] for c in list(got[k].asDict())[1:]], want, rtol=1e-12)
        assert got[6].ratio_std is None and got[6].ratio_mean == 1.0
        assert 5 not in got and 8 not in got and (7 in got) == (mask is None)


def test_moments_of_values_far_from_zero(spark):
    """Merging by means keeps a tiny spread around a large mean, which sums of squares would lose."""
    values = [[12.0 + 1e-9 * (i * 7 % 5), 12.0 + 1e-9 * (i % 3)] for i in range(50)]
    df = spark.createDataFrame([(1, v, [0.0, 0.0]) for v in values], "k int, p array<double>, o array<double>")
    ratio = np.exp(np.array(values).ravel())
    assert LO.ratio_stats(df, "p", "o", ["k"]).first().ratio_std == pytest.approx(ratio.std(ddof=1), rel=1e-6)


@pytest.mark.parametrize("query", ["ratio_stats", "ratio_stats_masked"])
def test_no_position_is_exploded(spark, query):
    logical = catalog.QUERIES[query](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Generate explode") <= 2 and "arrays_zip" not in logical.split("Generate")[0].split("Aggregate")[0]
    df = spark.createDataFrame([(1, [1.0], [0.5])], "k int, p array<double>, o array<double>")
    assert "Generate" not in LO.ratio_stats(df, "p", "o", ["k"])._jdf.queryExecution().executedPlan().toString()


def test_summary_lines_round_as_python(spark):
    values = (0.00005, 0.0625, 2.675, 0.12345, 31.25)
    df = spark.createDataFrame([(1, 3, *values)], "run_id long, step long, loss double, grad_norm double, reward_mean double, "
                               "reward_std double, avg_output_tokens double")
    loss, norm, mean, std, tokens = values
    assert M.train_summary_line(df).first().line == (
        f"Step 3 | Loss: {loss:.4f} | Grad norm: {norm:.4f} | Reward mean: {mean:.4f} | Reward std: {std:.4f} | Avg output tokens: {tokens:.1f}")
    line = M.train_summary_line(df.withColumn("grad_norm", F.lit(None).cast("double"))).first().line
    assert f"Grad norm: {float('nan'):.4f}" in line


def test_best_accuracy_and_gradient_norm(spark):
    acc = spark.createDataFrame([(1, s, a) for s, a in ((0, 10.0), (10, 30.0), (20, 20.0), (30, 40.0))] + [(2, 0, 0.0)],
                                "run_id long, step long, accuracy double")
    best = {(r.run_id, r.step): r.best_accuracy for r in M.with_best_accuracy(acc).collect()}
    assert best == {(1, 0): 10.0, (1, 10): 30.0, (1, 20): 30.0, (1, 30): 40.0, (2, 0): 0.0}
    norms = spark.createDataFrame([(1, 1, "w", 3.0), (1, 1, "b", 4.0)], "run_id long, step long, parameter string, norm double")
    assert M.grad_norm_per_step(norms).first().grad_norm == 5.0
