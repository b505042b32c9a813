"""Quarantine, declared Parquet, the pruned task store, co-located tables, observed counters, the batched map, F11."""

import os
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollscore import schemas
from rollscore.functions.batched import batched_map, slices
from rollscore.operators import advantages as A
from rollscore.operators.scoring import attach_tasks_observed, require
from rollscore.operators.solutions import check_solutions
from rollscore.plans import fixtures as FX
from rollscore.plans import jobs as J
from rollscore.session import scratch_dir, settings
from rollscore.sources import quarantine as Q
from rollscore.sources import readers as RD
from rollscore.sources import stores as ST

SF001 = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quarantine_keeps_every_line(spark):
    work = scratch_dir(spark, "q")
    os.makedirs(f"{work}/in")
    lines = {"a.jsonl": ['{"target": 5, "nums": [1, 2, 3]}', "not json", '{"target": "x", "nums": [1]}', '{"target": 7}', ""],
             "b.jsonl": ['{"nums": [4], "target": 9, "more": 1}', '{"target": 1, "nums": "no"}', "[1, 2]", '{"target": null, "nums": [1]}',
                         '{"target": 3, "nums": [1']}
    for name, content in lines.items():
        with open(f"{work}/in/{name}", "w") as f:
            f.write("\n".join(content))
    for _ in range(2):  # again replaces
        Q.split_jsonl(spark, f"{work}/in", schemas.TASK_JSON, f"{work}/out")
    good = {(r.target, tuple(r.nums)) for r in Q.good_rows(spark, schemas.TASK_JSON, f"{work}/out").collect()}
    bad = sorted((os.path.basename(r.file), r.reason, r.line) for r in Q.bad_lines(spark, schemas.TASK_JSON, f"{work}/out").collect())
    assert good == {(5, (1, 2, 3)), (9, (4,))}
    assert [b[:2] for b in bad] == [("a.jsonl", "malformed"), ("a.jsonl", "missing"), ("a.jsonl", "type"), ("b.jsonl", "malformed"),
                                    ("b.jsonl", "malformed"), ("b.jsonl", "missing"), ("b.jsonl", "type")]
    assert ("a.jsonl", "malformed", "not json") in bad


def test_parquet_must_have_the_declared_columns(spark):
    path = scratch_dir(spark, "declared")
    FX.tasks(spark, SF001).drop("n_nums").write.parquet(f"{path}/ok")
    assert RD.read_tasks(spark, f"{path}/ok", split="test").count() == FX.tasks(spark, SF001).where("split = 'test'").count()
    FX.tasks(spark, SF001).select("task_id", "split", F.col("target").cast("string"), "nums").write.parquet(f"{path}/type")
    FX.tasks(spark, SF001).select("task_id", "split", "target").write.parquet(f"{path}/missing")
    for bad in ("type", "missing"):
        with pytest.raises(ValueError, match="declared columns"):
            RD.read_tasks(spark, f"{path}/{bad}")


def test_task_store_reads_only_its_folders(spark):
    path = scratch_dir(spark, "store")
    ST.write_task_store(FX.tasks(spark, SF001), path, files_per_folder=3)
    store = ST.read_task_store(spark, path)
    fixed = store.where("split = 'test' AND n_nums = 3")
    assert "PartitionFilters: [isnotnull(split" in plan(fixed) and "PushedFilters: []" in plan(fixed)
    sizes = spark.createDataFrame([("test", 3)], "split string, n_nums int").where("n_nums > 0")
    by_table = ST.tasks_of_sizes(store, sizes)
    assert sorted(r.task_id for r in by_table.collect()) == sorted(r.task_id for r in fixed.collect())
    assert "dynamicpruning" in plan(by_table).lower()


def test_token_arrays_are_not_shuffled_for_the_losses(spark):
    path = scratch_dir(spark, "colocated")
    rows = FX.logprob_rollouts(spark, SF001)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with ST.bucket_names(spark, "tokens", "adv") as (a, b):
            tokens = ST.write_bucketed(rows.select(*J.ROW_KEYS, "policy_log_probs"), a, f"{path}/a", J.ROW_KEYS, 4)
            adv = ST.write_bucketed(rows.select(*J.ROW_KEYS, "output_tokens"), b, f"{path}/b", J.ROW_KEYS, 4)
            joined = adv.join(tokens, J.ROW_KEYS)
            assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
            assert joined.count() == rows.count()
        assert not [t.name for t in spark.catalog.listTables() if t.name in (a, b)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_training_step_reports_unmatched_and_ragged_rows(spark):
    rollouts, tasks = FX.logprob_rollouts(spark, SF001), FX.tasks(spark, SF001)
    with pytest.raises(ValueError, match="n_unmatched"):
        J.training_step_job(spark, rollouts, tasks.where("task_id > 5"), scratch_dir(spark, "job"), buckets=2)
    with pytest.raises(ValueError, match="n_ragged"):
        J.training_step_job(spark, rollouts.where("NOT (task_id < 9 AND slot = 3)"), tasks, scratch_dir(spark, "job"), buckets=2)
    paths = J.training_step_job(spark, rollouts, tasks, scratch_dir(spark, "job"), buckets=2)
    tags = {r.tag for p in ("metrics", "eval_metrics") for r in spark.read.parquet(paths[p]).select("tag").distinct().collect()}
    assert {"train/loss", "eval/accuracy", "eval/best_accuracy", "eval/examples_correct"} <= tags


def test_training_step_buckets_grow_with_the_rollouts(spark):
    rollouts, tasks = FX.logprob_rollouts(spark, SF001), FX.tasks(spark, SF001)
    few = J.training_step_job(spark, rollouts, tasks, scratch_dir(spark, "job"), buckets=2)
    many = J.training_step_job(spark, rollouts, tasks, scratch_dir(spark, "job"), buckets=2, bucket_rows=1 + rollouts.count() // 12)
    files = {p: [len(spark.read.parquet(job[p]).inputFiles()) for job in (few, many)] for p in ("tokens", "advantages")}
    assert files == {"tokens": [2, 12], "advantages": [2, 12]}
    a, b = (spark.read.parquet(job["step_metrics"]).select("run_id", "step", F.round("loss", 9)) for job in (few, many))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def _own_rollouts(spark, n_tasks):
    """Groups of four rollouts of own tasks, with token arrays; and the tasks."""
    t = F.col("task_id")
    tasks = spark.range(n_tasks).select(F.col("id").alias("task_id"), (t % 9 + 3).cast("int").alias("target"),
                                        F.array(F.lit(3), (t % 9).cast("int")).alias("nums"))
    answer = F.concat(F.lit("<answer>3 + "), (t % 9 + F.col("slot") % 2).cast("string"), F.lit("</answer>"))
    rows = tasks.select("task_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(3).cast("bigint"))).alias("slot")).select(
        (t % 2).alias("run_id"), F.expr("task_id div 12").alias("step"), "task_id", F.expr("task_id % 12 div 2").alias("prompt_ord"),
        "slot", answer.alias("response"), (t % 7 + F.col("slot")).alias("output_tokens"))
    return FX.with_logprob_arrays(rows), tasks


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {os.path.basename(f) for f in found.split("\n") if re.search(r"shuffle_\d+_\d+_\d+\.data$", f)}


def test_training_step_keeps_no_shuffle_files(spark):
    rollouts, tasks = _own_rollouts(spark, 24)
    before, keep = _shuffle_files(spark), dict(spark.conf.getAll)
    J.training_step_job(spark, rollouts, tasks, scratch_dir(spark, "job"), group_size=4, buckets=2)
    assert dict(spark.conf.getAll) == keep
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_training_step_in_waves_writes_the_same_tables(spark):
    rollouts, tasks = _own_rollouts(spark, 24)
    one, more = (J.training_step_job(spark, rollouts, tasks, scratch_dir(spark, "job"), group_size=4, buckets=5, eval_every=1,
                                     wave_rows=n) for n in (1 << 26, 47))
    assert [len(spark.read.parquet(job[p]).inputFiles()) for job in (one, more) for p in ("tokens", "advantages")] == [5] * 4
    for name in one:
        a, b = (spark.read.parquet(job[name]) for job in (one, more))
        a, b = (t.select(*[F.round(c, 9).alias(c) if k == "double" else c for c, k in a.dtypes]) for t in (a, b))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0, name
    with pytest.raises(ValueError, match="'n_unmatched': 24"):
        J.training_step_job(spark, rollouts, tasks.where("task_id >= 6"), scratch_dir(spark, "job"), group_size=4, buckets=2, wave_rows=40)
    few, task = _own_rollouts(spark, 1)  # a wave is empty; written over the tables of another run
    paths = J.training_step_job(spark, few, task, os.path.dirname(more["scored"]), group_size=4, buckets=3, wave_rows=2)
    assert [spark.read.parquet(paths[p]).count() for p in ("scored", "tokens", "advantages", "step_metrics")] == [4, 4, 4, 1]


def test_advantages_are_shuffled_once_and_joined_as_they_lie(spark):
    rows, path = _own_rollouts(spark, 40)[0], scratch_dir(spark, "as-they-lie")
    made = []

    def advantages(dealt):
        made.append(A.group_advantages(dealt, reward="output_tokens"))
        return made[-1]

    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with settings(spark, keep), ST.bucket_names(spark, "tokens", "adv") as (a, b):
        tokens = ST.write_bucketed(rows.select(*J.ROW_KEYS, "response_mask"), a, f"{path}/a", A.GROUP_KEYS, 4, J.ROW_KEYS, waves=2)
        adv = ST.write_bucketed(rows.select(*J.ROW_KEYS, "output_tokens"), b, f"{path}/b", A.GROUP_KEYS, 4, J.ROW_KEYS, 2, advantages)
        assert [plan(m).count("Exchange ") for m in made] == [1, 1]
        with settings(spark, J.AS_THEY_LIE):
            joined = adv.join(tokens, J.ROW_KEYS)
            assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
            assert joined.count() == 160


def test_counters_of_a_clean_join(spark):
    joined, seen = attach_tasks_observed(FX.rollouts(spark, SF001), FX.tasks(spark, SF001))
    n = joined.count()
    assert require(seen, n_unmatched=0) == {"n_rollouts": n, "n_unmatched": 0}
    adv, groups = A.observe_groups(A.group_advantages(joined.withColumn("reward", F.lit(1.0))), 8)
    adv.write.format("noop").mode("overwrite").save()
    assert require(groups, n_ragged=0)["n_rows"] == n


def test_batched_map(spark):
    df = spark.range(5000).select("id", F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("text"), F.lit(1).alias("drop_me"),
                                  F.when(F.col("id") % 5 > 0, F.col("id")).alias("maybe"))
    new = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("rows", T.LongType())])
    out = batched_map(df, lambda b: {"n": [len(t) for t in b.column("text").to_pylist()], "rows": [len(b)] * len(b)}, new,
                      remove=["drop_me", "text"], reads=["text"], max_rows=100)
    assert out.columns == ["id", "maybe", "n", "rows"] and out.schema["n"].dataType == T.IntegerType()
    got = out.collect()
    assert len(got) == 5000 and max(r.rows for r in got) <= 100
    assert all(r.n == r.id % 7 and r.maybe == (r.id if r.id % 5 else None) for r in got)
    assert "drop_me" not in plan(out).split("MapInArrow")[1].split("\n")[1]
    assert batched_map(df.where("id < 0"), lambda b: {"n": [], "rows": []}, new).count() == 0
    replaced = batched_map(df, lambda b: {"text": pa.array([1.5] * len(b))}, T.StructType([T.StructField("text", T.DoubleType())]))
    assert dict(replaced.dtypes)["text"] == "double"
    with pytest.raises(ValueError):
        batched_map(df, len, new, remove=["nope"])
    with pytest.raises(Exception, match="entries for"):
        batched_map(df, lambda b: {"n": [1], "rows": [1]}, new).collect()


def test_batches_are_bounded_by_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 1000] * 64 + ["y" * 50_000]})
    parts = list(slices(batch, 1000, 10_000))
    assert sum(map(len, parts)) == 65 and all(p.nbytes <= 10_000 or len(p) == 1 for p in parts)
    assert [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_solution_check(spark):
    nan = float("nan")
    rows = [
        (1, 36, "79 - (60 - 17)", 36.0, True, False), (2, 36, "79 - (60 - 17)", 35.0, True, True), (3, 36, "79 - (60 - 17)", 36.0, False, True),
        (4, 36, "79 -", None, False, False), (5, 36, "79 -", 36.0, False, True), (6, 36, "79 - (60 - 17)", None, True, True),
        (7, 36, None, None, False, False), (8, 36, "79 - (60 - 17)", 36.0, None, True), (9, 36, "79 - (60 - 17)", nan, True, True)]
    df = spark.createDataFrame(rows, "i int, target int, solution string, result double, is_exact boolean, want boolean")
    assert [r.i for r in check_solutions(df).where("mismatch <> want").collect()] == []
