"""ST3's stored manifest and ST2's closing row: retries, restarts, late rows, hot keys, NaN."""

import os
import random

from pyspark.sql import functions as F

from rollscore.operators import metrics as M
from rollscore.streaming import scoring as ST
from rollscore.streaming.manifest import BestManifest, track_best
from rollscore.plans import fixtures as FX
from rollscore.streaming.replay import land_batches, with_closing_row

COLUMNS = "run_id long, category string, step long, score double"


def rows(spark, n=600, seed=1):
    rnd = random.Random(seed)
    data = [(0 if i % 3 else i % 5, "c", i, float("nan") if i % 17 == 0 else rnd.random() * (1 + i / 50)) for i in range(n)]
    return spark.createDataFrame(data, COLUMNS)


def as_set(df):
    return {tuple(r) for r in df.select("run_id", "category", "step", "score").collect()}


def test_any_order_of_batches_gives_the_batch_result(spark):
    hist = rows(spark)
    want = as_set(M.new_bests(hist, chunk_steps=64))
    m = BestManifest(spark, os.path.join(ST.scratch_dir(spark, "best"), "m"), chunk_steps=64)
    for number, part in enumerate((3, 0, 4, 1, 2)):
        assert m.merge(hist.where(F.col("step") % 5 == part), "s", number)
    assert as_set(m.bests()) == want
    late, last = {}, {}
    steps = [(r.run_id, r.step) for r in hist.collect()]
    for part in (3, 0, 4, 1, 2):
        here = [(run, step) for run, step in steps if step % 5 == part]
        for run, step in here:
            late[run] = late.get(run, 0) + (step <= last.get(run, -1))
        for run, step in here:
            last[run] = max(last.get(run, -1), step)
    assert {r.run_id: r.n_late for r in m.seen().collect()} == late and late[0] > 0
    assert m.seen().agg(F.sum("n_rows")).first()[0] == 600
    assert len(m.versions()) <= 2


def test_retry_and_restart_merge_once(spark):
    hist = rows(spark, 200)
    path = os.path.join(ST.scratch_dir(spark, "best"), "m")
    m = BestManifest(spark, path)
    assert m.merge(hist.where("step < 100"), "s", 0)
    before = as_set(m.bests()), sorted(map(tuple, m.seen().collect()))
    assert not m.merge(hist.where("step < 100"), "s", 0)  # retried by Spark
    assert (as_set(m.bests()), sorted(map(tuple, m.seen().collect()))) == before
    # a version without its log was not committed: it is neither read nor an obstacle
    hist.write.parquet(f"{path}/version={m.versions()[-1] + 1}/bests")
    assert as_set(m.bests()) == before[0]
    again = BestManifest(spark, path)
    assert again.merge(hist.where("step >= 100"), "another stream", 0)
    assert as_set(again.bests()) == as_set(M.new_bests(hist))
    assert not again.merge(hist, "s", 0)


def test_first_row_is_best_without_start_value(spark):
    hist = spark.createDataFrame([(1, "c", 5, -3.0), (1, "c", 9, -4.0), (1, "c", 2, -7.0)], COLUMNS)
    m = BestManifest(spark, os.path.join(ST.scratch_dir(spark, "best"), "m"), init=None)
    m.merge(hist.where("step > 2"), "s", 0)
    assert as_set(m.bests()) == {(1, "c", 5, -3.0)}
    m.merge(hist.where("step = 2"), "s", 1)  # late: now the first row of the run
    assert as_set(m.bests()) == {(1, "c", 2, -7.0), (1, "c", 5, -3.0)} == as_set(M.new_bests(hist, init=None))


def test_stream_stops_and_goes_on(spark):
    hist, work = rows(spark, 300), ST.scratch_dir(spark, "best")
    src = os.path.join(work, "src")
    m = BestManifest(spark, os.path.join(work, "m"))
    land_batches(hist.where("step < 150"), src, F.expr("step div 50"))
    track_best(ST.file_stream(spark, src, hist.schema, 1), m, "s", os.path.join(work, "chk"))
    hist.where("step >= 150").coalesce(1).write.mode("append").parquet(os.path.join(src, "later"))
    track_best(ST.file_stream(spark, src, hist.schema, 1), m, "s", os.path.join(work, "chk"))
    assert as_set(m.bests()) == as_set(M.new_bests(hist))


def test_no_python_state_in_the_merge(spark):
    plan = M.new_bests(rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_closing_row_emits_every_window(spark):
    data = spark.range(500).select((F.col("id") % 3).alias("run_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
                                   F.col("id").cast("double").alias("reward"), F.expr("cast(id div 100 as int)").alias("batch"))
    work = ST.scratch_dir(spark, "closing")
    land_batches(with_closing_row(data, "ts", "batch", "'1 day'"), os.path.join(work, "src"), F.col("batch"))
    stream = ST.file_stream(spark, os.path.join(work, "src"), data.schema, 1)
    ST.run_append(ST.step_metrics_by_event_time(stream, delay="5 minutes", window="30 minutes"),
                  os.path.join(work, "out"), os.path.join(work, "chk"))
    got = spark.read.parquet(os.path.join(work, "out"))
    assert got.where("run_id IS NULL").count() == 0
    want = data.groupBy("run_id", F.window("ts", "30 minutes")).count()
    assert got.count() == want.count() and got.agg(F.sum("num_rollouts")).first()[0] == 500


def test_closing_row_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "run_id long, ts timestamp, batch int")
    assert with_closing_row(empty, "ts", "batch", "'1 day'").count() == 0


def test_late_rows_do_not_depend_on_how_arrivals_are_batched(spark):
    hist = rows(spark).withColumn("arrival", F.expr("step div 20 + if(step % 11 = 0, 2, 0)"))
    root = ST.scratch_dir(spark, "best")
    one, some = BestManifest(spark, os.path.join(root, "one")), BestManifest(spark, os.path.join(root, "some"))
    last = hist.agg(F.max("arrival")).first()[0]
    for number in range(last + 1):
        one.merge(hist.where(F.col("arrival") == number).drop("arrival"), "s", number)
    for number in range(0, last + 1, 8):
        some.merge(hist.where(F.col("arrival").between(number, number + 7)), "s", number)
    assert sorted(map(tuple, some.seen().collect())) == sorted(map(tuple, one.seen().collect()))
    assert some.seen().agg(F.sum("n_late")).first()[0] > 0
    assert as_set(some.bests()) == as_set(one.bests()) == as_set(M.new_bests(hist))


def test_files_of_a_replay_do_not_grow_with_its_steps(spark):
    table = spark.range(3000).select(F.col("id").alias("step"), (F.col("id") % 7).alias("v"))
    src = os.path.join(ST.scratch_dir(spark, "replay"), "src")
    ST.replay_files(table, src, by="step", files=5)
    files = sorted((os.path.getmtime(os.path.join(src, f)), f) for f in os.listdir(src) if f.endswith(".parquet"))
    assert len(files) == 5
    spans = [spark.read.parquet(os.path.join(src, f)).agg(F.min("step"), F.max("step")).first() for _, f in files]
    assert spans[0][0] == 0 and spans[-1][1] == 2999 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    out = os.path.join(src, "..", "out")
    ST.run_append(ST.file_stream(spark, src, table.schema, 2), out, os.path.join(src, "..", "chk"))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, table.collect()))


def test_laid_out_rollouts_are_the_same_rows_by_step(spark):
    sf = "/root/testdata/sf0.001"
    laid = FX.rollouts(spark, sf, ranges=6)
    assert sorted(map(tuple, laid.collect())) == sorted(map(tuple, FX.rollouts(spark, sf).collect()))
    spans = laid.groupBy(F.spark_partition_id().alias("p")).agg(F.min("step").alias("a"), F.max("step").alias("b")).orderBy("p").collect()
    assert len(spans) == 6 and all(x.b <= y.a for x, y in zip(spans, spans[1:]))
