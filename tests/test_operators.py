"""Invariants, sources/sinks, jobs, streaming and plan checks."""

import os
import re
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollscore.functions import losses as L
from rollscore.functions import tokens as TK
from rollscore.operators import advantages as A
from rollscore.operators import metrics as M
from rollscore.operators import tasks as TS
from rollscore.operators import tokens as TO
from rollscore.operators.scoring import score, score_all
from rollscore.plans import catalog
from rollscore.plans import fixtures as FX
from rollscore.plans import jobs as J
from rollscore.sources import readers as RD
from rollscore.sources import sinks as SK

SF001 = "/root/testdata/sf0.001"


def test_advantage_golden(spark):
    rows = [(0, 0, 0, s, r) for s, r in enumerate([1.0, 0.1, 0.1, 0.0])]
    df = spark.createDataFrame(rows, "run_id long, step long, task_id long, slot long, reward double")
    for strategy in ("window", "aggregate"):
        w1 = [r.advantage for r in A.group_advantages(df, eps=1e-6, strategy=strategy).orderBy("slot").collect()]
        assert w1 == pytest.approx([1.723277, -0.492365, -0.492365, -0.738547], abs=1e-6)
    c = [r.advantage for r in A.group_advantages(df, normalize_by_std=False).orderBy("slot").collect()]
    assert c == pytest.approx([0.7, -0.2, -0.2, -0.3], abs=1e-9)
    w2 = [r.advantage for r in A.group_advantages(df, eps=1e-4, stabilized=True).orderBy("slot").collect()]
    assert w2 == pytest.approx([1.723281, -0.492366, -0.492366, -0.738549], abs=1e-6)


def test_fixture_invariants(spark):
    r = FX.rollouts_with_tasks(spark, SF001)
    scored = score_all(r, {"sparse": ("sparse", None), "format": ("format", None),
                           "s5": ("signed5", 5.0), "s10": ("signed10", 10.0), "reward": ("hybrid", 5.0)})
    bad = scored.where(~F.col("sparse").isin(0.0, 0.1, 1.0) | (F.col("format") > 1.0)
                       | (F.abs(F.col("s5")) > 1.0) | (F.abs(F.col("s10")) > 1.0)).count()
    assert bad == 0
    adv = A.group_advantages(scored)
    sums = adv.groupBy("run_id", "step", "task_id").agg(F.sum("advantage").alias("s"))
    assert sums.where(F.abs("s") > 1e-9).count() == 0
    assert A.ragged_groups(scored, 8).count() == 0


def test_clip_never_lowers_loss(spark):
    df = FX.logprob_rollouts(spark, SF001).withColumn("advantage", (F.col("slot") - 3.5) / 2.0)
    ratio = L.prob_ratio("policy_log_probs", "old_log_probs")
    clipped = L.clipped_surrogate(F.col("advantage"), ratio, F.lit(0.2))
    unclipped = F.transform(ratio, lambda r: -F.col("advantage") * r)
    diff = F.zip_with(clipped, unclipped, lambda a, b: a - b)
    assert df.select(F.array_min(diff).alias("m")).where(F.col("m") < -1e-12).count() == 0


def test_masked_means_agree_when_lengths_equal(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], [False, True, True, False])], "x array<double>, m array<boolean>")
    row = df.select(L.masked_mean("x", "m").alias("a"), L.masked_mean_constant("x", "m", 2).alias("b")).first()
    assert row.a == row.b == 2.5
    empty = spark.createDataFrame([([1.0], [False])], "x array<double>, m array<boolean>")
    assert empty.select(L.masked_mean("x", "m")).first()[0] == 0.0


def test_log_softmax_sums_to_one(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet").select(L.log_softmax("embedding").alias("ls"))
    tot = df.select(F.aggregate(F.transform("ls", lambda x: F.exp(x)), F.lit(0.0), lambda a, x: a + x).alias("p"))
    assert tot.where(F.abs(F.col("p") - 1.0) > 1e-9).count() == 0


def test_token_functions(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5])], "p array<int>, o array<int>")
    t = TK.concat_tokens("p", "o")
    row = df.select(TK.shift_inputs(t).alias("i"), TK.shift_labels(t).alias("l"),
                    TK.response_mask(F.lit(3), F.lit(5), F.lit(6)).alias("m"),
                    TK.pad_right(TK.shift_inputs(t), F.lit(6), F.lit(0)).alias("pi")).first()
    assert row.i == [1, 2, 3, 4] and row.l == [2, 3, 4, 5]
    assert row.m == [False, False, True, True, False, False]
    assert row.pi == [1, 2, 3, 4, 0, 0]
    assert df.select(TK.response_mask(F.lit(1), F.lit(1), F.lit(0))).first()[0] == []


def test_running_best_chunks_equal_plain_window(spark):
    hist = FX.metric_history(spark, SF001)
    w = Window.partitionBy("run_id", "category").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    plain = hist.withColumn("p", F.max("score").over(w)).where(F.col("score") > F.greatest(F.col("p"), F.lit(0.0)))
    for chunk in (3, 50, 1 << 20):
        got = M.new_bests(hist, init=0.0, chunk_steps=chunk)
        assert got.select("run_id", "category", "step").exceptAll(plain.select("run_id", "category", "step")).count() == 0
        assert got.count() == plain.count()


def test_sources_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="rs-io-")
    tasks = FX.tasks(spark, SF001)
    stats = J.easy_set_job(tasks, os.path.join(d, "easy"), k=3)
    back = RD.read_tasks(spark, os.path.join(d, "easy"), fmt="json")
    assert back.count() == tasks.where(F.col("n_nums") == 3).count()
    assert {r.split for r in stats.collect()} == {"train", "test"}
    bad = os.path.join(d, "bad.jsonl")
    with open(bad, "w") as f:
        f.write('{"target": 5, "nums": [1, 2, 3]}\nnot json\n')
    permissive = RD.read_jsonl(spark, bad, RD.schemas.TASK_JSON, mode="PERMISSIVE")
    rows = permissive.select("target", "_corrupt_record").collect()
    assert sum(r._corrupt_record is not None for r in rows) == 1 and len(rows) == 2
    with pytest.raises(Exception):
        RD.read_jsonl(spark, bad, RD.schemas.TASK_JSON).collect()
    card = SK.dataset_card(FX.sft_rows(spark, SF001)).first()
    assert f"- **Train examples**: {card.num_train}" in card.card and "# Countdown SFT Dataset" in card.card


def test_training_step_job(spark):
    d = tempfile.mkdtemp(prefix="rs-job-")
    paths = J.training_step_job(spark, FX.logprob_rollouts(spark, SF001), FX.tasks(spark, SF001), d)
    metrics = spark.read.parquet(paths["metrics"])
    assert metrics.select("tag").distinct().count() == 4
    n_steps = FX.rollouts(spark, SF001).select("run_id", "step").distinct().count()
    assert spark.read.parquet(paths["step_metrics"]).count() == n_steps


def test_sft_prep_job(spark):
    sft = FX.sft_rows(spark, SF001)

    def tokenize(text):
        return F.transform(F.split(text, " "), lambda w: (F.abs(F.hash(w)) % 1000).cast("int"))

    out = J.sft_prep_job(sft, tokenize, width=64, pad_id=1000)
    row = out.select("input_ids", "attention_mask", "labels", "n_masked", "prompt_len").first()
    assert len(row.input_ids) == len(row.labels) == len(row.attention_mask) == 64
    assert row.n_masked >= min(row.prompt_len, 64)


def test_stream_equals_batch(spark):
    stream = catalog.QUERIES["stream_best"](spark, SF001)
    batch = catalog.QUERIES["best_so_far_c"](spark, SF001)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    scoring = _plan(catalog.QUERIES["reward_hybrid"](spark, SF001))
    assert scoring.count("ArrowEvalPython") == 1
    adv = _plan(catalog.QUERIES["advantage_grpo"](spark, SF001))
    assert adv.count("ArrowEvalPython") == 1 and len(re.findall(r"Window ", adv)) == 1
    for q in ("shift_pad", "label_logprob", "prompt_a", "best_so_far_c", "ratio_stats"):
        assert "ArrowEvalPython" not in _plan(catalog.QUERIES[q](spark, SF001)), q
    top = _plan(catalog.QUERIES["top_examples"](spark, SF001))
    assert "WindowGroupLimit" in top and top.count("ArrowEvalPython") == 1
    scan = catalog.QUERIES["word_count"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in scan


def test_user_reward_hook(spark):
    from rollscore.functions.rewards import REWARDS, register_reward
    register_reward("exact_only", lambda a, scale=None: F.when(a.numbers_ok & (a.distance < 1e-6), 1.0).otherwise(0.0))
    try:
        df = spark.createDataFrame([(36, [79, 17, 60], "<answer>79 - 60 + 17</answer>")],
                                   "target int, nums array<int>, response string")
        assert score(df, reward="exact_only").first().reward == 1.0
    finally:
        REWARDS.pop("exact_only")
    with pytest.raises(KeyError):
        score(df, reward="nope")


def test_unknown_loss_type_raises(spark):
    from rollscore.operators import losses as LO
    df = FX.logprob_rollouts(spark, SF001).withColumn("advantage", F.lit(1.0))
    with pytest.raises(ValueError, match="Unknown loss type"):
        LO.sequence_losses(df, loss_type="ppo")


def test_read_sft_splits_and_tokenizer(spark):
    d = tempfile.mkdtemp(prefix="rs-sft-")
    sft = FX.sft_rows(spark, SF001)
    for split in ("train", "validation"):
        sft.where(F.col("split") == split).drop("split", "task_id", "slot").write.json(os.path.join(d, split))
    both = RD.read_sft_splits(spark, os.path.join(d, "train"), os.path.join(d, "validation"))
    assert both.count() == sft.count()
    from rollscore.functions.tokenize import arrow_tokenizer, output_token_count
    tok = arrow_tokenizer(lambda texts: [[len(w) for w in t.split()] if t is not None else None for t in texts])
    row = both.select(output_token_count("completion", tok).alias("a"), output_token_count("completion").alias("b")).first()
    assert row.a == row.b


def test_event_time_stream_matches_batch_for_closed_windows(spark):
    from rollscore.streaming import scoring as ST
    from rollscore.streaming.replay import land_batches
    work = ST.scratch_dir(spark, "test-event-time")
    rows = FX.rollouts(spark, SF001).withColumn("ts", F.timestamp_seconds(F.col("step") * 60).cast("timestamp_ntz"))
    src = os.path.join(work, "src")
    land_batches(rows, src, F.expr("step div 4"))
    stream = ST.file_stream(spark, src, rows.schema, max_files_per_trigger=1)
    scored = ST.score_stream(stream, FX.tasks(spark, SF001))
    sink = os.path.join(work, "out")
    ST.run_append(ST.step_metrics_by_event_time(scored, delay="2 minutes").select(
        "run_id", F.col("window.start").alias("start"), "num_rollouts", "reward_mean"), sink, os.path.join(work, "chk"))
    got = spark.read.parquet(sink)
    batch = (score(FX.rollouts_with_tasks(spark, SF001), reward="hybrid")
             .withColumn("start", F.timestamp_seconds(F.col("step") * 60))
             .groupBy("run_id", "start").agg(F.count(F.lit(1)).alias("b_n"), F.avg("reward").alias("b_mean")))
    assert got.count() > 0
    joined = got.join(batch, ["run_id", "start"])
    assert joined.count() == got.count()
    assert joined.where((F.col("num_rollouts") != F.col("b_n"))
                        | (F.abs(F.col("reward_mean") - F.col("b_mean")) > 1e-12)).count() == 0
    assert got.count() < batch.count()  # windows after the final watermark are not emitted yet


def test_running_best_with_a_hot_run(spark):
    # One (run, category) holds most of the history; chunk windows stay bounded.
    hist = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 3 + 1).cast("long").alias("run_id"),
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("category"),
        F.col("id").alias("step"),
        ((F.col("id") * 7919) % 10007 / 100.0).alias("score"),
    )
    w = Window.partitionBy("run_id", "category").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    plain = hist.withColumn("p", F.max("score").over(w)).where(F.col("score") > F.greatest(F.col("p"), F.lit(0.0)))
    got = M.new_bests(hist, init=0.0, chunk_steps=500)
    assert got.select("run_id", "category", "step").exceptAll(plain.select("run_id", "category", "step")).count() == 0
    assert got.count() == plain.count()
    per_window = hist.groupBy("run_id", "category", F.floor(F.col("step") / 500)).count()
    assert per_window.agg(F.max("count")).first()[0] <= 500


def test_nan_scores_are_never_best(spark):
    from rollscore.operators.metrics import final_best, running_best

    rows = [("r", "c", i, s) for i, s in enumerate([0.5, float("nan"), 0.9, 0.7])]
    history = spark.createDataFrame(rows, "run_id string, category string, step long, score double")
    assert [r.is_best for r in running_best(history).orderBy("step").collect()] == [True, False, True, False]
    assert [r.is_best for r in running_best(history, init=None).orderBy("step").collect()] == [True, False, True, False]
    best = final_best(history).first()
    assert (best.best_score, best.best_step) == (0.9, 2)


def test_split_needs_a_split_column(spark, tmp_path):
    import pytest

    from rollscore.sources.readers import read_tasks

    spark.createDataFrame([(1, [2, 3])], "target long, nums array<long>").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        read_tasks(spark, str(tmp_path / "t"), split="test")


def test_advantages_follow_the_loss_type():
    import pytest

    from rollscore.operators.advantages import normalizes_by_std

    assert normalizes_by_std("grpo") and not normalizes_by_std("dr_grpo")
    with pytest.raises(ValueError):
        normalizes_by_std("other")


def test_whole_table_queries_leave_nothing_out(spark):
    from rollscore.plans import fixtures as FX
    from rollscore.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    categories = lambda df: {r[0] for r in df.select("category").distinct().collect()}
    assert categories(QUERIES["best_so_far_b"](spark, sf)) == categories(FX.metric_history(spark, sf)) != {"click"}
    turns = FX.read_table(spark, sf, "conversations")
    assert QUERIES["text_answer_null_path"](spark, sf).count() == turns.count() > turns.where("role = 'assistant'").count()
    assert QUERIES["group_expand"](spark, sf).count() == 8 * FX.tasks(spark, sf).count()
    joined = sum(r.n_rows for r in QUERIES["rollout_task_join"](spark, sf).collect())
    assert joined == FX.rollouts(spark, sf).count()


def test_token_bounds(spark, tmp_path):
    path = f"{tmp_path}/rollouts"
    spark.createDataFrame([(i, n) for i, n in enumerate([0, 7, 8, 40, 41, None])], "slot int, output_tokens long").write.parquet(path)
    rows = spark.read.parquet(path)
    slots = lambda *bounds: sorted(r.slot for r in TS.token_bounds(rows, *bounds).collect())
    assert slots(8, 40) == [2, 3] and slots(8) == [2, 3, 4] and slots(None, 8) == [0, 1, 2] and slots() == list(range(6))
    plan = TS.token_bounds(rows, 8, 40)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(output_tokens,8)" in plan and "LessThanOrEqual(output_tokens,40)" in plan
    with pytest.raises(ValueError):
        TS.token_bounds(rows, 9, 8)


SESSION = """
from pyspark.sql import SparkSession
from rollscore.session import build_session
if {running}:
    SparkSession.builder.master("local[1]").config("spark.sql.session.timeZone", "Asia/Tokyo").getOrCreate()
s = build_session("local[1]", shuffle_partitions=3, extra_conf={{"spark.driver.memory": "700m"}})
print([s.conf.get("spark.sql." + k) for k in ("session.timeZone", "shuffle.partitions", "execution.arrow.pyspark.enabled")])
"""


@pytest.mark.parametrize("running", [False, True])
def test_configured_settings_win_over_defaults(running):
    submitted = "--conf spark.ui.enabled=false " + ("" if running else "--conf spark.sql.session.timeZone=Asia/Tokyo ") + "pyspark-shell"
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"} | {"PYSPARK_SUBMIT_ARGS": submitted}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SESSION.format(running=running)], env=env, cwd=root, capture_output=True, text=True, timeout=120)
    assert "['Asia/Tokyo', '3', 'true']" in out.stdout, out.stderr[-2000:]


def test_token_lengths_of_missing_ids(spark):
    rows = [(1, 1, [1, 2], [3]), (1, 1, None, [4, 5, 6, 7]), (1, 2, [8], None), (1, 2, [], [9, 10])]
    df = spark.createDataFrame(rows, "run_id int, step int, prompt_ids array<int>, output_ids array<int>")
    want = df.select("*", F.size(F.concat("prompt_ids", "output_ids")).alias("want"))
    batch = TO.token_batch(want, eos_id=0)
    assert batch.where("NOT seq_len <=> want").count() == 0 and batch.count() == 4
    plan = _plan(TO.token_batch(df, eos_id=0).select("step", "response_mask"))
    assert "concat(prompt_ids" not in plan


def test_mask_by_runs(spark):
    lengths = [(p, n, w) for p in (None, 0, 1, 3, 7) for n in (None, 0, 1, 2, 5, 9) for w in (0, 1, 4, 8)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(lengths)], "i int, p int, n int, w int")
    each = F.transform(F.array_repeat(F.lit(False), F.col("w")), lambda _, i: (i >= F.col("p") - 1) & (i < F.col("n") - 1))
    text = F.array_join(F.transform("each", lambda b: F.when(b, "1").otherwise("0")), "")
    got = df.select("*", TK.response_mask(F.col("p"), F.col("n"), F.col("w")).alias("m"), each.alias("each"))
    got = got.select("*", TK.mask_text("m").alias("t"), text.alias("want"))
    assert got.where("m <=> each AND t <=> want").count() == len(lengths)
