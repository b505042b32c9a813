"""Registered queries for token batches, fine-tuning rows, log-softmax,
ratios, surrogate losses, KL and step losses (T1-T14, G9-G13, P13, P16).

Spark keeps one array per sequence and uses higher-order functions; the
DuckDB oracles explode positions and aggregate, an independent route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import losses as L
from ..functions import tokens as TK
from ..functions._util import report_double
from ..operators import advantages as A
from ..operators import losses as LO
from ..operators import tasks as TS
from ..operators import tokens as TO
from ..operators.scoring import score
from . import fixtures as FX
from .oracle import TASK_PARTS, rd
from .q_scoring import ROLL_KEYS, _RK, _rewarded_sql
from .registry import register

_TOK = "CASE WHEN {j} < P THEN (task_id * 17 + ({j}) * 29) % 1000 ELSE (task_id * 13 + slot * 7 + ({j} - P) * 31) % 1000 END"
_TOKEN_CTES = TASK_PARTS + """,
slots AS (SELECT *, CAST(unnest(range(8)) AS BIGINT) AS slot FROM task_parts),
tk AS (SELECT run_id, step, task_id, prompt_ord, slot, 3 + task_id % 5 AS P, 1 + (task_id + slot) % 6 AS O FROM slots),
tkw AS (SELECT *, P + O AS n, max(P + O) OVER (PARTITION BY run_id, step) - 1 AS w FROM tk)"""


def _tok_sql(body: str, extra: str = "") -> str:
    return "WITH " + _TOKEN_CTES.strip() + extra + "\n" + body


def _token_batch(spark: SparkSession, sf: str) -> DataFrame:
    return TO.token_batch(FX.token_rollouts(spark, sf), eos_id=FX.TOKEN_EOS)


register("shift_pad", _tok_sql(
    f"SELECT {_RK}, CAST(w AS BIGINT) AS width, "
    f"string_agg(CAST(CASE WHEN j < n - 1 THEN {_TOK.format(j='j')} ELSE 1000 END AS VARCHAR), ',' ORDER BY j) AS input_ids, "
    f"string_agg(CAST(CASE WHEN j < n - 1 THEN {_TOK.format(j='j + 1')} ELSE 1000 END AS VARCHAR), ',' ORDER BY j) AS labels "
    "FROM pos GROUP BY run_id, step, task_id, slot, w",
    ",\npos AS (SELECT *, unnest(range(w)) AS j FROM tkw)"))(
    lambda spark, sf: _token_batch(spark, sf).select(
        *ROLL_KEYS, F.col("width").cast("bigint").alias("width"),
        TK.ids_text("input_ids").alias("input_ids"), TK.ids_text("labels").alias("labels"))
)

register("response_mask", _tok_sql(
    f"SELECT {_RK}, CAST(P AS BIGINT) AS prompt_len, CAST(n AS BIGINT) AS seq_len, "
    "string_agg(CASE WHEN j >= P - 1 AND j < n - 1 THEN '1' ELSE '0' END, '' ORDER BY j) AS response_mask "
    "FROM pos GROUP BY run_id, step, task_id, slot, P, n",
    ",\npos AS (SELECT *, unnest(range(w)) AS j FROM tkw)"))(
    lambda spark, sf: _token_batch(spark, sf).select(
        *ROLL_KEYS, F.col("prompt_len").cast("bigint").alias("prompt_len"),
        F.col("seq_len").cast("bigint").alias("seq_len"), TK.mask_text("response_mask").alias("response_mask"))
)

_FW = 8
_FW_CTE = (",\nfw AS (SELECT *, unnest(range(" + str(_FW) + ")) AS j FROM tkw),\n"
           "fv AS (SELECT *, CASE WHEN j < n THEN " + _TOK.format(j="j") + " ELSE 1000 END AS x FROM fw)")


def _fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    t = FX.token_rollouts(spark, sf).select(
        *ROLL_KEYS, TK.concat_tokens("prompt_ids", "output_ids").alias("token_ids"),
        F.size("prompt_ids").alias("prompt_len"))
    return TO.fixed_width_rows(t, width=_FW, pad_id=FX.TOKEN_PAD)


register("fixed_width", _tok_sql(
    f"SELECT {_RK}, string_agg(CAST(x AS VARCHAR), ',' ORDER BY j) AS input_ids, "
    "string_agg(CASE WHEN j < n THEN '1' ELSE '0' END, ',' ORDER BY j) AS attention_mask FROM fv "
    "GROUP BY run_id, step, task_id, slot", _FW_CTE))(
    lambda spark, sf: _fixed_width(spark, sf).select(
        *ROLL_KEYS, TK.ids_text("input_ids").alias("input_ids"), TK.ids_text("attention_mask").alias("attention_mask"))
)

register("prompt_masked_labels", _tok_sql(
    f"SELECT {_RK}, string_agg(CAST(CASE WHEN j < P OR x = 1000 THEN -100 ELSE x END AS VARCHAR), ',' ORDER BY j) AS labels, "
    "CAST(count_if(j < P OR x = 1000) AS BIGINT) AS n_masked FROM fv GROUP BY run_id, step, task_id, slot", _FW_CTE))(
    lambda spark, sf: _fixed_width(spark, sf).select(
        *ROLL_KEYS, TK.ids_text("labels").alias("labels"), F.col("n_masked").cast("bigint").alias("n_masked"))
)

register("unmasked_labels", _tok_sql(
    f"SELECT {_RK}, string_agg(CAST(x AS VARCHAR), ',' ORDER BY j) AS labels FROM fv GROUP BY run_id, step, task_id, slot",
    _FW_CTE))(
    lambda spark, sf: TO.fixed_width_rows(
        FX.token_rollouts(spark, sf).select(*ROLL_KEYS, TK.concat_tokens("prompt_ids", "output_ids").alias("token_ids"),
                                            F.size("prompt_ids").alias("prompt_len")),
        width=_FW, pad_id=FX.TOKEN_PAD, mask_prompt=False).select(*ROLL_KEYS, TK.ids_text("labels").alias("labels"))
)

# --- log-softmax over the embeddings table (T8, T9) ------------------------

_EMB_CTES = """WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS z,
                        unnest(range(len(embedding))) AS pos FROM embeddings),
m AS (SELECT vec_id, max(z) AS mx FROM e GROUP BY vec_id),
s AS (SELECT e.vec_id, max(m.mx) AS mx, ln(sum(exp(e.z - m.mx))) AS lse, sum(e.z) AS zs, count(*) AS k,
             max(CASE WHEN e.pos = e.label THEN e.z END) AS zl
      FROM e JOIN m ON e.vec_id = m.vec_id GROUP BY e.vec_id)
"""

register("label_logprob", _EMB_CTES + f"SELECT vec_id, {rd('zl - mx - lse')} AS label_log_prob FROM s")(
    lambda spark, sf: FX.read_spread(spark, sf, "embeddings", "vec_id").select(
        "vec_id", report_double(L.label_log_prob("embedding", "label")).alias("label_log_prob"))
)

register("log_softmax", _EMB_CTES + f"SELECT vec_id, {rd('zs - k * (mx + lse)', 7)} AS log_softmax_sum, "
         f"{rd('-lse')} AS log_softmax_max FROM s")(
    lambda spark, sf: FX.read_spread(spark, sf, "embeddings", "vec_id")
    .select("vec_id", L.log_softmax("embedding").alias("ls"))
    .select("vec_id",
            report_double(F.aggregate("ls", F.lit(0.0), lambda a, x: a + x), 7).alias("log_softmax_sum"),
            report_double(F.array_max("ls")).alias("log_softmax_max"))
)

# --- ratios, surrogate, masked means, KL, step loss (T10-T14, G9-G13) -------

_P = "-((task_id * 31 + slot * 7 + i * 13) % 50) / 10.0::DOUBLE"
_O = "-((task_id * 11 + slot * 5 + i * 17) % 50) / 10.0::DOUBLE"
_Q = "-((task_id * 19 + slot * 3 + i * 23) % 50) / 10.0::DOUBLE"
_LOSS_CTES = f""",
adv AS (SELECT run_id, step, task_id, slot, prompt_ord, (r - avg(r) OVER g) / (stddev_pop(r) OVER g + 1e-6) AS a,
        r - avg(r) OVER g AS ac
        FROM rewarded WINDOW g AS (PARTITION BY run_id, step, task_id)),
tok AS (SELECT *, unnest(range(4 + task_id % 9)) AS i FROM adv),
tv AS (SELECT *, {_P} AS p, {_O} AS o, {_Q} AS q, i >= task_id % 3 AS m FROM tok),
tl AS (SELECT *, exp(p - o) AS ratio,
              -least(a * exp(p - o), a * least(greatest(exp(p - o), 0.8), 1.2)) AS tl,
              -least(ac * exp(p - o), ac * least(greatest(exp(p - o), 0.8), 1.2)) AS tlc FROM tv),
seq AS (SELECT run_id, step, task_id, slot, prompt_ord,
               sum(CASE WHEN m THEN tl ELSE 0.0 END) / greatest(count_if(m), 1) AS seq_grpo,
               sum(CASE WHEN m THEN tlc ELSE 0.0 END) / 256.0 AS seq_dr,
               sum(CASE WHEN m THEN tl + 0.01 * (p - q) ELSE 0.0 END) / greatest(count_if(m), 1) AS seq_kl_loss,
               sum(CASE WHEN m THEN p - q ELSE 0.0 END) / greatest(count_if(m), 1) AS seq_kl,
               sum(tl) AS loss_sum, min(tl) AS loss_min, max(tl) AS loss_max
        FROM tl GROUP BY run_id, step, task_id, slot, prompt_ord)"""


def _loss_sql(body: str) -> str:
    return _rewarded_sql("hybrid", body, _LOSS_CTES)


def _with_advantage(spark: SparkSession, sf: str, loss_type: str = "grpo") -> DataFrame:
    """Advantages on narrow rows, token arrays attached after the window:
    per-token arrays never go through a shuffle."""
    scored = score(FX.rollouts_with_tasks(spark, sf), reward="hybrid", scale=5.0)
    narrow = scored.select("run_id", "step", "task_id", "prompt_ord", "slot", "reward", "output_tokens")
    return FX.with_logprob_arrays(A.group_advantages(narrow, normalize_by_std=A.normalizes_by_std(loss_type), eps=1e-6))


def _seq(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return LO.sequence_losses(_with_advantage(spark, sf, kw["loss_type"]), clip_range=0.2, **kw)


_RATIO_COLUMNS = ("ratio_mean", "ratio_std", "ratio_min", "ratio_max", "log_ratio_mean", "log_ratio_max")


def _ratio_sql(where: str = "") -> str:
    return _loss_sql(
        f"SELECT run_id, step, {rd('avg(ratio)')} AS ratio_mean, {rd('stddev_samp(ratio)')} AS ratio_std, "
        f"{rd('min(ratio)')} AS ratio_min, {rd('max(ratio)')} AS ratio_max, {rd('avg(p - o)')} AS log_ratio_mean, "
        f"{rd('max(p - o)')} AS log_ratio_max FROM tl {where}GROUP BY run_id, step")


def _ratio_query(mask: str | None):
    return lambda spark, sf: LO.ratio_stats(FX.logprob_rollouts(spark, sf), mask=mask, clamp_log_ratio=True).select(
        "run_id", "step", *[report_double(F.col(c)).alias(c) for c in _RATIO_COLUMNS])


register("ratio_stats", _ratio_sql())(_ratio_query(None))
register("ratio_stats_masked", _ratio_sql("WHERE m "))(_ratio_query("response_mask"))


def _surrogate(spark: SparkSession, sf: str) -> DataFrame:
    adv = _with_advantage(spark, sf)
    ratio = L.prob_ratio(F.col("policy_log_probs"), F.col("old_log_probs"))
    tl = L.clipped_surrogate(F.col("advantage"), ratio, F.lit(0.2))
    out = adv.select(*ROLL_KEYS, tl.alias("tl"))
    return out.select(
        *ROLL_KEYS,
        report_double(F.aggregate("tl", F.lit(0.0), lambda a, x: a + x)).alias("loss_sum"),
        report_double(F.array_min("tl")).alias("loss_min"),
        report_double(F.array_max("tl")).alias("loss_max"),
    )


register("surrogate_loss", _loss_sql(
    f"SELECT {_RK}, {rd('loss_sum')} AS loss_sum, {rd('loss_min')} AS loss_min, {rd('loss_max')} AS loss_max FROM seq"))(
    _surrogate
)

register("loss_grpo", _loss_sql(
    f"SELECT run_id, step, {rd('avg(seq_grpo)')} AS loss, count(*) AS num_sequences FROM seq GROUP BY run_id, step"))(
    lambda spark, sf: LO.batch_loss(_seq(spark, sf, loss_type="grpo")).select(
        "run_id", "step", report_double(F.col("loss")).alias("loss"), "num_sequences")
)

register("loss_dr_grpo", _loss_sql(
    f"SELECT run_id, step, {rd('avg(seq_dr)')} AS loss, count(*) AS num_sequences FROM seq GROUP BY run_id, step"))(
    lambda spark, sf: LO.batch_loss(_seq(spark, sf, loss_type="dr_grpo", max_completion_length=256)).select(
        "run_id", "step", report_double(F.col("loss")).alias("loss"), "num_sequences")
)


def _kl(spark: SparkSession, sf: str) -> DataFrame:
    seqs = _seq(spark, sf, loss_type="grpo", ref_lp="ref_log_probs", kl_coef=0.01)
    return seqs.groupBy("run_id", "step").agg(
        report_double(F.avg("seq_loss")).alias("loss"), report_double(F.avg("seq_kl")).alias("kl_mean"))


register("kl_loss", _loss_sql(
    f"SELECT run_id, step, {rd('avg(seq_kl_loss)')} AS loss, {rd('avg(seq_kl)')} AS kl_mean FROM seq GROUP BY run_id, step"))(
    _kl
)

_MICRO = TS.micro_size(128, 32)  # rollout batch 128, accumulation 32 -> 4 rows


def _step_loss(spark: SparkSession, sf: str) -> DataFrame:
    seqs = _seq(spark, sf, loss_type="grpo", gradient_accumulation_steps=32)
    seqs = seqs.withColumn("micro_batch", TS.micro_batch_id("prompt_ord", "slot", 8, _MICRO))
    return LO.step_loss(seqs).select(
        "run_id", "step", report_double(F.col("step_loss")).alias("step_loss"), "num_micro_batches")


register("step_loss", _loss_sql(
    f", micro AS (SELECT run_id, step, (prompt_ord * 8 + slot) // {_MICRO} AS mb, avg(seq_grpo) / 32.0 AS ml "
    "FROM seq GROUP BY run_id, step, mb) "
    f"SELECT run_id, step, {rd('sum(ml) / count(*)')} AS step_loss, count(*) AS num_micro_batches "
    "FROM micro GROUP BY run_id, step"))(_step_loss)

register("microbatch", "WITH " + TASK_PARTS.strip() + ",\nslots AS (SELECT *, CAST(unnest(range(8)) AS BIGINT) AS slot FROM task_parts)\n"
         f"SELECT {_RK}, CAST((prompt_ord * 8 + slot) // {_MICRO} AS BIGINT) AS micro_batch FROM slots")(
    lambda spark, sf: FX.rollouts(spark, sf).select(
        *ROLL_KEYS, TS.micro_batch_id("prompt_ord", "slot", 8, _MICRO).alias("micro_batch"))
)

register("lr_schedule", "WITH " + TASK_PARTS.strip() +
         "\nSELECT DISTINCT step, least(1.0, step / greatest(1, 10))::DOUBLE AS lr_factor, "
         "least(1.0, step / greatest(1, 0))::DOUBLE AS lr_factor_no_warmup FROM task_parts")(
    lambda spark, sf: FX.task_parts(spark, sf).select("step").distinct().select(
        "step", L.lr_factor(F.col("step"), 10).alias("lr_factor"), L.lr_factor(F.col("step"), 0).alias("lr_factor_no_warmup"))
)
