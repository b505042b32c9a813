"""Registered queries for answer parsing, rewards, evaluation summaries and
advantages; each has a DuckDB oracle that states the expected result
independently.

Every query reads whole driver tables (or tables Spark derives from them),
so its work grows with the scale factor. Doubles in reports are rounded to
1e-9 (:func:`report_double`) in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions._util import report_double
from ..operators import advantages as A
from ..operators import evals as E
from ..operators.scoring import score, stage_answers
from . import fixtures as FX
from .oracle import ROLLOUT_PARTS, rd, reward_sql, with_ctes

from .registry import ORACLES, Query, register


ROLL_KEYS = ["run_id", "step", "task_id", "slot"]
_RK = ", ".join(ROLL_KEYS)


def _staged(spark: SparkSession, sf: str, strategy: str = "batch") -> DataFrame:
    return stage_answers(FX.rollouts_with_tasks(spark, sf), eval_strategy=strategy)


# --- F1-F8: answer parsing and checks ------------------------------------

register("extract_answer", with_ctes(ROLLOUT_PARTS, f"SELECT {_RK}, x_equation AS equation FROM answers"))(
    lambda spark, sf: _staged(spark, sf).select(*ROLL_KEYS, "equation")
)

register("validate_numbers", with_ctes(ROLLOUT_PARTS,
    f"SELECT {_RK}, CASE WHEN x_equation IS NULL THEN false ELSE x_numbers_ok END AS numbers_ok FROM answers"))(
    lambda spark, sf: _staged(spark, sf).select(*ROLL_KEYS, "numbers_ok")
)

register("evaluate_equation", with_ctes(ROLLOUT_PARTS, f"SELECT {_RK}, {rd('x_result')} AS result FROM answers"))(
    lambda spark, sf: _staged(spark, sf).select(*ROLL_KEYS, report_double(F.col("result")).alias("result"))
)

register("evaluate_equation_distinct", ORACLES["evaluate_equation"])(
    lambda spark, sf: _staged(spark, sf, "distinct").select(*ROLL_KEYS, report_double(F.col("result")).alias("result"))
)

register("matched_numbers", with_ctes(ROLLOUT_PARTS,
    f"SELECT {_RK}, CASE WHEN x_equation IS NULL THEN 0 ELSE x_n_matched END AS n_matched, "
    f"{rd('CASE WHEN x_equation IS NULL THEN 0 ELSE x_n_matched END / n_nums')} AS matched_share FROM answers"))(
    lambda spark, sf: _staged(spark, sf).select(
        *ROLL_KEYS, "n_matched",
        report_double(F.try_divide(F.col("n_matched").cast("double"), F.col("n_nums").cast("double"))).alias("matched_share"),
    )
)

register("tag_flags", with_ctes(ROLLOUT_PARTS,
    f"SELECT {_RK}, kind <> 2 AS has_answer, x_has_think AS has_think, "
    f"kind <> 2 AND x_has_think AS has_both FROM answers"))(
    lambda spark, sf: FX.rollouts(spark, sf).select(
        *ROLL_KEYS,
        X.has_answer_tags("response").alias("has_answer"),
        X.has_think_tags("response").alias("has_think"),
        (X.has_answer_tags("response") & X.has_think_tags("response")).alias("has_both"),
    )
)

_RE2_NOT_WS = X.NOT_WS_EXPLICIT  # RE2 has no White_Space property; same set listed

register("word_count",
    f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{_RE2_NOT_WS}+')) AS BIGINT) AS n_words FROM documents")(
    lambda spark, sf: FX.read_spread(spark, sf, "documents", "doc_id").select(
        "doc_id", X.word_count("text").cast("bigint").alias("n_words"))
)

register("text_answer_null_path",
    "SELECT conv_id, turn, role, CAST(NULL AS VARCHAR) AS equation, "
    "contains(text, '<answer>') AND contains(text, '</answer>') AS has_answer, "
    "contains(text, '<think>') AND contains(text, '</think>') AS has_think FROM conversations")(
    lambda spark, sf: FX.read_spread(spark, sf, "conversations", "conv_id").select(
        "conv_id", "turn", "role", X.extract_answer("text").alias("equation"),
        X.has_answer_tags("text").alias("has_answer"), X.has_think_tags("text").alias("has_think"))
)

# --- R0-R6: reward rules ---------------------------------------------------

_REWARD_SCALES = {"sparse": None, "hybrid": 5.0, "graded": 5.0, "format": None, "reason": 5.0,
                  "signed5": 5.0, "signed10": 10.0}


def _reward_query(rule: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        scored = score(FX.rollouts_with_tasks(spark, sf), reward=rule, scale=_REWARD_SCALES[rule])
        return scored.select(*ROLL_KEYS, report_double(F.col("reward")).alias("reward"))

    return q


for _rule in _REWARD_SCALES:
    register(f"reward_{_rule}", with_ctes(ROLLOUT_PARTS, f"SELECT {_RK}, {rd(reward_sql(_rule))} AS reward FROM answers"))(
        _reward_query(_rule)
    )

# --- G1/G2: evaluation summaries -------------------------------------------

_SUMMARY_RULE = {"exact": "hybrid", "remainder": "graded", "range": "signed10"}


def _bucket_sql(rule: str) -> tuple[str, str, str]:
    c = "abs(r - 1.0) < 1e-8"
    f0 = "abs(r - 0.0) < 1e-8"
    if rule == "exact":
        return c, "abs(r - 0.1) < 1e-8", f0
    if rule == "remainder":
        return c, f"NOT ({c}) AND NOT ({f0})", f0
    return c, "r > 0.0 AND r < 1.0 - 1e-8", "r <= 0.0"


def _summary_sql(rule: str) -> str:
    c, p, f = _bucket_sql(rule)
    body = f"""
, rewarded AS (SELECT run_id, step, output_tokens, {reward_sql(_SUMMARY_RULE[rule])} AS r FROM answers)
SELECT run_id, step, {rd('avg(r)')} AS mean_reward, {rd('coalesce(stddev_samp(r), 0.0)')} AS std_reward,
       count(*) AS num_examples, CAST(count_if({c}) AS BIGINT) AS count_correct, CAST(count_if({p}) AS BIGINT) AS count_partial,
       CAST(count_if({f}) AS BIGINT) AS count_failed, {rd('CAST(count_if(' + c + ') AS DOUBLE) / count(*) * 100.0')} AS accuracy,
       {rd('avg(output_tokens)')} AS avg_output_tokens
FROM rewarded GROUP BY run_id, step"""
    return "WITH " + ROLLOUT_PARTS.strip() + body


def _summary_query(rule: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        scored = score(FX.rollouts_with_tasks(spark, sf), reward=_SUMMARY_RULE[rule])
        s = E.eval_summary(scored, ("run_id", "step"), rule)
        return s.select(
            "run_id", "step",
            *[report_double(F.col(c)).alias(c) for c in ("mean_reward", "std_reward")],
            "num_examples", "count_correct", "count_partial", "count_failed",
            report_double(F.col("accuracy")).alias("accuracy"),
            report_double(F.col("avg_output_tokens")).alias("avg_output_tokens"),
        )

    return q


for _r in _SUMMARY_RULE:
    register(f"eval_summary_{_r}", _summary_sql(_r))(_summary_query(_r))


# --- W1/W2, G4/G5: advantages and reward metadata ----------------------------



def _rewarded_sql(rule: str, body: str, extra_ctes: str = "") -> str:
    return ("WITH " + ROLLOUT_PARTS.strip()
            + f",\nrewarded AS (SELECT run_id, step, task_id, slot, prompt_ord, output_tokens, "
            + f"CAST({reward_sql(rule)} AS DOUBLE) AS r FROM answers)" + extra_ctes + "\n" + body)


def _scored(spark: SparkSession, sf: str, rule: str) -> DataFrame:
    return score(FX.rollouts_with_tasks(spark, sf), reward=rule, scale=_REWARD_SCALES[rule])


_ADV_SQL = {
    "grpo": "(r - avg(r) OVER g) / (stddev_pop(r) OVER g + 1e-6)",
    "centered": "r - avg(r) OVER g",
    "clamped": "greatest(-10.0, least(10.0, (r - avg(r) OVER g) / greatest(stddev_pop(r) OVER g, 1e-4)))",
}
_ADV_ARGS = {
    "grpo": dict(rule="hybrid", normalize_by_std=True, eps=1e-6, stabilized=False),
    "centered": dict(rule="hybrid", normalize_by_std=False, eps=1e-6, stabilized=False),
    "clamped": dict(rule="signed10", normalize_by_std=True, eps=1e-4, stabilized=True),
}


def _adv_query(variant: str) -> Query:
    args = dict(_ADV_ARGS[variant])
    rule = args.pop("rule")

    def q(spark: SparkSession, sf: str) -> DataFrame:
        adv = A.group_advantages(_scored(spark, sf, rule), **args)
        return adv.select(*ROLL_KEYS, report_double(F.col("reward")).alias("reward"),
                          report_double(F.col("advantage")).alias("advantage"))

    return q


for _v, _expr in _ADV_SQL.items():
    register(f"advantage_{_v}", _rewarded_sql(
        _ADV_ARGS[_v]["rule"],
        f"SELECT {_RK}, {rd('r')} AS reward, {rd(_expr)} AS advantage FROM rewarded "
        f"WINDOW g AS (PARTITION BY run_id, step, task_id)"))(_adv_query(_v))

register("reward_metadata", _rewarded_sql("hybrid",
    f"SELECT run_id, step, {rd('avg(r)')} AS reward_mean, {rd('stddev_pop(r)')} AS reward_std, "
    f"{rd('max(r)')} AS reward_max, {rd('min(r)')} AS reward_min FROM rewarded GROUP BY run_id, step"))(
    lambda spark, sf: A.reward_metadata(_scored(spark, sf, "hybrid")).select(
        "run_id", "step", *[report_double(F.col(c)).alias(c) for c in ("reward_mean", "reward_std", "reward_max", "reward_min")])
)

register("zero_std_groups", _rewarded_sql("signed10",
    "SELECT run_id, step, CAST(count_if(sd < 1e-4) AS BIGINT) AS zero_std_groups, count(*) AS num_groups FROM per_group GROUP BY run_id, step",
    ",\nper_group AS (SELECT run_id, step, task_id, stddev_pop(r) AS sd FROM rewarded GROUP BY run_id, step, task_id)"))(
    lambda spark, sf: A.zero_std_groups(_scored(spark, sf, "signed10"), eps=1e-4)
)


# --- J1, F7: task join with an unmatched-key report; token counts ------------

from ..functions.tokenize import output_token_count  # noqa: E402
from ..operators.scoring import attach_tasks, unmatched_rollouts  # noqa: E402


def _train_tasks(spark: SparkSession, sf: str) -> DataFrame:
    return FX.tasks(spark, sf).where(F.col("split") == "train")


register("rollout_task_join", with_ctes(ROLLOUT_PARTS,
    "SELECT run_id, step, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS sum_target FROM rollout_parts GROUP BY run_id, step"))(
    lambda spark, sf: attach_tasks(FX.rollouts(spark, sf), FX.tasks(spark, sf))
    .groupBy("run_id", "step").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("target").alias("sum_target"))
)

register("unmatched_rollouts", with_ctes(ROLLOUT_PARTS,
    f"SELECT {_RK} FROM rollout_parts WHERE split <> 'train'"))(
    lambda spark, sf: unmatched_rollouts(FX.rollouts(spark, sf), _train_tasks(spark, sf)).select(*ROLL_KEYS)
)

register("output_token_count", with_ctes(ROLLOUT_PARTS,
    f"SELECT {_RK}, CAST(len(string_split(response, ' ')) AS BIGINT) AS n_tokens FROM rollout_parts"))(
    lambda spark, sf: FX.rollouts(spark, sf).select(
        *ROLL_KEYS, output_token_count("response").cast("bigint").alias("n_tokens"))
)
