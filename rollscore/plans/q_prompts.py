"""Registered queries for tasks, prompts, fine-tuning text, sampling,
previews, zero-shot accuracy, format metrics and example reports
(P1-P15, S4, S9, F9-F11, G3, G6, G8, W3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts as PR
from ..functions import text as X
from ..functions._util import report_double
from ..functions.decimals import fixed, shortest
from ..operators import evals as E
from ..operators import sampling as SP
from ..operators import tasks as TS
from ..operators.scoring import score, stage_answers
from ..operators.solutions import check_solutions
from ..sources import readers as RD
from ..sources import sinks as SK
from . import fixtures as FX
from .oracle import ROLLOUT_PARTS, TASK_PARTS, rd, reward_sql
from .q_scoring import ROLL_KEYS, _RK
from .registry import register

_NUMS_SQL = "('[' || array_to_string(nums, ', ') || ']')"


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _template_sql(template: str, max_tokens: int = 256) -> str:
    vals = {"{numbers}": _NUMS_SQL, "{target}": "CAST(target AS VARCHAR)", "{max_tokens}": _sql_lit(str(max_tokens))}
    parts, rest = [], template
    while True:
        hits = [(rest.find(k), k) for k in vals if rest.find(k) >= 0]
        if not hits:
            parts.append(_sql_lit(rest))
            break
        i, k = min(hits)
        parts += [_sql_lit(rest[:i]), vals[k]]
        rest = rest[i + len(k):]
    return "(" + " || ".join(p for p in parts if p != "''") + ")"


def _chat_sql(content_sql: str) -> str:
    return (_sql_lit("<|im_start|>system\n" + PR.SYSTEM_PROMPT + "<|im_end|>\n<|im_start|>user\n")
            + " || " + content_sql + " || " + _sql_lit("<|im_end|>\n<|im_start|>assistant\n"))


def _tasks_sql(body: str) -> str:
    return "WITH " + TASK_PARTS.strip() + "\n" + body


# --- P1, P2, G8, P15 -----------------------------------------------------------

register("tasks_by_size", _tasks_sql(f"SELECT task_id, target, {_NUMS_SQL} AS nums FROM task_parts WHERE n_nums = 3"))(
    lambda spark, sf: TS.filter_by_size(FX.tasks(spark, sf), 3).select("task_id", "target", PR.py_list("nums").alias("nums"))
)

register("split_stats", _tasks_sql(
    "SELECT split, count(*) AS total, CAST(count_if(n_nums = 3) AS BIGINT) AS kept, "
    f"{rd('CAST(count_if(n_nums = 3) AS DOUBLE) / count(*) * 100.0')} AS kept_pct FROM task_parts GROUP BY split"))(
    lambda spark, sf: TS.split_stats(FX.tasks(spark, sf)).select(
        "split", "total", "kept", report_double(F.col("kept_pct")).alias("kept_pct"))
)

register("preview_tasks", _tasks_sql(
    f"SELECT task_id, target, {_NUMS_SQL} AS nums FROM task_parts WHERE n_nums = 3 ORDER BY task_id LIMIT 5"))(
    lambda spark, sf: TS.preview(TS.filter_by_size(FX.tasks(spark, sf), 3), 5).select(
        "task_id", "target", PR.py_list("nums").alias("nums"))
)

register("text_preview", "SELECT doc_id, substr(text, 1, 200) AS preview FROM documents")(
    lambda spark, sf: FX.read_spread(spark, sf, "documents", "doc_id").select("doc_id", TS.text_preview("text", 200).alias("preview"))
)

# --- P3-P6: prompts --------------------------------------------------------------

for _v, _tpl in PR.TEMPLATES.items():
    register(f"prompt_{_v.lower()}", _tasks_sql(f"SELECT task_id, {_template_sql(_tpl)} AS prompt FROM task_parts"))(
        (lambda v: lambda spark, sf: FX.tasks(spark, sf).select("task_id", PR.prompt(v).alias("prompt")))(_v)
    )

register("chat_prompt", _tasks_sql(
    f"SELECT task_id, {_chat_sql(_template_sql(PR.TEMPLATE_A))} AS prompt, CAST(target AS DOUBLE) AS gt_target, "
    f"{_NUMS_SQL} AS gt_numbers FROM task_parts"))(
    lambda spark, sf: FX.tasks(spark, sf)
    .select("task_id", PR.chat_prompt(PR.prompt("A")).alias("prompt"), PR.ground_truth().alias("gt"))
    .select("task_id", "prompt", F.col("gt.target").alias("gt_target"), PR.py_list("gt.numbers").alias("gt_numbers"))
)

# --- P7, P8, F11, S4, S9: fine-tuning rows ---------------------------------------

_SFT_SQL = ROLLOUT_PARTS + """,
sft AS (SELECT task_id, slot, CASE WHEN task_id % 10 = 3 THEN 'validation' ELSE 'train' END AS split, target, nums,
               e AS solution, response AS completion, CAST(base AS DOUBLE) AS result, target = base AS is_exact
        FROM rollout_parts WHERE kind IN (0, 1, 7))"""


def _sft_sql(body: str) -> str:
    return "WITH " + _SFT_SQL.strip() + "\n" + body


register("sft_text_a", _sft_sql(
    f"SELECT task_id, slot, {_template_sql(PR.TEMPLATE_D)} || chr(10) || chr(10) || completion AS text FROM sft"))(
    lambda spark, sf: FX.sft_rows(spark, sf).select(
        "task_id", "slot", PR.sft_text_plain(PR.prompt("D"), "completion").alias("text"))
)

register("sft_text_b", _sft_sql(
    f"SELECT task_id, slot, {_chat_sql(_template_sql(PR.TEMPLATE_C))} || trim(completion) AS text FROM sft"))(
    lambda spark, sf: FX.sft_rows(spark, sf).select(
        "task_id", "slot", PR.sft_text_chat(PR.chat_prompt(PR.prompt("C")), "completion").alias("text"))
)


def _solution_check(spark: SparkSession, sf: str) -> DataFrame:
    return check_solutions(FX.sft_rows(spark, sf)).select(
        "task_id", "slot", report_double(F.col("checked")).alias("result"), F.col("checked_exact").alias("is_exact"), "mismatch")


register("solution_check", _sft_sql(
    f"SELECT task_id, slot, {rd('result')} AS result, is_exact, false AS mismatch FROM sft"))(_solution_check)


def _solution_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose stored result, flag or solution was changed: all of them are found, and no other one."""
    sft, t = FX.sft_rows(spark, sf), F.col("task_id")
    planted = sft.withColumn("result", F.when(t % 11 == 1, F.col("result") + 1.0).when(t % 11 == 2, F.lit(None)).otherwise(F.col("result")))
    planted = planted.withColumn("is_exact", F.when(t % 11 == 3, ~F.col("is_exact")).otherwise(F.col("is_exact")))
    planted = planted.withColumn("solution", F.when(t % 11 == 4, F.concat("solution", F.lit(" +"))).otherwise(F.col("solution")))
    return check_solutions(planted).where("mismatch").select("task_id", "slot", report_double(F.col("checked")).alias("checked"), "checked_exact")


register("solution_mismatches", _sft_sql(
    f"SELECT task_id, slot, CASE WHEN task_id % 11 = 4 THEN NULL ELSE {rd('result')} END AS checked, "
    "task_id % 11 <> 4 AND target = result AS checked_exact FROM sft WHERE task_id % 11 IN (1, 2, 3, 4)"))(_solution_mismatches)

register("sft_splits", _sft_sql("SELECT split, count(*) AS n FROM sft GROUP BY split"))(
    lambda spark, sf: RD.split_dataset(
        train=FX.sft_rows(spark, sf).where(F.col("split") == "train").drop("split"),
        validation=FX.sft_rows(spark, sf).where(F.col("split") == "validation").drop("split"),
    ).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
)

register("dataset_card")(lambda spark, sf: SK.dataset_card(FX.sft_rows(spark, sf)))

# --- P9-P12, P14: sampling, expansion, flattening, truncation, eval steps ---------

# Every task and every step of the rollouts; each split is a population of its own. The permutation of
# operators/sampling.py, round by round: j counts rounds, four of them make one image, one beyond n goes on.
register("sample_prompts", _tasks_sql("""
, d AS (SELECT split, task_id, row_number() OVER (PARTITION BY split ORDER BY task_id) - 1 AS ordinal FROM task_parts),
sized AS (SELECT split, count(*) AS n FROM d GROUP BY split),
tried AS (SELECT split, n, unnest(range(greatest(1, CAST(floor(sqrt(n)) AS BIGINT) - 1000), CAST(floor(sqrt(n)) AS BIGINT) + 1001)) AS a
          FROM sized),
best AS (SELECT split, n, a, (n + a - 1) // a AS b,
           row_number() OVER (PARTITION BY split ORDER BY a * ((n + a - 1) // a) - n, a) AS k FROM tried),
s AS (SELECT DISTINCT step FROM task_parts),
w AS (
  SELECT split, n, a, b, step, i, 0 AS j, i % a AS l, i // a AS r
  FROM (SELECT split, n, a, b, step, unnest(range(16)) AS i FROM best, s WHERE k = 1)
  UNION ALL
  SELECT split, n, a, b, step, i, j + 1,
    CASE WHEN j % 2 = 0 THEN (l + CAST('0x' || substr(md5(concat_ws(':', '42', step, j % 4, r)), 1, 8) AS BIGINT)) % a ELSE l END,
    CASE WHEN j % 2 = 1 THEN (r + CAST('0x' || substr(md5(concat_ws(':', '42', step, j % 4, l)), 1, 8) AS BIGINT)) % b ELSE r END
  FROM w WHERE NOT (j > 0 AND j % 4 = 0 AND l + a * r < n))
SELECT split, step, task_id, CAST(i AS BIGINT) AS prompt_ord
FROM w JOIN d USING (split) WHERE j > 0 AND j % 4 = 0 AND l + a * r < n AND ordinal = l + a * r
""").replace("WITH ", "WITH RECURSIVE ", 1))(
    lambda spark, sf: SP.sample_steps(
        FX.tasks(spark, sf), FX.rollouts(spark, sf).select("step"), 16, 42, within=["split"]
    ).select("split", "step", "task_id", "prompt_ord")
)

register("group_expand", _tasks_sql(
    "SELECT split, task_id, CAST(unnest(range(8)) AS BIGINT) AS slot FROM task_parts"))(
    lambda spark, sf: TS.expand_groups(FX.tasks(spark, sf).select("split", "task_id"), 8)
)

register("rollout_flatten", "WITH " + ROLLOUT_PARTS.strip() +
         "\nSELECT run_id, step, task_id, slot AS output_ord, response FROM rollout_parts WHERE task_id % 7 <> 0")(
    lambda spark, sf: TS.flatten_outputs(FX.nested_rollouts(spark, sf))
)

_SUFFIX = " extra</answer> tail"
register("stop_truncate", "WITH " + ROLLOUT_PARTS.strip() +
         f", x AS (SELECT {_RK}, response || {_sql_lit(_SUFFIX)} AS r FROM rollout_parts)\n"
         f"SELECT {_RK}, substr(r, 1, instr(r, '</answer>') + 8) AS response FROM x")(
    lambda spark, sf: FX.rollouts(spark, sf).select(
        *ROLL_KEYS, X.truncate_at_stop(F.concat(F.col("response"), F.lit(_SUFFIX))).alias("response"))
)

_BOUNDS = (8, 40)
register("token_bounds", "WITH " + ROLLOUT_PARTS.strip() +
         f"\nSELECT {_RK}, output_tokens FROM rollout_parts WHERE output_tokens BETWEEN {_BOUNDS[0]} AND {_BOUNDS[1]}")(
    lambda spark, sf: TS.token_bounds(FX.rollouts(spark, sf), *_BOUNDS).select(*ROLL_KEYS, "output_tokens")
)

register("eval_steps", "WITH " + ROLLOUT_PARTS.strip() +
         "\nSELECT step, count(*) AS n FROM rollout_parts WHERE step % 10 = 0 OR step = 0 GROUP BY step")(
    lambda spark, sf: TS.eval_steps(FX.rollouts(spark, sf), 10).groupBy("step").agg(F.count(F.lit(1)).alias("n"))
)

# --- F9/G6, G3, W3, F10: evaluation reports ---------------------------------------

_ANSWERS = "WITH " + ROLLOUT_PARTS.strip() + ",\nrw AS (SELECT *, CAST(" + reward_sql("hybrid") + " AS DOUBLE) AS r FROM answers)\n"


def _zero_shot(spark: SparkSession, sf: str) -> DataFrame:
    rows = FX.rollouts_with_tasks(spark, sf).where(F.col("task_id") % 10 == 3)
    rows = rows.withColumn("model", F.concat(F.lit("model_"), F.col("run_id").cast("string")))
    rows = rows.withColumn("max_tokens", F.when(F.col("slot") % 2 == 0, 256).otherwise(512).cast("bigint"))
    acc = E.zero_shot_accuracy(score(rows, reward="hybrid"))
    return acc.select("model", "max_tokens", "correct", "total", report_double(F.col("accuracy")).alias("accuracy"))


register("zero_shot_accuracy", _ANSWERS +
         "SELECT 'model_' || CAST(run_id AS VARCHAR) AS model, CAST(CASE WHEN slot % 2 = 0 THEN 256 ELSE 512 END AS BIGINT) AS max_tokens, "
         f"CAST(count_if(r = 1.0) AS BIGINT) AS correct, count(*) AS total, {rd('CAST(count_if(r = 1.0) AS DOUBLE) / count(*) * 100.0')} AS accuracy "
         "FROM rw WHERE task_id % 10 = 3 GROUP BY 1, 2")(_zero_shot)

register("format_metrics", _ANSWERS +
         "SELECT run_id, step, count(*) AS num_examples, CAST(count_if(kind <> 2) AS BIGINT) AS count_has_answer, "
         "CAST(count_if(kind IN (1, 7)) AS BIGINT) AS count_has_both_tags, "
         "CAST(count_if(x_equation IS NOT NULL AND x_equation <> '' AND x_numbers_ok) AS BIGINT) AS count_correct_numbers, "
         f"{rd('100.0 * count_if(kind IN (1, 7)) / count(*)')} AS format_accuracy, "
         f"{rd('100.0 * count_if(x_equation IS NOT NULL AND x_equation <> \'\' AND x_numbers_ok) / count(*)')} AS number_accuracy "
         "FROM rw GROUP BY run_id, step")(
    lambda spark, sf: E.format_metrics(stage_answers(FX.rollouts_with_tasks(spark, sf))).select(
        "run_id", "step", "num_examples", "count_has_answer", "count_has_both_tags", "count_correct_numbers",
        report_double(F.col("format_accuracy")).alias("format_accuracy"),
        report_double(F.col("number_accuracy")).alias("number_accuracy"))
)


def _top(spark: SparkSession, sf: str) -> DataFrame:
    top = E.top_examples(score(FX.rollouts_with_tasks(spark, sf), reward="hybrid"), n=10, rule="exact")
    return top.select("run_id", "step", "bucket", "task_id", "slot", F.col("rank").cast("bigint").alias("rank"))


register("top_examples", _ANSWERS +
         ", b AS (SELECT *, CASE WHEN abs(r - 1.0) < 1e-8 THEN 'correct' WHEN abs(r - 0.1) < 1e-8 THEN 'partial' "
         "WHEN abs(r) < 1e-8 THEN 'failed' END AS bucket FROM rw), "
         "k AS (SELECT run_id, step, bucket, task_id, slot, row_number() OVER (PARTITION BY run_id, step, bucket "
         "ORDER BY task_id, slot) AS rank FROM b WHERE bucket IS NOT NULL) "
         "SELECT run_id, step, bucket, task_id, slot, CAST(rank AS BIGINT) AS rank FROM k WHERE rank <= 10")(_top)


def _with_prompt(top: DataFrame) -> DataFrame:
    """The prompt of the chosen examples: made from the task after the choice, so that no prompt text is shuffled for it."""
    return top.withColumn("prompt", PR.prompt("A"))


def _example_text(spark: SparkSession, sf: str) -> DataFrame:
    scored = score(FX.rollouts_with_tasks(spark, sf), reward="hybrid")
    top = E.top_examples(scored, n=2, rule="exact")
    return E.examples_report(_with_prompt(top))


def _example_sql(rows: int) -> str:
    text = (f"'Prompt: ' || {_template_sql(PR.TEMPLATES['A'])} || chr(10) || 'Response: ' || response || chr(10) || 'Equation: ' "
            "|| coalesce(x_equation, 'None') || ' | Result: ' || coalesce(CAST(x_result AS VARCHAR), 'None') || ' | Target: ' "
            f"|| CAST(target AS VARCHAR) || ' | Numbers: ' || {_NUMS_SQL} || chr(10) || 'Reward: ' || printf('%.3f', r) || chr(10)")
    return (_ANSWERS + ", b AS (SELECT *, CASE WHEN abs(r - 1.0) < 1e-8 THEN 'correct' WHEN abs(r - 0.1) < 1e-8 THEN 'partial' "
            "WHEN abs(r) < 1e-8 THEN 'failed' END AS bucket FROM rw), "
            f"k AS (SELECT run_id, step, bucket, {text} AS example, row_number() OVER (PARTITION BY run_id, step, bucket "
            "ORDER BY task_id, slot) AS rank FROM b WHERE bucket IS NOT NULL), "
            "x AS (SELECT run_id, step, bucket, string_agg(example, chr(10) || chr(10) ORDER BY rank) AS text "
            f"FROM k WHERE rank <= {rows} GROUP BY run_id, step, bucket) ")


register("example_text", _example_sql(2) + "SELECT * FROM x")(_example_text)


def _example_rows(spark: SparkSession, sf: str) -> DataFrame:
    scored = score(TS.eval_steps(FX.rollouts_with_tasks(spark, sf), 10), reward="hybrid")
    return E.examples_long(_with_prompt(E.top_examples(scored, n=10, rule="exact"))).select("run_id", "step", "tag", "value", "text")


register("example_metrics", _example_sql(10) + "SELECT run_id, step, 'eval/examples_' || bucket AS tag, "
         "CAST(NULL AS DOUBLE) AS value, text FROM x WHERE step % 10 = 0")(_example_rows)


def _number_text(spark: SparkSession, sf: str) -> DataFrame:
    """Decimal text of every event's value, and of a thousandth and a power of it (ties and small numbers among them)."""
    v = F.col("value").cast("double")
    small, tie = v / F.lit(1e7), F.floor(v * 8).cast("double") / F.lit(16.0)
    return FX.read_spread(spark, sf, "events", "event_id").select(
        "event_id", fixed(v, 3).alias("f3"), shortest(v).alias("r"), fixed(tie, 3).alias("tie3"), shortest(tie).alias("tie"),
        fixed(small, 4).alias("small4"), shortest(small).alias("small"), shortest(v * F.lit(1e14)).alias("large"))


register("number_text",
         "SELECT event_id, printf('%.3f', value) AS f3, CAST(value AS VARCHAR) AS r, printf('%.3f', floor(value * 8) / 16.0) AS tie3, "
         "CAST(floor(value * 8) / CAST(16.0 AS DOUBLE) AS VARCHAR) AS tie, printf('%.4f', value / CAST(1e7 AS DOUBLE)) AS small4, "
         "CAST(value / CAST(1e7 AS DOUBLE) AS VARCHAR) AS small, CAST(value * CAST(1e14 AS DOUBLE) AS VARCHAR) AS large FROM events")(
    _number_text)
