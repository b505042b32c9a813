"""DuckDB SQL that derives the same fixtures and the expected values.

Expected answers come from the fixture's construction (which kind of
response was written), never from parsing the text, so a match checks the
Spark parser, evaluator and reward rules independently.
"""

from __future__ import annotations

# Round doubles for comparison and map -0.0 to 0.0.
def rd(expr: str, digits: int = 9) -> str:
    x = f"round(CAST({expr} AS DOUBLE), {digits})"
    return f"(CASE WHEN {x} = 0 THEN CAST(0.0 AS DOUBLE) ELSE {x} END)"


TASK_PARTS = """
task_base AS (
  SELECT o_orderkey AS task_id,
         CASE WHEN o_orderkey % 10 = 3 THEN 'test' ELSE 'train' END AS split,
         CAST(o_orderkey * 7 % 99 + 1 AS INTEGER) AS n1,
         CAST(o_custkey * 13 % 99 + 1 AS INTEGER) AS n2,
         CAST((o_orderkey + o_custkey) % 99 + 1 AS INTEGER) AS n3,
         CAST(o_orderkey % 97 + 1 AS INTEGER) AS n4,
         CAST(CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 4 END AS INTEGER) AS n_nums
  FROM orders
),
task_parts AS (
  SELECT *,
         CASE WHEN n_nums = 4 THEN [n1, n2, n3, n4] ELSE [n1, n2, n3] END AS nums,
         CASE WHEN n_nums = 4 THEN n4 ELSE 0 END AS t4,
         CASE WHEN n_nums = 4 THEN ' + ' || CAST(n4 AS VARCHAR) ELSE '' END AS tail,
         n1 + n2 - n3 + CASE WHEN n_nums = 4 THEN n4 ELSE 0 END AS base,
         CAST(n1 + n2 - n3 + CASE WHEN n_nums = 4 THEN n4 ELSE 0 END
              + CASE (task_id // 2) % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 4 ELSE 60 END
              AS INTEGER) AS target,
         task_id % 3 AS run_id,
         CAST(task_id // 48 + 1 AS BIGINT) AS step,
         CAST((task_id % 48) // 3 AS BIGINT) AS prompt_ord
  FROM task_base
)"""

ROLLOUT_PARTS = TASK_PARTS + """,
slots AS (
  SELECT *, CAST(unnest(range(8)) AS BIGINT) AS slot FROM task_parts
),
kinds AS (
  SELECT *,
         CAST(CASE WHEN task_id % 10 = 9 THEN 2 ELSE (task_id * 3 + slot) % 10 END AS BIGINT) AS kind,
         CAST(n1 AS VARCHAR) || ' + ' || CAST(n2 AS VARCHAR) || ' - ' || CAST(n3 AS VARCHAR) || tail AS e
  FROM slots
),
rollout_parts AS (
  SELECT *,
    CASE kind
      WHEN 0 THEN '<answer>' || e || '</answer>'
      WHEN 1 THEN '<think>step by step</think> <answer>(' || e || ')</answer>'
      WHEN 2 THEN 'The result is ' || e
      WHEN 3 THEN '<answer>' || CAST(n1 AS VARCHAR) || ' + ' || CAST(n2 AS VARCHAR) || '</answer>'
      WHEN 4 THEN '<answer>' || e || ' +</answer>'
      WHEN 5 THEN '<answer>1</answer> <ANSWER> ' || e || ' </ANSWER>'
      WHEN 6 THEN '<answer>' || e || ' = ' || CAST(base AS VARCHAR) || '</answer>'
      WHEN 7 THEN '<think>a</think><answer>-(-(' || e || '))</answer>'
      WHEN 8 THEN '<answer>' || CAST(n1 AS VARCHAR) || ' * ' || CAST(n2 AS VARCHAR) || ' - ' || CAST(n3 AS VARCHAR) || tail || '</answer>'
      ELSE '<answer>' || CAST(n1 AS VARCHAR) || ' / ' || CAST(n2 AS VARCHAR) || ' + ' || CAST(n3 AS VARCHAR) || tail || '</answer>'
    END AS response,
    CAST(4 + (task_id * 5 + slot * 3) % 60 AS BIGINT) AS output_tokens
  FROM kinds
),
expected AS (
  SELECT *,
    CASE kind
      WHEN 0 THEN e WHEN 1 THEN '(' || e || ')' WHEN 2 THEN NULL
      WHEN 3 THEN CAST(n1 AS VARCHAR) || ' + ' || CAST(n2 AS VARCHAR)
      WHEN 4 THEN e || ' +' WHEN 5 THEN e
      WHEN 6 THEN e || ' = ' || CAST(base AS VARCHAR)
      WHEN 7 THEN '-(-(' || e || '))'
      WHEN 8 THEN CAST(n1 AS VARCHAR) || ' * ' || CAST(n2 AS VARCHAR) || ' - ' || CAST(n3 AS VARCHAR) || tail
      ELSE CAST(n1 AS VARCHAR) || ' / ' || CAST(n2 AS VARCHAR) || ' + ' || CAST(n3 AS VARCHAR) || tail
    END AS x_equation,
    kind NOT IN (3, 6) AS x_numbers_ok,
    CAST(CASE
      WHEN kind IN (0, 1, 5, 7) THEN base
      WHEN kind = 3 THEN n1 + n2
      WHEN kind = 8 THEN n1 * n2 - n3 + t4
      WHEN kind = 9 THEN CAST(n1 AS DOUBLE) / n2 + n3 + t4
      ELSE NULL END AS DOUBLE) AS x_result,
    kind IN (1, 7) AS x_has_think,
    CAST(CASE kind WHEN 3 THEN 2
         WHEN 6 THEN n_nums + CASE WHEN list_contains(nums, CAST(abs(base) AS INTEGER)) THEN 1 ELSE 0 END
         ELSE n_nums END AS BIGINT) AS x_n_matched,
    CAST(len(string_split(response, ' ')) AS BIGINT) AS x_n_words
  FROM rollout_parts
),
answers AS (
  SELECT *, abs(x_result - target) AS x_distance, x_result IS NOT NULL AND abs(x_result - target) < 1e-6 AS x_exact
  FROM expected
)"""


def reward_sql(name: str) -> str:
    """Reward rule over the ``answers`` CTE, written from the rule text."""
    eq, ok, res, d, ex = "x_equation", "x_numbers_ok", "x_result", "x_distance", "x_exact"
    share = "(CAST(x_n_matched AS DOUBLE) / n_nums)"
    if name == "sparse":
        return f"CASE WHEN {eq} IS NULL THEN 0.0 WHEN NOT {ok} THEN 0.1 WHEN {res} IS NULL THEN 0.1 WHEN {ex} THEN 1.0 ELSE 0.1 END"
    if name == "hybrid":
        return (f"CASE WHEN {eq} IS NULL THEN 0.0 WHEN NOT {ok} THEN 0.1 WHEN {res} IS NULL THEN 0.2 "
                f"WHEN {ex} THEN 1.0 ELSE 0.2 + greatest(0.0, CASE WHEN {d} <= 5 THEN 0.8 * (1.0 - {d} / 10.0) "
                f"ELSE 0.8 * exp(-({d} - 5.0) / 5.0) * 0.5 END) END")
    if name == "graded":
        r0 = "(CASE WHEN x_has_think THEN 0.4 ELSE 0.2 END)"
        return (f"CASE WHEN {eq} IS NULL THEN 0.0 WHEN NOT {ok} THEN {r0} + 0.1 * {share} "
                f"WHEN {res} IS NULL THEN {r0} + 0.2 WHEN {ex} THEN 1.0 "
                f"ELSE {r0} + 0.4 + greatest(0.0, CASE WHEN {d} <= 1 THEN 0.4 * (1.0 - {d}) "
                f"WHEN {d} <= 5 THEN 0.3 * (1.0 - {d} / 5.0) WHEN {d} <= 10 THEN 0.2 * (1.0 - {d} / 10.0) "
                f"ELSE 0.1 * exp(-{d} / 10.0) END) END")
    if name == "format":
        return (f"CASE WHEN {eq} IS NULL THEN 0.0 ELSE least(1.0, 0.3 "
                f"+ CASE WHEN {ok} THEN 0.25 ELSE 0.75 * {share} END "
                f"+ 0.4 * least(x_n_words / 200.0, 1.0) + CASE WHEN {ex} THEN 0.05 ELSE 0.0 END) END")
    if name == "reason":
        return (f"CASE WHEN {eq} IS NULL THEN 0.0 WHEN NOT {ok} THEN 0.3 WHEN {res} IS NULL THEN 0.5 "
                f"WHEN {ex} THEN 1.0 ELSE 0.5 + greatest(0.0, CASE WHEN {d} <= 1 THEN 0.5 * (1.0 - {d}) "
                f"WHEN {d} <= 5 THEN 0.4 * (1.0 - {d} / 5.0) WHEN {d} <= 10 THEN 0.3 * (1.0 - {d} / 10.0) "
                f"WHEN {d} <= 25 THEN 0.2 * (1.0 - {d} / 25.0) ELSE 0.1 * exp(-{d} / 25.0) END) END")
    if name in ("signed5", "signed10"):
        s = 5.0 if name == "signed5" else 10.0
        return (f"CASE WHEN {eq} IS NULL THEN -0.1 WHEN NOT {ok} THEN -0.05 WHEN {res} IS NULL THEN 0.15 "
                f"WHEN {ex} THEN 1.0 ELSE greatest(-1.0, least(1.0, 0.4 + CASE WHEN {d} <= 1 THEN 0.5 * (1.0 - {d}) "
                f"WHEN {d} <= {s} THEN 0.3 * (1.0 - {d} / {s}) ELSE 0.1 * exp(-least({d}, {5 * s}) / {s}) END)) END")
    raise KeyError(name)


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body
