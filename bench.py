"""Benchmark: headline jobs at one scale factor, one JSON line on stdout.

Protocol: one warm-up, then the median of ``BENCH_RUNS`` (default 3) timed
runs per query, each written to the ``noop`` sink (full computation, no
output cost). ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
``BENCH_CPUS`` (default 8) choose the input and ``local[N]``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollscore.plans import catalog  # noqa: E402
from rollscore.session import build_session  # noqa: E402

HEADLINE = {
    "score": "reward_hybrid",                     # F1-F3 + R1, batch-dedup path
    "score_distinct": "evaluate_equation_distinct",  # J4 path
    "eval_summary": "eval_summary_exact",         # G1 + G2a
    "advantage": "advantage_grpo",                # W1
    "token_loss": "step_loss",                    # T8-T12 + G11
    "train_metrics": "train_metrics",             # M1
    "best_so_far": "best_so_far_c",               # W4
    "text_words": "word_count",                   # F6 over every whole document
    "text_answers": "text_answer_null_path",      # F1/F5 over assistant turns
}


def _time(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra_conf={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for name, query in HEADLINE.items():
        fn = catalog.QUERIES[query]
        _time(fn(spark, sf_dir))  # warm-up
        times[name] = round(statistics.median(_time(fn(spark, sf_dir)) for _ in range(runs)), 3)
    rollouts = spark.read.parquet(f"{sf_dir}/orders.parquet").count() * 8
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "rollouts": rollouts,
        "score_rollouts_per_sec": round(rollouts / times["score"], 1),
        "cpus": cpus,
        "shuffle_partitions": cpus * 2,
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
