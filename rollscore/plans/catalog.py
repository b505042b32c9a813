"""All registered queries: name -> Spark job over the given tables, plus the
DuckDB SQL that states the expected result independently (where SQL can).

Every query reads whole driver tables (or tables Spark derives from them),
so its work grows with the scale factor. Doubles in reports are rounded to
1e-9 (``report_double``) in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import q_metrics, q_prompts, q_scoring, q_sources, q_streaming, q_tokens  # noqa: F401  (register queries)
from .registry import ORACLES, QUERIES, register  # noqa: F401


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Score the rollouts with the hybrid rule and summarise each eval step."""
    return QUERIES["eval_summary_exact"](spark, sf)
