"""fine-tuning rows checked against their own solutions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.equation import evaluate_equation

EXACT_TOL = 1e-6


def check_solutions(sft: DataFrame, tol: float = EXACT_TOL) -> DataFrame:
    """Adds ``checked`` (the value of ``solution``, NULL when it has none), ``checked_exact`` (the target is reached) and
    ``mismatch``: the stored ``result`` or ``is_exact`` says something else. A NULL on one side only is a mismatch; two
    results count as equal within ``tol`` of each other, or when both are NaN."""
    rows = sft.withColumn("checked", evaluate_equation(F.col("solution")))
    exact = F.coalesce(F.abs(F.col("checked") - F.col("target")) < F.lit(tol), F.lit(False))
    near = F.abs(F.col("checked") - F.col("result")) < F.lit(tol)
    same = F.col("checked").eqNullSafe(F.col("result")) | F.coalesce(near, F.lit(False))
    return rows.withColumn("checked_exact", exact).withColumn("mismatch", ~same | ~exact.eqNullSafe(F.col("is_exact")))
