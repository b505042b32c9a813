"""K tasks per step by a keyed permutation of their dense numbers.

Tasks are numbered 0..N-1 in the order of their id. For every step a Feistel permutation of that range, keyed by
(seed, step), maps the positions 0..k-1 to k different numbers, so a step costs k small computations and one equi-join
brings in the tasks: O(steps * k + N), never steps * N. The permutation works on pairs (l, r) of a * b >= N numbers;
an image beyond N is permuted again (cycle walking). a is the divisor near sqrt(N) that leaves the fewest numbers
beyond N, and no walk is longer than their count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

ROUNDS = 4
REACH = 1000  # divisors tried on either side of sqrt(N)


def sides(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n, the least a * b for a near sqrt(n); ties: the smallest a."""
    root = math.isqrt(n)
    a = min(range(max(1, root - REACH), root + REACH + 1), key=lambda a: (a * -(-n // a) - n, a))
    return a, -(-n // a)


def dense_numbers(tasks: DataFrame, key: str = "task_id", within: Sequence[str] = ()) -> DataFrame:
    """``ordinal``: 0, 1, ... per population ``within`` in the order of the unique ``key``. Numbers are given inside the
    partitions of a range partitioning and moved by the counts of the partitions before; no window holds a population."""
    ranged = tasks.repartitionByRange(*within, key).withColumn("__part", F.spark_partition_id())
    stored = cut_lineage(ranged)  # a partition's bounds are sampled: keep one choice
    local = F.row_number().over(Window.partitionBy(*within, "__part").orderBy(key)) - 1
    counts = stored.groupBy(*within, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*within, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    joined = stored.withColumn("__local", local).join(shift, [*within, "__part"])
    return joined.withColumn("ordinal", F.col("__local") + F.col("__shift")).drop("__part", "__local", "__shift")


def _noise(seed: int, step: Column, turn: Column, half: Column) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), step.cast("string"), (turn % ROUNDS).cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def permuted(position: Column, n: Column, a: Column, b: Column, step: Column, seed: int) -> Column:
    """The image of ``position`` under the permutation of 0..n-1 keyed by (seed, step)."""

    def turn(state: Column, j: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.struct(
            F.when(j % 2 == 0, (left + _noise(seed, step, j, right)) % a).otherwise(left).alias("l"),
            F.when(j % 2 == 1, (right + _noise(seed, step, j, left)) % b).otherwise(right).alias("r"))

    def once(x: Column) -> Column:
        start = F.struct((x % a).alias("l"), F.floor(x / a).cast("bigint").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] + a * s["r"])

    beyond = (a * b - n).cast("int")
    walk = F.when(beyond > 0, F.sequence(F.lit(1), beyond)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(walk, once(position), lambda x, _: F.when(x >= n, once(x)).otherwise(x))


def sample_steps(tasks: DataFrame, steps: DataFrame, k: int, seed: int = 42, key: str = "task_id",
                 within: Sequence[str] = ()) -> DataFrame:
    """``k`` different tasks for every distinct ``step`` of ``steps``, with ``prompt_ord`` = position in the sample; each
    value of ``within`` (few, such as the splits) is a population of its own. Fewer than k tasks raise."""
    numbered = dense_numbers(tasks, key, within)
    sizes = numbered.groupBy(*within).agg(F.count(F.lit(1)).alias("n")).collect()
    for row in sizes or [{"n": 0}]:
        if row["n"] < k:
            raise ValueError(f"Sample larger than population or is negative: k={k}, n={row['n']}")
    lone = [F.struct(*[F.lit(row[c]).alias(c) for c in within], F.lit(row["n"]).cast("bigint").alias("n"),
                     *[F.lit(v).cast("bigint").alias(c) for c, v in zip(("a", "b"), sides(row["n"]))]) for row in sizes]
    places = F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))
    each = steps.select(F.col("step").cast("bigint").alias("step")).distinct()
    draws = each.select("step", F.explode(F.array(*lone)).alias("p")).select("step", "p.*", F.explode(places).alias("prompt_ord"))
    image = permuted(F.col("prompt_ord"), F.col("n"), F.col("a"), F.col("b"), F.col("step"), seed)
    drawn = draws.select("step", *within, "prompt_ord", image.alias("ordinal"))
    return numbered.join(drawn, [*within, "ordinal"]).drop("ordinal")
