"""The keyed permutation, dense numbers, and what a step costs."""

import pytest
from pyspark.sql import functions as F

from rollscore.operators import sampling as SP
from rollscore.operators import tasks as TS


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 1000, 12345, 999_983])
def test_sides_cover_the_range(n):
    a, b = SP.sides(n)
    assert a * b >= n and a * b - n < 2 + n // 1000


@pytest.mark.parametrize("n,a,b", [(1, 1, 1), (13, 4, 4), (97, 9, 11), (1000, 25, 40), (1000, 32, 34)])
def test_every_step_is_a_permutation(spark, n, a, b):
    """Also with more numbers beyond n than ``sides`` would leave, so that walks occur."""
    lit = lambda v: F.lit(v).cast("bigint")
    rows = spark.range(3).withColumnRenamed("id", "step").crossJoin(spark.range(n))
    got = rows.select("step", "id", SP.permuted(F.col("id"), lit(n), lit(a), lit(b), F.col("step"), 7).alias("y")).collect()
    images = {}
    for r in got:
        images.setdefault(r.step, {})[r.id] = r.y
    assert all(sorted(m.values()) == list(range(n)) for m in images.values())
    if n > 90:
        assert images[0] != images[1] != images[2]


def test_dense_numbers_follow_the_key(spark):
    tasks = spark.range(5000).select((F.col("id") * 37 % 5003).alias("task_id"), F.when(F.col("id") % 9 == 0, "b").otherwise("a").alias("split"))
    got = SP.dense_numbers(tasks.repartition(7), within=["split"]).collect()
    for split in ("a", "b"):
        mine = sorted((r.task_id, r.ordinal) for r in got if r.split == split)
        assert [o for _, o in mine] == list(range(len(mine)))


def test_samples_cover_the_steps_of_the_data(spark):
    rows = [(i, "test" if i % 4 == 0 else "train") for i in range(40)]
    tasks = spark.createDataFrame(rows, "task_id long, split string")
    steps = spark.createDataFrame([(s,) for s in (3, 11, 11, 250)], "step long")
    got = SP.sample_steps(tasks, steps, 5, within=["split"]).collect()
    assert sorted({(r.split, r.step) for r in got}) == [(s, n) for s in ("test", "train") for n in (3, 11, 250)]
    assert len({(r.split, r.step, r.task_id) for r in got}) == len(got) == 30
    assert sorted(r.prompt_ord for r in got if (r.split, r.step) == ("train", 3)) == [0, 1, 2, 3, 4]
    train = tasks.where("split = 'train'")
    wanted = {(r.task_id, r.prompt_ord) for r in TS.sample_steps(train, 1, 5, first_step=250).collect()}
    assert {(r.task_id, r.prompt_ord) for r in got if (r.split, r.step) == ("train", 250)} == wanted
    with pytest.raises(ValueError):
        SP.sample_steps(tasks, steps, 11, within=["split"])
    with pytest.raises(ValueError):
        SP.sample_steps(tasks.where("false"), steps, 1)


def test_cost_follows_the_draws(spark):
    """No pairs of tasks and steps: the tasks meet only the drawn numbers, in an equi-join."""
    tasks = spark.range(1000).withColumnRenamed("id", "task_id")
    plan = SP.sample_steps(tasks, spark.range(500).withColumnRenamed("id", "step"), 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_uniform_enough(spark):
    """Every task is drawn about equally often over many steps."""
    tasks = spark.range(40).withColumnRenamed("id", "task_id")
    steps = spark.range(2000).withColumnRenamed("id", "step")
    counts = [r["count"] for r in SP.sample_steps(tasks, steps, 4).groupBy("task_id").count().collect()]
    assert len(counts) == 40 and 130 < min(counts) and max(counts) < 270  # expected 200, sd 13
