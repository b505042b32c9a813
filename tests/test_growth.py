"""Work and shuffled rows of queries that have to grow with their tables: no hot task, no second pass, no text carried in vain."""

from pyspark.sql import functions as F

from rollscore.functions.equation import with_equation_result
from rollscore.operators import losses as LO
from rollscore.plans import catalog

SF001 = "/root/testdata/sf0.001"


def test_rows_without_equation_are_dealt_over_the_tasks(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    text = F.when(F.col("id") % 10 == 0, F.concat((F.col("id") % 70).cast("string"), F.lit(" + 1"))).when(F.col("id") % 10 > 4, "no sum")
    df = spark.range(8000).select("id", text.alias("equation"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = with_equation_result(df, strategy="distinct")
        assert got.columns == ["id", "equation", "m", "result"]
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 2500
        want = with_equation_result(df, strategy="batch")
        assert {r.id: r.result for r in got.collect()} == {r.id: r.result for r in want.collect()}
        assert got.where("result IS NOT NULL").count() == 800
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_ratio_statistics_read_their_rows_once(spark):
    df = spark.createDataFrame([(1, [1.0], [0.5]), (1, [2.0, 3.0], [1.0, 1.0]), (2, [1.0, None], [1.0, 1.0])],
                               "k int, p array<double>, o array<double>")
    stats = LO.ratio_stats(df, "p", "o", ["k"])
    assert "Join" not in stats._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: r for r in stats.collect()}
    assert abs(got[1].log_ratio_mean - 3.5 / 3) < 1e-12 and got[1].log_ratio_max == 2.0
    assert got[2].ratio_mean == 1.0 and got[2].ratio_std is None


def test_prompts_are_made_after_the_choice_of_examples(spark):
    for query in ("example_text", "example_metrics"):
        plan = catalog.QUERIES[query](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Window", 1)
        assert "Using the numbers" in above and "Using the numbers" not in below, query
