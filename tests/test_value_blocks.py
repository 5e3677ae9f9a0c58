"""The value distribution of one key is the work of many tasks, and whole."""

from pyspark.sql import functions as F

from dealsieve.operators import valuation


def test_one_key_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(valuation, "BLOCK_ROWS", 64)
    targets = spark.range(300).select(F.col("id").cast("string").alias("company_number"), F.lit("").alias("industry_code"),
                                      (F.col("id") + 1).cast("double").alias("scaling_value"))
    peers = spark.range(500).select(F.lit("123").alias("industry_code"), F.when(F.col("id") > 0, F.col("id") % 7).cast("double")
                                    .alias("multiple"))
    out = valuation.value_distribution(targets, peers)
    tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 300 * 500 and max(tasks) < 300 * 500
    expected = targets.crossJoin(peers.select("multiple")).select(
        "company_number", F.lit(3).alias("code_length_used"), "multiple",
        (F.col("scaling_value") * F.col("multiple")).alias("estimated_value"))
    assert out.exceptAll(expected).isEmpty() and expected.exceptAll(out).isEmpty()
