"""Equal multiples of the value distribution lie side by side in what is written."""

from pathlib import Path

from pyspark.sql import functions as F

from dealsieve.operators import valuation


def test_equal_multiples_compress(spark, tmp_dir):
    targets = spark.range(50).select(F.col("id").cast("string").alias("company_number"), F.lit("").alias("industry_code"),
                                     (F.col("id") + 1.37).alias("scaling_value"))
    peers = spark.range(4000).select(F.lit("123").alias("industry_code"), (F.pmod(F.xxhash64("id"), F.lit(100)) + 0.5).alias("multiple"))
    valuation.value_distribution(targets, peers).write.parquet(f"{tmp_dir}/out")
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == 50 * 4000
    assert sum(p.stat().st_size for p in Path(tmp_dir, "out").glob("*.parquet")) < 50 * 4000
    held = {r.multiple: r["count"] for r in peers.groupBy("multiple").count().collect()}
    found = out.groupBy("company_number", "multiple", "estimated_value").count().collect()
    assert len(found) == 50 * len(held) and all(r["count"] == held[r.multiple] for r in found)
