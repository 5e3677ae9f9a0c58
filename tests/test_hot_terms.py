"""Hot/cold lookup: the same rows as a plain join, and no task filled by a term of every document."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from dealsieve.operators import text_models as TM
from dealsieve.operators.hotcold import lookup_by_frequency


def terms(spark, documents=4000):
    """One term in every document, and twenty others that few documents share."""
    ids = spark.range(documents).select(F.col("id").alias("doc_id"))
    rest = ids.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("j")) \
        .select("doc_id", F.concat(F.lit("t"), F.pmod(F.xxhash64("doc_id", "j"), F.lit(9000)).cast("string")).alias("term"))
    return ids.withColumn("term", F.lit("the")).unionByName(rest).withColumn("tf", F.lit(2).cast("long"))


@pytest.mark.parametrize("hot_keys", [1, 50, 100_000])
def test_equals_a_plain_join(spark, hot_keys):
    rows = terms(spark).unionByName(spark.createDataFrame([(1, None, 3), (2, "unknown", 1)],
                                                          "doc_id long, term string, tf long"))
    df = terms(spark).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    got = lookup_by_frequency(rows, df, "term", "df", hot_keys)
    want = rows.join(df, "term").select("doc_id", "term", "tf", "df")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_term_of_every_document_fills_no_task(spark):
    rows = terms(spark).repartition(8, "doc_id", "term")
    df = terms(spark).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = {}
        for name, out in (("plain", rows.join(df, "term")), ("split", lookup_by_frequency(rows, df, "term", "df", 16))):
            sizes[name] = sorted(Counter(r[0] for r in out.select(F.spark_partition_id()).collect()).values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in sizes:
        assert sum(sizes[name]) == rows.count()
    # Tasks that read the hot rows and tasks that join the others are each of even size.
    assert max(sizes["split"]) < 2 * sizes["split"][len(sizes["split"]) // 2]


def test_no_hot_task_in_the_exchange(spark):
    """The rows that are exchanged by term are those of cold terms only."""
    rows, df = terms(spark), terms(spark).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    by_task = lookup_by_frequency(rows, df, "term", "df", 1).where(F.col("term") != "the") \
        .groupBy(F.pmod(F.hash("term"), F.lit(8)).alias("task")).count().collect()
    sizes = sorted(r["count"] for r in by_task)
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_empty_and_blank_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one one two")], "doc_id long, text string")
    got = {(r.doc_id, r.term): r.tf for r in TM.term_weights(docs, "doc_id", "text").collect()}
    assert {k: v for k, v in got.items() if k[0] == 3} == {(3, "one"): 2, (3, "two"): 1}
    assert TM.key_terms(docs.limit(0)).count() == 0
