"""Page rows of any number per company, and modules stored so that pages join without an exchange."""

import os
import uuid

from pyspark.sql import functions as F

from dealsieve.operators import coverage


def companies_and_modules(spark):
    companies = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None)], "company_number string, company_name string")
    charges = spark.createDataFrame([("1", "2020", 5), ("1", "2020", 5), ("1", None, None), ("9", "2021", 1),
                                     (None, "2022", 2)], "company_number string, company_name string, n int")
    flags = spark.createDataFrame([("2", True)], "company_number string, flag boolean")
    return companies, {"charges": (charges, {"company_name": "string", "n": "bigint"}),
                       "flags": (flags, {"flag": "boolean"}), "late": (None, {"n": "double"})}


def test_every_record_of_a_company(spark):
    companies, modules = companies_and_modules(spark)
    page = coverage.company_page(companies, modules)
    assert page.columns == ["company_number", "company_name", "module", "state", "charges__company_name",
                            "charges__n", "flags__flag", "late__n"]
    assert dict(page.dtypes)["charges__n"] == "bigint" and dict(page.dtypes)["late__n"] == "double"
    want = [("1", "A", "charges", "present", "2020", 5, None, None)] * 2 + [
        ("1", "A", "charges", "present", None, None, None, None),
        ("2", "B", "charges", "no record", None, None, None, None),
        ("3", None, "charges", "no record", None, None, None, None),
        ("1", "A", "flags", "no record", None, None, None, None),
        ("2", "B", "flags", "present", None, None, True, None),
        ("3", None, "flags", "no record", None, None, None, None)] + [
        (c, n, "late", "not run", None, None, None, None) for c, n in (("1", "A"), ("2", "B"), ("3", None))]
    assert sorted(map(repr, map(tuple, page.collect()))) == sorted(map(repr, want))
    assert coverage.company_page(companies.limit(0), modules).count() == 0


def test_stored_modules_join_without_an_exchange(spark, tmp_dir):
    companies = spark.range(500).select(F.col("id").cast("string").alias("company_number"),
                                        F.concat(F.lit("C"), "id").alias("company_name"))
    def module(step, name):
        return spark.range(0, 600, step).select(F.col("id").cast("string").alias("company_number"),
                                                (F.col("id") * 2).alias(name))
    modules = {"a": (module(2, "x"), {"x": "bigint"}), "b": (module(3, "y"), {"y": "bigint"}),
               "c": (module(600, "z").limit(0), {"z": "bigint"}), "late": (None, {"w": "string"})}
    listed, kept = coverage.store_modules(companies, modules, os.path.join(tmp_dir, "m"),
                                          f"test_{uuid.uuid4().hex}", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        page = coverage.dossier(listed, kept)
        rows = {tuple(r) for r in page.collect()}
        plan = page._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows == {tuple(r) for r in coverage.dossier(companies, modules).collect()} and len(rows) == 500
    assert kept["late"][0] is None
    # A second store under the same names replaces the first.
    fewer = {"a": (module(4, "x"), {"x": "bigint"})}
    name = f"test_{uuid.uuid4().hex}"
    coverage.store_modules(companies, modules, os.path.join(tmp_dir, "n"), name, 4)
    listed, kept = coverage.store_modules(companies, fewer, os.path.join(tmp_dir, "n"), name, 4)
    assert coverage.dossier(listed, kept).where(F.col("a_state") == "present").count() == 125
