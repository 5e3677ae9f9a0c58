"""Website accreditation claims, with the page text cited for every claim.

Absence is "not found on site", never "does not hold".  The term table is a
parameter; all citations are computed in one projection over the text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.functions.text import first_citation, page_text

# Accreditations and their search variants, in order (fixed values).
ACCREDITATION_TERMS = {
    "iso_9001": ["iso 9001", "iso9001"],
    "iso_14001": ["iso 14001", "iso14001"],
    "constructionline": ["constructionline"],
    "cyber_essentials": ["cyber essentials"],
}
NOT_FOUND_LABEL = "not found on site"
CLAIMED_LABEL = "claimed on site"
HAND_CHECK_SAMPLE_SIZE = 100


def page_texts(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    return pages.select(*keep, page_text(html).alias("page_text"))


def accreditation_wide(companies: DataFrame, terms: Mapping[str, list[str]] = ACCREDITATION_TERMS,
                       html: str = "html") -> DataFrame:
    """One row per company with a website: ``<name>_status`` and ``<name>_citation`` per term."""
    with_site = companies.where(F.col("website_url").isNotNull())
    text = with_site.select("company_number", "company_name", "website_url", page_text(html).alias("_t"))
    cols = []
    for name, variants in terms.items():
        cite = first_citation("_t", variants)
        cols.append(F.when(cite.isNotNull() & (cite != ""), F.lit(CLAIMED_LABEL))
                    .otherwise(F.lit(NOT_FOUND_LABEL)).alias(f"{name}_status"))
        cols.append(F.when(cite != "", cite).alias(f"{name}_citation"))
    return text.select("company_number", "company_name", "website_url", *cols)


def accreditation_long(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wide -> one row per (company, accreditation) with status, citation and the reading line.

    The reading line for an absence says it is not proof the accreditation is not held.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("accreditation"), F.col(f"{n}_status").alias("status"),
                               F.col(f"{n}_citation").alias("citation")) for n in names])
    long = wide.select("company_number", F.explode(pairs).alias("a")).select("company_number", "a.*")
    label = F.translate(F.col("accreditation"), "_", " ")
    statement = F.when(F.col("status") == NOT_FOUND_LABEL,
                       F.concat(label, F.lit(": not found on the site, which is not proof it is not held"))) \
        .otherwise(F.concat(label, F.lit(": "), F.col("status")))
    return long.withColumn("statement", statement)


def extractor_check(companies: DataFrame, labels: DataFrame, name: str, variants: list[str],
                    sample_size: int = HAND_CHECK_SAMPLE_SIZE, html: str = "html") -> DataFrame:
    """Precision and recall of one claim on a deterministic hand-check sample.

    The sample is the ``sample_size`` companies first by md5 of their number (a
    top-k, so it is the same sample every run).  ``labels`` holds the
    hand-checked truth: (company_number, holds boolean).
    """
    sample = companies.where(F.col("website_url").isNotNull()) \
        .orderBy(F.md5(F.col("company_number").cast("string")), "company_number").limit(sample_size)
    claimed = sample.select("company_number", first_citation(page_text(html), variants).isNotNull().alias("claimed"))
    j = claimed.join(labels, "company_number")
    tp = F.sum(F.when(F.col("claimed") & F.col("holds"), 1).otherwise(0))
    return j.agg(
        F.lit(name).alias("accreditation"),
        F.count(F.lit(1)).alias("checked"),
        F.try_divide(tp, F.sum(F.col("claimed").cast("int"))).alias("precision"),
        F.try_divide(tp, F.sum(F.col("holds").cast("int"))).alias("recall"))
