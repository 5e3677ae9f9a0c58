"""Company dossier (every signal on one row), company page (every record) and signal coverage.

Module outputs are optional: ``None`` means the module has not run, which is
a normal state and reads differently from "ran but holds no record".
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.sources.tables import write_bucketed

NOT_RUN, NO_RECORD, PRESENT = "not run", "no record", "present"


def select_company_rows(table: DataFrame | None, company_number=None, company_name=None) -> DataFrame | None:
    """Rows of one company, matched on whichever identifier the table carries."""
    if table is None:
        return None
    if "company_number" in table.columns:
        return table.where(F.col("company_number") == F.lit(company_number))
    if "company_name" in table.columns:
        return table.where(F.col("company_name") == F.lit(company_name))
    return None


def dossier(companies: DataFrame, modules: Mapping[str, tuple[DataFrame | None, Mapping[str, str]]]) -> DataFrame:
    """One row per company with ``<module>_state`` and the chosen columns of each module.

    ``modules`` maps a name to (table or None, columns to carry with their
    types).  A column has its stated type whether or not the module has run.
    Each table must hold one row per company_number; all joins share that key.
    """
    out = companies
    for name, (table, columns) in modules.items():
        if table is None:
            out = out.select("*", F.lit(NOT_RUN).alias(f"{name}_state"),
                             *[F.lit(None).cast(kind).alias(c) for c, kind in columns.items()])
            continue
        t = table.select("company_number", *[F.col(c).cast(kind).alias(c) for c, kind in columns.items()],
                         F.lit(True).alias(f"_{name}_hit"))
        out = out.join(t, "company_number", "left").withColumn(
            f"{name}_state", F.when(F.col(f"_{name}_hit"), F.lit(PRESENT)).otherwise(F.lit(NO_RECORD))) \
            .drop(f"_{name}_hit")
    return out


def store_modules(companies: DataFrame, modules: Mapping[str, tuple[DataFrame | None, Mapping[str, str]]],
                  folder: str, prefix: str, buckets: int):
    """(companies, modules) as tables bucketed by company number under ``folder``, named ``<prefix>_<module>``.

    What ``dossier`` and ``signal_coverage`` read then has one layout, so a
    page over stored modules is joined without an exchange, and a module that
    several pages use is computed once.  Modules that have not run stay None.
    """
    place = folder.rstrip("/")
    kept = write_bucketed(companies, f"{prefix}_companies", f"{place}/companies", "company_number", buckets)
    tables = {}
    for name, (table, columns) in modules.items():
        stored_table = None if table is None else write_bucketed(
            table.select("company_number", *columns), f"{prefix}_{name}", f"{place}/module-{name}",
            "company_number", buckets)
        tables[name] = (stored_table, columns)
    return kept, tables


def company_page(companies: DataFrame, modules: Mapping[str, tuple[DataFrame | None, Mapping[str, str]]]) -> DataFrame:
    """Every record that every module holds of each company, one row per record.

    ``modules`` maps a name to (table or None, columns to show with their
    types); unlike ``dossier`` a table may hold any number of rows per
    company.  Rows are (company columns, module, state, ``<module>__<column>``
    of all modules), where the other modules' columns are null; a company
    without a record of a module has one row that says so, and so has each
    company for a module that has not run.  Repeated records stay, records of
    companies that are not listed (or of none) are left out.  Select companies
    before the call for the page of a few.
    """
    shown = [(name, c, kind) for name, (_, columns) in modules.items() for c, kind in columns.items()]
    listed = [F.col(f"`{c}`") for c in companies.columns]
    pages = []
    for name, (table, columns) in modules.items():
        rows, state = companies, F.lit(NOT_RUN)
        if table is not None:
            held = table.select("company_number", F.struct(
                F.lit(True).alias("_hit"), *[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()])
                .alias("_record"))
            rows = companies.join(held, "company_number", "left").select(*listed, "_record")
            state = F.when(F.col("_record").isNotNull(), F.lit(PRESENT)).otherwise(F.lit(NO_RECORD))
        pages.append(rows.select(
            *listed, F.lit(name).alias("module"), state.alias("state"),
            *[(F.col("_record")[c] if own == name and table is not None else F.lit(None).cast(kind)).alias(f"{own}__{c}")
              for own, c, kind in shown]))
    return reduce(DataFrame.unionByName, pages)


def signal_coverage(companies: DataFrame, modules: Mapping[str, DataFrame | None]) -> DataFrame:
    """Per module: rows, companies covered, and the share of companies without a record.

    One aggregate per company over the union of all tables, then one over
    companies; the table of results has one row per module.  Modules that
    have not run report null counts and a missing share of 1.
    """
    listed = companies.select("company_number", F.lit(None).cast("string").alias("_module"))
    rows = listed
    for name, table in modules.items():
        if table is not None:
            rows = rows.unionByName(table.select("company_number", F.lit(name).alias("_module")))
    per_company = rows.groupBy("company_number").agg(
        F.max(F.col("_module").isNull()).alias("_listed"),
        *[F.count_if(F.col("_module") == name).alias(f"_n{i}") for i, name in enumerate(modules)])
    total = per_company.agg(
        F.count_if("_listed").alias("_companies"),
        *[F.sum(f"_n{i}").alias(f"_rows{i}") for i in range(len(modules))],
        *[F.count_if(F.col("_listed") & (F.col(f"_n{i}") > 0)).alias(f"_covered{i}") for i in range(len(modules))])
    lines = []
    for i, (name, table) in enumerate(modules.items()):
        ran = F.lit(table is not None)
        covered = F.when(ran, F.col(f"_covered{i}"))
        lines.append(F.struct(
            F.lit(name).alias("module"),
            F.when(ran, F.coalesce(F.col(f"_rows{i}"), F.lit(0))).cast("long").alias("row_count"),
            covered.cast("long").alias("companies_covered"),
            F.when(ran, F.lit(1.0) - F.try_divide(covered, F.col("_companies"))).otherwise(F.lit(1.0))
            .alias("share_missing")))
    return total.select(F.explode(F.array(*lines)).alias("m")).select("m.*")
