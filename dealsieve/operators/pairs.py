"""Every row of one table with every row of a second, stated set, as an equi-join on a salt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.session import cpu_partitions

_SALT = "_pair_salt"


def with_each(rows: DataFrame, each: DataFrame) -> DataFrame:
    """Rows of ``rows`` beside each row of ``each`` (column names must differ).

    ``rows`` is dealt over as many salts as the cluster runs tasks and the set
    ``each`` is copied to every salt, so the pairs come from an equi-join that
    spreads evenly and that Spark may turn into a broadcast by its own size
    estimate.  Nothing is collected.
    """
    salts = cpu_partitions(rows.sparkSession)
    dealt = rows.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)))
    copies = each.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copies, _SALT).drop(_SALT)
