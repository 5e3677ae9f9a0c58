"""Lookup join for keys of very uneven frequency: the frequent keys by a small map, the rest by an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 4096          # bound of the broadcast map, in keys


def lookup_by_frequency(rows: DataFrame, lookup: DataFrame, key: str, frequency: str,
                        hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` with the columns of ``lookup`` (one row per key), as an inner join on ``key``.

    The ``hot_keys`` most frequent keys (ties by key) are found by a top-k of
    ``lookup``, which is limited in every task before anything travels; they
    are the only data that is broadcast, so its size is bounded whatever the
    input.  Rows of these keys get their columns where they stand and are not
    exchanged, so a key in every row fills no task.  All other rows meet the
    other keys in an ordinary join: a key outside the top k is held by at
    most one in k of the rows.  Null keys match nothing.
    """
    added = [c for c in lookup.columns if c != key]
    hot = lookup.where(F.col(key).isNotNull()).orderBy(F.desc(frequency), key).limit(hot_keys) \
        .select(F.col(key), F.struct(*added).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    found = marked.where(F.col("_hot").isNotNull()).select(*rows.columns, *[F.col("_hot")[c].alias(c) for c in added])
    cold = marked.where(F.col("_hot").isNull()).drop("_hot").join(lookup, key).select(*rows.columns, *added)
    return found.unionByName(cold)
