"""Exact grouped quantiles (linear interpolation) without gathering a group in one task.

``percentile`` keeps every distinct value of a group in one buffer, which
breaks when one group holds a large share of the rows.  This operator reads
its input once: it counts each (group, value) with a partial aggregate and
stores those counts, then finds the values at the needed ranks by refining
order-preserving buckets over the stored table:

1. a coarse log-scale bucket per value (monotone in the value), a few thousand
   per group at most; running counts locate the bucket holding each rank;
2. 65,536 linear sub-buckets inside those buckets, located the same way;
3. the values inside the needed sub-buckets, in order.

Each level keeps only rows whose bucket is needed (a semi-join, planned by
Spark); no level gathers a group.  Infinite values have end buckets of their
own; NaN counts as missing.  Interpolation follows the linear rule of the
common array libraries, operation for operation, so results are bit-identical
to it: position = (n-1)*p; between neighbours a and b at fraction t,
``a + (b-a)*t`` when t < 0.5, else ``b - (b-a)*(1-t)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealsieve.session import stored

COARSE_PER_E = 32          # coarse buckets per factor e of magnitude (about 3 % wide)
FINE_BUCKETS = 65536       # linear sub-buckets per coarse bucket
CENTRE, END = 10_000_000, 20_000_000

_V, _G, _C = "_qv", "_qg", "_qc"


def coarse_bucket(v):
    """Monotone non-decreasing integer bucket of a double (log scale, sign aware)."""
    finite = F.when(F.abs(v) < F.lit(float("inf")), F.abs(v))
    lg = F.floor(F.log(finite) * F.lit(float(COARSE_PER_E)))
    return (F.when(v == F.lit(float("inf")), F.lit(END))
            .when(v == F.lit(float("-inf")), F.lit(-END))
            .when(v > 0, F.lit(CENTRE) + lg)
            .when(v < 0, F.lit(-CENTRE) - lg)
            .otherwise(F.lit(0))).cast("long")


def fine_bucket(v, coarse):
    """Linear sub-bucket inside a coarse bucket; monotone in v for a fixed coarse bucket."""
    one_value = (coarse == 0) | (F.abs(coarse) == END)
    lg = F.when(coarse > 0, coarse - F.lit(CENTRE)).otherwise(F.lit(-CENTRE) - coarse)
    scale = F.exp(F.when(~one_value, lg) / F.lit(float(COARSE_PER_E)))
    return F.when(one_value, F.lit(0)) \
        .otherwise(F.floor(v / scale * F.lit(float(FINE_BUCKETS * COARSE_PER_E)))).cast("long")


def _locate(counts: DataFrame, keys: list[str], order: str, want: DataFrame) -> DataFrame:
    """Rows of ``counts`` that hold a wanted rank, with the rank inside the row.

    ``want`` has one row per key with an array of (_rank, _r) structs, so the
    join never multiplies rows by ranks.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before, c = F.col("_before"), F.col(_C)
    running = counts.withColumn("_before", F.coalesce(F.sum(_C).over(w), F.lit(0)))
    inside = F.filter("_want", lambda x: (x["_r"] >= before) & (x["_r"] < before + c))
    hits = running.join(want, keys).select(*keys, order, before, F.explode(inside).alias("h"))
    return hits.select(*keys, order, (F.col("h._r") - before).alias("_r"), F.col("h._rank").alias("_rank"))


def _want(hits: DataFrame, keys: list[str]) -> DataFrame:
    return hits.groupBy(*keys).agg(F.collect_list(F.struct("_rank", "_r")).alias("_want"))


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """Group columns, ``n`` (non-missing values) and one column per probability.

    Only groups with at least one value are emitted; a null group is a group.
    """
    g = list(group_cols)
    v = F.col(value_col).cast("double")
    values = df.where(v.isNotNull() & ~F.isnan(v)).select(F.struct(*g).alias(_G), v.alias(_V))
    counted = stored(values.groupBy(_G, _V).agg(F.count(F.lit(1)).alias(_C)).select(
        "*", coarse_bucket(F.col(_V)).alias("_k1")).select("*", fine_bucket(F.col(_V), F.col("_k1")).alias("_k2")),
        "value-counts")

    first = counted.groupBy(_G, "_k1").agg(F.sum(_C).alias(_C))
    n = first.groupBy(_G).agg(F.sum(_C).alias("n"))
    positions, ranks = [], []
    for i, p in enumerate(probs):
        pos = (F.col("n") - F.lit(1)).cast("double") * F.lit(float(p))
        low = F.floor(pos).cast("long")
        positions.append(pos.alias(f"_pos{i}"))
        ranks += [F.struct(F.lit(2 * i).alias("_rank"), low.alias("_r")),
                  F.struct(F.lit(2 * i + 1).alias("_rank"), F.least(low + 1, F.col("n") - 1).alias("_r"))]
    hit1 = _locate(first, [_G], "_k1", n.select(_G, F.array(*ranks).alias("_want")))

    keys1, keys2 = [_G, "_k1"], [_G, "_k1", "_k2"]
    second = counted.join(hit1.select(*keys1).distinct(), keys1, "left_semi") \
        .groupBy(*keys2).agg(F.sum(_C).alias(_C))
    hit2 = _locate(second, keys1, "_k2", _want(hit1, keys1))
    third = counted.join(hit2.select(*keys2).distinct(), keys2, "left_semi")
    hit3 = _locate(third, keys2, _V, _want(hit2, keys2))

    at_rank = hit3.groupBy(_G).agg(F.map_from_entries(F.collect_list(F.struct("_rank", _V))).alias("_m"))
    out = n.select(_G, "n", *positions).join(at_rank, _G)
    columns = []
    for i in range(len(probs)):
        a, b = F.col("_m")[2 * i], F.col("_m")[2 * i + 1]
        t = F.col(f"_pos{i}") - F.floor(F.col(f"_pos{i}"))
        q = F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
        # No arithmetic where none is needed: an infinite value stays itself.
        columns.append(F.when((a == b) | (t == 0), a).otherwise(q).alias(f"{prefix}{i}"))
    return out.select(*[F.col(_G).getField(c).alias(c) for c in g], "n", *columns)
