"""Nearest comparable companies by mixed (numeric + one-hot categorical) distance: an exact k-nearest-neighbour join.

The mixed distance is Euclidean in one-hot space, so the triangle inequality
holds, and distances to a few pivots tell where a near item can be:

* every item belongs to the cell of its nearest pivot, and to a ring of that
  cell by its distance to the pivot;
* a query first looks at the rings around its own place, among a bounded
  number of items by hash: the nearest item found there in each of k groups
  bounds its search, for k items are no farther than the farthest of these
  (where they hold too few items, the pivots bound it: its distance to a pivot
  plus the k-th smallest distance in that cell); on large tables larger shares
  of the items bring the bound down before all items are searched;
* it then visits a cell only if the plane between that cell's pivot and its
  own one, and the cell's radius, are near enough, and of that cell only the
  rings within the bound.

Pairs come from an equi-join on (cell, ring), so a query meets the items of
the rings it visits, not the whole table; inside the join, a pair whose
distances to one of a few pivots differ by more than the bound is dropped
before its distance is computed, and no pair beyond the bound is sorted.  Items that agree in all compared
columns are one point: only their smallest ids can be ranked and travel, so a
point held by very many items costs no more than k + 1.  The driver sees the
pivots and a radius and a bound for each.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealsieve.functions.finance import mixed_distance
from dealsieve.session import stored

PIVOTS = 64         # cells; every item's distance to each of them is computed
RINGS = 64          # rings of a cell
LOOK = 4            # rings to each side that are looked at first
LOOKED = 1 << 19    # items of the first look, about
WIDEN = 4           # times as many items in each further look
GUARDS = 8          # pivots whose distances are compared before a pair's own distance is computed
MARGIN = 1e-9       # bounds only prune, they never decide


class _Cells:
    """Pivots of a table of items, and the expressions that place rows among them."""

    def __init__(self, items: DataFrame, id_col: str, numeric: Sequence[str], categorical: Sequence[str]):
        self.numeric, self.categorical = list(numeric), list(categorical)
        columns = [*self.numeric, *self.categorical]
        # A bounded choice, the same on every run: the items with the smallest hashes.
        rows = items.select(F.xxhash64(id_col).alias("_h"), *columns).orderBy("_h", *columns).limit(PIVOTS).collect()
        self.pivots = list(dict.fromkeys(tuple(r[c] for c in columns) for r in rows))

    def distance_to(self, pivot: tuple) -> str:
        """The mixed distance to a pivot as one SQL expression (built once per pivot, not once per literal)."""
        n = len(self.numeric)
        terms = [f"(`{c}` - ({float(v)!r}D)) * (`{c}` - ({float(v)!r}D))" for c, v in zip(self.numeric, pivot)]
        terms += ["2.0D" if v is None else f"CASE WHEN `{c}` = {_text(v)} THEN 0.0D ELSE 2.0D END"
                  for c, v in zip(self.categorical, pivot[n:])]
        return f"sqrt({' + '.join(['0.0D', *terms])})"

    def between(self, one: tuple, two: tuple) -> float:
        """Distance of two pivots; a missing category differs from every other."""
        n = len(self.numeric)
        flips = sum(a is None or a != b for a, b in zip(one[n:], two[n:]))
        return math.sqrt(sum((a - b) ** 2 for a, b in zip(one[:n], two[:n])) + 2.0 * flips)

    def placed(self, rows: DataFrame) -> DataFrame:
        """Adds _to (distances to all pivots), _cell (the nearest one's number, from 0) and _d (its distance)."""
        return rows.withColumn("_to", F.expr(f"array({', '.join(map(self.distance_to, self.pivots))})")) \
            .withColumn("_d", F.array_min("_to")).withColumn("_cell", (F.array_position("_to", F.col("_d")) - 1).cast("int"))

    def measure(self, placed: DataFrame, k: int) -> None:
        """Per cell its radius and its k-th smallest distance, from one row a cell."""
        nth = F.row_number().over(Window.partitionBy("_cell").orderBy("_d"))
        kth = placed.select("_cell", "_d").withColumn("_n", nth).where(F.col("_n") <= k).groupBy("_cell") \
            .agg(F.max("_n").alias("n"), F.max("_d").alias("kth"))
        radius = placed.groupBy("_cell").agg(F.max("_d").alias("radius"))
        self.radius, self.kth = [-1.0] * len(self.pivots), [math.inf] * len(self.pivots)
        for r in radius.join(kth, "_cell").collect():
            self.radius[r._cell] = r.radius
            self.kth[r._cell] = r.kth if r.n == k else math.inf

    def ring(self, distance, radius):
        """Ring of a distance to the pivot in a cell of this radius."""
        return F.when(radius > 0, F.least(F.greatest(F.floor(distance / radius * RINGS), F.lit(0)), F.lit(RINGS - 1))) \
            .otherwise(F.lit(0)).cast("int")

    def at(self, values: Sequence[float], cell):
        return F.element_at(_doubles(values), cell + 1)


def _doubles(values: Sequence[float]):
    """An array of numbers, written as one literal (constant folding reads it when the query is planned)."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def _text(value: str) -> str:
    """A string literal of Spark SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _finite(columns: Sequence[str]):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) != math.inf)
    return out


def _around(cells: _Cells, queries: DataFrame) -> DataFrame:
    """One row for each ring near a query's own place."""
    own = cells.ring(F.col("_d"), cells.at(cells.radius, F.col("_cell")))
    rings = F.sequence(F.greatest(own - LOOK, F.lit(0)), F.least(own + LOOK, F.lit(RINGS - 1)))
    return queries.withColumn("_in", F.col("_cell")).withColumn("_there", F.col("_d")) \
        .withColumn("_ring", F.explode(rings)).withColumn("_bound", F.lit(math.inf))


def _visits(cells: _Cells, queries: DataFrame) -> DataFrame:
    """One row for each ring that a query visits within its _bound."""
    reach = F.col("_bound") * (1 + MARGIN) + MARGIN
    number = len(cells.pivots)
    apart = _doubles([cells.between(p, q) for p in cells.pivots for q in cells.pivots])
    rows = queries.withColumn("_in", F.explode(F.sequence(F.lit(0), F.lit(number - 1)))) \
        .withColumn("_there", F.element_at("_to", F.col("_in") + 1))
    # Distance from the query to the plane between the pivots, on whose other side the cell's items are.
    between = F.element_at(apart, F.col("_cell") * number + F.col("_in") + 1)
    plane = F.col("_there") * F.col("_there") - F.col("_d") * F.col("_d")
    rows = rows.where((F.col("_in") == F.col("_cell")) | (plane <= reach * 2.0 * between)) \
        .withColumn("_radius", cells.at(cells.radius, F.col("_in"))).where(F.col("_there") - reach <= F.col("_radius"))
    low = cells.ring(F.col("_there") - reach, F.col("_radius"))
    high = cells.ring(F.least(F.col("_there") + reach, F.col("_radius")), F.col("_radius"))
    return rows.withColumn("_ring", F.explode(F.sequence(low, high)))


def nearest(items: DataFrame, references: DataFrame, id_col: str, numeric: Sequence[str],
            categorical: Sequence[str], k: int, exclude_self: bool = True) -> DataFrame:
    """For each reference row, the ``k`` nearest items: (reference_id, item_id, distance, rank).

    A pair with a missing or infinite number on either side has no distance
    and is never ranked; a missing category differs from every other; ties go
    to the smaller item id.  Reference ids are unique.
    """
    columns = [*numeric, *categorical]
    kind = dict(items.dtypes)[id_col]
    typed = [id_col, *[F.col(f"`{c}`").cast("double").alias(c) for c in numeric],
             *[F.col(f"`{c}`").cast("string").alias(c) for c in categorical]]
    clean = items.select(*typed).where(_finite(numeric))
    cells = _Cells(clean, id_col, numeric, categorical)
    if not cells.pivots:
        return items.sparkSession.createDataFrame([], f"reference_id {kind}, item_id {kind}, distance double, rank int")
    nth = F.row_number().over(Window.partitionBy(*columns).orderBy(id_col))
    points = clean.withColumn("_n", nth).where(F.col("_n") <= k + 1).drop("_n")
    guards = range(min(GUARDS, len(cells.pivots)))
    placed = stored(cells.placed(points).select("*", *[F.col("_to")[g].alias(f"_item_{g}") for g in guards]).drop("_to"),
                    "placed-items")
    cells.measure(placed, k + 1)
    ringed = placed.select(F.col(id_col).alias("item_id"), *columns, "_d", *[f"_item_{g}" for g in guards], F.col("_cell").alias("_in"),
                           cells.ring(F.col("_d"), cells.at(cells.radius, F.col("_cell"))).alias("_ring")) \
        .withColumnRenamed("_d", "_item_d")

    asked = references.select(*typed).where(_finite(numeric))
    bounds = F.transform(F.arrays_zip(F.col("_to"), _doubles(cells.kth).alias("kth")),
                         lambda x: x["_to"] + x["kth"])
    queries = stored(cells.placed(asked).withColumn("_bound", F.array_min(bounds)).select(
        F.col(id_col).alias("reference_id"), *[F.col(c).alias(f"ref_{c}") for c in columns], "_to", "_d", "_cell", "_bound"),
        "placed-queries")
    distance = mixed_distance([(F.col(c), F.col(f"ref_{c}")) for c in numeric],
                              [(F.col(c), F.col(f"ref_{c}")) for c in categorical])
    rank = F.row_number().over(Window.partitionBy("reference_id").orderBy("distance", "item_id"))

    def found(visits: DataFrame, share: int = 1) -> DataFrame:
        some = ringed if share == 1 else ringed.where(F.pmod(F.xxhash64("item_id"), F.lit(share)) == 0)
        asks = visits.select("reference_id", *[f"ref_{c}" for c in columns], "_bound", "_there", "_in", "_ring",
                             *[F.col("_to")[g].alias(f"_query_{g}") for g in guards])
        reach = F.col("_bound") * (1 + MARGIN) + MARGIN
        near = F.abs(F.col("_item_d") - F.col("_there")) <= reach
        for g in guards:
            near = near & (F.abs(F.col(f"_item_{g}") - F.col(f"_query_{g}")) <= reach)
        pairs = asks.join(some, ["_in", "_ring"]).where(near)
        if exclude_self:
            pairs = pairs.where(F.col("reference_id") != F.col("item_id"))
        return pairs.select("reference_id", "item_id", distance.alias("distance"), reach.alias("_reach")) \
            .where(F.col("distance") <= F.col("_reach")).drop("_reach")

    def best(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("rank", rank).where(F.col("rank") <= k)

    def tightened(asking: DataFrame, visits: DataFrame, share: int) -> DataFrame:
        """The queries, bounded by the nearest items of k groups among one visited item in ``share`` (an aggregate:
        the pairs of a look are not sorted)."""
        reached = found(visits, share).groupBy("reference_id", F.pmod(F.hash("item_id"), F.lit(k)).alias("_group")) \
            .agg(F.min("distance").alias("_least")).groupBy("reference_id") \
            .agg(F.count(F.lit(1)).alias("_n"), F.max("_least").alias("_kth"))
        return stored(asking.join(reached, "reference_id", "left").withColumn(
            "_bound", F.when(F.col("_n") == k, F.least("_bound", "_kth")).otherwise(F.col("_bound"))).drop("_n", "_kth"),
            "bounded-queries")

    share = max(1, math.ceil(placed.count() / LOOKED))
    bounded = tightened(queries, _around(cells, queries), share)
    while (share := share // WIDEN) > 1:
        bounded = tightened(bounded, _visits(cells, bounded), share)
    return best(found(_visits(cells, bounded)))


def portfolio_similar(items: DataFrame, portfolio_keys: DataFrame, references: DataFrame, id_col: str,
                      numeric: Sequence[str], categorical: Sequence[str], k: int, suitable) -> DataFrame:
    """Nearest companies restricted to the portfolio (semi-join), with a suitability flag."""
    pool = items.join(portfolio_keys.select(id_col).distinct(), id_col, "left_semi")
    near = nearest(pool, references, id_col, numeric, categorical, k)
    flags = pool.select(F.col(id_col).alias("item_id"), suitable.alias("suitable"))
    return near.join(flags, "item_id")
