"""The nearest-neighbour join against all pairs."""

import math
import random

import pytest

from dealsieve.operators import similar

SCHEMA = "id long, size double, price double, kind string, place string"


def plain(items, queries, k):
    ok = lambda r: all(x is not None and math.isfinite(x) for x in r[1:3])
    out = {}
    for q in queries:
        rows = []
        for x in items:
            if ok(q) and ok(x) and x[0] != q[0]:
                total = 0.0
                for a, b in zip(x[1:3], q[1:3]):
                    total = total + (a - b) * (a - b)
                for a, b in zip(x[3:], q[3:]):
                    total = total + (0.0 if a is not None and a == b else 2.0)
                rows.append((math.sqrt(total), x[0]))
        for n, (d, i) in enumerate(sorted(rows)[:k]):
            out[q[0], n + 1] = (i, d)
    return out


def table(n, seed, scale):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, math.nan, math.inf]) if i % 37 == 5 else rng.gauss(0, scale), rng.uniform(0, scale),
             rng.choice(["a", "it's", "c\\d", None]), rng.choice([None, *"xyzuvw"])) for i in range(n)]
    return rows + [(10_000 + i, 1.0, 1.0, "a", "x") for i in range(300)] + [(20_000 + i, 0.0, 0.0, None, None) for i in range(30)]


def found(spark, items, queries, k):
    out = similar.nearest(spark.createDataFrame(items, SCHEMA).repartition(3), spark.createDataFrame(queries, SCHEMA), "id",
                          ["size", "price"], ["kind", "place"], k).collect()
    return {(r.reference_id, r["rank"]): (r.item_id, r.distance) for r in out}


@pytest.mark.parametrize("scale", [0.5, 8.0, 1e6])
@pytest.mark.parametrize("k", [1, 5])
def test_equals_all_pairs(spark, k, scale):
    items = table(700, 3, scale)
    queries = [r for r in items if r[0] % 20 == 0] + [(-1, 1e9, -1e9, "q", None), (-2, None, 1.0, "a", "x")]
    assert found(spark, items, queries, k) == plain(items, queries, k)


def test_fewer_items_than_asked_for_and_empty_tables(spark):
    items = table(0, 1, 1.0)[:3]
    queries = items[:1]
    assert found(spark, items, queries, 5) == plain(items, queries, 5)
    assert found(spark, items, [], 5) == {}
    assert found(spark, [], queries, 5) == {}
    assert found(spark, [(1, None, 1.0, "a", "x")], queries, 5) == {}


def test_a_point_held_by_many_items_travels_k_times(spark):
    items = [(i, 1.0, 2.0, "a", "x") for i in range(5000)] + [(9000, 1.5, 2.0, "a", "x")]
    queries = [(9000, 1.5, 2.0, "a", "x"), (3, 1.0, 2.0, "a", "x")]
    assert found(spark, items, queries, 4) == {
        **{(9000, n + 1): (n, 0.5) for n in range(4)}, **{(3, n + 1): (i, 0.0) for n, i in enumerate([0, 1, 2, 4])}}
