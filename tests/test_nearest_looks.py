"""Looks at shares of the items bound the search without sorting the pairs they meet."""

import pytest

from dealsieve.operators import similar
from tests.test_nearest import found, plain, table


@pytest.mark.parametrize("looked", [40, 1 << 19])
def test_looks_sort_no_pairs_and_lose_none(spark, monkeypatch, looked):
    plans, plain_stored = [], similar.stored

    def seen(df, name):
        if name == "bounded-queries":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain_stored(df, name)
    monkeypatch.setattr(similar, "stored", seen)
    monkeypatch.setattr(similar, "LOOKED", looked, raising=False)
    monkeypatch.setattr(similar, "WIDEN", 3, raising=False)
    items = table(700, 3, 8.0)
    queries = [r for r in items if r[0] % 20 == 0] + [(-1, 1e9, -1e9, "q", None), (-2, None, 1.0, "a", "x")]
    assert found(spark, items, queries, 5) == plain(items, queries, 5)
    assert len(plans) == (3 if looked == 40 else 1) and not any("Window" in p for p in plans)
