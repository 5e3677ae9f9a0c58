"""Decision rows in one pass: equal to a plain search, and one exchange for all decisions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dealsieve.operators import asof


def day(n):
    return None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def awkward(spark, seed=5):
    """Decisions and two fact tables with nulls, ties, repeats, a hot company and clashing column names."""
    rng = random.Random(seed)
    company = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", None])
    when = lambda: rng.choice([rng.randrange(0, 200), 31, 31, None])
    dec = [(company(), day(when()), rng.choice(["x", None])) for _ in range(150)]
    dec += dec[:10]
    one = [(company(), day(when()), rng.choice([1, 2, None]), rng.choice(["p", "q", None])) for _ in range(300)]
    two = [(company(), day(when()), rng.random()) for _ in range(40)] + [("hot", day(-400), 0.5)]
    return (spark.createDataFrame(dec, "company_number string, decision_date timestamp_ntz, filings__note string"),
            spark.createDataFrame(one, "company_number string, fact_date timestamp_ntz, k int, decision_date string"),
            spark.createDataFrame(two, "company_number string, fact_date timestamp_ntz, _row double"), dec, one, two)


def low(x):
    """Nulls first, as Spark orders them."""
    return (x is not None, x if x is not None else 0)


def newest(facts, company, at):
    known = [f for f in facts if company is not None and at is not None
             and f[0] == company and f[1] is not None and f[1] <= at]
    return max(known, key=lambda f: tuple(low(x) for x in f[1:]))[1:] if known else None


@pytest.mark.parametrize("bucket", ["month", "year", "day"])
def test_merge_equals_plain_search(spark, bucket):
    decisions, one, two, dec_rows, one_rows, two_rows = awkward(spark)
    out = asof.decision_rows(decisions, {"filings": (one, ["k"]), "tenders": (two, []), "charges": None},
                             bucket=bucket)
    assert out.columns == ["company_number", "decision_date", "filings__note", "filings__fact_date", "filings__k",
                           "filings__decision_date", "tenders__fact_date", "tenders___row"]
    want = [(c, at, note, *(newest(one_rows, c, at) or (None,) * 3), *(newest(two_rows, c, at) or (None,) * 2))
            for c, at, note in dec_rows]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_merge_and_join_agree_on_driver_data(spark):
    from dealsieve.plans import views as V
    sf = "/root/testdata/sf0.001"
    a, b = (asof.decision_rows(V.decisions(spark, sf), V.fact_tables(spark, sf), strategy=s) for s in ("merge", "join"))
    assert a.columns == b.columns and a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_exchanges_the_decisions_once(spark):
    """Both readers of the events share one exchange, and only months' summaries travel besides."""
    decisions, one, two, *_ = awkward(spark)
    out = asof.decision_rows(decisions, {"filings": (one, ["k"]), "tenders": (two, [])})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    carried = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line
               and "REPARTITION_BY_COL" in line and "Reused" not in line]
    assert len(carried) == 1 and "ReusedExchange" in plan


def test_merge_of_nothing(spark):
    decisions, one, two, *_ = awkward(spark)
    assert asof.decision_rows(decisions, {}).collect() == decisions.collect()
    none = asof.decision_rows(decisions.limit(0), {"filings": (one, ["k"])})
    assert none.count() == 0 and "filings__k" in none.columns
    bare = asof.decision_rows(decisions, {"filings": (one.limit(0), ["k"])})
    assert bare.count() == 160 and bare.where(F.col("filings__fact_date").isNotNull()).count() == 0
    with pytest.raises(ValueError, match="lack column"):
        asof.decision_rows(decisions, {"filings": (one, ["nope"])})
