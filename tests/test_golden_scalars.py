"""Golden rows for the scalar functions (FIXTURES.md section 2)."""

import math

import pytest
from pyspark.sql import functions as F

from dealsieve.functions import finance as fin
from dealsieve.functions import names as N
from dealsieve.functions import text as TX
from dealsieve.functions.similarity import _ratio


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_normalise(spark):
    got = one(spark, N.normalise_name("n"), [("Acme Builders Limited",), ("A & B-C (Été) Ltd.",),
                                             ("Public Limited Company",), ("L.L.P.",), ("  ltd  Smith\tJones ",)],
              "n string")
    assert got == ["acme builders", "a bc été", "public company", "", "smithjones"]


def test_shingles(spark):
    got = one(spark, F.array_sort(N.shingles("n")), [("a b c",), ("ab",), ("",)], "n string")
    assert got == [sorted(["a_b", "_b_", "b_c"]), ["ab"], [""]]


def test_minhash_slot_value(spark):
    got = one(spark, N.minhash(F.array(F.lit("acm")))[0], [(1,)], "x int")
    assert got == ["1787411d2e312f84d70e9182a6a68b28"]


def test_minhash_matches_integer_minimum(spark):
    import hashlib
    shingles = ["acm", "cme", "me_", "e_b", "_bu"]
    expected = [format(min(int(hashlib.md5(f"{k}:{s}".encode()).hexdigest(), 16) for s in shingles), "032x")
                for k in range(64)]
    got = one(spark, N.minhash(F.array(*[F.lit(s) for s in shingles])), [(1,)], "x int")[0]
    assert got == expected


def test_signature_similarity(spark):
    a = F.array(*[F.lit(str(i)) for i in range(64)])
    b = F.array(*[F.lit(str(i if i < 40 else -i)) for i in range(64)])
    assert one(spark, N.signature_similarity(a, b), [(1,)], "x int") == [40 / 64]


@pytest.mark.parametrize("a,b,expected", [
    ("acme builders", "acme builder", 0.96), ("smith plumbing", "smiths plumbing", 0.965517),
    ("northern steel", "nothern steel", 0.962963), ("tide", "diet", 0.25), ("diet", "tide", 0.5), ("", "", 1.0)])
def test_sequence_ratio(a, b, expected):
    assert round(_ratio(a, b), 6) == expected


def test_sequence_ratio_udf(spark):
    from dealsieve.functions.similarity import sequence_ratio
    got = one(spark, sequence_ratio("a", "b"), [("tide", "diet"), ("diet", "tide")], "a string, b string")
    assert got == [0.25, 0.5]


def test_pair_score(spark):
    from dealsieve.operators.resolve import pair_score
    rows = [(0.96, None, None, None, None), (0.85, "P1", "P1", "S1", "S1"), (1.0, "P1", "P2", "S1", "S1"),
            (1.0, "P1", "P2", None, "S1")]
    got = one(spark, F.round(pair_score(F.col("r"), F.col("p1"), F.col("p2"), F.col("s1"), F.col("s2")), 6), rows,
              "r double, p1 string, p2 string, s1 string, s2 string")
    assert got == [0.96, 0.91, 0.8, 0.75]


def test_has_value(spark):
    got = one(spark, N.has_value("v"), [(None,), ("",), ("  ",), ("x",)], "v string")
    assert got == [False, False, False, True]


def test_safe_key(spark):
    assert one(spark, N.safe_key("k"), [("Smith/Jones Ltd",)], "k string") == ["smith_jones_ltd"]


def test_distress_formulas(spark):
    rows = [(100.0, 50.0, 20.0, 200.0, 400.0, 1000.0), (100.0, 50.0, None, 200.0, 400.0, 0.0)]
    schema = "wc double, re double, ebit double, bve double, tl double, ta double"
    full = one(spark, F.round(fin.full_distress_score("wc", "re", "ebit", "bve", "tl", "ta"), 6), rows, schema)
    reduced = one(spark, F.round(fin.reduced_distress_score("wc", "re", "bve", "tl", "ta"), 6), rows, schema)
    assert full == [1.4784, None] and reduced == [1.344, None]


def test_revenue_ratio(spark):
    rows = [(9_000_000.0,), (10_000_000.0,), (12_000_000.0,), (None,), (-1.0,)]
    ratio = fin.disagreement_ratio("m", fin.estimate_revenue(F.lit(50.0), F.lit(100_000.0)))
    got = one(spark, F.struct(F.round(ratio, 6), fin.revenue_usable(ratio)), rows, "m double")
    assert [tuple(g) for g in got] == [(1.8, True), (2.0, True), (2.4, False), (None, False), (None, False)]


def test_mixed_distance(spark):
    d = fin.mixed_distance([(F.col("a"), F.col("b"))], [(F.col("c"), F.col("d"))])
    assert round(one(spark, d, [(1.0, 2.0, "x", "y")], "a double, b double, c string, d string")[0], 4) == 1.7321


def test_page_text(spark):
    html = "<p>ISO&nbsp;9001</p>\n<b>Cyber  Essentials</b>"
    assert one(spark, TX.page_text("h"), [(html,)], "h string") == [" iso&nbsp;9001 cyber essentials "]


def test_citation_snippet(spark):
    text = "x" * 200 + "iso 9001 certified"
    got = one(spark, TX.citation_snippet("t", "iso 9001"), [(text,), ("nothing here",)], "t string")
    assert got[0] == "x" * 120 + "iso 9001 certified" and len(got[0]) == 138 and got[1] is None


def test_citation_near_start_is_clipped(spark):
    got = one(spark, TX.citation_snippet("t", "iso"), [("ab iso cd",)], "t string")
    assert got == ["ab iso cd"]


def test_first_citation_variants(spark):
    got = one(spark, TX.first_citation("t", ["iso 9001", "iso9001"]), [("we hold iso9001",), ("none",)], "t string")
    assert got == ["we hold iso9001", None]


def test_is_abstained(spark):
    assert one(spark, TX.is_abstained("b"), [("ABSTAINED. x",), ("Scored. y",)], "b string") == [True, False]


def test_ratio_bound_is_an_upper_bound():
    import random
    rnd = random.Random(7)
    for _ in range(500):
        a = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))
        bound = 1.0 if not a and not b else 2 * min(len(a), len(b)) / (len(a) + len(b))
        assert _ratio(a, b) <= bound + 1e-12
    assert not math.isnan(_ratio("", "x"))
