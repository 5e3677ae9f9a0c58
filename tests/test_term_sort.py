"""The norm and the rank of a document's terms share one sort."""

import math

from dealsieve.operators import text_models as TM


def test_terms_of_a_document_are_sorted_once(spark):
    docs = spark.createDataFrame([(1, "aa bb bb cc"), (2, "bb dd"), (2, "dd ee"), (None, "aa"), (3, None)], "doc_id long, text string")
    top = TM.key_terms(docs, k=2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert sum("Sort [doc_id" in line for line in plan.splitlines()) == 1
    idf = {t: math.log(6 / (1 + n)) + 1 for t, n in {"aa": 2, "bb": 2, "cc": 1, "dd": 1, "ee": 1}.items()}
    raw = {1: {"aa": idf["aa"], "bb": 2 * idf["bb"], "cc": idf["cc"]}, 2: {"bb": idf["bb"], "dd": 2 * idf["dd"], "ee": idf["ee"]},
           None: {"aa": idf["aa"]}}
    expected = []
    for doc_id, terms in raw.items():
        norm = math.sqrt(sum(x * x for x in terms.values()))
        for place, t in enumerate(sorted(terms, key=lambda t: (-terms[t], t))[:2]):
            expected.append((doc_id, t, place + 1, round(terms[t] / norm, 9)))
    assert sorted(((r.doc_id, r.term, r["rank"], round(r.weight, 9)) for r in top.collect()), key=str) == sorted(expected, key=str)
