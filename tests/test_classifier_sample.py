"""The classifier's corpus statistics cover all labelled rows, whatever the size of the fit."""

import hashlib

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, StringIndexerModel

from dealsieve.operators import text_models as TM


def test_a_bounded_fit_keeps_all_terms_and_labels(spark):
    other = [(f"word{i % 7} tail{i}", f"L{i % 3}") for i in range(40)]
    # One text that comes first by md5 fills a sample ordered by the text.
    low = min((f"copy{i} shared" for i in range(5000)), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert all(hashlib.md5(low.encode()).digest() < hashlib.md5(t.encode()).digest() for t, _ in other)
    rows = [(f"{i:08d}", t, lab) for i, (t, lab) in enumerate([(low, "copies")] * 60 + other + [("rare once", "only")])]
    labelled = spark.createDataFrame(rows, "company_number string, website_text string, industry_code string")
    bounded = TM.fit_industry_classifier(labelled, fit_rows=20, max_iter=20)
    whole = TM.fit_industry_classifier(labelled, max_iter=20)
    terms = lambda m: next(s for s in m.stages if isinstance(s, CountVectorizerModel)).vocabulary       # noqa: E731
    labels = lambda m: next(s for s in m.stages if isinstance(s, StringIndexerModel)).labels            # noqa: E731
    weights = lambda m: next(s for s in m.stages if hasattr(s, "getScalingVec")).getScalingVec()        # noqa: E731
    assert terms(bounded) == terms(whole) and {"rare", "tail39", "word0"} <= set(terms(bounded))
    assert list(labels(bounded)) == ["L0", "L1", "L2", "copies", "only"]
    assert (abs(weights(bounded).toArray() - weights(whole).toArray()) < 1e-12).all()
    found = {r.website_text: r.predicted_code for r in TM.classify(bounded, labelled).collect()}
    assert found[low] == "copies" and len(set(found.values())) >= 3
    fitted = next(s for s in bounded.stages if isinstance(s, LogisticRegressionModel)).coefficientMatrix.toArray()
    assert fitted[:, terms(bounded).index("rare")].argmax() == labels(bounded).index("only")    # its row was fitted on
