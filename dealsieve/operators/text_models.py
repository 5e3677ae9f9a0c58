"""Text features and the industry classifier (TF-IDF + multinomial logistic regression).

Weighting follows the smoothed TF-IDF rule: idf = ln((1+n)/(1+df)) + 1, then
L2-normalised rows.  Spark's ``IDF`` omits the ``+ 1``, so the pipeline
multiplies term counts by (idf + 1) with ``ElementwiseProduct`` (the idf
vector has at most ``vocab_size`` entries) and normalises with ``Normalizer``.
The logistic objective matches an L2 penalty with C = 1: regParam = 1/n,
no standardisation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, IDF, IndexToString, Normalizer,
                                RegexTokenizer, StringIndexer)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealsieve.functions.text import TOKEN_PATTERN, tokens
from dealsieve.operators.hotcold import lookup_by_frequency
from dealsieve.session import spread_for_cpu, stored

# Classifier settings and the review rule (fixed values).
MAXIMUM_VOCABULARY_SIZE = 5000
MAXIMUM_ITERATIONS = 1000
CONFIDENCE_REVIEW_THRESHOLD = 0.60
HASH_PREFIX = 4               # hexadecimal digits of an id's hash that are counted (65,536 prefixes at most)
STOPPING_TOLERANCE = 1e-4     # the common solver default for this objective


def vocabulary(docs: DataFrame, text_col: str, size: int) -> list[str]:
    """The ``size`` most frequent terms, most frequent first, ties by the term itself.

    A top-k over a partial aggregate, so the list does not depend on how the
    rows are partitioned; it is never empty (a model needs one term).
    """
    counts = docs.select(F.explode(tokens(text_col)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return [r.term for r in counts.orderBy(F.desc("n"), "term").limit(size).select("term").collect()] or [""]


def fit_industry_classifier(labelled: DataFrame, text_col: str = "website_text", label_col: str = "industry_code",
                            vocab_size: int = MAXIMUM_VOCABULARY_SIZE,
                            max_iter: int = MAXIMUM_ITERATIONS, fit_rows: int | None = None,
                            id_col: str = "company_number") -> PipelineModel:
    """Fit tokeniser, vocabulary, smoothed TF-IDF and the multinomial model on labelled text.

    Everything comes from all labelled rows: vocabulary, document frequencies
    and labels by partial aggregates, the logistic model by passes over the
    term counts, which are stored once.  A caller may bound the rows of the
    logistic fit alone by ``fit_rows``: the first by md5 of ``id_col`` (the
    same rows on every run, and equal texts do not travel together), and one
    more row of each label that has none of them.
    """
    usable = spread_for_cpu(labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()))
    indexer = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc").fit(usable)
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True)
    cv = CountVectorizerModel.from_vocabulary(vocabulary(usable, text_col, vocab_size), "_tokens", "_tf")
    front = PipelineModel(stages=[tok, cv])
    if fit_rows is not None:
        key = F.struct(F.md5(F.col(id_col).cast("string")), F.col(text_col))
        some = stored(_smallest_hashes(usable, id_col, fit_rows).orderBy(key, label_col).limit(fit_rows)
                      .select(text_col, label_col), "sampled-text")
        seen = [r[0] for r in some.select(F.col(label_col).cast("string")).distinct().collect()]
        unseen = usable.where(~F.col(label_col).cast("string").isin(seen)).groupBy(label_col) \
            .agg(F.min_by(text_col, key).alias(text_col)).select(text_col, label_col)
        sample = some.unionAll(unseen) if len(seen) < len(indexer.labels) else some
        counted = stored(front.transform(spread_for_cpu(sample)).select(label_col, "_tf"), "term-counts")
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(front.transform(usable).select("_tf"))
    else:
        # Tokenising is the costly pass; the fits read the stored counts.
        counted = stored(front.transform(usable).select(label_col, "_tf"), "term-counts")
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted)
    n = counted.count()
    scale = ElementwiseProduct(scalingVec=Vectors.dense([w + 1.0 for w in idf.idf.toArray()]),
                               inputCol="_tf", outputCol="_w")
    norm = Normalizer(inputCol="_w", outputCol="_features", p=2.0)
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", family="multinomial",
                            maxIter=max_iter, regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                            standardization=False, tol=STOPPING_TOLERANCE)
    back = Pipeline(stages=[scale, norm, indexer, lr]).fit(counted)
    to_label = IndexToString(inputCol="prediction", outputCol="predicted_code", labels=indexer.labels)
    return PipelineModel(stages=[*front.stages, *back.stages, to_label])


def _smallest_hashes(rows: DataFrame, id_col: str, n: int) -> DataFrame:
    """The rows whose id hash starts with one of the smallest prefixes, as many prefixes as hold ``n`` rows.

    The first ``n`` rows by hash are among them.  The prefixes are counted on
    the ids alone, so no more than about ``n`` texts meet for the final order,
    however many partitions the table has.
    """
    prefix = F.coalesce(F.substring(F.md5(F.col(id_col).cast("string")), 1, HASH_PREFIX), F.lit(""))
    held, last = 0, None
    for r in rows.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():
        if held >= n:
            break
        held, last = held + r.n, r.p
    return rows if last is None else rows.where(prefix <= last)


def classify(model: PipelineModel, companies: DataFrame, text_col: str = "website_text") -> DataFrame:
    """Predicted code and its probability (the confidence) per row."""
    scored = model.transform(companies.withColumn(text_col, F.coalesce(F.col(text_col), F.lit(""))))
    keep = [c for c in companies.columns]
    return scored.select(*keep, "predicted_code",
                         F.array_max(vector_to_array("probability")).alias("confidence"))


def review_routing(classified: DataFrame, threshold: float = CONFIDENCE_REVIEW_THRESHOLD) -> DataFrame:
    """Low confidence or disagreement with the filed code goes to review (null filed disagrees)."""
    disagrees = ~F.col("predicted_code").eqNullSafe(F.col("filed_sic_code"))
    return classified.select(
        "company_number", "predicted_code", "confidence", "filed_sic_code",
        ((F.col("confidence") < F.lit(threshold)) | disagrees).alias("needs_review"),
        disagrees.alias("disagrees_with_filed"))


def term_weights(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf, df, weight) with smoothed idf and L2-normalised weights per document.

    Term frequency and document frequency are partial aggregates; the document
    count is one scalar action.  Terms held by most documents take their
    document frequency from a small map instead of meeting in one task.
    """
    n = docs.count()
    terms = docs.select(id_col, F.explode_outer(tokens(text_col)).alias("term")).where(F.col("term").isNotNull())
    tf = terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    # Counting on tf keeps that column, so both readers of tf have the same columns and share its exchange.
    df = tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    idf = F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    w = lookup_by_frequency(tf, df, "term", "df").withColumn("raw", F.col("tf") * idf)
    # The order of key_terms: the norm and the rank then share one sort.
    norm = _by_weight(id_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return w.withColumn("weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(norm)))


def _by_weight(id_col: str):
    """The terms of a document from the heaviest on, ties by term."""
    return Window.partitionBy(id_col).orderBy(F.desc("raw"), "term")


def key_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """Top-k terms per document by TF-IDF weight (ties by term); a per-group top-k, limited map-side."""
    w = term_weights(docs, id_col, text_col)
    rank = F.row_number().over(_by_weight(id_col))
    return w.withColumn("rank", rank).where(F.col("rank") <= k).select(id_col, "term", "rank", "weight")


def keyword_onehot(docs: DataFrame, keywords: Sequence[str], id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One 0/1 column per keyword: does the document's token list contain it."""
    t = docs.select(id_col, tokens(text_col).alias("_t"))
    return t.select(id_col, *[F.array_contains("_t", kw).cast("int").alias(f"kw_{kw}") for kw in keywords])


# Words and wording of the engineered text flags over annual reports (defaults; pass others for other texts).
NEGATIVE_WORDS = ["loss", "losses", "decline", "adverse", "impairment", "default", "breach", "insolvency",
                  "uncertainty", "doubt"]
GOING_CONCERN_PATTERN = "going concern"


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  negative_words: Sequence[str] = NEGATIVE_WORDS,
                  going_concern_pattern: str = GOING_CONCERN_PATTERN) -> DataFrame:
    """Token counts and two flags per document, all built-in expressions."""
    t = docs.select(id_col, text_col, tokens(text_col).alias("_t"))
    return t.select(
        id_col,
        F.size("_t").alias("n_tokens"),
        F.size(F.array_distinct("_t")).alias("n_distinct_tokens"),
        F.size(F.split(text_col, "\n")).alias("n_lines"),
        F.arrays_overlap("_t", F.array(*[F.lit(w) for w in negative_words])).cast("int")
        .alias("report_negative_language_flag"),
        (F.instr(F.lower(text_col), going_concern_pattern) > 0).cast("int").alias("going_concern_flag"))
