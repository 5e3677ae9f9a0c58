"""Credit scoring: hash split, logistic fit, exact held-out ROC AUC, text-feature lift."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealsieve.operators.quantiles import coarse_bucket, fine_bucket
from dealsieve.session import stored

# Model inputs and split (fixed values).
RATIO_FEATURE_COLUMNS = ["current_ratio", "gearing", "retained_earnings_to_assets"]
TEXT_FEATURE_COLUMNS = ["report_negative_language_flag", "going_concern_flag"]
LABEL_COLUMN = "defaulted_within_year"
TEST_SET_FRACTION = 0.25
MAXIMUM_ITERATIONS = 1000
FURTHEST = 30.0             # linear predictors beyond this count as this: their probability is 0 or 1 to 13 digits
SETTLED = 1e-6              # a step this small is the last: what remains is about its square
DECIMALS = 9                # of the weights that score


def hash_split(df: DataFrame, key: str, test_fraction: float = TEST_SET_FRACTION) -> DataFrame:
    """Adds ``is_test``: md5 of the key, first two hex digits below the fraction of 256.

    Deterministic per key, so reruns and retried tasks give the same split.
    """
    cut = f"{int(round(test_fraction * 256)):02x}"
    return df.withColumn("is_test", F.substring(F.md5(F.col(key).cast("string")), 1, 2) < F.lit(cut))


def auc_exact(scored: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Exact ROC AUC (ties count one half) without sorting all scores in one task.

    Positives p and negatives q are counted per distinct score (a partial
    aggregate) and stored.  The negatives below a score are three running
    totals: over coarse buckets of the scores' magnitude (a few thousand for
    any doubles, so that window is bounded), over fine buckets inside a coarse
    one, and over the scores inside a fine one.  Scores may be of any range.
    AUC = sum p * (below + q/2) / (P * Q); null when a class is absent.
    """
    s = F.col(score_col).cast("double")
    per_score = stored(
        scored.where(s.isNotNull() & ~F.isnan(s) & F.col(label_col).isNotNull()).groupBy((s + F.lit(0.0)).alias("s"))
        .agg(F.sum((F.col(label_col) == 1).cast("long")).alias("p"),
             F.sum((F.col(label_col) != 1).cast("long")).alias("q"))
        .select("*", coarse_bucket(F.col("s")).alias("b")).select("*", fine_bucket(F.col("s"), F.col("b")).alias("f")),
        "score-counts")

    def before(keys: list[str], order: str, total: str):
        w = (Window.partitionBy(*keys) if keys else Window).orderBy(order)
        return F.coalesce(F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fine = per_score.groupBy("b", "f").agg(F.sum("q").alias("qf"))
    coarse = fine.groupBy("b").agg(F.sum("qf").alias("qb"))
    offsets = fine.select("b", "f", before(["b"], "f", "qf").alias("in_b")) \
        .join(coarse.select("b", before([], "b", "qb").alias("under_b")), "b") \
        .select("b", "f", (F.col("in_b") + F.col("under_b")).alias("off"))
    ranked = per_score.withColumn("qin", before(["b", "f"], "s", "q")).join(offsets, ["b", "f"])
    below = (F.col("off") + F.col("qin")).cast("double")
    num = F.sum(F.col("p").cast("double") * (below + F.col("q").cast("double") / 2.0))
    return ranked.agg(num.alias("_num"), F.sum("p").alias("positives"), F.sum("q").alias("negatives")).select(
        F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
               F.col("_num") / (F.col("positives").cast("double") * F.col("negatives").cast("double"))).alias("auc"),
        "positives", "negatives")


def complete_rows(training: DataFrame, columns: Sequence[str], label_col: str = LABEL_COLUMN) -> DataFrame:
    """The rows that a model can use: every feature present and finite, and a label."""
    ok = F.col(label_col).isNotNull()
    for c in columns:
        v = F.col(c).cast("double")
        ok = ok & v.isNotNull() & (F.abs(v) < F.lit(float("inf")))      # NaN is above infinity in Spark's order
    return training.where(F.coalesce(ok, F.lit(False)))


def _predictor(columns: Sequence[str], weights: Sequence[float]):
    """Intercept plus weighted columns.  The weights are one array literal, which generated code holds by reference, so
    the steps of a fit share one compiled program."""
    w = F.expr(f"array({', '.join(f'{float(x)!r}D' for x in weights)})")
    z = w[0]
    for j, c in enumerate(columns):
        z = z + w[j + 1] * F.col(c).cast("double")
    return z


def fit_logistic(train: DataFrame, feature_columns: Sequence[str], label_col: str = LABEL_COLUMN,
                 max_iter: int = MAXIMUM_ITERATIONS, start: Sequence[float] | None = None) -> list[float]:
    """Intercept and weights of the logistic model with L2 penalty C = 1 (no standardisation, intercept free).

    Newton steps on sufficient statistics: every step sums X'(y - p) and X'WX
    over the rows by partial aggregates, so a step is one pass and the driver
    solves a system as wide as the features.  A step is shortened by
    log(1 + s) / s, where s bounds the change it makes to any row's predictor
    (weights' change times largest absolute values); this keeps every step a
    descent and fades out near the optimum.  Without rows all weights are 0.
    """
    d = len(feature_columns) + 1
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in feature_columns]]
    first = train.agg(F.count(F.lit(1)), *[F.max(F.abs(v)) for v in x[1:]]).first()
    weights = np.array(start if start is not None else [0.0] * d)
    if not first[0]:
        return weights.tolist()
    largest = np.array([1.0, *first[1:]])
    ridge = np.diag([0.0] + [1.0] * (d - 1))
    rows, cols = np.triu_indices(d)
    y = F.col(label_col).cast("double")
    totals = [F.sum(v * (y - F.col("_p"))) for v in x]
    totals += [F.sum(x[i] * x[j] * F.col("_w")) for i, j in zip(rows, cols)]
    for _ in range(max_iter):
        z = F.least(F.greatest(_predictor(feature_columns, weights), F.lit(-FURTHEST)), F.lit(FURTHEST))
        rated = train.withColumn("_p", 1.0 / (1.0 + F.exp(-z))).withColumn("_w", F.col("_p") * (1.0 - F.col("_p")))
        sums = np.array(rated.agg(*totals).first(), float)
        hessian = np.zeros((d, d))
        hessian[rows, cols] = hessian[cols, rows] = sums[d:]
        step = np.linalg.solve(hessian + ridge, sums[:d] - ridge @ weights)
        moved = float(np.abs(step) @ largest)
        weights = weights + step * (np.log1p(moved) / moved if moved > 0 else 1.0)
        if moved < SETTLED:
            break
    return weights.tolist()


def train_and_evaluate(split: DataFrame, feature_columns: Sequence[str], label_col: str = LABEL_COLUMN,
                       max_iter: int = MAXIMUM_ITERATIONS) -> DataFrame:
    """Fit a logistic model (``fit_logistic``) on the training rows; one-row held-out AUC.

    Rows must be complete (``complete_rows``).  Rows are ranked by the linear
    predictor, which orders them as the probability does, with the weights
    rounded to ``DECIMALS`` digits.
    """
    fitted = fit_logistic(split.where(~F.col("is_test")), feature_columns, label_col, max_iter)
    return held_out_auc(split, feature_columns, fitted, label_col)


def held_out_auc(split: DataFrame, feature_columns: Sequence[str], weights: Sequence[float],
                 label_col: str = LABEL_COLUMN) -> DataFrame:
    scored = split.where(F.col("is_test")) \
        .withColumn("_z", _predictor(feature_columns, [round(w, DECIMALS) for w in weights]))
    return auc_exact(scored, label_col, "_z")


def text_feature_lift(training: DataFrame, key: str, label_col: str = LABEL_COLUMN) -> DataFrame:
    """AUC with ratios only, with ratios + text flags, and the difference, on one identical split.

    Both fits use the rows that are complete in every feature; ``rows_used``
    and ``rows_left_out`` say how many there are.  The split is stored, so both
    fits read exactly the same rows.
    """
    every = [*RATIO_FEATURE_COLUMNS, *TEXT_FEATURE_COLUMNS]
    split = stored(hash_split(complete_rows(training, every, label_col), key).select(key, label_col, "is_test", *every),
                   "credit-split")
    used, seen = split.count(), training.count()
    train = split.where(~F.col("is_test"))
    ratio = fit_logistic(train, RATIO_FEATURE_COLUMNS, label_col)
    text = fit_logistic(train, every, label_col, start=[*ratio, *[0.0] * len(TEXT_FEATURE_COLUMNS)])
    ratio_only = held_out_auc(split, RATIO_FEATURE_COLUMNS, ratio, label_col).withColumn("_which", F.lit("ratio"))
    with_text = held_out_auc(split, every, text, label_col).withColumn("_which", F.lit("text"))
    both = ratio_only.unionByName(with_text).agg(
        F.max(F.when(F.col("_which") == "ratio", F.col("auc"))).alias("ratio_only_auc"),
        F.max(F.when(F.col("_which") == "text", F.col("auc"))).alias("with_text_auc"))
    return both.select("ratio_only_auc", "with_text_auc",
                       (F.col("with_text_auc") - F.col("ratio_only_auc")).alias("text_feature_lift"),
                       F.lit(used).cast("long").alias("rows_used"),
                       F.lit(seen - used).cast("long").alias("rows_left_out"))
