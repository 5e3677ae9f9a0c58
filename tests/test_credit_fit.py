"""The logistic fit: its optimum, hard cases, and an independent fit."""

import math
import random

import numpy as np
import pytest

from dealsieve.operators import credit

SCHEMA = "k long, a double, b double, y int"


def table(n, seed, scale=1.0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.gauss(0, scale), rng.uniform(0, 5)
        out.append((i, a, b, int(rng.random() < 1 / (1 + math.exp(-(0.3 + 1.5 * a / scale - 0.6 * b))))))
    return out


def gradient(rows, w):
    x = np.array([[1.0, r[1], r[2]] for r in rows])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return x.T @ (np.array([r[3] for r in rows]) - p) - np.array([0.0, w[1], w[2]])


@pytest.mark.parametrize("scale", [0.01, 1.0, 1000.0])
def test_the_gradient_is_zero_at_the_fit(spark, scale):
    rows = table(600, 4, scale)
    w = np.array(credit.fit_logistic(spark.createDataFrame(rows, SCHEMA).repartition(3), ["a", "b"], "y"))
    assert np.abs(gradient(rows, w) / np.array([1, scale, 1])).max() < 1e-6


def test_equals_the_library_fit(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame(table(400, 9), SCHEMA)
    ours = credit.fit_logistic(df, ["a", "b"], "y")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(df.withColumn("y", df.y.cast("double")))
    model = LogisticRegression(featuresCol="x", labelCol="y", regParam=1 / 400, elasticNetParam=0.0, standardization=False,
                               tol=1e-10, maxIter=500).fit(rows)
    assert np.allclose(ours, [model.intercept, *model.coefficients], atol=1e-4)


def test_from_a_far_start_and_on_separated_classes(spark):
    rows = table(300, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    near, far = (credit.fit_logistic(df, ["a", "b"], "y", start=s) for s in (None, [40.0, -30.0, 20.0]))
    assert np.allclose(near, far, atol=1e-6)
    apart = spark.createDataFrame([(i, float(i - 50), 0.0, int(i >= 50)) for i in range(100)], SCHEMA)
    w = credit.fit_logistic(apart, ["a", "b"], "y")
    assert all(map(math.isfinite, w)) and w[1] > 0


def test_one_class_or_no_rows(spark):
    one = spark.createDataFrame([(i, float(i), 1.0, 1) for i in range(20)], SCHEMA)
    assert all(map(math.isfinite, credit.fit_logistic(one, ["a", "b"], "y", max_iter=30)))
    assert credit.fit_logistic(one.limit(0), ["a", "b"], "y") == [0.0, 0.0, 0.0]
