"""Validation harness: error statistics and interval calibration per method.

One ``groupBy(method_name)`` computes every method's report in a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.operators.quantiles import exact_quantiles
from dealsieve.schemas import nan_to_null, require_columns

# Reported error quantiles and the interval coverage target (fixed values).
ERROR_QUANTILES = [0.05, 0.25, 0.50, 0.75, 0.95]
INTERVAL_COVERAGE_TARGET = 0.80


def validation_report(estimates: DataFrame, quantiles: list[float] = ERROR_QUANTILES,
                      target: float = INTERVAL_COVERAGE_TARGET) -> DataFrame:
    """Per method: sample size (all rows), error mean / sample std / worst / bias word,
    error quantiles (linear), observed interval coverage and the calibrated flag.

    Errors are estimate - filed; rows with a missing side drop out of the error
    statistics but count as outside the interval.  Bias is "underestimates" at
    exactly zero mean and null when no error exists.
    """
    require_columns(estimates, ["method_name", "estimated_value", "filed_value",
                                "interval_lower", "interval_upper"], "estimates")
    est = nan_to_null(estimates).withColumn("_err", F.col("estimated_value") - F.col("filed_value"))
    err = F.col("_err")
    inside = F.coalesce((F.col("filed_value") >= F.col("interval_lower"))
                        & (F.col("filed_value") <= F.col("interval_upper")), F.lit(False))
    agg = est.groupBy("method_name").agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(err).alias("mean_error"),
        F.stddev_samp(err).alias("error_standard_deviation"),
        F.max(F.abs(err)).alias("worst_case_error"),
        F.avg(inside.cast("double")).alias("observed_coverage"),
    )
    qs = exact_quantiles(est, ["method_name"], "_err", quantiles).drop("n")
    mean = F.col("mean_error")
    return agg.join(qs, "method_name", "left").select(
        "method_name", "sample_size", "mean_error", "error_standard_deviation", "worst_case_error",
        F.when(mean > 0, F.lit("overestimates")).when(mean.isNotNull(), F.lit("underestimates"))
         .alias("bias_direction"),
        *[F.col(f"q{i}").alias(f"error_quantile_{int(round(q * 100))}") for i, q in enumerate(quantiles)],
        "observed_coverage",
        F.lit(target).alias("target_coverage"),
        (F.col("observed_coverage") >= F.lit(target)).alias("calibrated"),
    )
