"""Financial formulas as null-safe column expressions (ANSI mode safe: no bare division)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Altman Z'' coefficients and labels (fixed values).
WORKING_CAPITAL_COEFFICIENT = 6.56
RETAINED_EARNINGS_COEFFICIENT = 3.26
EBIT_COEFFICIENT = 6.72
EQUITY_COEFFICIENT = 1.05
FULL_SCORE_LABEL = "full"
REDUCED_SCORE_LABEL = "reduced_no_ebit"
# Estimates disagreeing by more than this ratio make revenue unusable (fixed value).
DISAGREEMENT_RATIO_LIMIT = 2.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _denominators_ok(total_liabilities, total_assets) -> Column:
    ta, tl = _c(total_assets), _c(total_liabilities)
    return ta.isNotNull() & (ta != 0) & tl.isNotNull() & (tl != 0)


def reduced_distress_score(working_capital, retained_earnings, book_value_of_equity,
                           total_liabilities, total_assets) -> Column:
    """Three-term Z'': null when total assets or liabilities are missing or zero."""
    ta, tl = _c(total_assets), _c(total_liabilities)
    score = (F.lit(WORKING_CAPITAL_COEFFICIENT) * F.try_divide(_c(working_capital), ta)
             + F.lit(RETAINED_EARNINGS_COEFFICIENT) * F.try_divide(_c(retained_earnings), ta)
             + F.lit(EQUITY_COEFFICIENT) * F.try_divide(_c(book_value_of_equity), tl))
    return F.when(_denominators_ok(tl, ta), score)


def full_distress_score(working_capital, retained_earnings, ebit, book_value_of_equity,
                        total_liabilities, total_assets) -> Column:
    """Four-term Z'' (with EBIT / total assets)."""
    ta, tl = _c(total_assets), _c(total_liabilities)
    score = (F.lit(WORKING_CAPITAL_COEFFICIENT) * F.try_divide(_c(working_capital), ta)
             + F.lit(RETAINED_EARNINGS_COEFFICIENT) * F.try_divide(_c(retained_earnings), ta)
             + F.lit(EBIT_COEFFICIENT) * F.try_divide(_c(ebit), ta)
             + F.lit(EQUITY_COEFFICIENT) * F.try_divide(_c(book_value_of_equity), tl))
    return F.when(_denominators_ok(tl, ta), score)


def estimate_revenue(headcount, revenue_per_employee) -> Column:
    """Headcount x benchmark; null when either is missing."""
    return _c(headcount) * _c(revenue_per_employee)


def disagreement_ratio(estimate_one, estimate_two) -> Column:
    """larger / smaller; null when either is missing or not positive."""
    a, b = _c(estimate_one), _c(estimate_two)
    ok = a.isNotNull() & b.isNotNull() & (a > 0) & (b > 0)
    return F.when(ok, F.try_divide(F.greatest(a, b), F.least(a, b)))


def revenue_usable(ratio) -> Column:
    return F.coalesce(_c(ratio) <= F.lit(DISAGREEMENT_RATIO_LIMIT), F.lit(False))


def mixed_distance(numeric_pairs: list[tuple], categorical_pairs: list[tuple]) -> Column:
    """Euclidean distance over numerics plus one-hot categoricals, without building vectors.

    One differing categorical flips two one-hot cells, so it adds 2 to the sum
    of squares; a null on either side counts as differing.
    """
    total = F.lit(0.0)
    for a, b in numeric_pairs:
        d = _c(a) - _c(b)
        total = total + d * d
    for a, b in categorical_pairs:
        same = F.coalesce(_c(a) == _c(b), F.lit(False))
        total = total + F.when(same, F.lit(0.0)).otherwise(F.lit(2.0))
    return F.sqrt(total)
