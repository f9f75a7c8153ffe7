"""Column functions for risk scores, flags and score changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the anomaly rule, all strict.
RISK_LIMIT, SYSTOLIC_LIMIT, DIASTOLIC_LIMIT, BMI_LIMIT = 0.7, 160, 100, 35

# The bands of the drift, late-data and risk panels.
DRIFT_BANDS = ((0.1, "yellow"), (0.2, "red"))
LATE_BANDS = ((0.05, "yellow"), (0.1, "red"))
RISK_BANDS = ((0.5, "yellow"), (0.7, "red"))
LATENCY_BANDS = ((20, "yellow"), (30, "red"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def normalize_output(out: Column) -> Column:
    """Probability of class 1 from a model's output array.

    Two values are class probabilities, one value is a logit; of a longer output the first value
    counts as it is up to 1 and as a logit above.
    """
    first = F.try_element_at(out, F.lit(1))
    return (
        F.when(F.size(out) == 2, F.try_element_at(out, F.lit(2)))
        .when(F.size(out) == 1, sigmoid(first))
        .when(first <= 1.0, first)
        .otherwise(sigmoid(first))
    )


def anomaly_flag(risk: Column, systolic: Column, diastolic: Column, bmi: Column) -> Column:
    """True when any limit is exceeded; a null reading never trips its own term."""
    terms = [risk > RISK_LIMIT, systolic > SYSTOLIC_LIMIT, diastolic > DIASTOLIC_LIMIT, bmi > BMI_LIMIT]
    flag = F.lit(False)
    for term in terms:
        flag = flag | F.coalesce(term, F.lit(False))
    return flag


def risk_factor_logit(age: Column, systolic: Column, diabetes: Column, hypertension: Column, medication: Column, bmi: Column) -> Column:
    """Weighted sum of the known risk factors. The weights, which `RISK_FACTOR_MODEL` has too."""
    obese = F.when(bmi > 30, F.lit(0.15)).otherwise(F.lit(0.0))
    return age * 0.01 + systolic * 0.005 + diabetes * 0.3 + hypertension * 0.2 + medication * 0.05 + obese


def abs_change(current: Column, previous: Column, has_previous: Column) -> Column:
    """Size of the change; a field absent from the previous reading counts 0; null without a previous reading."""
    return F.when(has_previous, F.abs(current - F.coalesce(previous, F.lit(0.0))))


def relative_change(reference: Column, current: Column) -> Column:
    """Null where there is nothing to compare with; capped at 1."""
    return F.when(current.isNotNull(), F.least(F.abs(current - reference) / F.abs(reference), F.lit(1.0)))


def round_score(x: Column, digits: int = 4) -> Column:
    return F.round(x, digits)


def bool_to_int(flag: Column) -> Column:
    return flag.cast("bigint")


def severity_band(x: Column, steps: Sequence[tuple[float, str]], base: str = "green") -> Column:
    """Colour of the highest step that `x` reaches."""
    band = None
    for limit, colour in sorted(steps, reverse=True):
        band = F.when(x >= limit, F.lit(colour)) if band is None else band.when(x >= limit, F.lit(colour))
    return band.otherwise(F.lit(base))
