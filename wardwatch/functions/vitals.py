"""Column functions that turn raw vitals into numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category codes, clinical limits and defaults.
GENDER_CODES = {"Male": 0, "Female": 1, "Other": 2}
DESTINATION_CODES = {"Home": 0, "Nursing_Facility": 1, "Rehab": 2}
YES_NO_CODES = {"Yes": 1, "No": 0}
DEFAULT_SYSTOLIC, DEFAULT_DIASTOLIC = 120.0, 80.0
HYPERTENSION_SYSTOLIC, HYPERTENSION_DIASTOLIC = 140, 90
BP_FORMAT_ERROR = "blood_pressure must be in format 'systolic/diastolic'"


def _bp_parts(bp: Column) -> Column:
    return F.split(bp, "/")


def split_bp(bp: Column, policy: str = "default") -> tuple[Column, Column]:
    """Systolic and diastolic pressure of `"s/d"`.

    Text without exactly two parts gives 120/80 under `default` and null under `reject`.
    A part that is no number gives null under both.
    """
    parts = _bp_parts(bp)
    two = F.size(parts) == 2

    def part(i: int, fallback: float) -> Column:
        value = F.when(two, F.try_element_at(parts, F.lit(i)).try_cast("double"))
        return value.when(bp.isNotNull(), F.lit(fallback)) if policy == "default" else value

    return part(1, DEFAULT_SYSTOLIC), part(2, DEFAULT_DIASTOLIC)


def bp_error(bp: Column, policy: str = "default") -> Column:
    """Why a blood pressure cannot be used, or null."""
    parts = _bp_parts(bp)
    two = F.size(parts) == 2
    bad_part = F.coalesce(
        *[
            F.when(p.try_cast("double").isNull(), F.concat(F.lit("could not convert string to float: '"), p, F.lit("'")))
            for p in (F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2)))
        ]
    )
    error = F.when(two, bad_part)
    return error.when(bp.isNotNull(), F.lit(BP_FORMAT_ERROR)) if policy == "reject" else error


def validate_bp(bp: Column) -> Column:
    """True for two numeric parts, false for anything else, null included."""
    parts = _bp_parts(bp)
    numeric = [F.try_element_at(parts, F.lit(i)).try_cast("double").isNotNull() for i in (1, 2)]
    return F.coalesce((F.size(parts) == 2) & numeric[0] & numeric[1], F.lit(False))


def encode(col: Column, codes: Mapping[str, int], default: int | None = None) -> Column:
    """Category code; an unknown or null category gives `default` (null when training)."""
    out = None
    for name, code in codes.items():
        hit = col == name
        out = F.when(hit, F.lit(float(code))) if out is None else out.when(hit, F.lit(float(code)))
    return out.otherwise(F.lit(None if default is None else float(default)).cast("double"))


def derive_hypertension(systolic: Column, diastolic: Column) -> Column:
    high = (systolic > HYPERTENSION_SYSTOLIC) | (diastolic > HYPERTENSION_DIASTOLIC)
    return F.when(high, F.lit(1)).otherwise(F.lit(0))


def missing_field_error(columns: Sequence[str]) -> Column:
    """Names the first required field that is null, or null when all are present."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"Missing required field: {c}")) for c in columns])


def numeric_error(col: Column, name: str) -> Column:
    """Error text for a value that is present but is no number."""
    bad = col.isNotNull() & col.try_cast("double").isNull()
    return F.when(bad, F.concat(F.lit(f"{name} is not a number: '"), col.cast("string"), F.lit("'")))


def feature_array(features: Column, order: Sequence[str]) -> Column:
    """The ordered model input as `array<float>`; a feature that is absent counts 0."""
    return F.array(*[F.coalesce(features[c], F.lit(0.0)).cast("float") for c in order])
