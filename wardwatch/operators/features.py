"""Validation and featurizing: one pass of column expressions over the events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import vitals as V
from wardwatch.schemas import FEATURE_ORDER, REQUIRED_FIELDS

# What stands in for an absent field.
FIELD_DEFAULTS = {
    "cholesterol": 200,
    "medication_count": 0,
    "length_of_stay": 3,
    "diabetes": "No",
    "hypertension": "No",
    "gender": "Other",
    "discharge_destination": "Home",
}


def _field(df: DataFrame, name: str) -> Column:
    """The column, or its default where the frame has no such column or the row no value."""
    default = F.lit(FIELD_DEFAULTS[name])
    return F.coalesce(F.col(name), default) if name in df.columns else default


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({name: _field(df, name) for name in FIELD_DEFAULTS})


def coerce_numeric(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Read text columns as numbers; the first one that fails is named in `error`."""
    errors = [V.numeric_error(F.col(c), c) for c in types]
    kept = [F.col("error")] if "error" in df.columns else []
    checked = df.withColumn("error", F.coalesce(*kept, *errors))
    return checked.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def validate_required(df: DataFrame, columns: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    kept = [F.col("error")] if "error" in df.columns else []
    return df.withColumn("error", F.coalesce(*kept, V.missing_field_error(columns)))


def feature_struct(df: DataFrame, policy: str = "service", bp_policy: str = "default") -> Column:
    """The model inputs as a struct of doubles.

    `service` takes the given fields and fills defaults, `vitals_only` uses age, pressure and BMI
    and fixed values for the rest, `training` leaves unknown categories null.
    """
    systolic, diastolic = V.split_bp(F.col("blood_pressure"), bp_policy)
    fields: dict[str, Column] = {
        "age": F.col("age").cast("double"),
        "systolic_bp": systolic,
        "diastolic_bp": diastolic,
        "bmi": F.col("bmi").cast("double"),
    }
    if policy == "vitals_only":
        fields |= {
            "gender": F.lit(0.0),
            "cholesterol": F.lit(float(FIELD_DEFAULTS["cholesterol"])),
            "diabetes": F.lit(0.0),
            "hypertension": V.derive_hypertension(systolic, diastolic).cast("double"),
            "medication_count": F.lit(0.0),
            "length_of_stay": F.lit(float(FIELD_DEFAULTS["length_of_stay"])),
            "discharge_destination": F.lit(0.0),
        }
    else:
        training = policy == "training"

        def raw(name: str) -> Column:
            return F.col(name) if training else _field(df, name)

        fields |= {
            "gender": V.encode(raw("gender"), V.GENDER_CODES, None if training else 2),
            "cholesterol": raw("cholesterol").cast("double"),
            "diabetes": V.encode(raw("diabetes"), V.YES_NO_CODES, None if training else 0),
            "hypertension": V.encode(raw("hypertension"), V.YES_NO_CODES, None if training else 0),
            "medication_count": raw("medication_count").cast("double"),
            "length_of_stay": raw("length_of_stay").cast("double"),
            "discharge_destination": V.encode(raw("discharge_destination"), V.DESTINATION_CODES, None if training else 0),
        }
    return F.struct(*[fields[c].alias(c) for c in FEATURE_ORDER])


def featurize(df: DataFrame, policy: str = "service", bp_policy: str = "default") -> DataFrame:
    """Add `features` and `error`; a row in error keeps its raw fields.

    Whether there is an error is decided by null tests alone, and its text is put together behind
    them. A filter on `error` or a score that depends on it so costs the null tests and no text.
    """
    bp = F.col("blood_pressure")
    usable = F.lit(True)
    for column in (*[F.col(c) for c in REQUIRED_FIELDS], *V.split_bp(bp, bp_policy)):
        usable = usable & column.isNotNull()
    reasons = [V.missing_field_error(REQUIRED_FIELDS), V.bp_error(bp, bp_policy), F.lit("Invalid record")]
    if "error" in df.columns:
        usable = usable & F.col("error").isNull()
        reasons.insert(0, F.col("error"))
    return df.withColumns({"error": F.when(~usable, F.coalesce(*reasons)), "features": feature_struct(df, policy, bp_policy)})
