"""Where queries and their check SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.fixtures import HALF_DAY, SPLIT_DAY, VITALS_VIEW

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Named parts of the check SQL. 'n/a' has two parts that are no numbers, so it is an error under
# every policy; `defaulted` is about text without two parts, which counts as 120/80.
LOGIT = "-15e-1 + 1e-2 * age + 5e-3 * sys + 3e-1 * dm + 2e-1 * ht + 5e-2 * medication_count + CASE WHEN bmi > 30 THEN 15e-2 ELSE 0e0 END"
_SCORE = f"1 / (1 + exp(-({LOGIT})))"
_FLAG = "(risk > 0.7 OR sys > 160 OR dia > 100 OR bmi > 35)"
_FORMAT = "'blood_pressure must be in format ''systolic/diastolic'''"
_FLOAT = "'could not convert string to float: ''n'''"
PARTS = {
    "vitals": VITALS_VIEW.format(ms="(epoch_us(ts) // 1000)", events="events"),
    "bp": """
SELECT *, CASE WHEN blood_pressure = 'n/a' THEN NULL ELSE cast(split_part(blood_pressure, '/', 1) AS double) END AS sys0,
  CASE WHEN blood_pressure = 'n/a' THEN NULL ELSE cast(split_part(blood_pressure, '/', 2) AS double) END AS dia0,
  CASE WHEN diabetes = 'Yes' THEN 1 ELSE 0 END AS dm, CASE WHEN hypertension = 'Yes' THEN 1 ELSE 0 END AS ht
FROM vitals""",
    "defaulted": f"""
SELECT *, {_FLAG} AS anomaly FROM (
  SELECT *, {_SCORE} AS risk FROM (
    SELECT *, coalesce(sys0, 120) AS sys, coalesce(dia0, 80) AS dia FROM bp))""",
    "scored": f"""
SELECT *, error IS NULL AND {_FLAG} AS anomaly FROM (
  SELECT *, CASE WHEN error IS NULL THEN {_SCORE} ELSE 0 END AS risk FROM (
    SELECT *, coalesce(sys0, 0) AS sys, coalesce(dia0, 0) AS dia, CASE WHEN sys0 IS NULL THEN {_FLOAT} END AS error FROM bp))""",
    "judged": f"""
SELECT * REPLACE (CASE WHEN error IS NOT NULL AND source_partition % 2 = 0 THEN {_FORMAT} ELSE error END AS error) FROM scored""",
    "requests": """
SELECT event_id, epoch_us(ts) // 1000 AS ms, event_type AS source, value AS latency_ms,
  CASE WHEN event_type = 'error' THEN 'error' WHEN value > 100 THEN 'timeout' ELSE 'success' END AS status
FROM events""",
    "counter": """
SELECT source, ms, max_by(no % 1000, event_id)::double AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY ms, event_id) AS no FROM requests) GROUP BY ALL""",
    "reference": f"SELECT * FROM vitals WHERE ts < TIMESTAMP '{SPLIT_DAY}'",
    "current_": f"SELECT * REPLACE (glucose_level * 1.3 AS glucose_level) FROM vitals WHERE ts >= TIMESTAMP '{SPLIT_DAY}'",
    "before_": f"SELECT * FROM vitals WHERE ts < TIMESTAMP '{HALF_DAY}'",
    "after_": f"SELECT * FROM vitals WHERE ts >= TIMESTAMP '{HALF_DAY}'",
}
_NEEDS = {
    "bp": ["vitals"],
    "defaulted": ["bp"],
    "scored": ["bp"],
    "judged": ["scored"],
    "counter": ["requests"],
    "reference": ["vitals"],
    "current_": ["vitals"],
    "before_": ["vitals"],
    "after_": ["vitals"],
}


def with_parts(parts: str, body: str) -> str:
    """Put the named parts, and the parts those need, in front of `body`."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in parts.split():
        add(name)
    if not ordered:
        return body
    named = ",\n".join(f"{name} AS ({PARTS[name]})" for name in ordered)
    body = body.strip()
    joint = ",\n" + body[5:] if body.upper().startswith("WITH ") else "\n" + body
    return f"WITH {named}{joint}"


def query(name: str, parts: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_parts(parts, sql)
        return run

    return register


def r6(column: Column | str, name: str) -> Column:
    """Six places: sums in another order and another `exp` differ in the last digits only."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6).alias(name)
