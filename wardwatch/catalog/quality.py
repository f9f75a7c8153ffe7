"""Lateness and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardwatch.catalog.history import SMALL_CHUNK
from wardwatch.catalog.registry import query, r6
from wardwatch.fixtures import current, reference, vitals
from wardwatch.operators import drift as D
from wardwatch.operators import lateness as L
from wardwatch.operators.profile import column_drift_from_profile, read_profile, reference_profile, write_profile
from wardwatch.session import work_dir
from wardwatch.streaming.windows import tumbling_vitals

NUMBERS = ["age", "bmi", "glucose_level", "cholesterol"]
TEXTS = ["gender", "discharge_destination", "diabetes"]
DAY_MS = 86_400_000


@query(
    "late_counts",
    "vitals",
    "SELECT source_partition, count(*) AS total_data_count, count(*) FILTER (arrival_ms - event_ms > 300000) AS late_data_count FROM vitals GROUP BY ALL",
)
def _late_counts(spark, sf_dir):
    return L.late_counts(vitals(spark, sf_dir), ["source_partition"])


@query(
    "late_ratio",
    "vitals",
    """
SELECT count(*) AS total_data_count, count(*) FILTER (arrival_ms - event_ms > 300000) AS late_data_count,
  round(avg((arrival_ms - event_ms > 300000)::int), 6) AS late_data_ratio FROM vitals""",
)
def _late_ratio(spark, sf_dir):
    return L.late_ratio(L.late_counts(vitals(spark, sf_dir))).withColumn("late_data_ratio", F.round("late_data_ratio", 6))


_TIERS_SQL = """
SELECT event_id, behind_ms, CASE WHEN behind_ms IS NULL OR behind_ms <= 120000 THEN 'on_time' WHEN behind_ms <= 300000 THEN 'allowed_late' ELSE 'side_output' END AS tier
FROM (SELECT event_id, max(event_ms) OVER (PARTITION BY source_partition ORDER BY arrival_ms, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - event_ms AS behind_ms FROM vitals)"""


@query("lateness_tiers", "vitals", _TIERS_SQL)
def _lateness_tiers(spark, sf_dir):
    return L.lateness_tiers(vitals(spark, sf_dir)).select("event_id", "behind_ms", "tier")


@query("lateness_tiers_split", "vitals", _TIERS_SQL)
def _lateness_tiers_split(spark, sf_dir):
    return L.lateness_tiers(vitals(spark, sf_dir), rows_per_chunk=SMALL_CHUNK).select("event_id", "behind_ms", "tier")


@query(
    "event_time_lag",
    "vitals",
    "SELECT arrival_ms // 3600000 * 3600000 AS window_ms, max(arrival_ms - event_ms) AS lag_ms FROM vitals GROUP BY ALL",
)
def _event_time_lag(spark, sf_dir):
    return L.event_time_lag(vitals(spark, sf_dir), 3_600_000)


@query(
    "tumbling_vitals",
    "vitals",
    """
SELECT event_ms // 3600000 * 3600000 AS window_ms, discharge_destination, count(*) AS n, round(avg(glucose_level), 6) AS mean_glucose,
  max(bmi) AS max_bmi, max(arrival_ms - event_ms) AS max_delay_ms FROM vitals GROUP BY ALL""",
)
def _tumbling_vitals(spark, sf_dir):
    return tumbling_vitals(vitals(spark, sf_dir), "1 hour").withColumn("mean_glucose", F.round("mean_glucose", 6))


@query(
    "column_means",
    "reference",
    """
UNPIVOT (SELECT round(avg(age), 6) AS age, round(avg(bmi), 6) AS bmi, round(avg(cholesterol), 6) AS cholesterol,
  round(avg(glucose_level), 6) AS glucose_level FROM reference) ON * INTO NAME "column" VALUE mean""",
)
def _column_means(spark, sf_dir):
    return D.column_means(reference(spark, sf_dir), NUMBERS).withColumn("mean", F.round("mean", 6))


_SHIFT_PARTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT avg({c}) FROM reference) AS ref_mean, (SELECT avg({c}) FROM current_) AS cur_mean" for c in ("age", "bmi", "glucose_level")
)


@query(
    "pair_stats",
    "reference current_",
    f"""SELECT "column", round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean,
  round(least(abs(cur_mean - ref_mean) / abs(ref_mean), 1), 6) AS shift FROM ({_SHIFT_PARTS}) WHERE ref_mean <> 0""",
)
def _pair_stats(spark, sf_dir):
    out = D.column_shifts(reference(spark, sf_dir), current(spark, sf_dir), ["age", "bmi", "glucose_level"])
    return out.select("column", r6("ref_mean", "ref_mean"), r6("cur_mean", "cur_mean"), r6("shift", "shift"))


@query(
    "mean_shift_drift",
    "reference current_",
    f"""SELECT round(avg(least(abs(cur_mean - ref_mean) / abs(ref_mean), 1)), 6) AS drift_score,
  avg(least(abs(cur_mean - ref_mean) / abs(ref_mean), 1)) > 0.2 AS drift_detected FROM ({_SHIFT_PARTS})""",
)
def _mean_shift_drift(spark, sf_dir):
    out = D.mean_shift_drift(reference(spark, sf_dir), current(spark, sf_dir), ["age", "bmi", "glucose_level"])
    return out.withColumn("drift_score", F.round("drift_score", 6))


@query(
    "nonzero_guard",
    "reference current_",
    """
SELECT 'bmi' AS "column", round((SELECT avg(bmi) FROM reference), 6) AS ref_mean, round((SELECT avg(bmi) FROM current_), 6) AS cur_mean""",
)
def _nonzero_guard(spark, sf_dir):
    """A column that is 0 throughout the reference cannot be compared."""
    ref = reference(spark, sf_dir).withColumn("zero", F.lit(0.0))
    cur = current(spark, sf_dir).withColumn("zero", F.col("bmi"))
    out = D.column_shifts(ref, cur, ["bmi", "zero"])
    return out.select("column", r6("ref_mean", "ref_mean"), r6("cur_mean", "cur_mean"))


def _long(name: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c}::double AS value, {name} AS side FROM {source}" for c in columns)


def _edf_sql(bins: int | None = None) -> str:
    """Merged distinct values with both cumulative shares, as CTE text."""
    value = "value"
    bounds = ""
    if bins:
        bounds = 'bounds AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM long WHERE side = 0 GROUP BY ALL),'
        value = f"lo + (least(greatest(floor((value - lo) / ((hi - lo) / {bins})), 0), {bins - 1}) + 0.5) * ((hi - lo) / {bins})"
    source = 'long JOIN bounds USING ("column")' if bins else "long"
    return f"""
WITH long AS ({_long("0", "reference", NUMBERS)} UNION ALL {_long("1", "current_", NUMBERS)}), {bounds}
counts AS (SELECT "column", {value} AS v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM {source} GROUP BY ALL),
edf AS (
  SELECT "column", v, lead(v) OVER w AS next_v, sum(r) OVER w / sum(r) OVER (PARTITION BY "column") AS fr,
    sum(c) OVER w / sum(c) OVER (PARTITION BY "column") AS fc
  FROM counts WINDOW w AS (PARTITION BY "column" ORDER BY v)),
spread AS (SELECT "column", stddev_pop(value) AS s FROM long WHERE side = 0 GROUP BY ALL),
wd AS (SELECT "column", 'wasserstein' AS method, sum(abs(fr - fc) * (next_v - v)) / greatest(any_value(s), 0.001) AS distance
  FROM edf JOIN spread USING ("column") GROUP BY ALL)"""


def _shares_sql(lead: str) -> str:
    rows = f"""{" UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS value, 0 AS side FROM reference UNION ALL SELECT '{c}', {c}, 1 FROM current_" for c in TEXTS)}"""
    return f"""{lead} cats AS (
  SELECT col AS "column", value, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM ({rows}) GROUP BY ALL),
shares AS (SELECT *, r / sum(r) OVER p AS ps, c / sum(c) OVER p AS qs, sum(c) OVER p AS nc FROM cats WINDOW p AS (PARTITION BY "column")),
js AS (SELECT "column", 'jensenshannon' AS method, sqrt(greatest(sum(
    CASE WHEN ps > 0 THEN ps * log2(ps / ((ps + qs) / 2)) ELSE 0 END + CASE WHEN qs > 0 THEN qs * log2(qs / ((ps + qs) / 2)) ELSE 0 END) / 2, 0)) AS distance
  FROM shares GROUP BY ALL)"""


_COLUMN_DRIFT = """
SELECT "column", method, round(distance, 5) AS distance, distance >= 0.1 AS drifted FROM (FROM wd UNION ALL FROM js)"""


def _distances(df):
    return df.select("column", "method", F.round("distance", 5).alias("distance"), "drifted")


@query("column_drift", "reference current_", _edf_sql() + _shares_sql(",") + _COLUMN_DRIFT)
def _column_drift(spark, sf_dir):
    return _distances(D.column_drift(reference(spark, sf_dir), current(spark, sf_dir), NUMBERS, TEXTS, bins=None))


@query("column_drift_split", "reference current_", _edf_sql() + _shares_sql(",") + _COLUMN_DRIFT)
def _column_drift_split(spark, sf_dir):
    return _distances(D.column_drift(reference(spark, sf_dir), current(spark, sf_dir), NUMBERS, TEXTS, bins=None, rows_per_chunk=SMALL_CHUNK))


@query("column_drift_binned", "reference current_", _edf_sql(200) + _shares_sql(",") + _COLUMN_DRIFT)
def _column_drift_binned(spark, sf_dir):
    return _distances(D.column_drift(reference(spark, sf_dir), current(spark, sf_dir), NUMBERS, TEXTS))


@query("column_drift_profile", "reference current_", _edf_sql(200) + _shares_sql(",") + _COLUMN_DRIFT)
def _column_drift_profile(spark, sf_dir):
    """The reference is profiled and stored first; the check reads the stored profile and the current rows."""
    path = work_dir(spark, "profile")
    write_profile(reference_profile(reference(spark, sf_dir), NUMBERS, TEXTS), path, 1)
    return _distances(column_drift_from_profile(read_profile(spark, path), current(spark, sf_dir)))


# The same distances over sides of which one lacks a column, or holds values that are not numbers.
_ODD_SIDES = """
ref_ AS (SELECT age, CASE WHEN event_id % 7 = 0 THEN 'nan'::double ELSE bmi END AS bmi, glucose_level, diabetes FROM reference),
cur_ AS (SELECT age, CASE WHEN event_id % 5 = 0 THEN 'nan'::double ELSE bmi END AS bmi, glucose_level, diabetes FROM current_)"""


def _odd_sql(empty: str) -> str:
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c}::double AS value, {side} AS side FROM {name}{' WHERE false' if (c, side) == (empty, 1) else ''}"
        for c in ("age", "bmi", "glucose_level")
        for side, name in ((0, "ref_"), (1, "cur_"))
    )
    return f"""WITH {_ODD_SIDES}, long AS (SELECT * FROM ({sides}) WHERE NOT isnan(value)),
counts AS (SELECT "column", value AS v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM long GROUP BY ALL),
edf AS (SELECT "column", v, lead(v) OVER w AS next_v, sum(r) OVER w / sum(r) OVER (PARTITION BY "column") AS fr,
    sum(c) OVER w / nullif(sum(c) OVER (PARTITION BY "column"), 0) AS fc FROM counts WINDOW w AS (PARTITION BY "column" ORDER BY v)),
spread AS (SELECT "column", stddev_pop(value) AS s FROM long WHERE side = 0 GROUP BY ALL),
wd AS (SELECT "column", sum(abs(fr - fc) * (next_v - v)) / greatest(any_value(s), 0.001) AS distance FROM edf JOIN spread USING ("column") GROUP BY ALL)
SELECT "column", round(distance, 5) AS distance, coalesce(distance >= 0.1, false) AS drifted, distance IS NOT NULL AS comparable FROM wd"""


def _odd_drift(spark, sf_dir, empty):
    def side(df, every):
        bmi = F.when(F.col("event_id") % every == 0, F.lit(float("nan"))).otherwise(F.col("bmi"))
        return df.withColumn("bmi", bmi)

    now = side(current(spark, sf_dir), 5)
    if empty:
        now = now.withColumn(empty, F.lit(None).cast("double"))
    out = D.column_drift(side(reference(spark, sf_dir), 7), now, ["age", "bmi", "glucose_level"], bins=None)
    return out.select("column", F.round("distance", 5).alias("distance"), "drifted", "comparable")


@query("drift_with_nan", "reference current_", _odd_sql(""))
def _drift_with_nan(spark, sf_dir):
    return _odd_drift(spark, sf_dir, "")


@query("drift_empty_side", "reference current_", _odd_sql("glucose_level"))
def _drift_empty_side(spark, sf_dir):
    """A sensor that died: no current glucose at all."""
    return _odd_drift(spark, sf_dir, "glucose_level")


@query(
    "dataset_drift",
    "reference current_",
    _edf_sql()
    + _shares_sql(",")
    + """
SELECT round(avg((distance >= 0.1)::int), 6) AS drift_score, avg((distance >= 0.1)::int) > 0.2 AS drift_detected FROM (FROM wd UNION ALL FROM js)""",
)
def _dataset_drift(spark, sf_dir):
    out = D.dataset_drift(D.column_drift(reference(spark, sf_dir), current(spark, sf_dir), NUMBERS, TEXTS, bins=None))
    return out.withColumn("drift_score", F.round("drift_score", 6))


@query(
    "ks_drift",
    "reference current_",
    _edf_sql()
    + """, ks AS (SELECT "column", max(abs(fr - fc)) AS d FROM edf GROUP BY ALL),
sizes AS (SELECT "column", count(*) FILTER (side = 0) AS n, count(*) FILTER (side = 1) AS m FROM long GROUP BY ALL),
x AS (SELECT "column", d, d * d * n * m / (n + m) AS x2 FROM ks JOIN sizes USING ("column")),
p AS (SELECT "column", d, CASE WHEN x2 < 0.04 THEN 1 ELSE least(greatest(list_sum(list_transform(range(1, 101),
  lambda k: CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END * exp(-2e0 * k * k * x2))), 0), 1) END AS p FROM x)
SELECT "column", round(d, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drifted FROM p""",
)
def _ks_drift(spark, sf_dir):
    out = D.ks_drift(reference(spark, sf_dir), current(spark, sf_dir), NUMBERS, bins=None)
    return out.select("column", r6("statistic", "statistic"), r6("p_value", "p_value"), "drifted")


@query(
    "chi2_drift",
    "reference current_",
    _shares_sql("WITH")
    + """
SELECT "column", round(sum(power(c - ps * nc, 2) / (ps * nc)) FILTER (ps > 0), 6) AS statistic, count(*) FILTER (ps > 0) - 1 AS dof
FROM shares GROUP BY ALL""",
)
def _chi2_drift(spark, sf_dir):
    out = D.chi2_drift(reference(spark, sf_dir), current(spark, sf_dir), TEXTS, p_value=False)
    return out.select("column", r6("statistic", "statistic"), "dof")


def _psi_sql(columns: list[str]) -> str:
    return f"""
WITH long AS ({_long("0", "reference", columns)} UNION ALL {_long("1", "current_", columns)}),
deciles AS (SELECT "column", unnest(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS edge
  FROM long WHERE side = 0 GROUP BY "column"),
edges AS (SELECT "column", list(edge) AS es FROM deciles GROUP BY ALL),
binned AS (SELECT "column", len(list_filter(es, lambda e: e < value)) AS bin, side FROM long JOIN edges USING ("column")),
counts AS (SELECT "column", bin, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM binned GROUP BY ALL),
shares AS (SELECT "column", greatest(r / sum(r) OVER p, 1e-4) AS rs, greatest(c / sum(c) OVER p, 1e-4) AS cs FROM counts WINDOW p AS (PARTITION BY "column"))
SELECT "column", round(sum((cs - rs) * ln(cs / rs)), 5) AS psi FROM shares GROUP BY ALL"""


@query("psi_drift", "reference current_", _psi_sql(NUMBERS))
def _psi_drift(spark, sf_dir):
    out = D.psi_drift(reference(spark, sf_dir), current(spark, sf_dir), NUMBERS)
    return out.select("column", F.round("psi", 5).alias("psi"))


@query(
    "category_frequencies",
    "vitals",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM vitals GROUP BY ALL" for c in TEXTS),
)
def _category_frequencies(spark, sf_dir):
    return D.category_frequencies(vitals(spark, sf_dir), TEXTS)


_ROWS_SQL = """
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY arrival_ms, event_id) AS r FROM vitals),
windows AS (SELECT *, unnest(range(greatest(ceil((r - 1000) / 900), 0)::bigint, (r - 1) // 900 + 1)) AS window_no FROM numbered)"""


@query(
    "count_windows",
    "vitals",
    _ROWS_SQL + "SELECT window_no, count(*) AS n, round(avg(glucose_level), 6) AS mean_glucose, min(r) AS first_row FROM windows GROUP BY ALL",
)
def _count_windows(spark, sf_dir):
    rows = D.count_windows(vitals(spark, sf_dir))
    return rows.groupBy("window_no").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("glucose_level"), "mean_glucose"), F.min("row_no").alias("first_row"))


def _shift_of(row: str) -> str:
    ref = "(SELECT avg({c}) FROM reference)"
    parts = [f"least(abs({row}.{c} - {ref.format(c=c)}) / abs({ref.format(c=c)}), 1)" for c in ("age", "bmi", "glucose_level")]
    return "(" + " + ".join(parts) + ") / 3"


@query(
    "count_window_drift",
    "vitals reference",
    _ROWS_SQL
    + f""", m AS (SELECT window_no, count(*) AS n_rows, avg(age) AS age, avg(bmi) AS bmi, avg(glucose_level) AS glucose_level
  FROM windows GROUP BY ALL HAVING count(*) = 1000)
SELECT window_no, n_rows, round({_shift_of("m")}, 6) AS drift_score, {_shift_of("m")} > 0.2 AS drift_detected FROM m""",
)
def _count_window_drift(spark, sf_dir):
    rows = D.count_windows(vitals(spark, sf_dir))
    out = D.shift_by_window(rows, ["window_no"], reference(spark, sf_dir), ["age", "bmi", "glucose_level"], D.WINDOW_ROWS)
    return out.withColumn("drift_score", F.round("drift_score", 6))


_WATCH_SQL = f"""
WITH n AS (SELECT *, row_number() OVER (ORDER BY arrival_ms, event_id) AS r, arrival_ms // {{timer}} AS cell,
  sum((arrival_ms - event_ms > 300000)::int) OVER (ORDER BY arrival_ms, event_id) AS late FROM vitals),
p AS (SELECT *, (r - min(r) OVER (PARTITION BY cell)) // 900 AS part FROM n),
c AS (SELECT cell, part, min(r) AS lo, max(r) AS hi, max(late)::bigint AS late, max_by(arrival_ms, r) AS t_ms FROM p GROUP BY ALL),
m AS (SELECT hi, any_value(t_ms) AS t_ms, any_value(c.late) AS late, count(*) AS n_rows, avg(age) AS age, avg(bmi) AS bmi, avg(glucose_level) AS glucose_level
  FROM c JOIN n ON r <= hi AND r > greatest(lo - 101, 0) GROUP BY hi HAVING count(*) >= 100)
SELECT hi AS row_no, t_ms, n_rows, late AS late_data_count, round(late / hi, 6) AS late_data_ratio, round({_shift_of("m")}, 6) AS drift_score,
  {_shift_of("m")} > 0.2 AS drift_detected FROM m"""


def _watch(spark, sf_dir, **options):
    out = D.drift_watch(vitals(spark, sf_dir), reference(spark, sf_dir), ["age", "bmi", "glucose_level"], **options)
    return out.withColumns({c: F.round(c, 6) for c in ("drift_score", "late_data_ratio")})


@query("drift_watch", "vitals reference", _WATCH_SQL.format(timer=5 * DAY_MS))
def _drift_watch(spark, sf_dir):
    """Both triggers act: some 1,700 rows arrive between two ticks of the timer."""
    return _watch(spark, sf_dir, timer_ms=5 * DAY_MS)


@query("drift_watch_sparse", "vitals reference", _WATCH_SQL.format(timer=DAY_MS // 4))
def _drift_watch_sparse(spark, sf_dir):
    """Fewer rows come between two ticks than are carried over."""
    return _watch(spark, sf_dir, timer_ms=DAY_MS // 4, rows_per_chunk=SMALL_CHUNK)


_DAILY_DRIFT = f"""
SELECT t_ms, n_rows, round({_shift_of("m")}, 6) AS drift_score, {_shift_of("m")} > 0.2 AS drift_detected
FROM (SELECT event_ms // 86400000 * 86400000 AS t_ms, count(*) AS n_rows, avg(age) AS age, avg(bmi) AS bmi, avg(glucose_level) AS glucose_level
  FROM vitals GROUP BY ALL HAVING count(*) >= 100) m"""


@query("drift_windows", "vitals reference", _DAILY_DRIFT)
def _drift_windows(spark, sf_dir):
    from wardwatch.plans.alerting import drift_series

    out = drift_series(vitals(spark, sf_dir), reference(spark, sf_dir), ["age", "bmi", "glucose_level"], DAY_MS)
    return out.withColumn("drift_score", F.round("drift_score", 6))


@query(
    "min_rows",
    "vitals",
    "SELECT patient_id, count(*) AS n_rows, round(avg(glucose_level), 6) AS mean_glucose FROM vitals GROUP BY ALL HAVING count(*) >= 70",
)
def _min_rows(spark, sf_dir):
    out = vitals(spark, sf_dir).groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_rows"), r6(F.avg("glucose_level"), "mean_glucose"))
    return D.min_rows(out, 70)
