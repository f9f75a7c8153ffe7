"""Training and judging the risk model with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwatch.functions.vitals import YES_NO_CODES, encode
from wardwatch.operators.features import feature_struct
from wardwatch.operators.scoring import RiskModel
from wardwatch.schemas import FEATURE_ORDER

LABEL = "readmitted_30_days"

# Share of held-out rows and the limits of the fit.
TEST_SHARE, MAX_ITERATIONS = 0.2, 1000

#: Digits of a hash that rows are counted by at a time, and rows that may be put in order in one task.
HASH_DIGITS, FEW_ROWS = 4, 100_000


def prepare_training(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Encoded features and target; the raw pressure is gone and unknown categories are null."""
    features = df.withColumn("_f", feature_struct(df, "training", "reject"))
    label = encode(F.col(LABEL), YES_NO_CODES).cast("int").alias(LABEL)
    return features.select(*keep, "_f.*", label)


def label_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.col(LABEL)).alias("label_rate"))


def hash_threshold(df: DataFrame, hashed: Column, key: str, n: int, digits: int = HASH_DIGITS, few: int = FEW_ROWS) -> tuple[str, object] | None:
    """The `n`-th smallest `(hash, key)` of a table, without a sort: None where there are not so many rows.

    Rows are counted by the first digits of their hash; then only the bucket that the `n`-th row falls into is
    counted by further digits, until few rows are left in it. The driver sees 16 ** digits counts a round.
    """
    rows = df.select(hashed.alias("_h"), F.col(key).alias("_k")).where("_h IS NOT NULL")
    prefix, below = "", 0
    while True:
        counts = rows.groupBy(F.substring("_h", len(prefix) + 1, digits).alias("b")).count().collect()
        for bucket, count in sorted((r["b"], r["count"]) for r in counts):
            if below + count >= n:
                break
            below += count
        else:
            return None
        prefix += bucket
        rows = rows.where(F.col("_h").startswith(prefix))
        if count <= few or not bucket:
            break
    # Rows of one hash and key are alike, so what is left of a bucket of full hashes is cut by key.
    row = rows.orderBy("_h", "_k").limit(n - below).agg(F.max(F.struct("_h", "_k")).alias("m")).first()["m"]
    return row["_h"], row["_k"]


def stratified_split(df: DataFrame, key: str, label: str = LABEL, test_share: float = TEST_SHARE, digits: int = HASH_DIGITS) -> DataFrame:
    """Add `is_test` so that each label gives the same share of test rows: the first `ceil(share * n)` by the hash of their key.

    Rows are counted by label and the first digits of their hash; running sums over these counts give the
    bucket of each label in which its share ends, and only the rows of that bucket are ranked. The rows themselves
    are compared with one threshold per label; whether that table is broadcast is left to its size.
    """
    hashed = df.withColumn("_h", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))))
    bucket = F.substring("_h", 1, digits)
    counts = hashed.groupBy(F.col(label).alias("_label"), bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy("_label")
    summed = counts.withColumns({"_upto": F.sum("_n").over(by_label.orderBy("_bucket")), "_all": F.sum("_n").over(by_label)})
    wanted = F.ceil(F.lit(test_share) * F.col("_all"))
    ends = summed.where((F.col("_upto") >= wanted) & (F.col("_upto") - F.col("_n") < wanted) & (wanted > 0))
    ends = ends.select("_label", "_bucket", (wanted - F.col("_upto") + F.col("_n")).alias("_rest"))
    edge = hashed.select(F.col(label).alias("_of"), "_h", F.col(key).alias("_k"), bucket.alias("_b"))
    edge = edge.join(ends, F.col("_of").eqNullSafe(F.col("_label")) & (F.col("_b") == F.col("_bucket")))
    place = F.row_number().over(Window.partitionBy("_label").orderBy("_h", "_k"))
    limit = edge.withColumn("_place", place).where(F.col("_place") == F.col("_rest")).select("_label", F.struct("_h", "_k").alias("_limit"))
    joined = hashed.join(limit, F.col(label).eqNullSafe(F.col("_label")), "left")
    own = F.struct(F.col("_h"), F.col(key).alias("_k"))
    return joined.withColumn("is_test", F.coalesce(own <= F.col("_limit"), F.lit(False))).drop("_h", "_label", "_limit")


def sample_rows(df: DataFrame, n: int, key: str = "event_id", seed: int = 42) -> DataFrame:
    """`n` rows by a seeded hash, the same on every run: those up to a threshold, found without a sort.

    `key` tells rows apart; rows that share one are taken together. With `n` rows or fewer, all are taken.
    """
    hashed = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    if n <= 0:
        return df.where(F.lit(False))
    limit = hash_threshold(df, hashed, key, n)
    if limit is None:
        return df
    kind = df.schema[key].dataType
    h, k = F.lit(limit[0]), F.lit(limit[1]).cast(kind)
    same = F.coalesce(F.col(key) <= k, F.col(key).isNull())
    return df.where((hashed < h) | ((hashed == h) & same))


def train_risk_model(train: DataFrame, features: Sequence[str] = FEATURE_ORDER, label: str = LABEL) -> LogisticRegressionModel:
    """L2-regularised logistic regression with unit penalty per data set; rows with a null feature are left out."""
    rows = train.dropna(subset=[*features, label])
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows).select("features", F.col(label).cast("double").alias("label"))
    n = rows.count()
    fit = LogisticRegression(maxIter=MAX_ITERATIONS, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, tol=1e-8)
    return fit.fit(vectors)


def as_risk_model(model: LogisticRegressionModel, features: Sequence[str] = FEATURE_ORDER, version: str = "1.0") -> RiskModel:
    return RiskModel(dict(zip(features, (float(c) for c in model.coefficients), strict=True)), float(model.intercept), version, feature_columns=tuple(features))


def rank_coefficients(spark: SparkSession, model: RiskModel) -> DataFrame:
    """Features by the size of their coefficient."""
    rows = [(name, float(model.weights.get(name, 0.0))) for name in model.feature_columns]
    return spark.createDataFrame(rows, "feature STRING, coefficient DOUBLE").orderBy(F.abs("coefficient").desc(), "feature")


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("bigint").alias("label"), F.col(prediction).cast("bigint").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means.

    Everything after the first aggregation works on one row per pair of classes.
    """
    n = confusion_counts(df, label, prediction)
    sides = n.select(F.col("label").alias("cls"), F.col("n").alias("support"), F.lit(0).alias("predicted"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"))
    sides = sides.unionByName(n.select(F.col("prediction").alias("cls"), F.lit(0).alias("support"), F.col("n").alias("predicted"), F.lit(0).alias("hit")))
    per = sides.groupBy("cls").agg(*[F.sum(c).cast("double").alias(c) for c in ("support", "predicted", "hit")])
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), zero)
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero)
    per = per.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    per = per.withColumn("f1", f1)
    classes = per.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1", "support")
    total = F.sum("support")
    measures = ("precision", "recall", "f1")
    accuracy = F.sum("hit") / total
    summaries = per.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in measures], total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], total.alias("support")),
            F.struct(F.lit("weighted avg").alias("class"), *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures], total.alias("support")),
        ).alias("_s")
    )
    return classes.unionByName(summaries.select(F.explode("_s").alias("_r")).select("_r.*"))


def predict_label(df: DataFrame, model: RiskModel, features: Column) -> DataFrame:
    """Class 1 where the logit is positive; a row in error is class 0."""
    positive = model.logit(features) > 0
    if "error" in df.columns:
        positive = positive & F.col("error").isNull()
    return df.withColumn("prediction", F.coalesce(positive, F.lit(False)).cast("int"))
