"""Training, evaluation and scoring of the fraud model with Spark ML."""
from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.operators import boosting
from fraudloom.operators.ingest import injected
from fraudloom.operators.rules import DEFAULT
from fraudloom.plans.ranges import running_totals, smallest_share
from fraudloom.session import checkpoint_root

# Spark's trees have no missing branch: these two are null on a user's first event, so they are filled
# and get an indicator each.
MAY_BE_MISSING = ("seconds_since_prev", "km_from_prev")
VECTOR = "model_input"
SEED = 42
TRAIN_SHARE = (3, 4)
MIN_ROWS, MIN_POSITIVES = 500, 50  # fixed values
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters. The defaults are fixed values."""

    trees: int = 300
    depth: int = 6
    step: float = 0.1
    row_share: float = 0.9
    column_share: float = 0.9
    seed: int = SEED


def feature_scan(processed: DataFrame, *keep: str) -> DataFrame:
    """The twelve inputs, flags as 0/1; a missing number stays null."""
    inputs = [F.col(c).cast("int").alias(c) if c in schemas.FLAG_FEATURES else F.col(c)
              for c in schemas.MODEL_FEATURES]
    return processed.select("transaction_id", *keep, *inputs)


def input_columns() -> list[str]:
    return [*schemas.MODEL_FEATURES, *[f"{c}_missing" for c in MAY_BE_MISSING]]


def vectorize(df: DataFrame) -> DataFrame:
    """Add the input vector: twelve features in fixed order, then the missing indicators."""
    plain = {f"_{c}": F.coalesce(F.col(c).cast("int").cast("double") if c in schemas.FLAG_FEATURES
                                 else F.col(c).cast("double"), F.lit(0.0)) for c in schemas.MODEL_FEATURES}
    missing = {f"_{c}_missing": F.col(c).isNull().cast("double") for c in MAY_BE_MISSING}
    names = [f"_{c}" for c in input_columns()]
    assembler = VectorAssembler(inputCols=names, outputCol=VECTOR)
    return assembler.transform(df.withColumns({**plain, **missing})).drop(*names)


def labels(raw: DataFrame) -> DataFrame:
    """Ground truth per transaction: was any copy injected?"""
    return raw.groupBy("transaction_id").agg(
        F.bool_or(injected(F.col("payload")).isNotNull()).alias("label"))


def join_features_label(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Model inputs with the rules' verdict and the label. Labels are unique, so nothing fans out."""
    scan = feature_scan(processed, "rule_flagged")
    return (scan.join(labels(raw), "transaction_id")
            .withColumns({"rule_pred": F.col("rule_flagged").cast("int"), "label": F.col("label").cast("int")})
            .drop("rule_flagged"))


def gate_counts(labelled: DataFrame) -> DataFrame:
    n, positives = F.count("*"), F.count_if(F.col("label") == 1)
    return labelled.agg(n.alias("rows"), positives.alias("positives"),
                        ((n >= MIN_ROWS) & (positives >= MIN_POSITIVES)).alias("enough"))


def require_enough(labelled: DataFrame) -> tuple[int, int]:
    got = gate_counts(labelled).first()
    if not got["enough"]:
        raise ValueError(f"not enough data to train: rows={got['rows']} positives={got['positives']}")
    return got["rows"], got["positives"]


def stratified_split(labelled: DataFrame, share: tuple[int, int] = TRAIN_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``is_train``: exactly ``floor(share)`` rows of each label, chosen by hashed id."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.col("transaction_id")))
    cuts = smallest_share(labelled, "label", hashed, share, labelled.count())
    return (labelled.join(F.broadcast(cuts), "label", "left")
            .withColumn("is_train", F.coalesce(hashed <= F.col("cut"), F.lit(False))).drop("cut"))


def positive_weight(train: DataFrame) -> float:
    """Negatives per positive."""
    got = train.agg(F.count_if(F.col("label") == 0).alias("neg"), F.count_if(F.col("label") == 1).alias("pos")).first()
    return got["neg"] / max(got["pos"], 1)


def dealt_out(train: DataFrame) -> DataFrame:
    """The rows in equal tasks of at most ``ROWS_PER_TASK``, one per core at least.

    Every level of every tree is a pass over these tasks and waits for the largest, so files or shuffles that
    happened to leave rows uneven would count thousands of times.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(max(cores, -(-train.count() // ROWS_PER_TASK)))


def train_model(train: DataFrame, params: TreeParams = TreeParams()) -> GBTClassificationModel:
    weight = positive_weight(train)
    rows = vectorize(dealt_out(train)).select(
        vector_to_array(VECTOR).alias("inputs"), F.col("label").cast("double").alias("label"))
    trees, layout = boosting.fit(rows, weight, **vars(params))
    trainer = GBTClassifier(
        featuresCol=VECTOR, labelCol="label", weightCol="weight", maxIter=params.trees,
        maxDepth=params.depth, stepSize=params.step, subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share), seed=params.seed)
    return boosting.as_model(train.sparkSession, trees, layout, trainer)


def score(df: DataFrame, model: GBTClassificationModel | None = None) -> DataFrame:
    """Add ``fraud_score``, the probability of fraud; null without a model."""
    if model is None:
        return df.withColumn("fraud_score", F.lit(None).cast("double"))
    if model.getMaxDepth() > boosting.DEEPEST:
        scored = model.transform(vectorize(df))
        made = (VECTOR, model.getRawPredictionCol(), model.getProbabilityCol(), model.getPredictionCol())
        return scored.withColumn("fraud_score", vector_to_array(model.getProbabilityCol())[1]).drop(*made)
    probability = boosting.probability(df.sparkSession, model)
    return vectorize(df).withColumn("fraud_score", probability(vector_to_array(VECTOR))).drop(VECTOR)


def evaluate(scored: DataFrame, predicted: Column, name: str) -> DataFrame:
    """Confusion counts, precision, recall and F1 of a 0/1 prediction; a ratio over nothing is 0."""
    truth = F.col("label") == 1
    hit = F.coalesce(predicted, F.lit(False))
    counted = scored.agg(
        F.count_if(truth & hit).alias("tp"), F.count_if(~truth & hit).alias("fp"),
        F.count_if(truth & ~hit).alias("fn"), F.count_if(~truth & ~hit).alias("tn"))

    def ratio(num: Column, den: Column) -> Column:
        return F.coalesce(num.cast("double") / F.nullif(den, F.lit(0)), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(
        F.lit(name).alias("name"), "tp", "fp", "fn", "tn",
        F.round(ratio(tp, tp + fp), 4).alias("precision"), F.round(ratio(tp, tp + fn), 4).alias("recall"),
        F.round(ratio(tp * 2, tp * 2 + fp + fn), 4).alias("f1"))


def average_precision(scored: DataFrame, score_col: str = "fraud_score", rows_per_range: int = 50_000) -> DataFrame:
    """Average precision: the step sum over distinct scores, highest first."""
    checkpoint_root(scored.sparkSession)
    grouped = scored.groupBy(F.col(score_col).alias("score")).agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("pos")).checkpoint()
    totals = running_totals(grouped, "score", ("n", "pos"), grouped.count(), rows_per_range)
    gained = F.sum(F.col("pos") * (F.col("pos_upto") / F.col("n_upto")))
    return totals.agg((gained / F.nullif(F.sum("pos"), F.lit(0))).alias("average_precision"))


def importances(spark: SparkSession, model: GBTClassificationModel) -> DataFrame:
    """Feature importances, highest first; an indicator counts for its feature."""
    weight = dict.fromkeys(schemas.MODEL_FEATURES, 0.0)
    for name, value in zip(input_columns(), model.featureImportances.toArray()):
        weight[name.removesuffix("_missing")] += float(value)
    return (spark.createDataFrame(list(weight.items()), "feature string, importance double")
            .orderBy(F.col("importance").desc(), "feature"))


def save_model(spark: SparkSession, model: GBTClassificationModel, metadata: dict, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metadata),)], "metadata string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[GBTClassificationModel | None, dict | None]:
    """Model and metadata, or two Nones when nothing was trained yet."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/metadata/_SUCCESS")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None, None
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    return GBTClassificationModel.load(f"{path}/model"), metadata


def publish(processed: DataFrame, raw: DataFrame, path: str, trained_at: str,
            params: TreeParams = TreeParams(), threshold: float = DEFAULT.score) -> dict:
    """Train on three quarters, evaluate on the rest against the rules, save model and metadata."""
    checkpoint_root(processed.sparkSession)
    return publish_labelled(join_features_label(processed, raw).checkpoint(), path, trained_at, params, threshold)


def publish_labelled(labelled: DataFrame, path: str, trained_at: str, params: TreeParams = TreeParams(),
                     threshold: float = DEFAULT.score) -> dict:
    """The same from a table of model inputs and labels, which is read more than once."""
    spark = labelled.sparkSession
    checkpoint_root(spark)
    rows, positives = require_enough(labelled)
    halves = stratified_split(labelled).checkpoint()
    model = train_model(halves.filter("is_train"), params)
    scored = score(halves.filter("NOT is_train"), model).checkpoint()
    predicted = {"ml_metrics": F.col("fraud_score") >= threshold, "rule_metrics": F.col("rule_pred") == 1}
    metrics = {name: evaluate(scored, col, name).first().asDict() for name, col in predicted.items()}
    metadata = {
        "trained_at": trained_at, "rows": rows, "positives": positives,
        "features": list(schemas.MODEL_FEATURES), "threshold": threshold,
        "pr_auc": round(average_precision(scored).first()[0] or 0.0, 4), **metrics,
        "feature_importances": {r["feature"]: round(r["importance"], 4)
                                for r in importances(spark, model).collect()},
    }
    save_model(spark, model, metadata, path)
    return metadata


def backfill(processed: DataFrame, model: GBTClassificationModel, threshold: float = DEFAULT.score) -> DataFrame:
    """The processed table with every row scored. Flags and fraud events of the rules stay as they are."""
    scored = score(processed.drop("fraud_score", "ml_flagged"), model)
    return scored.withColumn("ml_flagged", F.col("fraud_score") >= threshold).select(*processed.columns)


def backfill_report(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("updated"), F.count_if("ml_flagged").alias("ml_flagged"))
