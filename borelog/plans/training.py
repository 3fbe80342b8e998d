"""Train, apply and inspect a classifier of well states: boosted trees, or Spark's own forest."""

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from borelog.functions.tree_sql import apply_boosted, model_labels
from borelog.operators.newest import latest_n_obs
from borelog.plans.boosting import BoostedModel, BoostingSettings, train_boosted
from borelog.schema import ALL_WELLS, MODEL_FEATURES

# Learning rate, share of features and rows per tree, depth of a forest's trees (2 ** 5 > 31 leaves), seed.
LEARNING_RATE = 0.1
FEATURE_SHARE = "0.8"
ROW_SHARE = 0.8
MAX_DEPTH = 5
SEED = 42


def train_state_model(
    training: DataFrame,
    learner: str = "forest",
    features: Sequence[str] = MODEL_FEATURES,
    label: str = "state",
    num_trees: int = 20,
    max_depth: int = MAX_DEPTH,
) -> PipelineModel | BoostedModel:
    """Fit a classifier on labelled rows; rows without a label teach nothing and are left out.

    ``boosted`` is the learner of ``plans.boosting``: ``num_trees`` rounds of one tree per class under softmax, which take
    missing values as they are and grow to a number of leaves, whatever their depth. ``forest`` is Spark's random forest:
    its trees reject missing values, so those that forward fill leaves are replaced by training medians, and by 0 in a
    feature that the training rows never show.
    """
    if learner == "boosted":
        settings = BoostingSettings(rounds=num_trees, rate=LEARNING_RATE, feature_share=float(FEATURE_SHARE), row_share=ROW_SHARE, seed=SEED)
        return train_boosted(training, features, label, settings)
    if learner != "forest":
        raise ValueError(f"unknown learner {learner}")
    classifier = RandomForestClassifier(
        numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy=FEATURE_SHARE, subsamplingRate=ROW_SHARE,
        featuresCol="features", labelCol="label", predictionCol="index", seed=SEED,
    )
    labelled = training.where(F.col(label).isNotNull())
    rows = labelled.select(*_doubles(features), F.col(label)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = rows.agg(*[F.count(F.nanvl(c, F.lit(None).cast("double"))).alias(c) for c in features]).first()
        training = rows.fillna(0.0, subset=[c for c in features if seen[c] == 0])
        filled = [f"{c} filled" for c in features]
        indexer = StringIndexer(inputCol=label, outputCol="label", handleInvalid="keep").fit(training)
        stages = [
            indexer,
            Imputer(strategy="median", inputCols=list(features), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="features"),
            classifier,
            IndexToString(inputCol="index", outputCol="predicted_label", labels=indexer.labels),
        ]
        return Pipeline(stages=stages).fit(training)
    finally:
        rows.unpersist()


def _doubles(features) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in features]


def apply_model(model, rows: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Add ``prediction``, the predicted state code, and ``probability``, one number per class."""
    if isinstance(model, BoostedModel):
        return apply_boosted(model, rows)
    label = model.stages[0].getInputCol()
    kept = F.struct(*rows.columns).alias("_row")
    if label not in rows.columns:
        rows = rows.withColumn(label, F.lit(None).cast("int"))
    scored = model.transform(rows.select(kept, *_doubles(features), label))
    prediction = F.col("predicted_label").cast("int").alias("prediction")
    return scored.select("_row.*", prediction, vector_to_array("probability").alias("probability"))


def class_scores(model) -> Mapping[int, Column]:
    """Score column of every class in the output of ``apply_model``."""
    return {label: F.get("probability", F.lit(i)) for i, label in enumerate(model_labels(model))}


def predict_state(
    model, observations: DataFrame, well: int = ALL_WELLS, n: int = 10, scan_cap: int | None = None
) -> DataFrame:
    """Predicted state of the newest ``n`` observations per well; only those rows reach the model."""
    newest = latest_n_obs(observations, well, n, scan_cap)
    return apply_model(model, newest).select("well_number", "timestamp", "prediction")


def feature_importance(model, observations: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` features by importance, for boosted trees their share in the gain; one small row per feature."""
    if isinstance(model, BoostedModel):
        rows = model.importance()
    else:
        features = [c.removesuffix(" filled") for c in model.stages[2].getInputCols()]
        rows = [(f, float(i)) for f, i in zip(features, model.stages[3].featureImportances.toArray())]
    table = observations.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)
