import numpy as np
import pytest
from pyspark.sql import functions as F

from borelog.functions.scoring import register_batch_model
from borelog.functions.table_functions import register_functions
from borelog.functions.tree_sql import create_model_function
from borelog.operators.metrics import accuracy, weighted_ovr_auc
from borelog.operators.newest import latest_n_obs
from borelog.plans.training import apply_model, class_scores, feature_importance, predict_state, train_state_model
from borelog.schema import MODEL_TAGS


@pytest.fixture(scope="module")
def labelled(spark):
    """Three states, one of them far from the others in one sensor and all in part without readings."""
    rows = spark.range(3000).select(
        (F.col("id") % 4 + 1).cast("int").alias("well_number"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
        F.element_at(F.array(*map(F.lit, (0, 8, 101))), (F.col("id") % 3 + 1).cast("int")).alias("state"),
        *[F.when(F.rand(i) < 0.95, F.rand(100 + i)).alias(t) for i, t in enumerate(MODEL_TAGS)],
        F.lit("f").alias("source_file"),
    )
    return rows.withColumn("P-PDG", F.col("P-PDG") + F.col("state"))


@pytest.fixture(scope="module")
def forest(labelled):
    return train_state_model(labelled, num_trees=5)


def test_forest_learns_and_returns_state_codes(labelled, forest):
    scored = apply_model(forest, labelled)
    assert scored.columns[: len(labelled.columns)] == labelled.columns
    assert {r.prediction for r in scored.select("prediction").distinct().collect()} == {0, 8, 101}
    assert accuracy(scored).first()[0] > 0.9
    assert weighted_ovr_auc(scored, class_scores(forest)).first().weighted_auc > 0.9


def test_boosted_trees(spark, labelled):
    model = train_state_model(labelled.limit(600), learner="boosted", num_trees=3)
    scored = apply_model(model, labelled)
    assert accuracy(scored).first()[0] > 0.9
    assert weighted_ovr_auc(scored, class_scores(model)).first().weighted_auc > 0.9
    assert scored.where("abs(aggregate(probability, 0D, (a, b) -> a + b) - 1) > 1e-9").isEmpty()
    assert feature_importance(model, labelled, top=1).first().feature == "P-PDG"
    labelled.withColumn("P-JUS-CKP", F.lit(None).cast("double")).createOrReplaceTempView("boosted_rows")
    register_functions(spark, "boosted_rows", create_model_function(spark, model, "boosted_model"))
    assert spark.sql("SELECT * FROM predict_state()").exceptAll(predict_state(model, labelled)).isEmpty()


def test_rows_without_label_teach_nothing(labelled):
    unlabelled = labelled.limit(50).withColumn("state", F.lit(None).cast("int"))
    model = train_state_model(labelled.limit(600).unionByName(unlabelled), num_trees=2)
    assert sorted(model.stages[0].labels) == ["0", "101", "8"]


def test_unknown_learner(labelled):
    with pytest.raises(ValueError):
        train_state_model(labelled, learner="oracle")


def test_importance_ranks_the_telling_sensor_first(labelled, forest):
    rows = feature_importance(forest, labelled, top=3).collect()
    assert len(rows) == 3 and rows[0].feature == "P-PDG"


def test_sql_prediction_equals_the_pipeline(spark, labelled, forest):
    with_other_sensors = labelled.withColumn("P-JUS-CKP", F.lit(None).cast("double"))
    with_other_sensors.createOrReplaceTempView("labelled_rows")
    register_functions(spark, "labelled_rows", create_model_function(spark, forest))
    for sql, wanted in (
        ("SELECT * FROM predict_state()", predict_state(forest, labelled)),
        ("SELECT * FROM predict_state(2, 100)", predict_state(forest, labelled, 2, 100)),
    ):
        found = sorted(map(tuple, spark.sql(sql).collect()))
        assert found == sorted(map(tuple, wanted.collect())) and found
    assert spark.sql("SELECT * FROM predict_state(1023)").isEmpty()


def test_a_feature_never_seen_in_training(labelled):
    """It is filled with 0, in training and later, and says nothing."""
    blind = labelled.withColumn("QGL", F.lit(None).cast("double")).withColumn("T-TPT", F.lit(float("nan")))
    model = train_state_model(blind, num_trees=3)
    assert accuracy(apply_model(model, labelled)).first()[0] > 0.9
    importance = {r.feature: r.importance for r in feature_importance(model, labelled).collect()}
    assert importance["QGL"] == importance["T-TPT"] == 0.0


def test_an_external_model_in_sql(spark, labelled):
    labelled.withColumn("P-JUS-CKP", F.lit(None).cast("double")).createOrReplaceTempView("labelled_rows")

    def load():
        return lambda rows: np.where(np.nan_to_num(rows[:, 0]) > 50, 101.0, 0.0)

    register_functions(spark, "labelled_rows", register_batch_model(spark, load, "threshold_model"))
    found = {(r.well_number, r.timestamp): r.prediction for r in spark.sql("SELECT * FROM predict_state(n_obs_param => 20)").collect()}
    newest = latest_n_obs(labelled, n=20).collect()
    assert found == {(r.well_number, r.timestamp): 101 if (r["P-PDG"] or 0) > 50 else 0 for r in newest}
