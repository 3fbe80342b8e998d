"""Boosting on histograms against a plain booster, and trees as SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from borelog.functions.table_functions import register_functions
from borelog.functions.tree_sql import apply_boosted, booster_margins, create_model_function, prediction_sql, quoted
from borelog.operators.metrics import accuracy
from borelog.operators.newest import latest_n_obs
from borelog.plans import boosting
from borelog.plans.boosting import BoostingSettings, Tree, leaves_of, train_boosted
from borelog.plans.training import predict_state, train_state_model
from borelog.schema import MODEL_FEATURES, MODEL_TAGS
from borelog.sources.trees import write_table

FEATURES = ["a", "b", "c", "d"]


def table(n, seed, missing=0.2, classes=(0, 3, 101)):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, 4)).round(1)
    values[:, 3] = rng.integers(0, 3, n)
    label = np.digitize(values[:, 0] + values[:, 1] * values[:, 3] + rng.normal(size=n) / 2, [-0.5, 0.7])
    label = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), label)
    values[rng.random((n, 4)) < missing] = np.nan
    values[label == 2, 2] = np.where(rng.random((label == 2).sum()) < 0.7, np.nan, values[label == 2, 2])
    return values, np.array(classes)[label]


def frame(spark, values, labels):
    rows = [(*[None if math.isnan(v) else float(v) for v in row], int(label)) for row, label in zip(values, labels)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, state int")


def plain_tree(bins, cuts, slopes, bends, features, settings):
    """Best-first growth that looks at the rows of every leaf for every split."""
    steps = boosting.STEPS
    score = lambda rows: (slopes[rows].sum() / steps) ** 2 / max(bends[rows].sum() / steps, 1e-300)

    def best(rows):
        found = None
        for i in features:
            missing = bins[rows, i] == 255
            for way in (True, False) if missing.any() else (None,):
                for cut in range(len(cuts[i]) + 1):
                    left = np.where(missing, bool(way), bins[rows, i] <= cut)
                    parts = rows[left], rows[~left]
                    if min(map(len, parts)) < settings.least_rows or min(bends[p].sum() for p in parts) < settings.least_hessian * steps:
                        continue
                    gain = score(parts[0]) + score(parts[1]) - score(rows)
                    if gain > settings.least_gain and (found is None or gain > found[0]):
                        found = gain, i, cut, len(parts[0]) >= len(parts[1]) if way is None else way, parts
        return found

    leaves = [("", np.arange(len(bins)))]
    splits, nodes = {"": best(leaves[0][1])}, {}
    while len(nodes) < settings.leaves - 1:
        ready = [(splits[name][0], -int("1" + name, 2), name) for name, _ in leaves if splits[name]]
        if not ready:
            break
        *_, name = max(ready)
        nodes[name] = splits[name][1:4]
        leaves = [leaf for leaf in leaves if leaf[0] != name]
        for side, rows in zip("01", splits[name][4]):
            leaves.append((name + side, rows))
            splits[name + side] = best(rows)
    values = {name: -settings.rate * float(slopes[rows].sum()) / float(bends[rows].sum()) for name, rows in leaves}
    return nodes, values


def as_paths(tree):
    nodes, values, todo = {}, {}, [("", 0)]
    while todo:
        name, at = todo.pop()
        if tree.feature[at] < 0:
            values[name] = tree.value[at]
        else:
            nodes[name] = tree.feature[at], tree.cut[at], tree.missing_left[at]
            todo += [(name + "0", tree.left[at]), (name + "1", tree.right[at])]
    return nodes, values


@pytest.mark.parametrize("settings", [
    BoostingSettings(rounds=4, leaves=31, least_rows=5, rounds_per_write=2, feature_share=0.8),
    BoostingSettings(rounds=3, leaves=6, row_share=1.0, feature_share=1.0, rows_drawn_every=1),
    BoostingSettings(rounds=3, leaves=2, rows_drawn_every=1, rounds_per_write=1),
])
def test_equal_to_a_plain_booster_tree_by_tree(spark, settings):
    values, labels = table(500, 3)
    rows = frame(spark, values, labels)
    model = train_boosted(rows.repartition(5), FEATURES, settings=settings)
    assert model.labels == [0, 3, 101] and len(model.rounds) == settings.rounds

    keyed = rows.select(F.xxhash64(*rows.columns).alias("row_key")).collect()
    cuts = boosting.cut_points(rows.select(*boosting.feature_values(FEATURES)), 4)
    assert all(set(c) <= set(values[:, i]) and np.nanmax(values[:, i]) == c[-1] for i, c in enumerate(cuts))
    bins = np.stack([np.where(np.isnan(values[:, i]), 255, np.searchsorted(cuts[i], values[:, i])) for i in range(4)], axis=1)
    place, keys = np.searchsorted(model.labels, labels), np.array([r.row_key for r in keyed])
    margins = np.tile(np.log([(place == k).mean() for k in range(3)]), (500, 1))
    for number, trees in enumerate(model.rounds):
        chosen = boosting.drawn(keys, number // settings.rows_drawn_every, settings)
        chances = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
        slopes = np.rint((chances - (place[:, None] == np.arange(3))) * boosting.STEPS)
        bends = np.rint(chances * (1 - chances) * boosting.STEPS)
        for k, tree in enumerate(trees):
            allowed = boosting.tree_features(4, number, k, settings)
            nodes, leaf_values = plain_tree(bins[chosen], cuts, slopes[chosen, k], bends[chosen, k], allowed, settings)
            found_nodes, found_values = as_paths(tree)
            assert found_nodes == nodes
            assert found_values == pytest.approx(leaf_values, rel=1e-6)
            margins[:, k] += np.array(tree.value)[leaves_of(tree, bins)]
    assert max(len(t.feature) for trees in model.rounds for t in trees) <= 2 * settings.leaves - 1


def test_sql_margins_equal_the_trees_on_every_row(spark):
    values, labels = table(700, 5)
    rows = frame(spark, values, labels).union(frame(spark, [[math.nan] * 4, [math.inf, -math.inf, 0, 1e300]], [0, 0]))
    model = train_boosted(rows, FEATURES, settings=BoostingSettings(rounds=6, least_rows=5))
    scored = rows.withColumn("margins", F.expr(booster_margins(model, quoted(FEATURES)))).collect()

    def walk(tree, row, at=0):
        while tree.feature[at] >= 0:
            value = row[FEATURES[tree.feature[at]]]
            left = tree.missing_left[at] if value is None or math.isnan(value) else value <= tree.threshold[at]
            at = tree.left[at] if left else tree.right[at]
        return tree.value[at]

    for row in scored:
        sums = list(model.base)
        for trees in model.rounds:
            sums = [s + walk(t, row) for s, t in zip(sums, trees)]
        assert row.margins == sums
    applied = apply_boosted(model, rows)
    assert applied.where("abs(aggregate(probability, 0D, (a, b) -> a + b) - 1) > 1e-9").isEmpty()
    assert applied.where(f"prediction <> {prediction_sql(model, quoted(FEATURES))}").isEmpty()
    assert accuracy(applied).first()[0] > 0.8


def test_trees_do_not_depend_on_the_order_of_rows(spark):
    rows = frame(spark, *table(600, 7))
    one, two = (train_boosted(r, FEATURES, settings=BoostingSettings(rounds=3)) for r in (rows.coalesce(1), rows.repartition(13)))
    assert [[as_paths(t) for t in trees] for trees in one.rounds] == [[as_paths(t) for t in trees] for trees in two.rounds]


def test_missing_values_alone_decide(spark):
    """No value tells the classes apart, only that one is missing; a feature that is always missing says nothing."""
    rows = spark.range(400).selectExpr("IF(id % 2 = 0, 1D, NULL) AS a", "CAST(NULL AS DOUBLE) AS b", "CAST('NaN' AS DOUBLE) AS c", "1D AS d", "CAST(id % 2 AS INT) * 7 AS state", "id")
    model = train_boosted(rows, FEATURES, settings=BoostingSettings(rounds=2, feature_share=1.0))
    assert apply_boosted(model, rows).where("prediction <> state").isEmpty()
    assert dict(model.importance()) == {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0}


def test_one_label_few_rows_and_none(spark):
    rows = frame(spark, *table(30, 1))
    model = train_boosted(rows.withColumn("state", F.lit(4)), FEATURES, settings=BoostingSettings(rounds=1))
    assert {r.prediction for r in apply_boosted(model, rows).collect()} == {4}
    few = train_boosted(rows.limit(5), FEATURES, settings=BoostingSettings(rounds=1))
    assert all(len(t.feature) == 1 for t in few.rounds[0])
    with pytest.raises(ValueError):
        train_boosted(rows.withColumn("state", F.lit(None).cast("int")), FEATURES)


def test_a_branch_over_all_values():
    tree = Tree([0, -1, -1], [0, 0, 0], [math.inf, 0.0, 0.0], [False, True, True], [1, 1, 2], [2, 1, 2], [0.0, 1.0, 2.0], [1.0, 0.0, 0.0])
    assert leaves_of(tree, np.array([[0], [255]], np.uint8)).tolist() == [1, 2]


@pytest.mark.parametrize("learner", ["boosted", "forest"])
def test_permanent_predict_state(spark, tmp_path, learner):
    """A new session finds the function in the catalog and plans it without Python."""
    rows = spark.range(2000).select(
        (F.col("id") % 4 + 1).cast("int").alias("well_number"), F.timestamp_seconds("id").alias("timestamp"),
        F.element_at(F.array(*map(F.lit, (0, 8, 101))), (F.col("id") % 3 + 1).cast("int")).alias("state"),
        *[F.when(F.rand(i) < 0.9, F.rand(100 + i)).alias(t) for i, t in enumerate(MODEL_TAGS)], F.lit("f").alias("source_file"),
        F.lit(None).cast("double").alias("P-JUS-CKP"),
    ).withColumn("P-PDG", F.col("P-PDG") * 3 + F.col("state"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wells_{learner} LOCATION '{tmp_path}/db'")
    name = f"wells_{learner}.well_data"
    try:
        spark.sql(f"USE wells_{learner}")
        write_table(rows, name)
        stored = spark.table(name)
        model = train_state_model(stored, learner, num_trees=4)
        function = create_model_function(spark, model, temporary=False, schema=f"wells_{learner}")
        register_functions(spark, name, function, temporary=False, schema=f"wells_{learner}")
        later = spark.newSession()
        later.sql(f"USE wells_{learner}")
        found = later.sql("SELECT * FROM predict_state(n_obs_param => 1000)")
        assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
        wanted = predict_state(model, stored, n=1000)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
        assert found.count() == latest_n_obs(stored, n=1000).count() == 2000
        one = later.sql("SELECT * FROM predict_state(2)")
        assert one.count() == 10 and {r.well_number for r in one.collect()} == {2}
        features = ", ".join(f"CAST(`{f}` AS DOUBLE)" for f in MODEL_FEATURES)
        assert later.sql(f"SELECT avg(int(state_model(array({features})) = state)) FROM well_data").first()[0] > 0.9
    finally:
        spark.sql("USE default")
        spark.sql(f"DROP DATABASE wells_{learner} CASCADE")
