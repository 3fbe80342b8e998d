"""Tree models as SQL expressions and as SQL functions, temporary or permanent: scoring without Python."""

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from borelog.plans.boosting import BoostedModel, Tree
from borelog.schema import MODEL_FEATURES


def _number(value: float) -> str:
    if math.isinf(value):
        return f"DOUBLE('{'-' if value < 0 else ''}Infinity')"
    return f"{value!r}D"


def _branches(tree: Tree, names: Sequence[str], node: int = 0) -> str:
    """A tree as nested IFs; a comparison with a missing value is NULL and goes the node's way for missing values."""
    if tree.feature[node] < 0:
        return _number(tree.value[node])
    test = f"{names[tree.feature[node]]} <= {_number(tree.threshold[node])}"
    way = "true" if tree.missing_left[node] else "false"
    left, right = (_branches(tree, names, side[node]) for side in (tree.left, tree.right))
    return f"IF(coalesce({test}, {way}), {left}, {right})"


def _cleaned(features: Sequence[str]) -> list[str]:
    return [f"nanvl(CAST({f} AS DOUBLE), CAST(NULL AS DOUBLE))" for f in features]


def booster_margins(model: BoostedModel, features: Sequence[str]) -> str:
    """Array of one margin per class, of SQL expressions of the features; the trees are added in the order of their rounds."""
    names = [f"x[{i}]" for i in range(len(features))]
    sums = [" + ".join([_number(b), *[_branches(trees[k], names) for trees in model.rounds]]) for k, b in enumerate(model.base)]
    # Each feature is computed once, as an element of an array that the trees look at.
    return f"transform(array(array({', '.join(_cleaned(features))})), x -> array({', '.join(sums)}))[0]"


def forest_votes(model: PipelineModel, features: Sequence[str]) -> str:
    """Array of one vote per class of a forest of ``plans.training``, with its fill values for missing features."""
    _, imputer, _, forest, _ = model.stages
    fill = imputer.surrogateDF.first()
    trees = [_shares(tree._java_obj.rootNode()) for tree in forest.trees]
    names = [f"x[{i}]" for i in range(len(features))]
    sums = [" + ".join(["0D", *[_branches(_one_class(nodes, k), names) for nodes in trees]]) for k in range(forest.numClasses)]
    filled = [f"coalesce({c}, {_number(fill[f])})" for c, f in zip(_cleaned(features), MODEL_FEATURES)]
    return f"transform(array(array({', '.join(filled)})), x -> array({', '.join(sums)}))[0]"


def _shares(root) -> list:
    """Nodes of a Spark tree from the root on: (feature, threshold, left, right) or the shares of the classes in a leaf."""
    nodes = []

    def add(node):
        at = len(nodes)
        nodes.append(None)
        if node.subtreeDepth() == 0:
            counts = list(node.impurityStats().stats())
            nodes[at] = [n / sum(counts) for n in counts]
        else:
            split = node.split()
            nodes[at] = (split.featureIndex(), split.threshold(), add(node.leftChild()), add(node.rightChild()))
        return at

    add(root)
    return nodes


def _one_class(nodes: list, k: int) -> Tree:
    tree = Tree()
    for node in nodes:
        if isinstance(node, tuple):
            tree.add(node[0], threshold=node[1])
            tree.left[-1], tree.right[-1] = node[2], node[3]
        else:
            tree.add(value=node[k])
    return tree


def scores_sql(model, features: Sequence[str]) -> str:
    """Array of the scores of all classes, in the order of ``model_labels``."""
    if isinstance(model, BoostedModel):
        return booster_margins(model, features)
    return forest_votes(model, features)


def model_labels(model) -> list[int]:
    return list(model.labels) if isinstance(model, BoostedModel) else [int(label) for label in model.stages[0].labels]


def prediction_sql(model, features: Sequence[str]) -> str:
    """The label of the largest score; of equal ones the first."""
    labels = model_labels(model)
    # Spark's learners may count one class more than there are labels; it has no rows.
    scores = f"slice({scores_sql(model, features)}, 1, {len(labels)})"
    listed = ", ".join(map(str, labels))
    return f"transform(array({scores}), s -> element_at(array({listed}), CAST(array_position(s, array_max(s)) AS INT)))[0]"


def quoted(features: Sequence[str]) -> list[str]:
    return [f"`{f}`" for f in features]


def apply_boosted(model: BoostedModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction``, the predicted label, and ``probability``, one number per class."""
    scored = rows.withColumn("_margins", F.expr(booster_margins(model, quoted(model.features))))
    top = F.array_max("_margins")
    weights = F.transform("_margins", lambda m: F.exp(m - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    labels = F.array(*map(F.lit, model.labels))
    prediction = F.element_at(labels, F.array_position("_margins", top).cast("int"))
    return scored.select(*rows.columns, prediction.alias("prediction"), F.transform(weights, lambda w: w / total).alias("probability"))


def create_model_function(spark: SparkSession, model, name: str = "state_model", temporary: bool = True, schema: str | None = None) -> str:
    """Create a SQL function of one array, the features in ``MODEL_FEATURES`` order, that returns the predicted state.

    ``model`` is a ``BoostedModel`` or a pipeline of ``plans.training``. The trees are the function's body: it needs no
    Python and, unless ``temporary``, stays in the catalog, where any later session finds it. The body grows with the
    number of nodes, some 60 characters for each.
    """
    home = f"{schema}." if schema else ""
    body = prediction_sql(model, [f"features[{i}]" for i in range(len(MODEL_FEATURES))])
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}FUNCTION {home}{name}(features ARRAY<DOUBLE>) RETURNS INT RETURN {body}")
    return f"{home}{name}"
