"""Fold models as tables, and rows scored by joining them.

A tree model is a table of nodes (fold, tree, weight, node, feature, place, threshold, below,
above, value); a network is a table of weights (fold, layer, output, input, weight), input -1 being the
bias. Either is read off the stored models, so what scores is data that any engine can read.

To score, a fold's model is laid out as one row of arrays and joined to the rows by fold. A row goes
down all trees level by level, or through all layers, in one projection; no row is
exploded by trees. A model's size follows from its parameters (trees x 2**depth nodes, or weights), not from the rows; it
is broadcast in blocks of trees that ``spark.rowtide.broadcastBytes`` allows, and more
than one block takes one stored pass each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import name
from rowtide.plans.training import TrainSpec, scaled_by_all, scaled_by_own
from rowtide.session import limits, materialise
from rowtide.sources.cache import cached_table

NODE_BYTES = 36
_NODE = ("place", "threshold", "below", "above", "value")


def tree_table_of(spark: SparkSession, spec: TrainSpec, fold: int) -> DataFrame:
    """The nodes of one fold's stored model."""
    names = F.array(*[F.lit(f) for f in spec.features])
    path = spec.model_path(fold)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{path}/data").selectExpr("treeID AS tree", "nodeData.*")
    inner = F.col("leftChild") >= 0
    grouped = F.raise_error(F.lit("trees with category splits are not supported")).cast("int")
    return nodes.join(F.broadcast(weights), "tree").select(
        F.lit(fold).alias("fold"),
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner & (F.col("split.numCategories") >= 0), grouped).otherwise(F.col("split.featureIndex")).alias("place"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("below"),
        F.col("rightChild").alias("above"),
        F.col("prediction").alias("value"),
    )


def node_table(spark: SparkSession, spec: TrainSpec) -> DataFrame:
    """The nodes of all fold models, stored beside them; values up to the threshold go to ``below``."""

    def read() -> DataFrame:
        parts = [tree_table_of(spark, spec, fold) for fold in range(spec.folds)]
        return reduce(DataFrame.unionByName, parts)

    return cached_table(spark, f"{spec.folder}/{spec.model}_nodes", read, spec.fingerprint)


def weight_table(spark: SparkSession, spec: TrainSpec) -> DataFrame:
    """The weights of all fold networks, stored beside them.

    A stored network is one vector: for each layer the weights input by input, then the biases.
    """

    def read() -> DataFrame:
        parts = None
        for fold in range(spec.folds):
            flat = spark.read.parquet(f"{spec.model_path(fold)}/data").select(vector_to_array("weights").alias("flat"))
            part = weights_of(flat, spec.layers).select(F.lit(fold).alias("fold"), "*")
            parts = part if parts is None else parts.unionByName(part)
        return parts

    return cached_table(spark, f"{spec.folder}/{spec.model}_weights", read, spec.fingerprint)


def weights_of(flat: DataFrame, layers: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, layer, output, input, weight of networks whose column ``flat`` holds all their weights."""
    at = flat.select(*keep, F.posexplode("flat").alias("at", "weight"))
    parts, begin = None, 0
    for i, (n_in, n_out) in enumerate(zip(layers, layers[1:], strict=False)):
        end = begin + (n_in + 1) * n_out
        inside = F.col("at") - begin
        part = at.filter((F.col("at") >= begin) & (F.col("at") < end)).select(
            *keep,
            F.lit(i).alias("layer"),
            (inside % n_out).cast("int").alias("output"),
            F.when(inside < n_in * n_out, F.floor(inside / n_out)).otherwise(-1).cast("int").alias("input"),
            "weight",
        )
        parts, begin = part if parts is None else parts.unionByName(part), end
    return parts


def forests(nodes: DataFrame) -> DataFrame:
    """One row per fold: its trees in order, each as arrays over its nodes."""
    trees = nodes.groupBy("fold", "tree").agg(
        F.first("weight").alias("weight"), F.array_sort(F.collect_list(F.struct("node", *_NODE))).alias("nodes")
    )
    laid = F.struct("tree", "weight", *[F.col(f"nodes.{c}").alias(c) for c in _NODE])
    return trees.groupBy("fold").agg(F.array_sort(F.collect_list(laid)).alias("forest"))


def _contributions(depth: int) -> str:
    """What each tree of ``forest`` adds to a row with features ``x``; a missing comparison goes above, as in training."""
    step = (
        "CASE WHEN get(t.below, at) < 0 THEN at "
        "WHEN get(x, get(t.place, at)) <= get(t.threshold, at) THEN get(t.below, at) ELSE get(t.above, at) END"
    )
    leaf = f"aggregate(sequence(1, {max(1, depth)}), 0, (at, i) -> {step})"
    return f"transform(forest, t -> t.weight * get(t.value, {leaf}))"


def _features(spec: TrainSpec) -> str:
    return "array(" + ", ".join(f"CAST({name(f)} AS DOUBLE)" for f in spec.features) + ")"


def tree_parts(rows: DataFrame, nodes: DataFrame, spec: TrainSpec, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``parts``: what each tree of the row's ``fold`` adds, in the order of the trees.

    ``keep`` holds what tells rows apart, ``fold`` included.
    """
    spark = rows.sparkSession
    size, trees = nodes.agg(F.count("*"), F.max("tree") + 1).first()
    per_block = max(1, (trees or 1) * limits(spark).broadcast_bytes // max(1, size * NODE_BYTES))
    depth = int(dict(spec.params).get("maxDepth", 8))
    inputs = rows.selectExpr(*[name(c) for c in keep], f"{_features(spec)} AS x")
    if trees is None or per_block >= trees:
        joined = inputs.join(F.broadcast(forests(nodes)), "fold")
        return joined.selectExpr(*[name(c) for c in keep], f"{_contributions(depth)} AS parts")
    inputs = materialise(inputs, "model-inputs")
    blocks = None
    for begin in range(0, trees, per_block):
        block = forests(nodes.filter(F.col("tree").between(begin, begin + per_block - 1)))
        part = inputs.join(F.broadcast(block), "fold").selectExpr(
            *[name(c) for c in keep], f"{begin} AS begin", f"{_contributions(depth)} AS parts"
        )
        part = materialise(part, "model-block")
        blocks = part if blocks is None else blocks.unionByName(part)
    gathered = F.array_sort(F.collect_list(F.struct("begin", "parts")))
    return blocks.groupBy(*keep).agg(F.flatten(gathered["parts"]).alias("parts"))


def _sigmoid(x: str) -> str:
    return f"(1 / (1 + exp(-({x}))))"


def _margin_to_probability(parts: str) -> str:
    return _sigmoid(f"2 * aggregate({parts}, 0D, (a, p) -> a + p)")


def _networks(weights: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per network: its layers in order, each unit as bias and weights."""
    inner = F.array_sort(F.collect_list(F.when(F.col("input") >= 0, F.struct("input", "weight"))))
    units = weights.groupBy(*by, "layer", "output").agg(
        F.max(F.when(F.col("input") < 0, F.col("weight"))).alias("bias"), inner["weight"].alias("w")
    )
    layers = units.groupBy(*by, "layer").agg(F.array_sort(F.collect_list(F.struct("output", "bias", "w"))).alias("units"))
    return layers.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("layer", "units"))).alias("layers"))


def network_scores(inputs: DataFrame, weights: DataFrame, n_layers: int, keep: Sequence[str], by: Sequence[str] = ("fold",)) -> DataFrame:
    """``keep`` and ``prediction`` of rows with scaled features ``x``, by the network that ``by`` names.

    A network has as many weights as its layers say, whatever the rows; it is broadcast if it is within the bound.
    """
    spark = inputs.sparkSession
    laid = _networks(weights, by)
    small = limits(spark).may_broadcast(weights.count(), weights.schema)
    df = inputs.join(F.broadcast(laid) if small else laid, list(by))
    for i in range(n_layers):
        total = "u.bias + aggregate(zip_with(u.w, x, (a, b) -> a * b), 0D, (a, p) -> a + p)"
        shown = _sigmoid(total) if i + 1 < n_layers else total
        df = df.withColumn("x", F.expr(f"transform(layers[{i}].units, u -> {shown})"))
    return df.selectExpr(*[name(c) for c in keep], f"{_sigmoid('x[1] - x[0]')} AS prediction")


def _scored(rows: DataFrame, spec: TrainSpec, keep: Sequence[str], nodes: DataFrame | None) -> DataFrame:
    """``keep`` and ``prediction`` of rows, each by the model of its ``fold``."""
    spark = rows.sparkSession
    if spec.model == "trees":
        parts = tree_parts(rows, nodes or node_table(spark, spec), spec, keep)
        return parts.selectExpr(*[name(c) for c in keep], f"{_margin_to_probability('parts')} AS prediction")
    # Each fold has a scaler of its own.
    return _network_scores(scaled_by_own(rows, spec, keep), spec, keep)


def _network_scores(inputs: DataFrame, spec: TrainSpec, keep: Sequence[str]) -> DataFrame:
    return network_scores(inputs, weight_table(inputs.sparkSession, spec), len(spec.layers) - 1, keep)


def score_out_of_fold(train: DataFrame, spec: TrainSpec, nodes: DataFrame | None = None) -> DataFrame:
    """key, target, fold, prediction: each row by the stored model that has not seen it.

    ``nodes``: other trees than those of the stored models, cut at their best iteration, say.
    """
    target = train.withColumn("target", F.col(spec.target))
    return _scored(target, spec, [spec.key, "target", "fold"], nodes)


def score_blend(test: DataFrame, spec: TrainSpec, nodes: DataFrame | None = None) -> DataFrame:
    """key and the mean prediction of all fold models; keys are unique."""
    keep = [spec.key, "fold"]
    if spec.model == "network":
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"x{f}").alias("x")) for f in range(spec.folds)]))
        inputs = scaled_by_all(test, spec).select(spec.key, each.alias("each")).select(spec.key, "each.*")
        scored = _network_scores(inputs, spec, keep)
        return scored.groupBy(spec.key).agg(F.avg("prediction").alias("prediction"))
    rows = test.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(spec.folds - 1))))
    return _scored(rows, spec, keep, nodes).groupBy(spec.key).agg(F.avg("prediction").alias("prediction"))
