"""Shopping gender by decision tree, and the tree demo."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IndexToString,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.measures import majority_rule
from tagloom.operators.bounded import local_frame
from tagloom.operators.lookup import Rules, attach_tags
from tagloom.operators.ranges import with_running_sum

SPLIT_STEPS = 1_000_000


def encode(df: DataFrame, column: str, codes: Mapping[str, int], output: str) -> DataFrame:
    """Code of a category, 0 if it is not in the dictionary.

    The dictionary is a short fixed list, so it is broadcast.
    """
    entries = local_frame(
        df.sparkSession, list(codes.items()), ["_name", "_code"], [pa.string(), pa.int32()]
    )
    found = df.join(F.broadcast(entries), F.col(column) == F.col("_name"), "left")
    return found.withColumn(output, F.coalesce("_code", F.lit(0))).drop("_name", "_code")


def split_share(*keys: str | Column, seed: int = 0) -> Column:
    """Number in [0, 1) fixed by the key columns, for repeatable random splits."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(SPLIT_STEPS)) / F.lit(float(SPLIT_STEPS))


def random_split(
    df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int = 0
) -> list[DataFrame]:
    """`df` split by weight on a hash of its keys: the same rows fall together in every run."""
    share, total, parts, start = split_share(*keys, seed=seed), sum(weights), [], 0.0
    for i, weight in enumerate(weights):
        end = start + weight / total
        inside = share >= start
        if i < len(weights) - 1:
            inside = inside & (share < end)
        parts.append(df.where(inside))
        start = end
    return parts


def item_features(items: DataFrame) -> DataFrame:
    """Order items with colour code, type code, rule label and train flag.

    Expects cOrderSn, ogColor, productType; an `itemId` tells apart equal items of one order.
    """
    is_female = F.col("ogColor").isin(fixed.FEMALE_COLOURS) | F.col("productType").isin(
        fixed.FEMALE_TYPES
    )
    keys = ["cOrderSn", "ogColor", "productType"]
    keys += ["itemId"] if "itemId" in items.columns else []
    labelled = items.select(
        "cOrderSn",
        "ogColor",
        F.col("productType").alias("_type"),
        F.when(is_female, 1).otherwise(0).alias("gender"),
        (split_share(*keys, seed=fixed.KMEANS_SEED) < fixed.TRAIN_SHARE).alias("train"),
    )
    coded = encode(labelled, "ogColor", fixed.COLOUR_CODES, "color")
    coded = encode(coded, "_type", fixed.TYPE_CODES, "productType")
    return coded.select("cOrderSn", "color", "productType", "gender", "train")


KIND = ["color", "productType", "gender", "train"]


def _items_per_order(coded: DataFrame, kind: Sequence[str]) -> DataFrame:
    """Equal items of an order counted before any join, so that an order with very many items
    crosses the network as one row per kind of item."""
    return coded.groupBy("cOrderSn", *kind).agg(F.count(F.lit(1)).alias("n"))


def user_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items per (user, colour, type, label) after joining items to orders."""
    kind = [c for c in KIND if c != "train"]
    buyers = orders.select(F.col("memberId").alias("userId"), "orderSn")
    per_order = _items_per_order(item_features(items), kind)
    joined = per_order.join(buyers, F.col("cOrderSn") == F.col("orderSn"))
    return joined.groupBy("userId", *kind).agg(F.sum("n").alias("n"))


def user_kinds(coded: DataFrame, orders: DataFrame) -> DataFrame:
    """Items per (user, colour, type, label, train flag) after joining items to orders."""
    buyers = orders.select(F.col("memberId").alias("userId"), "orderSn")
    per_order = _items_per_order(coded, KIND)
    joined = per_order.join(buyers, F.col("cOrderSn") == F.col("orderSn"))
    return joined.groupBy("userId", *KIND).agg(F.sum("n").alias("n"))


def kinds_of(counted: DataFrame) -> DataFrame:
    """Joined items per (colour, type, label, train flag), in one sorted partition.

    At most (colours + 1) x (types + 1) x 4 rows, as the dictionaries are fixed.
    """
    return counted.groupBy(*KIND).agg(F.sum("n").alias("n")).repartition(1).sortWithinPartitions(*KIND)


def item_kinds(coded: DataFrame, orders: DataFrame) -> DataFrame:
    """Items per kind, from items and orders."""
    return kinds_of(user_kinds(coded, orders))


def index_labels(rows: DataFrame, label: str) -> StringIndexerModel:
    """Label indexer over all rows, in text order, so that index 0 is the first label."""
    return StringIndexer(
        inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(rows)


def tree_pipeline(
    indexer: StringIndexerModel,
    features: Sequence[str],
    tree_settings: Mapping[str, object],
    max_categories: int | None = None,
    weight: str | None = None,
) -> Pipeline:
    """Index the label (L7), assemble (L1) and index features (L8), grow a tree (L9), restore
    labels (L10): one pipeline (L11)."""
    stages = [indexer, VectorAssembler(inputCols=list(features), outputCol="features")]
    tree_input = "features"
    if max_categories is not None:
        # A rare category may be missing from the training rows.
        stages.append(
            VectorIndexer(
                inputCol="features",
                outputCol="featureIndexed",
                maxCategories=max_categories,
                handleInvalid="keep",
            )
        )
        tree_input = "featureIndexed"
    tree = DecisionTreeClassifier(
        featuresCol=tree_input,
        labelCol="label",
        predictionCol="predict",
        seed=fixed.KMEANS_SEED,
        **tree_settings,
    )
    if weight:
        tree = tree.setWeightCol(weight)
    restore = IndexToString(inputCol="predict", outputCol="labelConverted", labels=indexer.labels)
    return Pipeline(stages=[*stages, tree, restore])


def fit_gender_tree(kinds: DataFrame) -> PipelineModel:
    """Tree on the kinds of items, each weighted by its number of training items.

    Weights give the same split gains as the repeated rows would.
    """
    train = kinds.where(F.col("train")).withColumn("weight", F.col("n").cast("double"))
    pipeline = tree_pipeline(
        index_labels(kinds, "gender"),
        ["color", "productType"],
        fixed.USG_TREE,
        fixed.USG_MAX_CATEGORIES,
        "weight",
    )
    return pipeline.fit(train)


def tree_leaves(model: PipelineModel) -> list[dict]:
    """The leaves of a fitted tree as split intervals over the raw features.

    Each leaf has its `predict` value and `bounds`: feature number to (above, up to, values, others). A
    feature lies above the first and up to the second, None for no bound; where the feature indexer took it
    as categorical, it is one of `values`, or, with `others`, none of those the indexer knows.
    """
    tree = next(stage for stage in model.stages if hasattr(stage, "toDebugString"))
    known: dict[int, dict[int, float]] = {}
    for stage in model.stages:
        if isinstance(stage, VectorIndexerModel):
            known = {f: {index: value for value, index in m.items()} for f, m in stage.categoryMaps.items()}
    leaves = []

    def raw(feature: int, above, up_to, categories) -> tuple:
        if categories is None:
            return above, up_to, None, False
        values = known[feature]
        return None, None, sorted(values[c] for c in categories if c in values), len(values) in categories

    def walk(node, bounds: dict) -> None:
        if node.getClass().getSimpleName() == "LeafNode":
            sides = {f: raw(f, *side) for f, side in bounds.items()}
            leaves.append({"predict": float(node.prediction()), "bounds": sides, "known": {f: sorted(m.values()) for f, m in known.items()}})
            return
        split = node.split()
        feature = split.featureIndex()
        above, up_to, left = bounds.get(feature, (None, None, None))
        if split.getClass().getSimpleName() == "ContinuousSplit":
            sides = ((above, split.threshold(), None), (split.threshold(), up_to, None))
        else:
            parts = [{int(c) for c in side} for side in (split.leftCategories(), split.rightCategories())]
            # A category the split does not list goes with the larger part.
            unseen = len(known[feature])
            if unseen not in parts[0] | parts[1]:
                parts[len(parts[0]) <= (len(parts[0]) + len(parts[1])) // 2].add(unseen)
            sides = tuple((None, None, part if left is None else part & left) for part in parts)
        for child, side in zip((node.leftChild(), node.rightChild()), sides):
            walk(child, {**bounds, feature: side})

    walk(tree._java_obj.rootNode(), {})
    return leaves


def in_leaf(leaf: Mapping, features: Sequence[str]) -> Column:
    """Whether a row's features lie in the intervals of a leaf."""
    inside = F.lit(True)
    for feature, (above, up_to, values, others) in leaf["bounds"].items():
        value = F.col(features[feature])
        if values is not None:
            among = value.isin(*values) if values else F.lit(False)
            inside = inside & (among | ~value.isin(*leaf["known"][feature]) if others else among)
        if above is not None:
            inside = inside & (value > above)
        if up_to is not None:
            inside = inside & (value <= up_to)
    return inside


def predicted_by_leaves(leaves: Sequence[Mapping], features: Sequence[str]) -> Column:
    """The prediction of the leaf a row lies in, as one expression without vectors."""
    return F.coalesce(*(F.when(in_leaf(leaf, features), leaf["predict"]) for leaf in leaves))


def leaves_frame(spark: SparkSession, leaves: Sequence[Mapping], features: Sequence[str]) -> DataFrame:
    """The leaves as a table, one row per leaf and feature: (leaf, predict, feature, above, up_to, values, others)."""
    rows = [
        (i, leaf["predict"], name, *leaf["bounds"].get(f, (None, None, None, False)))
        for i, leaf in enumerate(leaves)
        for f, name in enumerate(features)
    ]
    types = [pa.int32(), pa.float64(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.bool_()]
    return local_frame(spark, rows, ["leaf", "predict", "feature", "above", "up_to", "values", "others"], types)


def rank_sum_auc(predicted: DataFrame, score: str = "predict", label: str = "label", count: str | None = None) -> DataFrame:
    """One row (`positives`, `negatives`, `auc`): the exact area under ROC as a rank sum.

    Rows are counted per distinct score first; a positive beats the negatives of lower scores and ties with half
    of those of its own, in whole numbers, so the result does not depend on the order of the rows. `count` names whole
    numbers of rows that a row stands for. Without rows of both labels `auc` is null.
    """
    n = F.col(count) if count else F.lit(1)
    whole = "decimal(38,0)"

    def rows_of(wanted: int) -> Column:
        return F.sum(F.when(F.col(label) == wanted, n).otherwise(0)).cast("long")

    by_score = predicted.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score"))
    by_score = by_score.agg(rows_of(1).alias("pos"), rows_of(0).alias("neg"))
    ranked = with_running_sum(by_score, "score", "neg", "below")
    beaten = F.sum(F.col("pos").cast(whole) * (2 * F.col("below") + F.col("neg")).cast("decimal(20,0)")).cast(whole)
    totals = ranked.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), beaten.alias("beaten"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    auc = F.when(pairs > 0, F.col("beaten").cast("double") / pairs)
    return totals.select("positives", "negatives", auc.alias("auc"))


def accuracy(predicted: DataFrame, weight: str | None = None) -> dict[str, float]:
    """Share of rows whose `predict` equals `label`, and the error rate."""
    evaluator = MulticlassClassificationEvaluator(
        predictionCol="predict", labelCol="label", metricName="accuracy"
    )
    share = (evaluator.setWeightCol(weight) if weight else evaluator).evaluate(predicted)
    return {"accuracy": share, "error": 1.0 - share}


def area_under_roc(predicted: DataFrame, weight: str | None = None) -> float:
    """Area under ROC with `predict` as the score of a 0/1 `label`."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="predict", labelCol="label", metricName="areaUnderROC"
    )
    return (evaluator.setWeightCol(weight) if weight else evaluator).evaluate(predicted)


def votes(predicted: DataFrame, orders: DataFrame, predict: str = "predict") -> DataFrame:
    """Items, items predicted male, items predicted female per user, as doubles.

    Items are counted per order and class first: at most two short rows per order go into the
    join, whose inputs are plain shuffles that adaptive execution can split.
    """
    per_order = _items_per_order(predicted, [predict])
    buyers = orders.select(F.col("memberId").alias("userId"), "orderSn")
    return votes_of(per_order.join(buyers, F.col("cOrderSn") == F.col("orderSn")), predict)


def votes_of(counted: DataFrame, predict: str = "predict") -> DataFrame:
    """The votes of (user, class, n) rows."""
    def items(rows: Column, name: str) -> Column:
        return F.sum(F.when(rows, F.col("n")).otherwise(0)).cast("double").alias(name)

    return counted.groupBy("userId").agg(
        items(F.lit(True), "total"),
        items(F.col(predict) == 0, "male"),
        items(F.col(predict) == 1, "female"),
    )


def vote_tags(voted: DataFrame, rules: Rules, share: float = fixed.USG_VOTE_SHARE) -> DataFrame:
    """(userId, tagIds) from each user's votes."""
    code = majority_rule(F.col("total"), F.col("male"), F.col("female"), share)
    return attach_tags(voted.withColumn("rule_code", code), rules, "rule_code", "userId", "error")


def tree_text(model: PipelineModel) -> str:
    """Decisions of the fitted tree as text."""
    trees = [stage for stage in model.stages if hasattr(stage, "toDebugString")]
    return trees[0].toDebugString
