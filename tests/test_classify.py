import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.operators import classify
from tagloom.plans import tag_jobs


@pytest.fixture(scope="module")
def shop(spark):
    """Items of 60 buyers, some of them without an order, and the orders."""
    names = [*fixed.COLOUR_CODES, "unknown"]
    types = [*fixed.TYPE_CODES, "unknown"]
    colours = F.array(*[F.lit(n) for n in names])
    kinds = F.array(*[F.lit(t) for t in types])


    def pick(seed, items):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(items))).cast("int")

    order = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 300)
    items = spark.range(6000).select(
        F.concat(F.lit("o"), order).alias("cOrderSn"),
        F.get(colours, pick(0, names)).alias("ogColor"),
        F.get(kinds, pick(1, types)).alias("productType"),
        F.col("id").alias("itemId"),
    )
    orders = spark.range(280).select(
        (F.col("id") % 60).cast("string").alias("memberId"),
        F.concat(F.lit("o"), F.col("id")).alias("orderSn"),
    )
    return items, orders


def test_item_features(frame):
    items = frame(
        "cOrderSn,ogColor,productType,itemId",
        [
            ("1", "白色", "烤箱", "1"),
            ("2", "香槟金色", "净水机", "2"),
            ("3", "unknown", "料理机", "3"),
            ("4", None, "Haier/海尔冰箱", "4"),
        ],
    )
    rows = classify.item_features(items).collect()
    found = {r["cOrderSn"]: (r["color"], r["productType"], r["gender"]) for r in rows}
    assert found == {"1": (4, 28, 1), "2": (2, 16, 0), "3": (0, 23, 1), "4": (0, 10, 0)}


def test_dictionary_sizes():
    assert len(fixed.COLOUR_CODES) == 20 and len(fixed.TYPE_CODES) == 28
    assert sorted(fixed.COLOUR_CODES.values()) == list(range(1, 21))
    assert sorted(fixed.TYPE_CODES.values()) == [9, 10, *range(12, 38)]


def test_user_items_against_a_plain_join(shop, pairs):
    items, orders = shop
    plain = (
        classify.item_features(items)
        .join(orders, F.col("cOrderSn") == F.col("orderSn"))
        .groupBy(F.col("memberId").alias("userId"), "color", "productType", "gender")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    assert pairs(classify.user_items(items, orders)) == pairs(plain)


def test_repeated_order_rows_count_as_in_a_join(frame, pairs):
    rows = [("1", "白色", "x"), ("1", "黑色", "x"), ("9", "x", "x")]
    items = frame("cOrderSn,ogColor,productType", rows)
    orders = frame("memberId,orderSn", [("a", "1"), ("b", "1"), ("b", "1")])
    coded = classify.item_features(items)
    found = pairs(classify.votes(coded, orders, "gender"))
    assert found == {("a", 2.0, 1.0, 1.0), ("b", 4.0, 2.0, 2.0)}
    kinds = classify.item_kinds(coded, orders)
    assert sorted(r["n"] for r in kinds.collect()) == [3, 3]


def test_weighted_tree_equals_row_by_row_tree(shop):
    items, orders = shop
    kinds = classify.item_kinds(classify.item_features(items), orders)
    model = classify.fit_gender_tree(kinds)
    predicted = {
        (r["color"], r["productType"]): r["predict"] for r in model.transform(kinds).collect()
    }
    rows = classify.item_features(items).join(orders, F.col("cOrderSn") == F.col("orderSn"))
    rows = VectorAssembler(inputCols=["color", "productType"], outputCol="v").transform(rows)
    tree = DecisionTreeClassifier(featuresCol="v", labelCol="gender", **fixed.USG_TREE)
    plain = tree.fit(rows.where("train")).transform(rows)
    assert predicted == {(r["color"], r["productType"]): r["prediction"] for r in plain.collect()}


def test_usg_tags(shop):
    items, orders = shop
    tagged = tag_jobs.usg_tags(items, orders).collect()
    # The buyer of the hot order o0 and those whose orders are no multiple of 3.
    assert len(tagged) == len({r["userId"] for r in tagged}) == 41
    assert {r["tagIds"] for r in tagged} <= {"57", "58", "59"}
    kinds, model, _ = tag_jobs.usg_kinds(items, orders)
    assert "If (feature" in classify.tree_text(model)
    votes = classify.votes(
        classify.item_features(items).join(
            kinds.select("color", "productType", "gender", "predict").distinct(),
            ["color", "productType", "gender"],
        ),
        orders,
    ).collect()

    def code(row):
        shares = {"57": row["male"] / row["total"], "58": row["female"] / row["total"]}
        return next((tag for tag, share in shares.items() if share >= 0.6), "59")

    assert {(r["userId"], code(r)) for r in votes} == {tuple(r) for r in tagged}


def test_usg_quality(shop):
    quality = tag_jobs.usg_quality(*shop)
    for part in ("train", "test"):
        assert 0.5 < quality[part]["accuracy"] <= 1
        assert quality[part]["error"] == pytest.approx(1 - quality[part]["accuracy"])
        assert 0.5 <= quality[part]["auc"] <= 1


def test_quality_of_known_predictions(spark):
    rows = [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, predict double")
    assert classify.accuracy(df) == {"accuracy": 0.75, "error": 0.25}
    assert classify.area_under_roc(df) == pytest.approx((1 + 2 / 3) / 2)
    rows = [(0.0, 0.0, 2.0), (0.0, 1.0, 1.0), (1.0, 1.0, 1.0)]
    weighted = spark.createDataFrame(rows, "label double, predict double, w double")
    assert classify.accuracy(weighted, "w")["accuracy"] == 0.75
    assert classify.area_under_roc(weighted, "w") == pytest.approx((1 + 2 / 3) / 2)


@pytest.mark.parametrize(
    "total, male, female, tag",
    [(5.0, 3.0, 2.0, "57"), (6.0, 4.0, 2.0, "57"), (5.0, 1.0, 4.0, "58"), (2.0, 1.0, 1.0, "59")],
)
def test_vote_tags(spark, total, male, female, tag):
    schema = "userId string, total double, male double, female double"
    voted = spark.createDataFrame([("1", total, male, female)], schema)
    assert classify.vote_tags(voted, fixed.USG_RULES).first()["tagIds"] == tag


def test_random_split(spark):
    df = spark.range(10000)
    train, test = classify.random_split(df, [0.8, 0.2], ["id"], seed=10)
    again, _ = classify.random_split(df.repartition(5), [0.8, 0.2], ["id"], seed=10)
    ids = {r["id"] for r in train.collect()}
    assert ids == {r["id"] for r in again.collect()}
    assert ids.isdisjoint(r["id"] for r in test.collect())
    assert train.count() + test.count() == 10000
    assert 7800 < len(ids) < 8200


def test_iris_tree(spark):
    rows = spark.range(300).select(
        *[(F.col("id") % 3 * 2 + F.rand(i)).alias(f"m{i}") for i in range(4)],
        F.concat(F.lit("s"), F.col("id") % 3).alias("Species"),
        "id",
    )
    predicted, model = tag_jobs.iris_tree(rows, [f"m{i}" for i in range(4)], "Species", ["id"])
    assert predicted.where("Species <> labelConverted").count() == 0
    assert predicted.count() > 20
    assert classify.accuracy(predicted)["accuracy"] == 1.0
    assert classify.tree_text(model).startswith("DecisionTreeClassificationModel")


def test_hot_order_is_split_by_adaptive_execution(spark, pairs):
    """A third of the order rows share one number: the join into the votes is split."""
    number = F.concat(F.lit("o"), F.col("id") % 500)
    items = spark.range(20000).select(
        number.alias("cOrderSn"), (F.col("id") % 2).alias("predict")
    )
    orders = spark.range(60000).select(
        F.col("id").cast("string").alias("memberId"),
        F.when(F.col("id") % 3 == 0, "o7").otherwise(number).alias("orderSn"),
    )
    expected = pairs(classify.votes(items, orders))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        voted = classify.votes(items, orders)
        assert pairs(voted) == expected
        assert "skew=true" in voted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)


def test_leaves_predict_like_the_model(spark):
    """Continuous and categorical splits, values the indexer never saw included."""
    rows = spark.range(3_000).select(
        (F.col("id") % 40).cast("double").alias("a"),
        F.pmod(F.xxhash64("id"), F.lit(5)).cast("double").alias("b"),
        F.when((F.col("id") % 40 > 17) != (F.pmod(F.xxhash64("id"), F.lit(5)).isin(1, 3)), "yes").otherwise("no").alias("label_text"),
    )
    indexer = classify.index_labels(rows, "label_text")
    model = classify.tree_pipeline(indexer, ["a", "b"], {"maxDepth": 4, "maxBins": 8}, max_categories=5).fit(rows.where("b <> 4"))
    leaves = classify.tree_leaves(model)
    assert any(side[2] is not None for leaf in leaves for side in leaf["bounds"].values())
    unseen = rows.unionByName(rows.limit(200).withColumn("b", F.lit(9.0)).withColumn("a", F.col("a") * 1.5))
    own = model.transform(unseen).withColumn("by_leaf", classify.predicted_by_leaves(leaves, ["a", "b"]))
    assert own.where("by_leaf IS NULL OR by_leaf <> predict").count() == 0 and own.select("predict").distinct().count() == 2
    table = classify.leaves_frame(spark, leaves, ["a", "b"])
    assert table.count() == 2 * len(leaves) and table.columns[:4] == ["leaf", "predict", "feature", "above"]


def test_usg_tags_by_leaves_and_by_model(shop, spark, tmp_path):
    items, orders = shop
    kinds, model, _ = tag_jobs.usg_kinds(items, orders)
    own = model.transform(kinds.drop("label", "predict")).select(*classify.KIND, F.col("predict").alias("own"))
    assert kinds.join(own, classify.KIND).where("own <> predict OR predict IS NULL").count() == 0
    path = f"file://{tmp_path}/usg"
    first = {tuple(r) for r in tag_jobs.usg_tags(items, orders, model_path=path).collect()}
    assert {tuple(r) for r in tag_jobs.usg_tags(items, orders, model_path=path).collect()} == first


def test_rank_sum_auc(spark):
    """Against all pairs, with ties, and with counted rows; null without both labels."""
    import random

    rng = random.Random(6)
    rows = [(rng.randrange(25) / 7, float(rng.random() < 0.4), rng.randrange(4)) for _ in range(400)] + [(None, 1.0, 3)]
    df = spark.createDataFrame(rows, "predict double, label double, n long").repartition(6)
    for count in (None, "n"):
        kept = [(s, label, n if count else 1) for s, label, n in rows if s is not None]
        pairs = [(a[0], b[0], a[2] * b[2]) for a in kept if a[1] for b in kept if not b[1]]
        want = sum(w * ((a > b) + 0.5 * (a == b)) for a, b, w in pairs) / sum(w for *_, w in pairs)
        found = classify.rank_sum_auc(df, count=count).first()
        assert abs(found["auc"] - want) < 1e-12
    assert classify.rank_sum_auc(df.where("label = 1")).first()["auc"] is None
    assert classify.rank_sum_auc(df.limit(0)).first()["auc"] is None
    known = classify.area_under_roc(df.where("predict IS NOT NULL"))
    assert abs(known - classify.rank_sum_auc(df).first()["auc"]) < 1e-9
