import bisect
import math
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.operators import aggregates, clusters
from tagloom.plans import tag_jobs
from tagloom.plans.standard import standard_jobs
from tagloom.sources.versions import path_exists
from tagloom.workload import certificates

RFM = ["recency", "frequency", "monetary"]


@pytest.mark.parametrize(
    "sums, rules, expected",
    [
        (
            {0: 11.0, 1: 9.97, 2: 5.56, 3: 3.0, 4: 4.0, 5: 12.04, 6: 6.5},
            fixed.RFM_RULES,
            {5: "38", 0: "39", 1: "40", 6: "41", 2: "42", 4: "43", 3: "44"},
        ),
        (
            {0: 12.0, 1: 13.0, 2: 14.0, 3: 13.0},
            fixed.RFE_RULES,
            {2: "46", 3: "47", 1: "48", 0: "49"},
        ),
        (
            {0: 0.132, 1: 0.556, 2: 0.318, 3: 0.084, 4: 0.213},
            fixed.PSM_RULES,
            {1: "51", 2: "52", 4: "53", 0: "54", 3: "55"},
        ),
        ({0: 1.0, 1: 2.0}, [(9, "10"), (8, "2"), (7, "1")], {1: "7", 0: "8"}),
    ],
)
def test_rank_clusters(sums, rules, expected):
    assert dict(clusters.rank_clusters(list(sums.items()), rules)) == expected


def test_more_clusters_than_tags_fails():
    with pytest.raises(ValueError, match="3 clusters"):
        clusters.rank_clusters([(0, 1.0), (1, 2.0), (2, 3.0)], [(1, "1"), (2, "2")])


def test_zip_clusters_with_a_rule_frame(spark, pairs):
    clustered = spark.createDataFrame([("a", 0), ("b", 1), ("c", 0)], "userId string, predict int")
    rules = spark.createDataFrame([(8, "2"), (7, "1"), (9, "10")], "id long, rule string")
    tagged = clusters.zip_clusters(clustered, [(0, 1.0), (1, 2.0)], rules)
    assert pairs(tagged.select("userId", "tagIds")) == {("a", "8"), ("b", "7"), ("c", "8")}


@pytest.fixture(scope="module")
def scored(spark):
    score = lambda seed: (F.abs(F.xxhash64(F.lit(seed), "id")) % 5 + 1).cast("int")
    return spark.range(3000).select(
        F.col("id").cast("string").alias("userId"),
        *[score(i).alias(name) for i, name in enumerate(RFM)],
    )


def test_score_clusters_do_not_depend_on_partitioning(scored, pairs):
    def tagged(n):
        rows = scored.repartition(n)
        return frozenset(pairs(clusters.tag_by_score_clusters(rows, RFM, 7, fixed.RFM_RULES)))

    found = [tagged(n) for n in (1, 3, 7)]
    assert len(set(found)) == 1
    assert len(found[0]) == 3000
    assert {tag for _, tag in found[0]} == {str(i) for i, _ in fixed.RFM_RULES}


def test_tags_follow_the_centre_sums(scored):
    tagged = clusters.tag_by_score_clusters(scored, RFM, 7, fixed.RFM_RULES)
    means = (
        scored.withColumn("total", F.col("recency") + F.col("frequency") + F.col("monetary"))
        .join(tagged, "userId")
        .groupBy("tagIds")
        .agg(F.avg("total").alias("mean"))
        .orderBy("tagIds")
        .collect()
    )
    totals = [r["mean"] for r in means]
    assert totals == sorted(totals, reverse=True)


def test_weighted_fit_costs_the_same_as_row_by_row(scored):
    points = clusters.score_points(scored, RFM)
    assert points.agg(F.sum("weight")).first()[0] == 3000
    model = clusters.kmeans(7, weight="weight").fit(points)
    centres = np.array(model.clusterCenters())
    rows = np.array([[r[c] for c in RFM] for r in scored.select(*RFM).collect()], dtype=float)
    nearest = ((rows[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1)
    assert model.summary.trainingCost == pytest.approx(nearest.sum(), rel=1e-6)


def test_fewer_distinct_points_than_clusters(spark):
    scored = spark.createDataFrame(
        [("1", 5, 5, 5), ("2", 1, 1, 1), ("3", 5, 5, 5)],
        "userId string, recency int, frequency int, monetary int",
    )
    tagged = clusters.tag_by_score_clusters(scored, RFM, 7, fixed.RFM_RULES)
    assert {tuple(r) for r in tagged.collect()} == {("1", "38"), ("2", "39"), ("3", "38")}


def test_elbow(scored):
    rows = clusters.elbow(clusters.score_points(scored, RFM), [3, 6, 11]).collect()
    assert [r["k"] for r in rows] == [3, 6, 11]
    assert rows[0]["sse"] > rows[1]["sse"] > rows[2]["sse"] > 0


def test_elbow_states_the_cost_of_its_centres(spark):
    """Five clusters of squares still move in the last iteration, so MLlib's stated cost is not that of the centres."""
    line = spark.range(200).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    points = clusters.score_points(line, ["x"])
    [(_, model)] = clusters.elbow_fits(points, [5])
    assert model.summary.numIter == fixed.KMEANS_MAX_ITER
    centres = np.array(model.clusterCenters())[:, 0]
    cost = sum(((i * i - centres) ** 2).min() for i in range(200))
    assert model.summary.trainingCost > cost * 1.0005
    assert clusters.elbow(points, [5]).first()["sse"] == pytest.approx(cost, rel=1e-9)
    # The certificate of a fit holds it to that cost too.
    assert tuple(certificates._fit_violations(points, model).first()) == (200, 200, 0, 0)


def test_model_is_fitted_once(spark, scored, tmp_path, pairs):
    path = f"file://{tmp_path}/rfm"
    points = clusters.score_points(scored, RFM)
    first = clusters.fit_score_clusters(points, 3, path)
    assert path_exists(spark, path) and len(KMeansModel.load(path).clusterCenters()) == 3
    again = clusters.fit_score_clusters(points, 3, path)
    assert again.uid == first.uid and np.array_equal(first.clusterCenters(), again.clusterCenters())
    # Other settings make another model, in the place of the first; so does one without settings beside it.
    other = clusters.fit_score_clusters(points, 7, path)
    assert len(other.clusterCenters()) == 7 and KMeansModel.load(path).uid == other.uid
    assert clusters.fit_score_clusters(points, 7, path, {"columns": RFM}).uid != other.uid
    first.write().overwrite().save(path)
    assert clusters.fit_score_clusters(points, 3, path).uid != first.uid


def test_psm_tags(frame, spark):
    rows = [(str(u), "100", str(u % 5 * 10 + 1)) for u in range(200)]
    orders = frame("memberId,orderAmount,couponCodeValue", rows).withColumn("orderSn", F.lit("x"))
    tagged = {r["userId"]: r["tagIds"] for r in tag_jobs.psm_tags(orders).collect()}
    assert [tagged[u] for u in "43210"] == ["51", "52", "53", "54", "55"]
    assert len(tagged) == 200


def test_cluster_ranges_and_confusion(spark):
    rows = [(1, 2.0, "a"), (0, 5.0, "a"), (1, 3.0, "b")]
    df = spark.createDataFrame(rows, "predict int, v double, label string")
    assert [tuple(r) for r in clusters.cluster_ranges(df, F.col("v")).collect()] == [
        (0, 5.0, 5.0),
        (1, 3.0, 2.0),
    ]
    assert {tuple(r) for r in clusters.confusion_counts(df).collect()} == {
        ("a", 0, 1),
        ("a", 1, 1),
        ("b", 1, 1),
    }


def test_iris_clusters(spark):
    """Three groups far apart fall into three clusters."""
    group = F.col("id") % 3
    slots = [(group * (i + 1) * 10 + F.rand(i)).cast("double") for i in range(4)]
    rows = spark.range(90).select(
        group.cast("double").alias("label"), array_to_vector(F.array(*slots)).alias("features")
    )
    counts = tag_jobs.iris_clusters(rows).collect()
    assert sorted(r["count"] for r in counts) == [30, 30, 30]


def test_min_max_scale(spark):
    rows = [(Vectors.dense(1.0, 5.0),), (Vectors.dense(3.0, 5.0),)]
    df = spark.createDataFrame(rows, ["features"])
    found = [list(r["scalerFeatures"]) for r in clusters.min_max_scale(df).collect()]
    assert found == [[0.0, 0.5], [1.0, 0.5]]


def test_price_sensitivity_does_not_follow_the_partitioning(spark, pairs):
    from tagloom.plans import tag_jobs

    rows = [(str(u), f"{u}-{i}", str(50 + u * 7 % 90 + i), str((u * i) % 11)) for u in range(300) for i in range(3)]
    orders = spark.createDataFrame(rows, "memberId string, orderSn string, orderAmount string, couponCodeValue string")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in (1, 3, 7, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(pairs(tag_jobs.psm_tags(orders.repartition(n))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert found[0] and all(f == found[0] for f in found)


def test_fit_of_a_summary_is_the_same_for_any_partitioning(spark, pairs):
    """Tags of 1, 8 and 200 partitions are equal, and the fit reads no more rows than the summary has bins."""
    rng = random.Random(4)
    rows = [(f"u{i}", f"s{i}-{j}", rng.lognormvariate(3, 1), rng.choice([0.0, 1.0, 3.5])) for i in range(800) for j in range(3)]
    orders = spark.createDataFrame(rows, "memberId string, orderSn string, orderAmount double, couponCodeValue double")
    found = [pairs(tag_jobs.psm_tags(orders.repartition(n))) for n in (1, 8, 200)]
    assert found[0] and found[0] == found[1] == found[2]
    scored = aggregates.psm_scores(aggregates.psm_features(orders))
    points = clusters.value_summary(scored, "psm", 0.05)
    assert points.rdd.getNumPartitions() == 1 and points.count() < 60
    assert points.agg(F.sum("weight")).first()[0] == scored.count()


@pytest.mark.parametrize("error", [0.1, 1e-3])
def test_points_of_a_summary_are_near_their_values(spark, error):
    """Every value has a point within the error, with the weight of the values nearest to it; signs, zero and nulls."""
    rng = random.Random(2)
    values = [rng.lognormvariate(0, 4) * rng.choice([1, -1]) for _ in range(2_000)] + [0.0, -0.0, 1e-12, 5e300, -5e300]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    points = [(r["x"], r["weight"]) for r in clusters.value_summary(df, "x", error).collect()]
    places = sorted(p for p, _ in points)
    for v in values:
        at = bisect.bisect_left(places, v)
        near = min(places[max(0, at - 1) : at + 1], key=lambda p: abs(p - v))
        assert abs(near - v) <= error * abs(v) * (1 + 1e-9) + clusters.SUMMARY_LEAST
    assert sum(w for _, w in points) == len(values)
    mean = sum(p * w for p, w in points if abs(p) < 1e300) / len(values)
    assert abs(mean - math.fsum(v for v in values if abs(v) < 1e300) / len(values)) <= error * sum(abs(v) for v in values if abs(v) < 1e300) / len(values)


def test_settings_of_price_sensitivity_reach_the_fit(spark, monkeypatch):
    seen, summary = [], clusters.value_summary

    def watched(values, column, error):
        seen.append(error)
        return summary(values, column, error)

    monkeypatch.setattr(clusters, "value_summary", watched)
    rows = [(f"u{i}", f"s{i}", 100.0 + i, float(i % 7), 1_500_000_000 + i) for i in range(60)]
    orders = spark.createDataFrame(rows, "memberId string, orderSn string, orderAmount double, couponCodeValue double, finishTime long")
    orders = orders.withColumn("paymentCode", F.lit("alipay"))
    tag_jobs.psm_tags(orders, error=0.01, zero_discount_eps=0.01)
    jobs = standard_jobs(settings={"psm": {"error": 0.02, "zero_discount_eps": 0.01}})
    jobs["psm"](fixed.PSM_RULES, orders)
    tag_jobs.order_tags(orders, as_of="2019-11-25", psm_error=0.03)
    assert seen == [0.01, 0.02, 0.03]


def test_too_many_score_vectors_are_refused(spark, monkeypatch):
    monkeypatch.setattr(clusters, "MAX_SCORE_VECTORS", 10)
    scored = spark.createDataFrame([(str(i), float(i)) for i in range(11)], "userId string, value double")
    with pytest.raises(ValueError, match="banded"):
        clusters.tag_by_score_clusters(scored, ["value"], 2, fixed.PSM_RULES)
