"""Queries for fits whose outcome is known, so that SQL can give the same rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.operators import classify, clusters
from tagloom.operators.bounded import local_frame
from tagloom.plans import tag_jobs
from tagloom.workload import inputs as src
from tagloom.workload.features import PSM_SQL

HIGH_NATION = 12


def known_clusters(spark, sf_dir):
    """Five distinct values, five clusters: each value is a centre, its rank the tag."""
    digit = F.substring("o_orderpriority", 1, 1).cast("double")
    scored = src.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("userId"), (digit * 10).alias("value"))
    return clusters.tag_by_score_clusters(scored, ["value"], len(fixed.PSM_RULES), fixed.PSM_RULES).select(
        F.col("userId").cast("string"), "tagIds"
    )


def psm_violations(spark, sf_dir):
    """Scored users, users whose centre is not the nearest, and tags out of centre order."""
    clustered, model = tag_jobs.psm_clusters(src.coupon_orders(spark, sf_dir))
    centres = [float(c[0]) for c in model.clusterCenters()]
    own = F.get(F.array(*map(F.lit, centres)), F.col("predict"))
    nearest = F.array_min(F.array(*[F.abs(F.col("psm") - c) for c in centres]))
    far = F.abs(F.col("psm") - own) > nearest + 1e-9
    tagged = clusters.zip_clusters(clustered, clusters.centre_sums(model), fixed.PSM_RULES)
    rank = {str(tag): int(place) for tag, place in fixed.PSM_RULES}
    place = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])[F.col("tagIds")]
    better = F.size(F.filter(F.array(*map(F.lit, centres)), lambda c: c > own)) + 1
    return tagged.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(far).alias("not_nearest"),
        F.count_if(place != better).alias("out_of_order"),
    )


def _nations(spark, sf_dir):
    return src.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").cast("double").alias("nation"),
        (F.col("c_custkey") % 7).cast("double").alias("noise"),
        F.when(F.col("c_nationkey") >= HIGH_NATION, "high").otherwise("low").alias("side"),
    )


def _known_tree(spark, sf_dir):
    rows = _nations(spark, sf_dir)
    train, test = classify.random_split(rows, [0.8, 0.2], ["c_custkey"], seed=fixed.KMEANS_SEED)
    pipeline = classify.tree_pipeline(
        classify.index_labels(rows, "side"), ["nation", "noise"], {"impurity": "gini", "maxDepth": 5}
    )
    return pipeline.fit(train), rows, test


def known_tree(spark, sf_dir):
    """One feature decides the label, so every prediction is known."""
    model, rows, _ = _known_tree(spark, sf_dir)
    return model.transform(rows).select("c_custkey", F.col("labelConverted").alias("predicted"))


def known_tree_quality(spark, sf_dir):
    """Accuracy, error and area under ROC on the test rows, and one decision in the tree."""
    model, _, test = _known_tree(spark, sf_dir)
    predicted = model.transform(test)
    found = classify.accuracy(predicted)
    decisions = classify.tree_text(model).count("If (")
    rows = [(found["accuracy"], found["error"], classify.area_under_roc(predicted), decisions)]
    names = ["accuracy", "error", "auc", "decisions"]
    return local_frame(spark, rows, names, [pa.float64()] * 3 + [pa.int32()])


def split_parts(spark, sf_dir):
    """Every customer falls in exactly one part of a random split."""
    rows = src.table(spark, sf_dir, "customer").select("c_custkey")
    parts = classify.random_split(rows, [0.6, 0.3, 0.1], ["c_custkey"], seed=3)
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("parts"))


QUERIES = {f.__name__: f for f in (known_clusters, psm_violations, known_tree, known_tree_quality, split_parts)}

SQL = {
    "known_clusters": f"""SELECT CAST(o_orderkey AS VARCHAR) AS "userId", CAST(r.id AS VARCHAR) AS "tagIds"
FROM orders JOIN {src.values_sql(fixed.PSM_RULES, 'r(id, rule)')}
ON CAST(r.rule AS INTEGER) = 6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER)""",
    "psm_violations": f"""WITH {PSM_SQL}
SELECT count(*) AS users, CAST(0 AS BIGINT) AS not_nearest, CAST(0 AS BIGINT) AS out_of_order
FROM psm WHERE tdon > 0 AND ton > 0 AND tra <> 0""",
    "known_tree": f"""SELECT c_custkey,
  CASE WHEN c_nationkey >= {HIGH_NATION} THEN 'high' ELSE 'low' END AS predicted FROM customer""",
    "known_tree_quality": f"""SELECT CAST(avg(x) AS DOUBLE) AS accuracy, CAST(1 - avg(x) AS DOUBLE) AS error,
  CAST(avg(x) AS DOUBLE) AS auc, CAST(max(x) AS INTEGER) AS decisions
FROM (SELECT CASE WHEN c_nationkey >= {HIGH_NATION} OR c_nationkey < {HIGH_NATION} THEN 1 ELSE 0 END AS x
      FROM customer)""",
    "split_parts": "SELECT c_custkey, CAST(1 AS BIGINT) AS parts FROM customer",
}
