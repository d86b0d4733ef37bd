"""Queries for clustering, classification and recommendation, and their SQL-checkable parts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.measures import as_double, money
from tagloom.operators import aggregates as agg
from tagloom.operators import classify, clusters
from tagloom.operators.bounded import local_frame
from tagloom.plans import tag_jobs
from tagloom.session import scratch_path
from tagloom.sources.readers import preview, read_libsvm, read_measurements
from tagloom.workload import inputs as src
from tagloom.workload.features import ORDER_BANDS, VIEW_BANDS, rfm_scores_sql

RFM = ["recency", "frequency", "monetary"]
VECTOR_WIDTH = 64
MEASURES = [f"m{i + 1}" for i in range(VECTOR_WIDTH)]


def segment_clusters(spark, sf_dir):
    """Customers with their segment's number as cluster (L7: labels in text order)."""
    customers = src.table(spark, sf_dir, "customer")
    indexer = StringIndexer(
        inputCol="c_mktsegment", outputCol="_index", stringOrderType="alphabetAsc"
    )
    indexed = indexer.fit(customers).transform(customers)
    return indexed.withColumn("predict", F.col("_index").cast("int")).drop("_index")


def label_index(spark, sf_dir):
    """L7."""
    return segment_clusters(spark, sf_dir).select("c_custkey", "predict")


def cluster_zip(spark, sf_dir):
    """Segments as clusters, ranked by mean balance, to the PSM tags."""
    clustered = segment_clusters(spark, sf_dir)
    means = clustered.groupBy("predict").agg(
        (as_double(F.sum(money(F.col("c_acctbal")))) / F.count("c_acctbal")).alias("centre")
    )
    centres = [(r["predict"], r["centre"]) for r in means.take(len(fixed.PSM_RULES) + 1)]
    tagged = clusters.zip_clusters(clustered, centres, fixed.PSM_RULES)
    return tagged.select(F.col("c_custkey").cast("string").alias("userId"), "tagIds")


def cluster_minmax(spark, sf_dir):
    """Price range per order priority."""
    orders = src.table(spark, sf_dir, "orders")
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    return clusters.cluster_ranges(orders.withColumn("predict", number), F.col("o_totalprice"))


def confusion_counts(spark, sf_dir):
    """A9 over two flags of the order lines."""
    lines = src.table(spark, sf_dir, "lineitem")
    return clusters.confusion_counts(lines, "l_returnflag", "l_linestatus")


def vectors(spark, sf_dir):
    return src.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )


def min_max_scaled(spark, sf_dir):
    """Every slot of every vector, scaled."""
    scaled = clusters.min_max_scale(vectors(spark, sf_dir))
    slots = F.posexplode(vector_to_array("scalerFeatures")).alias("pos", "value")
    return scaled.select("vec_id", slots)


def rfm_tags(spark, sf_dir):
    """T9."""
    orders = src.orders(spark, sf_dir)
    return tag_jobs.rfm_tags(orders, as_of=src.AS_OF, shift_days=0, **ORDER_BANDS)


def rfm_points(spark, sf_dir):
    features = agg.rfm_features(src.orders(spark, sf_dir), src.AS_OF, shift_days=0)
    return clusters.score_points(agg.rfm_scores(features, **ORDER_BANDS), RFM)


def score_points(spark, sf_dir):
    """L1: distinct RFM score vectors with their numbers of users."""
    return rfm_points(spark, sf_dir).select(
        *RFM, "weight", vector_to_array("feature").alias("_v")
    ).select(*RFM, "weight", F.aggregate("_v", F.lit(0.0), lambda a, x: a + x).alias("total"))


def elbow_sse(spark, sf_dir):
    """L4."""
    orders = src.orders(spark, sf_dir)
    return tag_jobs.rfm_elbow(orders, src.AS_OF, shift_days=0, **ORDER_BANDS)


def rfe_tags(spark, sf_dir):
    """T10."""
    views = src.views(spark, sf_dir)
    return tag_jobs.rfe_tags(views, as_of=src.VIEWS_AS_OF, shift_days=0, **VIEW_BANDS)


def psm_tags(spark, sf_dir):
    """T11."""
    return tag_jobs.psm_tags(src.coupon_orders(spark, sf_dir))


def order_tags(spark, sf_dir):
    """T7, T9, T11 from one pass over the orders."""
    orders = src.coupon_orders(spark, sf_dir)
    return tag_jobs.order_tags(orders, as_of=src.AS_OF, rfm_shift_days=0, **ORDER_BANDS)


def psm_cluster_ranges(spark, sf_dir):
    """A8 after L2, L3."""
    clustered, _ = tag_jobs.psm_clusters(src.coupon_orders(spark, sf_dir))
    return clusters.cluster_ranges(clustered, F.col("psm"))


def model_checkpoint(spark, sf_dir):
    """The model fitted and stored by a first run tags the same in a second one."""
    path = scratch_path(spark, "rfm-model")
    orders = src.orders(spark, sf_dir)
    settings = {"as_of": src.AS_OF, "shift_days": 0, "model_path": path, **ORDER_BANDS}
    tag_jobs.rfm_tags(orders, **settings)
    stored = KMeansModel.load(path)
    again = tag_jobs.rfm_tags(orders, **settings)
    return again.withColumn("k", F.lit(len(stored.clusterCenters())))


def usg_tags(spark, sf_dir):
    """T12."""
    return tag_jobs.usg_tags(src.items(spark, sf_dir), src.orders(spark, sf_dir))


def usg_quality(spark, sf_dir):
    """L12, L13."""
    found = tag_jobs.usg_quality(src.items(spark, sf_dir), src.orders(spark, sf_dir))
    rows = [(name, q["accuracy"], q["error"], q["auc"]) for name, q in found.items()]
    number = pa.float64()
    return local_frame(
        spark, rows, ["part", "accuracy", "error", "auc"], [pa.string(), number, number, number]
    )


def als_top5(spark, sf_dir):
    """L15, O5, F16."""
    return tag_jobs.brand_tags(src.views(spark, sf_dir))


def kmeans_minmax(spark, sf_dir):
    """T14 over the embeddings and their labels."""
    return tag_jobs.iris_clusters(vectors(spark, sf_dir), keys=["vec_id"])


def measurements(spark, sf_dir):
    slots = [F.get("embedding", i).cast("double").alias(m) for i, m in enumerate(MEASURES)]
    species = F.concat(F.lit("s"), F.col("label")).alias("Species")
    return src.table(spark, sf_dir, "embeddings").select(*slots, species)


def tree_accuracy(spark, sf_dir):
    """T15, L12 over all slots of the embeddings: accuracy on the test rows."""
    predicted, _ = tag_jobs.iris_tree(measurements(spark, sf_dir), MEASURES, "Species", MEASURES)
    found = classify.accuracy(predicted)
    rows = [(found["accuracy"], found["error"])]
    return local_frame(spark, rows, ["accuracy", "error"], [pa.float64(), pa.float64()])


def libsvm_roundtrip(spark, sf_dir):
    """Vectors written as libsvm text and read back, all slots summed up per label."""
    path = scratch_path(spark, "libsvm")
    vectors(spark, sf_dir).select("label", "features").write.format("libsvm").save(path)
    rows = read_libsvm(spark, path, VECTOR_WIDTH)
    slots = rows.select("label", F.posexplode(vector_to_array("features")).alias("pos", "value"))
    return slots.groupBy("label", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def csv_roundtrip(spark, sf_dir):
    """Measurements written as header-less CSV and read back."""
    path = scratch_path(spark, "csv")
    measurements(spark, sf_dir).write.csv(path)
    return read_measurements(spark, path, MEASURES)


def top_orders(spark, sf_dir):
    """The ten dearest orders."""
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"), 10)


QUERIES = {
    f.__name__: f
    for f in (
        label_index,
        cluster_zip,
        cluster_minmax,
        confusion_counts,
        min_max_scaled,
        score_points,
        rfm_tags,
        elbow_sse,
        rfe_tags,
        psm_tags,
        order_tags,
        psm_cluster_ranges,
        model_checkpoint,
        usg_tags,
        usg_quality,
        als_top5,
        kmeans_minmax,
        tree_accuracy,
        libsvm_roundtrip,
        csv_roundtrip,
        top_orders,
    )
}

_SEGMENTS = """segments AS (
  SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS predict,
         CAST(SUM(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE) / count(c_acctbal) AS centre
  FROM customer GROUP BY c_mktsegment)"""

_SLOTS = f"""slots AS (
  SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value
  FROM embeddings, (SELECT unnest(range(1, {VECTOR_WIDTH + 1})) AS i) AS n)"""


def _score_points_sql() -> str:
    scored = rfm_scores_sql(0, *ORDER_BANDS.values(), True)
    return f"""SELECT recency, frequency, monetary, CAST(count(*) AS DOUBLE) AS weight,
       CAST(any_value(total) AS DOUBLE) AS total
FROM ({scored}) AS s GROUP BY recency, frequency, monetary"""


SQL = {
    "label_index": f"""WITH {_SEGMENTS}
SELECT c_custkey, predict FROM customer JOIN segments USING (c_mktsegment)""",
    "cluster_zip": f"""WITH {_SEGMENTS},
ranked AS (SELECT *, row_number() OVER (ORDER BY centre DESC, predict DESC) AS rank FROM segments)
SELECT CAST(c_custkey AS VARCHAR) AS "userId", CAST(r.id AS VARCHAR) AS "tagIds"
FROM customer JOIN ranked USING (c_mktsegment)
JOIN {src.values_sql(fixed.PSM_RULES, 'r(id, rule)')} ON rank = CAST(r.rule AS INTEGER)""",
    "cluster_minmax": """SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS predict,
       max(o_totalprice) AS max_value, min(o_totalprice) AS min_value
FROM orders GROUP BY 1 ORDER BY 1""",
    "confusion_counts": """SELECT l_returnflag AS label, l_linestatus AS predict, count(*) AS count
FROM lineitem GROUP BY 1, 2""",
    "min_max_scaled": f"""WITH {_SLOTS},
spans AS (SELECT pos, min(value) AS low, max(value) AS high FROM slots GROUP BY pos)
SELECT vec_id, pos,
       CASE WHEN high > low THEN (value - low) * (1.0::DOUBLE / (high - low)) ELSE 0.5 END AS value
FROM slots JOIN spans USING (pos)""",
    "score_points": _score_points_sql(),
    "libsvm_roundtrip": f"""WITH {_SLOTS}
SELECT CAST(label AS DOUBLE) AS label, pos, count(*) AS n, min(value) AS low, max(value) AS high
FROM slots GROUP BY label, pos""",
    "csv_roundtrip": "SELECT "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {m}" for i, m in enumerate(MEASURES))
    + """, 's' || label AS "Species" FROM embeddings""",
    "top_orders": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
}
