"""KMeans over user features, and clusters to tags by rank."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.operators.bounded import local_frame, lookup_join
from tagloom.operators.lookup import Rules, rules_frame
from tagloom.session import cut_lineage
from tagloom.sources.writers import load_or_fit

ELBOW_PARALLELISM = 4
#: Distinct score vectors a fit may have; they are sorted into one partition.
MAX_SCORE_VECTORS = 100_000
#: Half the width of a bin of `value_summary`, relative to its values, and the least value told from zero.
SUMMARY_ERROR, SUMMARY_LEAST = 1e-3, 1e-9


def assemble(df: DataFrame, columns: Sequence[str], output: str = "feature") -> DataFrame:
    """Columns as one vector (L1)."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def kmeans(k: int, features: str = "feature", weight: str | None = None) -> KMeans:
    """KMeans with the fixed settings (L2).

    The row solver, as the block solver fails where there are fewer distinct points than `k`.
    """
    estimator = KMeans(
        k=k,
        maxIter=fixed.KMEANS_MAX_ITER,
        seed=fixed.KMEANS_SEED,
        featuresCol=features,
        predictionCol="predict",
        solver="row",
    )
    return estimator.setWeightCol(weight) if weight else estimator


def dealt(rows: DataFrame, *keys: str, parts: int = fixed.FIT_PARTS) -> DataFrame:
    """Rows dealt out by key and sorted, so that a fit sees the same order on any cluster.

    The first centres of a fit depend on the order of the rows; `parts` is a setting of the job and
    follows neither the cluster nor the number of files. Raise it with the number of users.
    """
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys)


def score_points(scored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct score vectors with the number of users at each.

    Banded scores have few values (125 vectors for three scores of five), and a weighted fit on
    this frame has the same cost function as a fit on all users. Sorting it into one partition
    makes the fit the same for any partitioning of the users.
    """
    points = scored.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return assemble(points.repartition(1).sortWithinPartitions(*columns), columns)


def value_summary(values: DataFrame, column: str, error: float = SUMMARY_ERROR) -> DataFrame:
    """All values of a column as weighted points, each value within `error` of its point, relative to the value.

    The bins are intervals of a geometric grid that is the same everywhere, so summaries merge by adding
    counts, in any order and from any partitioning; the result is an aggregation of one row per bin in use. Their
    number follows the range of the values and not their count: a factor of ten takes about 1,150 bins at
    the usual error. Values nearer to zero than `SUMMARY_LEAST` count as zero; nulls and NaN are left out.
    A weighted mean of points, such as a centre, is off by no more than `error` as well.
    """
    value, ratio = F.col(column).cast("double"), (1 + error) / (1 - error)
    step = F.ceil((F.log(F.abs(value)) - math.log(SUMMARY_LEAST)) / math.log(ratio))
    bins = values.where(value.isNotNull() & ~F.isnan(value)).select(
        F.when(F.abs(value) <= SUMMARY_LEAST, 0).otherwise(F.signum(value)).cast("int").alias("_sign"),
        F.when(F.abs(value) <= SUMMARY_LEAST, 0).otherwise(step).cast("int").alias("_step"),
    )
    counted = bins.groupBy("_sign", "_step").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    point = F.col("_sign") * F.exp(F.col("_step") * math.log(ratio) + math.log(SUMMARY_LEAST)) * (1 - error)
    points = counted.select(point.alias(column), "weight")
    return assemble(points.repartition(1).sortWithinPartitions(column), [column])


def fit_score_clusters(
    points: DataFrame, k: int, model_path: str | None = None, settings: Mapping[str, Any] | None = None
) -> KMeansModel:
    """KMeans on weighted points, or the stored model if its settings were the same."""
    return load_or_fit(
        points.sparkSession,
        model_path,
        KMeansModel.load,
        lambda: kmeans(k, weight="weight").fit(points),
        {"k": k, "seed": fixed.KMEANS_SEED, "max_iter": fixed.KMEANS_MAX_ITER, **(settings or {})},
    )


def elbow_fits(points: DataFrame, ks: Iterable[int] = tuple(fixed.ELBOW_KS)) -> list[tuple[int, KMeansModel]]:
    """The fit for each k; they run side by side."""

    def fit(k: int) -> tuple[int, KMeansModel]:
        return k, kmeans(k, weight="weight").fit(points)

    with ThreadPool(ELBOW_PARALLELISM) as pool:
        return pool.map(inheritable_thread_target(points.sparkSession)(fit), list(ks), chunksize=1)


def fit_cost(points: DataFrame, model: KMeansModel) -> float:
    """Weighted sum of squared distances of the points to the centres of their clusters (L4).

    MLlib's `trainingCost` is that of the centres before they moved for the last time, so it is another wherever a fit
    has not settled within its iterations.
    """
    centres = F.array(*(F.array(*map(F.lit, map(float, centre))) for centre in model.clusterCenters()))
    slots, own = vector_to_array(model.getFeaturesCol()), F.get(centres, F.col(model.getPredictionCol()))
    squares = F.zip_with(slots, own, lambda x, c: (x - c) * (x - c))
    distance = F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
    return model.transform(points).agg(F.sum(F.col("weight") * distance)).first()[0]


def elbow(points: DataFrame, ks: Iterable[int] = tuple(fixed.ELBOW_KS)) -> DataFrame:
    """Sum of squared distances to the nearest centre for each k (L4)."""
    rows = [(k, fit_cost(points, model)) for k, model in elbow_fits(points, ks)]
    return local_frame(points.sparkSession, rows, ["k", "sse"], [pa.int32(), pa.float64()])


def rank_clusters(
    centre_sums: Sequence[tuple[int, float]], rules: Sequence[tuple[int, str]]
) -> list[tuple[int, str]]:
    """(cluster, tag): the largest centre sum gets the tag of the lowest rank.

    On equal sums the higher cluster number comes first. Fewer clusters than rules is fine.
    """
    if len(centre_sums) > len(rules):
        raise ValueError(f"{len(centre_sums)} clusters but only {len(rules)} ranked tags")
    order = sorted(centre_sums, key=lambda c: (c[1], c[0]), reverse=True)
    ranked = sorted(rules, key=lambda r: int(r[1]))
    return [(cluster, str(tag)) for (cluster, _), (tag, _) in zip(order, ranked)]


def _ranked_rules(df: DataFrame, rules: Rules, at_least: int) -> list[tuple[int, str]]:
    if not isinstance(rules, DataFrame):
        return list(rules)
    ranked = rules_frame(df.sparkSession, rules).orderBy(F.col("rule").cast("int"))
    return [(row["id"], row["rule"]) for row in ranked.take(at_least)]


def zip_clusters(
    clustered: DataFrame, centre_sums: Sequence[tuple[int, float]], rules: Rules
) -> DataFrame:
    """`clustered` with column `tagIds`, by rank of its `predict` cluster.

    The map has one row per cluster centre, so it is broadcast.
    """
    ranked = _ranked_rules(clustered, rules, len(centre_sums))
    tags = local_frame(
        clustered.sparkSession,
        rank_clusters(centre_sums, ranked),
        ["predict", "tagIds"],
        [pa.int32(), pa.string()],
    )
    return clustered.join(F.broadcast(tags), "predict")


def centre_sums(model: KMeansModel) -> list[tuple[int, float]]:
    """(cluster, sum of its centre) of a fitted model."""
    return [(i, float(centre.sum())) for i, centre in enumerate(model.clusterCenters())]


def tag_by_score_clusters(
    scored: DataFrame,
    columns: Sequence[str],
    k: int,
    rules: Rules,
    model_path: str | None = None,
    settings: Mapping[str, Any] | None = None,
) -> DataFrame:
    """(userId, tagIds) by clustering banded scores.

    Only the distinct score vectors are clustered, of which banded scores have at most a few hundred; users find their
    tag by their scores. More than `MAX_SCORE_VECTORS` are refused, as continuous scores want `value_summary`.
    """
    points = score_points(scored, columns)
    if points.count() > MAX_SCORE_VECTORS:
        raise ValueError(f"more than {MAX_SCORE_VECTORS} distinct vectors of {list(columns)}: scores must be banded")
    model = fit_score_clusters(points, k, model_path, {"columns": list(columns), **(settings or {})})
    tagged = zip_clusters(model.transform(points), centre_sums(model), rules)
    by_scores = cut_lineage(tagged.select(*columns, "tagIds"))
    return lookup_join(scored, by_scores, list(columns), "inner").select("userId", "tagIds")


def cluster_ranges(clustered: DataFrame, value: Column) -> DataFrame:
    """Greatest and least value per cluster, by cluster."""
    return (
        clustered.groupBy("predict")
        .agg(F.max(value).alias("max_value"), F.min(value).alias("min_value"))
        .orderBy(F.col("predict").asc())
    )


def confusion_counts(df: DataFrame, label: str = "label", predict: str = "predict") -> DataFrame:
    """Rows per (label, predict)."""
    return df.groupBy(F.col(label).alias("label"), F.col(predict).alias("predict")).agg(
        F.count(F.lit(1)).alias("count")
    )


def min_max_scale(
    df: DataFrame, features: str = "features", output: str = "scalerFeatures"
) -> DataFrame:
    """Each vector slot scaled to [0, 1]."""
    return MinMaxScaler(inputCol=features, outputCol=output).fit(df).transform(df)
