"""The tag jobs (T1-T15): business tables and rules to (userId, tagIds)."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.measures import days_since_epoch_seconds
from tagloom.functions.text import compact_date
from tagloom.operators import aggregates as agg
from tagloom.operators import classify, clusters, recommend
from tagloom.operators.lookup import Rules, attach_band_tags, attach_tags
from tagloom.operators.merge import merge_profiles, one_row_per_user
from tagloom.session import cut_lineage
from tagloom.sources.writers import load_or_fit


def gender_tags(users: DataFrame, rules: Rules = tuple(fixed.GENDER_RULES)) -> DataFrame:
    """Gender (T1, T2): every user's gender must have a rule."""
    return attach_tags(users, rules, "gender", unmatched="error")


def job_tags(users: DataFrame, rules: Rules = tuple(fixed.JOB_RULES)) -> DataFrame:
    """Job (T3): every user's job must have a rule."""
    return attach_tags(users, rules, "job", unmatched="error")


def nationality_tags(users: DataFrame, rules: Rules = tuple(fixed.NATIONALITY_RULES)) -> DataFrame:
    """Nationality (T4): users without a rule get no row."""
    return attach_tags(users, rules, "nationality", unmatched="drop")


def political_face_tags(users: DataFrame, rules: Rules) -> DataFrame:
    """Political face (T5): users without a rule get a blank tag."""
    return attach_tags(users, rules, "politicalFace", unmatched="blank")


def age_tags(users: DataFrame, rules: Rules = tuple(fixed.AGE_RULES)) -> DataFrame:
    """Age band by birthday."""
    return attach_band_tags(users, rules, compact_date(F.col("birthday").cast("string")))


def cycle_tags(
    orders: DataFrame,
    rules: Rules = tuple(fixed.CYCLE_RULES),
    as_of: date | str | None = None,
    shift_days: int = fixed.CYCLE_SHIFT_DAYS,
) -> DataFrame:
    """Purchase cycle by days since the last purchase."""
    gaps = agg.purchase_gap(orders, as_of, shift_days)
    return attach_band_tags(gaps, rules, F.col("days"), user="userId", numeric=True)


def payment_tags(orders: DataFrame, rules: Rules = tuple(fixed.PAYMENT_RULES)) -> DataFrame:
    """Preferred payment (T8): codes without a rule get the tag of `other`."""
    best = agg.most_frequent_code(orders)
    return attach_tags(best, rules, "paymentCode", "memberId", unmatched="default")


def _bands(scores: Callable, bands: dict) -> dict:
    """All bands of a scoring function, its own where none are given."""
    own = {name: p.default for name, p in inspect.signature(scores).parameters.items() if p.default is not p.empty}
    return own | bands


def rfm_tags(
    orders: DataFrame,
    rules: Rules = tuple(fixed.RFM_RULES),
    as_of: date | str | None = None,
    shift_days: int = fixed.RFM_SHIFT_DAYS,
    k: int = fixed.RFM_K,
    model_path: str | None = None,
    **bands,
) -> DataFrame:
    """Customer value."""
    scored = cut_lineage(agg.rfm_scores(agg.rfm_features(orders, as_of, shift_days), **bands))
    columns = ["recency", "frequency", "monetary"]
    return clusters.tag_by_score_clusters(scored, columns, k, rules, model_path, _bands(agg.rfm_scores, bands))


def rfm_elbow(
    orders: DataFrame,
    as_of: date | str | None = None,
    shift_days: int = fixed.RFM_SHIFT_DAYS,
    ks: Iterable[int] = tuple(fixed.ELBOW_KS),
    **bands,
) -> DataFrame:
    """Cost of the customer-value clusters for each k, to choose k by (L4)."""
    scored = agg.rfm_scores(agg.rfm_features(orders, as_of, shift_days), **bands)
    points = clusters.score_points(scored, ["recency", "frequency", "monetary"])
    return clusters.elbow(cut_lineage(points), ks)


def rfe_tags(
    views: DataFrame,
    rules: Rules = tuple(fixed.RFE_RULES),
    as_of: date | str | None = None,
    shift_days: int = fixed.RFE_SHIFT_DAYS,
    k: int = fixed.RFE_K,
    model_path: str | None = None,
    **bands,
) -> DataFrame:
    """Activity (T10)."""
    scored = cut_lineage(agg.rfe_scores(agg.rfe_features(views, as_of, shift_days), **bands))
    columns = ["recency", "frequency", "engagements"]
    return clusters.tag_by_score_clusters(scored, columns, k, rules, model_path, _bands(agg.rfe_scores, bands))


def psm_tags(
    orders: DataFrame,
    rules: Rules = tuple(fixed.PSM_RULES),
    k: int = fixed.PSM_K,
    zero_discount_eps: float | None = None,
    error: float = clusters.SUMMARY_ERROR,
    model_path: str | None = None,
) -> DataFrame:
    """Price sensitivity (T11): scores are continuous, so the fit runs on a summary of all users' scores."""
    clustered, model = psm_clusters(orders, k, zero_discount_eps, error, model_path)
    tagged = clusters.zip_clusters(clustered, clusters.centre_sums(model), rules)
    return tagged.select(F.col("userId").cast("string"), "tagIds")


def psm_clusters(
    orders: DataFrame,
    k: int = fixed.PSM_K,
    zero_discount_eps: float | None = None,
    error: float = clusters.SUMMARY_ERROR,
    model_path: str | None = None,
):
    """(userId, psm, predict) and the fitted model behind T11."""
    return _psm_fit(agg.psm_features(orders), k, zero_discount_eps, error, model_path)


def _psm_fit(features: DataFrame, k: int, zero_discount_eps: float | None, error: float, model_path: str | None):
    """Members stay where they are: the fit reads the weighted points of `value_summary`, whatever the partitioning."""
    scored = cut_lineage(agg.psm_scores(features, zero_discount_eps))
    points = clusters.value_summary(scored, "psm", error)
    settings = {"columns": ["psm"], "zero_discount_eps": zero_discount_eps, "error": error}
    model = clusters.fit_score_clusters(points, k, model_path, settings)
    clustered = model.transform(clusters.assemble(scored, ["psm"]))
    return clustered.select("userId", "psm", "predict"), model


def cycle_from(
    totals: DataFrame, rules: Rules, as_of: date | str | None = None, shift_days: int = fixed.CYCLE_SHIFT_DAYS
) -> DataFrame:
    """T7 from the totals of each member."""
    days = days_since_epoch_seconds(F.col("finishTime"), as_of, shift_days)
    gaps = totals.select("userId", days.alias("days"))
    return attach_band_tags(gaps, rules, F.col("days"), user="userId", numeric=True)


def payment_from(summary: DataFrame, rules: Rules) -> DataFrame:
    """T8 from an order summary."""
    best = agg.best_code(summary.select("userId", "paymentCode", "counts"), "userId")
    return attach_tags(best, rules, "paymentCode", "userId", unmatched="default")


def rfm_from(
    totals: DataFrame,
    rules: Rules,
    as_of: date | str | None = None,
    shift_days: int = fixed.RFM_SHIFT_DAYS,
    k: int = fixed.RFM_K,
    model_path: str | None = None,
    **bands,
) -> DataFrame:
    """T9 from the totals of each member."""
    recency = days_since_epoch_seconds(F.col("finishTime"), as_of, shift_days).alias("recency")
    features = totals.select("userId", recency, "frequency", "monetary")
    scored = cut_lineage(agg.rfm_scores(features, **bands))
    columns = ["recency", "frequency", "monetary"]
    tagged = clusters.tag_by_score_clusters(scored, columns, k, rules, model_path, _bands(agg.rfm_scores, bands))
    return tagged.select(F.col("userId").cast("string"), "tagIds")


def psm_from(
    totals: DataFrame,
    rules: Rules,
    k: int = fixed.PSM_K,
    zero_discount_eps: float | None = None,
    error: float = clusters.SUMMARY_ERROR,
    model_path: str | None = None,
) -> DataFrame:
    """T11 from the totals of each member."""
    clustered, model = _psm_fit(totals, k, zero_discount_eps, error, model_path)
    tagged = clusters.zip_clusters(clustered, clusters.centre_sums(model), rules)
    return tagged.select(F.col("userId").cast("string"), "tagIds")


def order_tags(
    orders: DataFrame,
    cycle_rules: Rules = tuple(fixed.CYCLE_RULES),
    rfm_rules: Rules = tuple(fixed.RFM_RULES),
    psm_rules: Rules = tuple(fixed.PSM_RULES),
    as_of: date | str | None = None,
    cycle_shift_days: int = fixed.CYCLE_SHIFT_DAYS,
    rfm_shift_days: int = fixed.RFM_SHIFT_DAYS,
    psm_error: float = clusters.SUMMARY_ERROR,
    **bands,
) -> DataFrame:
    """Rows of T7, T9 and T11 from a single pass over the orders.

    The per-member totals are written once; each job then reads one short row per member.
    """
    totals = cut_lineage(agg.order_totals(orders))
    cycle = cycle_from(totals, cycle_rules, as_of, cycle_shift_days)
    rfm = rfm_from(totals, rfm_rules, as_of, rfm_shift_days, **bands)
    return cycle.unionByName(rfm).unionByName(psm_from(totals, psm_rules, error=psm_error))


def usg_kinds(items: DataFrame, orders: DataFrame, model_path: str | None = None):
    """The kinds of items with counts, train flag and predicted class, the model, and the items
    per user and kind they were counted from (T12).

    The class depends on the kind of item alone, so the tree is applied to the kinds.
    """
    counted = cut_lineage(classify.user_kinds(classify.item_features(items), orders))
    kinds = cut_lineage(classify.kinds_of(counted))
    settings = {"features": classify.KIND[:2], "seed": fixed.KMEANS_SEED, "max_categories": fixed.USG_MAX_CATEGORIES, **fixed.USG_TREE}
    model = load_or_fit(kinds.sparkSession, model_path, PipelineModel.load, lambda: classify.fit_gender_tree(kinds), settings)
    predicted = classify.predicted_by_leaves(classify.tree_leaves(model), classify.KIND[:2])
    label = F.col("gender").cast("double").alias("label")
    return kinds.select(*classify.KIND, "n", label, predicted.alias("predict")), model, counted


def usg_tags(
    items: DataFrame, orders: DataFrame, rules: Rules = tuple(fixed.USG_RULES), model_path: str | None = None
) -> DataFrame:
    """Shopping gender (T12): each item of the train and test sets votes once.

    Items and orders are read and joined once; the fit and the votes both come from the counts. The tree is applied as the
    intervals of its leaves.
    """
    kinds, _, counted = usg_kinds(items, orders, model_path)
    classes = F.broadcast(kinds.select(*classify.KIND, "predict"))  # bounded by the dictionaries
    return classify.vote_tags(classify.votes_of(counted.join(classes, classify.KIND)), rules)


def usg_quality(items: DataFrame, orders: DataFrame) -> dict[str, dict[str, float]]:
    """Accuracy, error and exact area under ROC on the train and the test items."""
    kinds, _, _ = usg_kinds(items, orders)
    weighted = kinds.withColumn("weight", F.col("n").cast("double"))
    parts = {"train": F.col("train"), "test": ~F.col("train")}
    result = {}
    for name, rows in parts.items():
        part = weighted.where(rows)
        result[name] = classify.accuracy(part, "weight")
        result[name]["auc"] = classify.rank_sum_auc(part, count="n").first()["auc"]
    return result


def brand_tags(views: DataFrame, blocks: int = recommend.BLOCKS, model_path: str | None = None) -> DataFrame:
    """Product preference (T13): `tagIds` lists product ids, best first."""
    ratings = cut_lineage(agg.product_ratings(views))
    if model_path:
        settings = {"seed": fixed.KMEANS_SEED, **fixed.ALS_SETTINGS}
        load_or_fit(views.sparkSession, model_path, ALSModel.load, lambda: recommend.fit_preferences(ratings, blocks), settings)
        model = ALSModel.load(model_path)
    else:
        model = recommend.stored_model(recommend.fit_preferences(ratings, blocks))
    return recommend.top_products(model)


def iris_clusters(
    rows: DataFrame, k: int = fixed.IRIS_K, keys: Iterable[str] = (), parts: int = fixed.FIT_PARTS
) -> DataFrame:
    """Scaled features, clusters, and rows per (label, cluster).

    With `keys` the fit sees the rows in an order that no partitioning changes.
    """
    scaled = clusters.min_max_scale(rows)
    if keys:
        scaled = clusters.dealt(scaled, *keys, parts=parts)
    model = clusters.kmeans(k, features="scalerFeatures").fit(scaled)
    return clusters.confusion_counts(model.transform(scaled))


def iris_tree(rows: DataFrame, features: list[str], label: str, keys: list[str]):
    """Tree on measurements: predictions on the test rows and the fitted pipeline."""
    train, test = classify.random_split(rows, [0.8, 0.2], keys, seed=fixed.KMEANS_SEED)
    pipeline = classify.tree_pipeline(
        classify.index_labels(rows, label), features, {"impurity": "gini", "maxDepth": 5}
    )
    model = pipeline.fit(train)
    return model.transform(test), model


def profile_of(
    *tag_frames: DataFrame, stored: DataFrame | None = None, how: str = "full"
) -> DataFrame:
    """Tags of many jobs as one profile, merged with the stored one in a single pass."""
    new = one_row_per_user(*tag_frames)
    return new if stored is None else merge_profiles(new, stored, how)
