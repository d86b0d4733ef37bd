"""Per-user features from business tables.

Input columns may be text or typed; each is cast once, here.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.measures import (
    band_score,
    days_since_epoch_seconds,
    days_since_timestamp,
    as_double,
    money,
    price_sensitivity,
)
from tagloom.functions.text import product_id


def last_purchase(orders: DataFrame) -> DataFrame:
    """Latest finish time per member, in epoch seconds (A1)."""
    finished = F.col("finishTime").try_cast("long")
    return orders.groupBy("memberId").agg(F.max(finished).alias("finishTime"))


def purchase_gap(
    orders: DataFrame, as_of: date | str | None = None, shift_days: int = fixed.CYCLE_SHIFT_DAYS
) -> DataFrame:
    """Days since the last purchase per member."""
    days = days_since_epoch_seconds(F.col("finishTime"), as_of, shift_days)
    return last_purchase(orders).select(F.col("memberId").alias("userId"), days.alias("days"))


def code_counts(orders: DataFrame, user: str = "memberId", code: str = "paymentCode") -> DataFrame:
    """Orders per (user, code); orders without a code count 0 (A2)."""
    return orders.groupBy(user, code).agg(F.count(code).alias("counts"))


def most_frequent_code(
    orders: DataFrame, user: str = "memberId", code: str = "paymentCode"
) -> DataFrame:
    """The code each user has most often, the first in text order on a tie.

    Counting comes first and the rank filter is applied before the second shuffle, so a user
    with very many orders sends one row per task.
    """
    return best_code(code_counts(orders, user, code), user, code)


def best_code(counted: DataFrame, user: str = "memberId", code: str = "paymentCode") -> DataFrame:
    """The row of each user's most frequent code among (user, code, counts)."""
    best_first = Window.partitionBy(user).orderBy(F.desc("counts"), F.asc_nulls_last(code))
    ranked = counted.withColumn("rn", F.row_number().over(best_first))
    return ranked.where("rn = 1").drop("rn")


def rfm_features(
    orders: DataFrame, as_of: date | str | None = None, shift_days: int = fixed.RFM_SHIFT_DAYS
) -> DataFrame:
    """Recency, frequency, monetary value per member (A3)."""
    last = F.max(F.col("finishTime").try_cast("long"))
    return orders.groupBy(F.col("memberId").alias("userId")).agg(
        days_since_epoch_seconds(last, as_of, shift_days).alias("recency"),
        F.count("orderSn").alias("frequency"),
        as_double(F.try_sum(money(F.col("orderAmount")))).alias("monetary"),
    )


def rfm_scores(
    features: DataFrame,
    recency=fixed.RFM_RECENCY,
    frequency=fixed.RFM_FREQUENCY,
    monetary=fixed.RFM_MONETARY,
) -> DataFrame:
    """Banded R, F, M; users with a value between bands drop out."""
    return features.select(
        "userId",
        band_score(F.col("recency"), recency).alias("recency"),
        band_score(F.col("frequency"), frequency).alias("frequency"),
        band_score(F.col("monetary"), monetary).alias("monetary"),
    ).dropna(subset=["recency", "frequency", "monetary"])


def rfe_features(
    views: DataFrame, as_of: date | str | None = None, shift_days: int = fixed.RFE_SHIFT_DAYS
) -> DataFrame:
    """Recency, page views, distinct pages per visitor (A4)."""
    last = F.max(F.col("log_time").try_cast("timestamp"))
    return views.groupBy(F.col("global_user_id").alias("userId")).agg(
        days_since_timestamp(last, as_of, shift_days).alias("recency"),
        F.count("loc_url").alias("frequency"),
        F.count_distinct("loc_url").alias("engagements"),
    )


def rfe_scores(
    features: DataFrame,
    recency=fixed.RFE_RECENCY,
    frequency=fixed.RFE_FREQUENCY,
    engagements=fixed.RFE_ENGAGEMENT,
) -> DataFrame:
    """Banded R, F, E; users with a value between bands drop out."""
    return features.select(
        "userId",
        band_score(F.col("recency"), recency).alias("recency"),
        band_score(F.col("frequency"), frequency).alias("frequency"),
        band_score(F.col("engagements"), engagements).alias("engagements"),
    ).dropna(subset=["recency", "frequency", "engagements"])


def order_discounts(orders: DataFrame) -> DataFrame:
    """Receivable, discount and paid amount as exact decimals, and the discount flag."""
    paid, coupon = money(F.col("orderAmount")), money(F.col("couponCodeValue"))
    state = F.when(coupon != 0, 1).when(coupon == 0, 0)
    return orders.select(
        F.col("memberId").alias("userId"),
        F.try_add(paid, coupon).alias("ra"),
        coupon.alias("da"),
        paid.alias("pa"),
        state.alias("state"),
    )


def psm_features(orders: DataFrame) -> DataFrame:
    """Discounted orders, orders, discount and receivable totals per member (A5)."""
    per_user = order_discounts(orders).groupBy("userId").agg(
        F.sum("state").alias("tdon"),
        F.count("state").alias("ton"),
        F.try_sum("da").alias("tda"),
        F.try_sum("ra").alias("tra"),
    )
    return per_user.select(
        "userId",
        "tdon",
        "ton",
        as_double(F.col("tda")).alias("tda"),
        as_double(F.col("tra")).alias("tra"),
    )


def psm_scores(features: DataFrame, zero_discount_eps: float | None = None) -> DataFrame:
    """Price sensitivity per member.

    Members without a discounted order drop out, unless `zero_discount_eps` stands in for
    their count of 0.
    """
    tdon = F.col("tdon").cast("double")
    if zero_discount_eps is not None:
        tdon = F.when(tdon == 0, F.lit(zero_discount_eps)).otherwise(tdon)
    psm = price_sensitivity(tdon, F.col("ton"), F.col("tda"), F.col("tra"))
    return features.select("userId", psm.alias("psm")).where(F.col("psm").isNotNull())


def order_totals(orders: DataFrame) -> DataFrame:
    """Everything the cycle, RFM and PSM features need, in one scan and one shuffle.

    The columns are those of the single features, before dates are compared with today.
    """
    paid, coupon = money(F.col("orderAmount")), money(F.col("couponCodeValue"))
    return orders.groupBy(F.col("memberId").alias("userId")).agg(
        F.max(F.col("finishTime").try_cast("long")).alias("finishTime"),
        F.count("orderSn").alias("frequency"),
        as_double(F.try_sum(paid)).alias("monetary"),
        F.sum(F.when(coupon != 0, 1).when(coupon == 0, 0)).alias("tdon"),
        F.count(coupon).alias("ton"),
        as_double(F.try_sum(coupon)).alias("tda"),
        as_double(F.try_sum(F.try_add(paid, coupon))).alias("tra"),
    )


ORDER_COLUMNS = ("memberId", "paymentCode", "orderSn", "finishTime", "orderAmount", "couponCodeValue")


def order_summary(orders: DataFrame) -> DataFrame:
    """One row per member and payment code with all that the order jobs need.

    Several jobs on the same orders read this frame instead of the orders. Columns the orders do not have
    count as null.
    """
    known = orders.select(
        *[F.col(c) if c in orders.columns else F.lit(None).cast("string").alias(c) for c in ORDER_COLUMNS]
    )
    paid, coupon = money(F.col("orderAmount")), money(F.col("couponCodeValue"))
    return known.groupBy(F.col("memberId").alias("userId"), F.col("paymentCode")).agg(
        F.count("paymentCode").alias("counts"),
        F.max(F.col("finishTime").try_cast("long")).alias("finishTime"),
        F.count("orderSn").alias("frequency"),
        F.try_sum(paid).alias("paid"),
        F.sum(F.when(coupon != 0, 1).when(coupon == 0, 0)).alias("tdon"),
        F.count(coupon).alias("ton"),
        F.try_sum(coupon).alias("coupon"),
        F.try_sum(F.try_add(paid, coupon)).alias("both"),
    )


def member_totals(summary: DataFrame) -> DataFrame:
    """The columns of `order_totals` from an `order_summary`."""
    return summary.groupBy("userId").agg(
        F.max("finishTime").alias("finishTime"),
        F.sum("frequency").alias("frequency"),
        as_double(F.try_sum("paid")).alias("monetary"),
        F.sum("tdon").alias("tdon"),
        F.sum("ton").alias("ton"),
        as_double(F.try_sum("coupon")).alias("tda"),
        as_double(F.try_sum("both")).alias("tra"),
    )


def product_views(views: DataFrame) -> DataFrame:
    """(userId, productId) of the page views that show a product."""
    return views.select(
        F.col("global_user_id").alias("userId"), product_id(F.col("loc_url")).alias("productId")
    ).where(F.col("productId").isNotNull())


def product_ratings(views: DataFrame) -> DataFrame:
    """Views per (user, product) as an implicit rating; ids that are no int drop out."""
    counted = product_views(views).groupBy("userId", "productId").agg(
        F.count("productId").alias("rating")
    )
    return counted.select(
        F.col("userId").try_cast("int").alias("userId"),
        F.col("productId").try_cast("int").alias("productId"),
        F.col("rating").cast("double").alias("rating"),
    ).dropna()
