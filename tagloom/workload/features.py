"""Queries for per-user features, scores and votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.measures import score_sum
from tagloom.functions.text import product_id
from tagloom.operators import aggregates as agg
from tagloom.operators import classify
from tagloom.plans import tag_jobs
from tagloom.workload import inputs as src

ORDER_BANDS = {
    "recency": src.ORDER_RECENCY,
    "frequency": src.ORDER_FREQUENCY,
    "monetary": src.ORDER_MONETARY,
}
VIEW_BANDS = {"frequency": src.VIEW_FREQUENCY, "engagements": src.VIEW_ENGAGEMENT}


def payment_counts(spark, sf_dir):
    """A2."""
    return agg.code_counts(src.orders(spark, sf_dir))


def top_payment_code(spark, sf_dir):
    """A2, W1, P6."""
    return agg.most_frequent_code(src.orders(spark, sf_dir))


def preferred_payment(spark, sf_dir):
    """A2, W1, J3."""
    return tag_jobs.payment_tags(src.orders(spark, sf_dir))


def last_purchase_days(spark, sf_dir):
    """A1, F6."""
    return agg.purchase_gap(src.orders(spark, sf_dir), src.AS_OF)


def rfm_features(spark, sf_dir):
    """A3."""
    return agg.rfm_features(src.orders(spark, sf_dir), src.AS_OF)


def rfm_scores(spark, sf_dir):
    """F8 with the fixed bands: members past the shifted day and between bands drop out."""
    return agg.rfm_scores(rfm_features(spark, sf_dir))


def rfm_scores_spread(spark, sf_dir):
    """F8, F19 with bands that spread over the given orders."""
    features = agg.rfm_features(src.orders(spark, sf_dir), src.AS_OF, shift_days=0)
    scored = agg.rfm_scores(features, **ORDER_BANDS)
    return scored.withColumn("total", score_sum("recency", "frequency", "monetary"))


def rfe_features(spark, sf_dir):
    """A4, F7."""
    return agg.rfe_features(src.views(spark, sf_dir), src.VIEWS_AS_OF, shift_days=0)


def rfe_scores(spark, sf_dir):
    """F9 with the fixed bands."""
    return agg.rfe_scores(rfe_features(spark, sf_dir))


def rfe_scores_spread(spark, sf_dir):
    """F9, F19 with bands that spread over the given events."""
    scored = agg.rfe_scores(rfe_features(spark, sf_dir), **VIEW_BANDS)
    return scored.withColumn("total", score_sum("recency", "frequency", "engagements"))


def psm_features(spark, sf_dir):
    """A5, F12, F13."""
    return agg.psm_features(src.coupon_orders(spark, sf_dir))


def psm_score(spark, sf_dir):
    """F14, P4."""
    return agg.psm_scores(psm_features(spark, sf_dir))


def order_totals(spark, sf_dir):
    """A1, A3, A5 in one pass."""
    return agg.order_totals(src.coupon_orders(spark, sf_dir))


def usg_features(spark, sf_dir):
    """Items per user, colour code, type code and rule label."""
    return classify.user_items(src.items(spark, sf_dir), src.orders(spark, sf_dir))


def usg_vote_counts(spark, sf_dir):
    """A7 over the rule label."""
    coded = classify.item_features(src.items(spark, sf_dir))
    return classify.votes(coded, src.orders(spark, sf_dir), predict="gender")


def usg_vote(spark, sf_dir):
    """F20, X5 over the rule label."""
    return classify.vote_tags(usg_vote_counts(spark, sf_dir), fixed.USG_RULES)


def product_views(spark, sf_dir):
    """page views per product page, and how many pages show no product."""
    views = src.views(spark, sf_dir).select(product_id(F.col("loc_url")).alias("product_id"))
    return views.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))


def product_ratings(spark, sf_dir):
    """F15, P4, A6, F5."""
    return agg.product_ratings(src.views(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        payment_counts,
        top_payment_code,
        preferred_payment,
        last_purchase_days,
        rfm_features,
        rfm_scores,
        rfm_scores_spread,
        rfe_features,
        rfe_scores,
        rfe_scores_spread,
        psm_features,
        psm_score,
        order_totals,
        usg_features,
        usg_vote_counts,
        usg_vote,
        product_views,
        product_ratings,
    )
}

TOP_CODE_SQL = f"""{src.ORDERS_SQL},
counted AS (SELECT member, code, count(code) AS counts FROM orders_in GROUP BY member, code),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY member ORDER BY counts DESC, code NULLS LAST) AS rn
  FROM counted),
best AS (SELECT member, code, counts FROM ranked WHERE rn = 1)"""

PAYMENT_SQL = f"""{TOP_CODE_SQL},
payment AS (
  SELECT CAST(member AS VARCHAR) AS user_id, coalesce(CAST(r.id AS VARCHAR), '35') AS tags
  FROM best LEFT JOIN {src.values_sql(fixed.PAYMENT_RULES, 'r(id, rule)')} ON code = r.rule)"""


def rfm_sql(shift_days: int) -> str:
    return f"""{src.ORDERS_SQL},
rfm AS (
  SELECT member,
         CAST(date_diff('day', max(finished), DATE '{src.AS_OF}' - {shift_days}) AS INTEGER) AS r,
         count(sn) AS f, CAST(SUM(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS m
  FROM orders_in GROUP BY member)"""


def rfm_scores_sql(shift_days: int, recency, frequency, monetary, total: bool) -> str:
    return f"""WITH {rfm_sql(shift_days)},
scored AS (
  SELECT member AS "userId", CAST({src.band_sql('r', recency)} AS INTEGER) AS recency,
         CAST({src.band_sql('f', frequency)} AS INTEGER) AS frequency,
         CAST({src.band_sql('m', monetary)} AS INTEGER) AS monetary
  FROM rfm)
SELECT *{', recency + frequency + monetary AS total' if total else ''} FROM scored
WHERE recency IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL"""


RFE_SQL = f"""{src.VIEWS_SQL},
rfe AS (
  SELECT visitor, CAST(date_diff('day', max(day), DATE '{src.VIEWS_AS_OF}') AS INTEGER) AS r,
         count(url) AS f, count(DISTINCT url) AS e
  FROM views GROUP BY visitor)"""


def rfe_scores_sql(frequency, engagements, total: bool) -> str:
    return f"""WITH {RFE_SQL},
scored AS (
  SELECT visitor AS "userId", CAST({src.band_sql('r', fixed.RFE_RECENCY)} AS INTEGER) AS recency,
         CAST({src.band_sql('f', frequency)} AS INTEGER) AS frequency,
         CAST({src.band_sql('e', engagements)} AS INTEGER) AS engagements
  FROM rfe)
SELECT *{', recency + frequency + engagements AS total' if total else ''} FROM scored
WHERE recency IS NOT NULL AND frequency IS NOT NULL AND engagements IS NOT NULL"""


PSM_SQL = f"""{src.COUPONS_SQL},
psm AS (
  SELECT member, CAST(count(CASE WHEN da <> 0 THEN 1 END) AS BIGINT) AS tdon, count(da) AS ton,
         CAST(sum(da) AS DOUBLE) AS tda, CAST(sum(pa + da) AS DOUBLE) AS tra
  FROM coupon_orders GROUP BY member)"""

ITEM_VOTES_SQL = f"""{src.ITEMS_SQL},
bought AS (
  SELECT o_custkey AS member, color, product_type, gender
  FROM coded JOIN orders ON sn = o_orderkey),
votes AS (
  SELECT member, CAST(count(*) AS DOUBLE) AS total,
         CAST(sum(CASE WHEN gender = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS male,
         CAST(sum(CASE WHEN gender = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS female
  FROM bought GROUP BY member)"""

_PRODUCT = """CASE
     WHEN instr(url, '/product/') > 0 AND instr(url, '.html') > instr(url, '/product/')
     THEN substr(url, instr(url, '/product/') + 9,
                 instr(url, '.html') - instr(url, '/product/') - 9) END"""

SQL = {
    "payment_counts": f"""WITH {TOP_CODE_SQL}
SELECT member AS "memberId", code AS "paymentCode", counts FROM counted""",
    "top_payment_code": f"""WITH {TOP_CODE_SQL}
SELECT member AS "memberId", code AS "paymentCode", counts FROM best""",
    "preferred_payment": f"""WITH {PAYMENT_SQL}
SELECT user_id AS "userId", tags AS "tagIds" FROM payment""",
    "last_purchase_days": f"""WITH {rfm_sql(fixed.CYCLE_SHIFT_DAYS)}
SELECT member AS "userId", r AS days FROM rfm""",
    "rfm_features": f"""WITH {rfm_sql(fixed.RFM_SHIFT_DAYS)}
SELECT member AS "userId", r AS recency, f AS frequency, m AS monetary FROM rfm""",
    "rfm_scores": rfm_scores_sql(
        fixed.RFM_SHIFT_DAYS, fixed.RFM_RECENCY, fixed.RFM_FREQUENCY, fixed.RFM_MONETARY, False
    ),
    "rfm_scores_spread": rfm_scores_sql(0, *ORDER_BANDS.values(), True),
    "rfe_features": f"""WITH {RFE_SQL}
SELECT visitor AS "userId", r AS recency, f AS frequency, e AS engagements FROM rfe""",
    "rfe_scores": rfe_scores_sql(fixed.RFE_FREQUENCY, fixed.RFE_ENGAGEMENT, False),
    "rfe_scores_spread": rfe_scores_sql(src.VIEW_FREQUENCY, src.VIEW_ENGAGEMENT, True),
    "psm_features": f"""WITH {PSM_SQL}
SELECT member AS "userId", tdon, ton, tda, tra FROM psm""",
    "psm_score": f"""WITH {PSM_SQL}
SELECT member AS "userId",
       CAST(tdon AS DOUBLE) / ton + (tda / tdon) / (tra / ton) + tda / tra AS psm
FROM psm WHERE tdon > 0 AND ton > 0 AND tra <> 0""",
    "order_totals": f"""WITH {src.COUPONS_SQL}
SELECT member AS "userId", CAST(floor(epoch(max(finished))) AS BIGINT) AS "finishTime",
       count(sn) AS frequency, CAST(sum(pa) AS DOUBLE) AS monetary,
       CAST(count(CASE WHEN da <> 0 THEN 1 END) AS BIGINT) AS tdon, count(da) AS ton,
       CAST(sum(da) AS DOUBLE) AS tda, CAST(sum(pa + da) AS DOUBLE) AS tra
FROM coupon_orders GROUP BY member""",
    "usg_features": f"""WITH {ITEM_VOTES_SQL}
SELECT member AS "userId", color, product_type AS "productType", gender, count(*) AS n
FROM bought GROUP BY ALL""",
    "usg_vote_counts": f"""WITH {ITEM_VOTES_SQL}
SELECT member AS "userId", total, male, female FROM votes""",
    "usg_vote": f"""WITH {ITEM_VOTES_SQL}
SELECT CAST(member AS VARCHAR) AS "userId",
       CASE WHEN male / total >= 0.6 THEN '57' WHEN female / total >= 0.6 THEN '58' ELSE '59' END
         AS "tagIds"
FROM votes""",
    "product_views": f"""WITH {src.VIEWS_SQL}
SELECT {_PRODUCT} AS product_id, count(*) AS n FROM views GROUP BY 1""",
    "product_ratings": f"""WITH {src.VIEWS_SQL},
seen AS (SELECT visitor, {_PRODUCT} AS product FROM views)
SELECT CAST(visitor AS INTEGER) AS "userId", CAST(product AS INTEGER) AS "productId",
       CAST(count(*) AS DOUBLE) AS rating
FROM seen WHERE product IS NOT NULL GROUP BY 1, 2""",
}
