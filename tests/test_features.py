import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import aggregates as agg

DAY = 24 * 3600
NEW_YEAR = 1577836800  # 2020-01-01


def test_rfm_scores(spark, pairs):
    features = spark.createDataFrame(
        [("13822725", 7, 116, 179298.34), ("13823083", 7, 132, 233524.17), ("x", 0, 5, 1.0)],
        "userId string, recency int, frequency long, monetary double",
    )
    assert pairs(agg.rfm_scores(features)) == {("13822725", 3, 3, 4), ("13823083", 3, 3, 5)}


def test_rfe_scores(spark, pairs):
    features = spark.createDataFrame(
        [("296", 18, 380, 227), ("467", 18, 405, 267), ("853", 18, 388, 252)],
        "userId string, recency int, frequency long, engagements long",
    )
    assert pairs(agg.rfe_scores(features)) == {
        ("296", 4, 4, 4),
        ("467", 4, 5, 5),
        ("853", 4, 4, 5),
    }


def test_rfm_features_from_text(frame, pairs):
    orders = frame(
        "memberId,orderSn,orderAmount,finishTime",
        [
            ("1", "a", "10.10", str(NEW_YEAR - 99 * DAY)),
            ("1", "b", "20.20", str(NEW_YEAR - 9 * DAY)),
            ("1", None, "x", "99"),
            ("2", "c", "5", None),
        ],
    )
    found = agg.rfm_features(orders, as_of="2020-03-31", shift_days=90)
    assert pairs(found) == {("1", 9, 2, 30.3), ("2", None, 1, 5.0)}


def test_rfe_features(frame, pairs):
    views = frame(
        "global_user_id,loc_url,log_time",
        [
            ("7", "u1", "2019-08-13 03:03:55"),
            ("7", "u1", "2019-08-14 23:59:59"),
            ("7", "u2", "broken"),
            ("8", None, "2019-08-01 00:00:00"),
        ],
    )
    found = agg.rfe_features(views, as_of="2019-11-04", shift_days=80)
    assert pairs(found) == {("7", 2, 3, 2), ("8", 15, 0, 0)}


def test_most_frequent_code(frame, pairs):
    rows = [("1", code) for code in "baab"] + [("2", None), ("2", None), ("2", "z"), ("3", None)]
    orders = frame("memberId,paymentCode", rows)
    assert pairs(agg.most_frequent_code(orders)) == {("1", "a", 2), ("2", "z", 1), ("3", None, 0)}


def test_most_frequent_code_of_a_hot_member_against_brute_force(spark, pairs):
    draw = random.Random(5)
    rows = [
        ("hot" if draw.random() < 0.4 else str(draw.randrange(40)), f"c{draw.randrange(6)}")
        for _ in range(4000)
    ]
    counts = {}
    for row in rows:
        counts[row] = counts.get(row, 0) + 1
    best = {}
    for (user, code), n in counts.items():
        best[user] = min(best.get(user, (0, "~")), (-n, code))
    df = spark.createDataFrame(rows, "memberId string, paymentCode string")
    found = agg.most_frequent_code(df)
    assert pairs(found) == {(u, code, -n) for u, (n, code) in best.items()}
    # One rank filter before the shuffle by member and one after.
    plan = agg.most_frequent_code(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def psm_orders(frame):
    return frame(
        "memberId,orderAmount,couponCodeValue",
        [
            ("1", "80.00", "20.00"),
            ("1", "100.00", "0.00"),
            ("1", "50", None),
            ("2", "7.0", "0"),
            ("3", "oops", "1"),
        ],
    )


def test_psm_features(frame, pairs):
    assert pairs(agg.psm_features(psm_orders(frame))) == {
        ("1", 1, 2, 20.0, 200.0),
        ("2", 0, 1, 0.0, 7.0),
        ("3", 1, 1, 1.0, None),
    }


def test_psm_scores(frame):
    features = agg.psm_features(psm_orders(frame))
    found = {r["userId"]: r["psm"] for r in agg.psm_scores(features).collect()}
    assert found == {"1": pytest.approx(0.5 + 20 / 100 + 0.1)}
    kept = {r["userId"]: r["psm"] for r in agg.psm_scores(features, 0.00001).collect()}
    assert set(kept) == {"1", "2"} and kept["2"] == pytest.approx(0.00001)


def test_product_ratings(frame, pairs):
    page = "http://shop.example/product/{}.html".format
    views = frame(
        "global_user_id,loc_url",
        [
            ("81", page(11013)),
            ("81", page(11013)),
            ("302", page(5353)),
            ("302", "http://shop.example/"),
            ("302", page("")),
            ("302", page("abc")),
            ("guest", page(1)),
            ("9", page(2**31)),
            ("9", None),
        ],
    )
    assert pairs(agg.product_ratings(views)) == {(81, 11013, 2.0), (302, 5353, 1.0)}


def test_sums_do_not_depend_on_partitioning(spark):
    rows = spark.range(5000).select(
        F.lit("1").alias("memberId"),
        F.col("id").alias("orderSn"),
        (F.col("id") * 0.01).alias("orderAmount"),
        F.lit(NEW_YEAR).alias("finishTime"),
    )
    found = {
        agg.rfm_features(rows.repartition(n), "2020-03-31").first()["monetary"] for n in (1, 3, 16)
    }
    assert found == {sum(range(5000)) / 100}
