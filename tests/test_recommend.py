import numpy as np
from pyspark.sql import functions as F

from tagloom.operators import recommend
from tagloom.operators.aggregates import product_ratings
from tagloom.plans import tag_jobs


def views(spark):
    product = (F.col("id") % 30 + F.pmod(F.xxhash64("id"), F.lit(4)) * 30).cast("int")
    return spark.range(4000).select(
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)).cast("string").alias("global_user_id"),
        F.concat(F.lit("http://shop.example/product/"), product, F.lit(".html")).alias("loc_url"),
    )


def test_top_products_against_all_scores(spark):
    model = recommend.fit_preferences(product_ratings(views(spark)))
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    products = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    stored = recommend.stored_model(model)
    found = {r["userId"]: r["tagIds"].split(",") for r in recommend.top_products(stored).collect()}
    assert set(found) == {str(u) for u in users}
    for user, factors in users.items():
        scores = {p: float(factors @ f) for p, f in products.items()}
        best = sorted(scores.values(), reverse=True)[:5]
        assert np.allclose([scores[int(p)] for p in found[str(user)]], best, rtol=1e-4)


def test_brand_tags(spark):
    rows = tag_jobs.brand_tags(views(spark)).collect()
    assert len(rows) == 50
    assert all(len(set(r["tagIds"].split(","))) == 5 for r in rows)


def test_stripes_find_the_best_and_skip_pairs(spark):
    """Long products first: the same lists as by all pairs, from fewer pairs; ties and short lists too."""
    rng = np.random.default_rng(3)
    users = rng.normal(size=(150, 8)).astype(np.float32)
    products = (rng.normal(size=(700, 8)) * rng.exponential(size=(700, 1)) ** 2).astype(np.float32)
    products[10:14] = products[9]
    users[5] = 0

    def frame(rows):
        return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "id int, features array<float>").repartition(3)

    best, pairs = recommend.best_inner_products(frame(users), frame(products), n=5, first=16)
    scores = users.astype(float) @ products.astype(float).T
    found = {r["id"]: [b["product"] for b in r["best"]] for r in best.collect()}
    assert len(found) == 150 and pairs < 0.6 * scores.size
    for user, ids in found.items():
        assert len(set(ids)) == 5
        assert np.allclose(scores[user, ids], np.sort(scores[user])[::-1][:5], rtol=1e-4, atol=1e-4)
    few, _ = recommend.best_inner_products(frame(users), frame(products[:3]), n=5, first=2)
    assert {len(r["best"]) for r in few.collect()} == {3}
    assert recommend.best_inner_products(frame(users).limit(0), frame(products))[0].count() == 0


def test_equal_and_nearly_equal_scores(spark):
    """Exact scores decide where single precision cannot tell, and of equal scores the smaller ids, however many there are."""
    one, step = np.float32(1), np.float32(2.0**-24)
    vectors = {i: [one, step * (i % 7)] for i in range(100, 160)}
    vectors |= {i: [one, step * 6] for i in range(300, 200, -1)} | {i: [step, one] for i in range(400, 440)}
    products = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "id int, features array<float>")
    users = {1: [1.0, 1.0], 2: [1.0, 0.0], 3: [0.0, 0.0], 4: [1.0, 1.0], 5: [-1.0, -1.0]}
    frame = spark.createDataFrame(list(users.items()), "id int, features array<float>").repartition(2)
    for first in (16, 4_096):
        best, _ = recommend.best_inner_products(frame, products.repartition(3), n=5, first=first)
        found = {r["id"]: [b["product"] for b in r["best"]] for r in best.collect()}
        for user, (a, b) in users.items():
            scores = {i: a * float(v[0]) + b * float(v[1]) for i, v in vectors.items()}
            assert found[user] == sorted(vectors, key=lambda i: (-scores[i], i))[:5]
