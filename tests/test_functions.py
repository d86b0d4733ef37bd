from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions import measures, rules, text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return df.select(column).first()[0]


def test_rule_options(spark):
    rule = "inType=HBase##zkHosts=10.0.0.1##zkPort=2181##selectFields=id,job##q=a=b##flag##zkPort=9"
    options = one(spark, rules.rule_options(F.lit(rule)))
    assert options["selectFields"] == "id,job"
    assert options["q"] == "a=b"
    assert options["flag"] is None
    assert options["zkPort"] == "9"


def test_option_default(spark):
    options = rules.rule_options(F.lit("a=1"))
    assert one(spark, rules.option(options, "a")) == "1"
    assert one(spark, rules.option(options, "b")) is None
    assert one(spark, rules.option(options, "b", "")) == ""


def test_band_ends(spark):
    rule = F.lit("19500101-19591231")
    assert one(spark, rules.band_start(rule)) == "19500101"
    assert one(spark, rules.band_end(rule)) == "19591231"


def test_compact_date(spark):
    assert one(spark, text.compact_date(F.lit("1992-05-31"))) == "19920531"


@pytest.mark.parametrize(
    "value, blank", [(None, True), ("", True), (" \t ", True), ("\n", True), (" a ", False)]
)
def test_is_blank(spark, value, blank):
    assert one(spark, text.is_blank(F.lit(value).cast("string"))) is blank


@pytest.mark.parametrize(
    "url, product",
    [
        ("http://shop.example/product/11013.html", "11013"),
        ("http://shop.example/mobile/item/11941.html", None),
        ("http://shop.example/product/11013", None),
        ("http://shop.example/a.html?to=/product/7", None),
        ("http://shop.example/product/.html", ""),
        ("http://shop.example/product/1.html/product/2.html", "1"),
        (None, None),
    ],
)
def test_product_id(spark, url, product):
    assert one(spark, text.product_id(F.lit(url).cast("string"))) == product


def test_id_list(spark):
    best = spark.sql(
        "SELECT array(struct(10935 AS productId, .85 AS rating), "
        "struct(6603 AS productId, .83 AS rating)) AS r"
    )
    assert best.select(text.id_list(F.col("r"), "productId")).first()[0] == "10935,6603"


def test_merge_tags_is_a_set_union(spark):
    def expected(new, old):
        tags = {t for part in (new, old) for t in (part or "").split(",") if t.strip()}
        return ",".join(sorted(tags)) or None

    texts = [None, "", "  ", "10", "23,30", "30,5,23", "10,10", "5,,6", "\t"]
    rows = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(rows, "a string, b string")
    merged = df.select("a", "b", text.merge_tags(F.col("a"), F.col("b")).alias("m")).collect()
    assert [r["m"] for r in merged] == [expected(r["a"], r["b"]) for r in merged]


def test_money_is_exact_and_null_for_text(spark):
    df = spark.createDataFrame([("0.10",), ("0.20",), ("x",), (None,)], "a string")
    total = df.select(measures.as_double(F.sum(measures.money(F.col("a"))))).first()[0]
    assert total == 0.3


def test_money_keeps_small_and_large_amounts(spark):
    texts = ["0.00004", "1e15", "0.12345", "1000000000000000"]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    amounts = [r[0] for r in df.select(measures.money(F.col("a"))).collect()]
    assert [float(a) for a in amounts] == [float(t) for t in texts] and all(amounts)
    doubles = df.select(measures.money(F.col("a").cast("double"))).collect()
    assert [float(r[0]) for r in doubles] == [float(t) for t in texts]


def test_epoch_in_microseconds_is_null(spark):
    rows = [(1_569_888_000,), (1_569_888_000_000_000,), (None,), (-(10**17),)]
    df = spark.createDataFrame(rows, "s long")
    days = measures.days_since_epoch_seconds(F.col("s"), "2019-10-02")
    assert [r[0] for r in df.select(days).collect()] == [1, None, None, None]


def test_days_since(spark):
    as_of = date(2019, 11, 1)
    seconds = F.unix_timestamp(F.lit("2019-08-01 23:59:59").cast("timestamp"))
    assert one(spark, measures.days_since_epoch_seconds(seconds, as_of, 90)) == 2
    moment = F.lit("2019-07-29 15:07:41").cast("timestamp")
    assert one(spark, measures.days_since_timestamp(moment, "2019-11-01", 80)) == 15
    now = F.unix_timestamp(F.current_timestamp())
    assert one(spark, measures.days_since_epoch_seconds(now)) == 0


@pytest.mark.parametrize(
    "bands, scores",
    [
        (fixed.RFM_RECENCY, {0: None, 1: 5, 3: 5, 4: 4, 9: 3, 15: 2, 16: 1, 900: 1, None: None}),
        (fixed.RFM_FREQUENCY, {0: None, 1: 1, 49: 1, 50: 2, 199: 4, 200: 5}),
        (fixed.RFM_MONETARY, {9999: 1, 9999.5: None, 10000: 2, 99999.5: None, 200000: 5}),
        (fixed.RFE_RECENCY, {-1: None, 0: 5, 15: 5, 60: 2, 61: 1}),
        (fixed.RFE_FREQUENCY, {0: 1, 99: 1, 100: 2, 400: 5}),
        (fixed.RFE_ENGAGEMENT, {49: 1, 50: 2, 149: 2, 150: 3, 210: 4, 250: 5}),
    ],
)
def test_band_score(spark, bands, scores):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in scores], "v double")
    found = df.select(measures.band_score(F.col("v"), bands)).collect()
    assert [r[0] for r in found] == list(scores.values())


@pytest.mark.parametrize(
    "tdon, ton, tda, tra, psm",
    [
        (3, 142, 500.0, 252430.92, 0.11686252330855691),
        (4, 116, 800.0, 180098.34, 0.16774328728519597),
        (0, 113, 0.0, 205931.91, None),
    ],
)
def test_price_sensitivity(spark, tdon, ton, tda, tra, psm):
    found = one(spark, measures.price_sensitivity(*[F.lit(v) for v in (tdon, ton, tda, tra)]))
    assert found == (psm if psm is None else pytest.approx(psm, rel=1e-12))


@pytest.mark.parametrize(
    "total, male, female, code",
    [(5, 3, 2, "0"), (6, 4, 2, "0"), (5, 2, 3, "1"), (4, 2, 2, "-1"), (0, 0, 0, "-1")],
)
def test_majority_rule(spark, total, male, female, code):
    columns = [F.lit(float(v)) for v in (total, male, female)]
    assert one(spark, measures.majority_rule(*columns, 0.6)) == code


# Properties, each example a whole column of values.

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def between_marks(url):
    """The product id by its definition."""
    if url is None or "/product/" not in url or ".html" not in url:
        return None
    start, end = url.index("/product/"), url.index(".html")
    return url[start + len("/product/") : end] if end > start else None


pieces = st.sampled_from(["/product/", ".html", "7", "a", "/", "é", "/product", "html"])
urls = st.lists(st.one_of(st.none(), st.lists(pieces, max_size=7).map("".join)), min_size=60)


@FEW
@given(urls)
def test_product_id_by_definition(spark, values):
    assert column(spark, values, "string", text.product_id) == [between_marks(v) for v in values]


tag_texts = st.lists(st.sampled_from(["1", "22", "3", ""]), max_size=5).map(",".join)
tag_pairs = st.lists(st.tuples(tag_texts, tag_texts), min_size=60)


@FEW
@given(tag_pairs)
def test_merging_twice_changes_nothing(spark, values):
    df = spark.createDataFrame(values, "a string, b string")
    merged = df.withColumn("m", text.merge_tags(F.col("a"), F.col("b")))
    again = merged.select("m", text.merge_tags(F.col("m"), F.col("a")).alias("n")).collect()
    swapped = merged.select("m", text.merge_tags(F.col("b"), F.col("a")).alias("n")).collect()
    assert all(r["m"] == r["n"] for r in again + swapped)


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-5, 500)), min_size=60))
def test_band_score_by_definition(spark, values):
    def score(value):
        if value is None:
            return None
        for low, high, points in fixed.RFE_FREQUENCY:
            inside = (low is None or value >= low) and (high is None or value <= high)
            if inside:
                return points
        return None

    found = column(spark, values, "long", lambda v: measures.band_score(v, fixed.RFE_FREQUENCY))
    assert found == [score(v) for v in values]
