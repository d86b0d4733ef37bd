"""Job inputs derived from the given tables, each beside its SQL form.

The tables hold no users with genders, payment codes or page views, so these are computed from
the columns they do have; every frame grows with the table it comes from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed

AS_OF = "2001-08-01"
VIEWS_AS_OF = "2024-03-01"

# Score bands that spread over the values of the given tables.
ORDER_RECENCY = [(0, 60, 5), (61, 120, 4), (121, 240, 3), (241, 480, 2), (481, None, 1)]
ORDER_FREQUENCY = [(14, None, 5), (12, 13, 4), (10, 11, 3), (8, 9, 2), (1, 7, 1)]
ORDER_MONETARY = [
    (3500000, None, 5),
    (2800000, 3500000, 4),
    (2200000, 2800000, 3),
    (1500000, 2200000, 2),
    (None, 1500000, 1),
]
VIEW_FREQUENCY = [(75, None, 5), (68, 74, 4), (62, 67, 3), (56, 61, 2), (None, 55, 1)]
VIEW_ENGAGEMENT = [(54, None, 5), (51, 53, 4), (47, 50, 3), (43, 46, 2), (None, 42, 1)]

SEGMENT_RULES = [(353, "BUILDING"), (354, "FURNITURE"), (355, "MACHINERY")]
ALL_SEGMENT_RULES = [*SEGMENT_RULES, (356, "AUTOMOBILE"), (357, "HOUSEHOLD")]
PRIORITY_RULES = [(30, "1-URGENT"), (31, "2-HIGH"), (34, "3-MEDIUM"), (35, "other")]

# Product types standing for p_type; STANDARD has none.
PART_TYPES = {
    "PROMO": "料理机",
    "SMALL": "吸尘器/除螨仪",
    "MEDIUM": "挂烫机",
    "ECONOMY": "智能电视",
    "LARGE": "冰吧",
}

NATION_BASE, SUPPLIER_BASE = 100, 1000
MODEL_BASE, VALUE_BASE = 10_000_000_000, 20_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values_sql(rows: list[tuple], alias: str) -> str:
    """A VALUES list, e.g. `(VALUES (5, '1'), (6, '2')) AS rules(id, rule)`."""
    cells = ", ".join(
        "(" + ", ".join(f"'{c}'" if isinstance(c, str) else str(c) for c in row) + ")"
        for row in rows
    )
    return f"(VALUES {cells}) AS {alias}"


def list_sql(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def band_sql(value: str, bands: list[tuple]) -> str:
    """CASE expression with the meaning of `band_score`."""
    arms = []
    for low, high, points in bands:
        tests = [f"{value} >= {low}"] if low is not None else []
        tests += [f"{value} <= {high}"] if high is not None else []
        arms.append(f"WHEN {' AND '.join(tests)} THEN {points}")
    return f"CASE {' '.join(arms)} END"


# Users: one per customer.


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    days = (F.col("c_custkey") * 7 % 29200).cast("int")
    born = F.date_add(F.lit("1950-01-01").cast("date"), days)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        (nation % 2 + 1).cast("string").alias("gender"),
        (nation % 6 + 1).cast("string").alias("job"),
        nation.cast("string").alias("nationality"),
        F.col("c_mktsegment").alias("politicalFace"),
        F.when(nation != 24, F.date_format(born, "yyyy-MM-dd")).alias("birthday"),
    )


USERS_SQL = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CAST(c_nationkey % 2 + 1 AS VARCHAR) AS gender,
         CAST(c_nationkey % 6 + 1 AS VARCHAR) AS job,
         CAST(c_nationkey AS VARCHAR) AS nationality,
         c_mktsegment AS "politicalFace",
         CASE WHEN c_nationkey <> 24
              THEN strftime(DATE '1950-01-01' + CAST(c_custkey * 7 % 29200 AS INTEGER), '%Y-%m-%d')
         END AS birthday
  FROM customer)"""


# Orders, with a payment code per order priority: one code has no rule, one is missing.


def payment_code() -> Column:
    priority = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(priority == "1", "alipay")
        .when(priority == "2", "wxpay")
        .when(priority == "3", "cod")
        .when(priority == "4", "bank")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("memberId"),
        F.col("o_orderkey").alias("orderSn"),
        F.col("o_totalprice").alias("orderAmount"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("finishTime"),
        payment_code().alias("paymentCode"),
    )


ORDERS_SQL = """orders_in AS (
  SELECT o_custkey AS member, o_orderkey AS sn, o_totalprice AS amount,
         CAST(o_orderdate AS DATE) AS finished,
         CASE substr(o_orderpriority, 1, 1)
              WHEN '1' THEN 'alipay' WHEN '2' THEN 'wxpay' WHEN '3' THEN 'cod' WHEN '4' THEN 'bank'
         END AS code
  FROM orders)"""


# Orders with the discount of their lines as coupon value.


def hundredths(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def coupon_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    saved = F.sum(hundredths("l_extendedprice") * hundredths("l_discount"))
    coupons = lines.groupBy("l_orderkey").agg(saved.alias("units"))
    joined = orders(spark, sf_dir).join(coupons, F.col("orderSn") == F.col("l_orderkey"), "left")
    return joined.select(
        "memberId",
        "orderSn",
        "orderAmount",
        "finishTime",
        (F.coalesce("units", F.lit(0)) / 10_000.0).alias("couponCodeValue"),
    )


COUPONS_SQL = """coupon_orders AS (
  SELECT o_custkey AS member, o_orderkey AS sn, o_orderdate AS finished,
         CAST(o_totalprice AS DECIMAL(18,4)) AS pa, coalesce(da, 0) AS da
  FROM orders LEFT JOIN (
    SELECT l_orderkey,
           SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS da
    FROM lineitem GROUP BY l_orderkey) AS c ON o_orderkey = l_orderkey)"""


# Order items: brand number as colour, part type as product type.


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    colours = F.array(*[F.lit(c) for c in fixed.COLOUR_CODES])
    kind = F.lit(None).cast("string")
    for part_type, name in PART_TYPES.items():
        kind = F.when(F.col("p_type") == part_type, name).otherwise(kind)
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.coalesce(F.get(colours, brand), "p_brand").alias("ogColor"),
        F.coalesce(kind, "p_type").alias("productType"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("cOrderSn"),
        "ogColor",
        "productType",
        F.col("l_linenumber").alias("itemId"),
    )


_TYPE_ARMS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PART_TYPES.items())
ITEMS_SQL = f"""items AS (
  SELECT l_orderkey AS sn,
         coalesce({list_sql(fixed.COLOUR_CODES)}[CAST(split_part(p_brand, '#', 2) AS INTEGER) + 1],
                  p_brand) AS colour,
         CASE p_type {_TYPE_ARMS} ELSE p_type END AS kind
  FROM lineitem JOIN part ON l_partkey = p_partkey),
coded AS (
  SELECT sn, coalesce(c.code, 0) AS color, coalesce(t.code, 0) AS product_type,
         CASE WHEN colour IN (SELECT unnest({list_sql(fixed.FEMALE_COLOURS)}))
                OR kind IN (SELECT unnest({list_sql(fixed.FEMALE_TYPES)}))
              THEN 1 ELSE 0 END AS gender
  FROM items
  LEFT JOIN {values_sql(list(fixed.COLOUR_CODES.items()), 'c(name, code)')} ON colour = c.name
  LEFT JOIN {values_sql(list(fixed.TYPE_CODES.items()), 't(name, code)')} ON kind = t.name)"""


# Page views: the `k` of an event names the product seen; errors show a help page.


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1)
    folder = F.when(F.col("event_type") == "error", "/help/").otherwise("/product/")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("global_user_id"),
        F.concat(F.lit("http://www.shop.example"), folder, k, F.lit(".html")).alias("loc_url"),
        F.col("ts").alias("log_time"),
    )


VIEWS_SQL = """views AS (
  SELECT user_id AS visitor,
         'http://www.shop.example'
           || CASE WHEN event_type = 'error' THEN '/help/' ELSE '/product/' END
           || regexp_extract(props, '([0-9]+)', 1) || '.html' AS url,
         CAST(ts AS DATE) AS day
  FROM events)"""


# Stored profile: one row per customer and per supplier, some of them blank. Customers in debt are
# stored under another key, so that outer joins have something to miss on both sides.


def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = F.col("c_nationkey") % 5
    tags = F.when(pick == 1, "  ").when(pick == 2, "23,30").when(pick == 3, "30")
    key = F.col("c_custkey").cast("string")
    known = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= 0, key).otherwise(F.concat(F.lit("d"), key)).alias("userId"),
        tags.when(pick == 4, "30,5,23,").alias("tagIds"),
    )
    shops = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("userId"),
        F.concat(F.lit("9,"), F.col("s_nationkey")).alias("tagIds"),
    )
    return known.unionByName(shops)


STORED_SQL = """stored AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN '' ELSE 'd' END || c_custkey AS user_id,
         CASE c_nationkey % 5 WHEN 1 THEN '  ' WHEN 2 THEN '23,30' WHEN 3 THEN '30'
              WHEN 4 THEN '30,5,23,' END AS tags
  FROM customer
  UNION ALL
  SELECT 's' || s_suppkey, '9,' || s_nationkey FROM supplier)"""


def tag_list_sql(*texts: str) -> str:
    """SQL for the sorted comma list of all tags in the given comma lists."""
    lists = texts[0] if len(texts) == 1 else " || ',' || ".join(f"coalesce({t}, '')" for t in texts)
    pieces = f"[x FOR x IN string_split({lists}, ',') IF trim(x) <> '']"
    return f"nullif(array_to_string(list_sort(list_distinct({pieces})), ','), '')"


# Tag catalogue: regions, nations and suppliers as categories, a model tag for each part below
# the part's first supplier, and two value tags below each model tag.


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    none, long = F.lit(None).cast("string"), "long"

    def rows(df: DataFrame, id_: Column, name: str, rule: Column, level: int, pid: Column):
        return df.select(
            id_.cast(long).alias("id"),
            F.col(name).alias("name"),
            rule.alias("rule"),
            F.lit(level).alias("level"),
            pid.cast(long).alias("pid"),
        )

    regions = rows(
        table(spark, sf_dir, "region"), F.col("r_regionkey") + 1, "r_name", none, 1, F.lit(-1)
    )
    nations = rows(
        table(spark, sf_dir, "nation"),
        F.col("n_nationkey") + NATION_BASE,
        "n_name",
        none,
        2,
        F.col("n_regionkey") + 1,
    )
    suppliers = rows(
        table(spark, sf_dir, "supplier"),
        F.col("s_suppkey") + SUPPLIER_BASE,
        "s_name",
        none,
        3,
        F.col("s_nationkey") + NATION_BASE,
    )
    first = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min("l_suppkey").alias("supplier")
    )
    parts = table(spark, sf_dir, "part")
    parts = parts.join(first, F.col("p_partkey") == F.col("l_partkey"), "left")
    supplier = F.coalesce("supplier", F.lit(0))
    source = F.concat(
        F.lit("inType=HBase##zkHosts=zk"),
        supplier,
        F.lit("##zkPort=2181##hbaseTable=tbl_"),
        F.lower("p_type"),
        F.lit("##family=detail##selectFields=id,size=>"),
        F.col("p_size"),
        F.when(F.col("p_size") % 2 == 0, "##rowKey=id").otherwise(""),
    )
    models = rows(
        parts, F.col("p_partkey") + MODEL_BASE, "p_name", source, 4, supplier + SUPPLIER_BASE
    )
    halves = table(spark, sf_dir, "part").withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
    size = F.col("p_size")
    band = F.when(F.col("half") == 0, F.concat(F.lit("0-"), size)).otherwise(
        F.concat(size + 1, F.lit("-99"))
    )
    values = rows(
        halves,
        F.col("p_partkey") * 2 + F.col("half") + VALUE_BASE,
        "p_brand",
        band,
        5,
        F.col("p_partkey") + MODEL_BASE,
    )
    return reduce(DataFrame.unionByName, (regions, nations, suppliers, models, values))


CATALOGUE_SQL = f"""first_supplier AS (
  SELECT l_partkey, min(l_suppkey) AS supplier FROM lineitem GROUP BY l_partkey),
catalogue AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS name, CAST(NULL AS VARCHAR) AS rule,
         1 AS level, CAST(-1 AS BIGINT) AS pid FROM region
  UNION ALL SELECT n_nationkey + {NATION_BASE}, n_name, NULL, 2, n_regionkey + 1 FROM nation
  UNION ALL SELECT s_suppkey + {SUPPLIER_BASE}, s_name, NULL, 3, s_nationkey + {NATION_BASE}
  FROM supplier
  UNION ALL SELECT p_partkey + {MODEL_BASE}, p_name,
         'inType=HBase##zkHosts=zk' || coalesce(supplier, 0) || '##zkPort=2181##hbaseTable=tbl_'
           || lower(p_type) || '##family=detail##selectFields=id,size=>' || p_size
           || CASE WHEN p_size % 2 = 0 THEN '##rowKey=id' ELSE '' END,
         4, coalesce(supplier, 0) + {SUPPLIER_BASE}
  FROM part LEFT JOIN first_supplier ON p_partkey = l_partkey
  UNION ALL SELECT p_partkey * 2 + {VALUE_BASE}, p_brand, '0-' || p_size, 5,
         p_partkey + {MODEL_BASE} FROM part
  UNION ALL SELECT p_partkey * 2 + 1 + {VALUE_BASE}, p_brand, (p_size + 1) || '-99', 5,
         p_partkey + {MODEL_BASE} FROM part)"""


# Model catalogue: each part has a model, run every p_size minutes while the part ships.


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("timestamp")
    span = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min(shipped).alias("start"), F.max(shipped).alias("end")
    )
    parts = table(spark, sf_dir, "part")
    text = F.concat_ws(
        ",",
        F.col("p_size").cast("string"),
        F.date_format("start", fixed.SCHEDULE_FORMAT),
        F.date_format("end", fixed.SCHEDULE_FORMAT),
    )
    return parts.join(span, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") + MODEL_BASE).alias("tag_id"),
        F.col("p_name").alias("model_name"),
        F.col("p_size").alias("freq"),
        text.alias("sche_time"),
    )


MODELS_SQL = f"""models AS (
  SELECT p_partkey AS id, p_partkey + {MODEL_BASE} AS tag_id, p_name AS model_name,
         p_size AS freq, starts, ends,
         p_size || ',' || strftime(starts, '%Y-%m-%d %H:%M:%S') || ','
           || strftime(ends, '%Y-%m-%d %H:%M:%S') AS sche_time
  FROM part JOIN (SELECT l_partkey, min(l_shipdate) AS starts, max(l_shipdate) AS ends
                  FROM lineitem GROUP BY l_partkey) AS s ON p_partkey = l_partkey)"""


# Paths of category names, partly in the catalogue.


def tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    fresh = F.col("n_nationkey") % 7 == 0
    return joined.select(
        F.when(fresh, F.concat(F.lit("NEW "), "r_name")).otherwise(F.col("r_name")).alias("level1"),
        F.col("n_name").alias("level2"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("level3"),
    )


PATHS_SQL = """paths AS (
  SELECT CASE WHEN n_nationkey % 7 = 0 THEN 'NEW ' || r_name ELSE r_name END AS level1,
         n_name AS level2, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS level3
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
