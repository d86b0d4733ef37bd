"""Queries for rules, sources, lookups and matching jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.rules import option, rule_options
from tagloom.operators.lookup import attach_band_tags, attach_tags
from tagloom.plans import tag_jobs
from tagloom.sources.readers import read_source, source_descriptor
from tagloom.workload import inputs as src


def kv_rule_parse(spark, sf_dir):
    """every level-4 rule as a map, its seven settings and a default."""
    rules = src.catalogue(spark, sf_dir).where("level = 4")
    parsed = rules.select("id", rule_options(F.col("rule")).alias("options"))
    settings = source_descriptor(F.col("options"), default="")
    full = parsed.select("id", settings.alias("s"), option(F.col("options"), "path").alias("p"))
    return full.select(
        "id",
        F.col("s.inType").alias("in_type"),
        F.col("s.zkHosts").alias("zk_hosts"),
        F.col("s.hbaseTable").alias("source_table"),
        F.col("s.selectFields").alias("fields"),
        F.col("s.rowKey").alias("row_key"),
        F.col("p").isNull().alias("no_path"),
    )


def rules_of_models(spark, sf_dir):
    """The level-5 rules of every level-4 tag, with its source rule."""
    tags = src.catalogue(spark, sf_dir)
    model = tags.where("level = 4").select(
        F.col("id").alias("tag_id"), F.col("rule").alias("source")
    )
    value = tags.where("level = 5").select("id", "rule", "pid")
    return model.join(value, F.col("tag_id") == F.col("pid")).drop("pid")


def source_by_rule(spark, sf_dir):
    """A source opened by rule, all strings, an absent field as null."""
    rule = {
        "inType": "parquet",
        "path": f"{sf_dir}/customer.parquet",
        "selectFields": "c_custkey,c_name,c_phone",
    }
    df = read_source(spark, rule)
    return df.select(F.col("c_custkey").alias("userId"), "c_name", "c_phone")


def second_source(spark, sf_dir):
    """Orders opened by a second rule next to their lines."""
    lines = read_source(
        spark,
        {
            "inType": "parquet",
            "path": f"{sf_dir}/lineitem.parquet",
            "selectFields": "l_orderkey,l_linenumber",
        },
    )
    orders = read_source(
        spark,
        {
            "inType": "parquet",
            "path": f"{sf_dir}/orders.parquet",
            "selectFields": "o_orderkey,o_custkey",
        },
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_custkey").agg(F.count("l_linenumber").alias("lines"))


def match_strict(spark, sf_dir):
    """Every segment has a rule."""
    users = src.users(spark, sf_dir)
    return attach_tags(users, src.ALL_SEGMENT_RULES, "politicalFace", unmatched="error")


def match_drop(spark, sf_dir):
    """J4."""
    return attach_tags(src.users(spark, sf_dir), src.SEGMENT_RULES, "politicalFace")


def match_blank(spark, sf_dir):
    """J2, T5."""
    return tag_jobs.political_face_tags(src.users(spark, sf_dir), src.SEGMENT_RULES)


def match_default(spark, sf_dir):
    """J3."""
    users = src.users(spark, sf_dir)
    rules = [*src.SEGMENT_RULES, (359, "other")]
    return attach_tags(users, rules, "politicalFace", unmatched="default")


def gender_tags(spark, sf_dir):
    """T1, T2."""
    return tag_jobs.gender_tags(src.users(spark, sf_dir))


def job_tags(spark, sf_dir):
    """T3 before merging."""
    return tag_jobs.job_tags(src.users(spark, sf_dir))


def nationality_tags(spark, sf_dir):
    """T4 before merging."""
    return tag_jobs.nationality_tags(src.users(spark, sf_dir))


def age_band(spark, sf_dir):
    """F3, F4, J5."""
    return tag_jobs.age_tags(src.users(spark, sf_dir))


def purchase_cycle(spark, sf_dir):
    """A1, F6, J6."""
    return tag_jobs.cycle_tags(src.orders(spark, sf_dir), as_of=src.AS_OF)


def part_size_bands(spark, sf_dir):
    """J6 with a rule frame that grows with the data: parts in the size bands of all parts."""
    parts = src.table(spark, sf_dir, "part").withColumn("id", F.col("p_partkey"))
    bands = src.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.concat_ws(
            "-",
            (F.col("s_suppkey") * 13).cast("string"),
            (F.col("s_suppkey") * 13 + 5 + F.col("s_nationkey")).cast("string"),
        ).alias("rule"),
    )
    tagged = attach_band_tags(parts, bands, F.col("p_partkey"), numeric=True)
    return tagged.select("userId", "tagIds")


QUERIES = {
    f.__name__: f
    for f in (
        kv_rule_parse,
        rules_of_models,
        source_by_rule,
        second_source,
        match_strict,
        match_drop,
        match_blank,
        match_default,
        gender_tags,
        job_tags,
        nationality_tags,
        age_band,
        purchase_cycle,
        part_size_bands,
    )
}


def equal_match_sql(column: str, rules: list[tuple], tag: str, join: str = "JOIN") -> str:
    return f"""WITH {src.USERS_SQL}
SELECT users.id AS "userId", {tag} AS "tagIds"
FROM users {join} {src.values_sql(rules, 'r(id, rule)')} ON users."{column}" = r.rule"""


_TAG = "CAST(r.id AS VARCHAR)"
_SETTING = "coalesce(nullif(regexp_extract(rule, '(^|##){0}=(.*?)(##|$)', 2), ''), '')"

SQL = {
    "kv_rule_parse": f"""WITH {src.CATALOGUE_SQL}
SELECT id, {_SETTING.format('inType')} AS in_type, {_SETTING.format('zkHosts')} AS zk_hosts,
       {_SETTING.format('hbaseTable')} AS source_table, {_SETTING.format('selectFields')} AS fields,
       {_SETTING.format('rowKey')} AS row_key, NOT contains(rule, '##path=') AS no_path
FROM catalogue WHERE level = 4""",
    "rules_of_models": f"""WITH {src.CATALOGUE_SQL}
SELECT m.id AS tag_id, m.rule AS source, v.id AS id, v.rule AS rule
FROM catalogue m JOIN catalogue v ON v.pid = m.id WHERE m.level = 4 AND v.level = 5""",
    "source_by_rule": """SELECT CAST(c_custkey AS VARCHAR) AS "userId", c_name,
       CAST(NULL AS VARCHAR) AS c_phone FROM customer""",
    "second_source": """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "match_strict": equal_match_sql("politicalFace", src.ALL_SEGMENT_RULES, _TAG),
    "match_drop": equal_match_sql("politicalFace", src.SEGMENT_RULES, _TAG),
    "match_blank": equal_match_sql(
        "politicalFace", src.SEGMENT_RULES, f"coalesce({_TAG}, '')", "LEFT JOIN"
    ),
    "match_default": equal_match_sql(
        "politicalFace", src.SEGMENT_RULES, f"coalesce({_TAG}, '359')", "LEFT JOIN"
    ),
    "gender_tags": equal_match_sql("gender", fixed.GENDER_RULES, _TAG),
    "job_tags": equal_match_sql("job", fixed.JOB_RULES, _TAG),
    "nationality_tags": equal_match_sql("nationality", fixed.NATIONALITY_RULES, _TAG),
    "age_band": f"""WITH {src.USERS_SQL}
SELECT users.id AS "userId", CAST(r.id AS VARCHAR) AS "tagIds"
FROM users JOIN {src.values_sql(fixed.AGE_RULES, 'r(id, rule)')}
  ON replace(birthday, '-', '') BETWEEN split_part(rule, '-', 1) AND split_part(rule, '-', 2)""",
    "purchase_cycle": f"""WITH {src.ORDERS_SQL},
gaps AS (
  SELECT member,
         date_diff('day', max(finished), DATE '{src.AS_OF}' - {fixed.CYCLE_SHIFT_DAYS}) AS days
  FROM orders_in GROUP BY member)
SELECT CAST(member AS VARCHAR) AS "userId", CAST(r.id AS VARCHAR) AS "tagIds"
FROM gaps JOIN {src.values_sql(fixed.CYCLE_RULES, 'r(id, rule)')}
  ON days BETWEEN CAST(split_part(rule, '-', 1) AS INTEGER)
              AND CAST(split_part(rule, '-', 2) AS INTEGER)""",
    "part_size_bands": """SELECT CAST(p_partkey AS VARCHAR) AS "userId",
       CAST(s_suppkey AS VARCHAR) AS "tagIds"
FROM part JOIN supplier ON p_partkey BETWEEN s_suppkey * 13 AND s_suppkey * 13 + 5 + s_nationkey""",
}
