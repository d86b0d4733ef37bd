"""Queries for merging, upserting and running whole tag jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.operators import aggregates as agg
from tagloom.operators.lookup import Match, attach_all_tags
from tagloom.operators.merge import merge_profiles, one_row_per_user, upsert
from tagloom.plans import tag_jobs
from tagloom.plans.template import run_tag_job
from tagloom.session import cut_lineage, scratch_path
from tagloom.sources.buckets import create_store
from tagloom.sources.readers import read_profile, read_source
from tagloom.sources.writers import write_source
from tagloom.workload import inputs as src
from tagloom.workload import matching
from tagloom.workload.features import PAYMENT_SQL
from tagloom.workload.matching import equal_match_sql


def _payment(spark, sf_dir):
    return one_row_per_user(tag_jobs.payment_tags(src.orders(spark, sf_dir)))


def merge_left(spark, sf_dir):
    """Payment tags merged into the stored profile, new users only."""
    return merge_profiles(_payment(spark, sf_dir), src.stored_profile(spark, sf_dir), "left")


def merge_full(spark, sf_dir):
    """The same for the users of both sides."""
    return merge_profiles(_payment(spark, sf_dir), src.stored_profile(spark, sf_dir), "full")


def job_profile(spark, sf_dir):
    """Job tags merged into the stored profile."""
    new = one_row_per_user(tag_jobs.job_tags(src.users(spark, sf_dir)))
    return merge_profiles(new, src.stored_profile(spark, sf_dir), "left")


def nationality_profile(spark, sf_dir):
    """T4: matched users and stored users."""
    new = one_row_per_user(tag_jobs.nationality_tags(src.users(spark, sf_dir)))
    return merge_profiles(new, src.stored_profile(spark, sf_dir), "full")


def political_profile(spark, sf_dir):
    """T5: a blank new tag keeps what is stored."""
    new = one_row_per_user(
        tag_jobs.political_face_tags(src.users(spark, sf_dir), src.SEGMENT_RULES)
    )
    return merge_profiles(new, src.stored_profile(spark, sf_dir), "full")


def gender_saved(spark, sf_dir):
    """Gender tags written over a store in buckets without merging, and read back."""
    rule = {"inType": "store", "path": scratch_path(spark, "store"), "rowKey": "userId", "buckets": "8"}
    write_source(src.stored_profile(spark, sf_dir), rule)
    write_source(tag_jobs.gender_tags(src.users(spark, sf_dir)), rule)
    return read_source(spark, {**rule, "selectFields": "userId,tagIds"})


def profile_upsert(spark, sf_dir):
    """S3: payment tags and segments written over the store; a null cell writes nothing."""
    store = src.stored_profile(spark, sf_dir)
    segments = src.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("userId"), F.col("c_mktsegment").alias("segment")
    )
    updates = segments.join(_payment(spark, sf_dir), "userId", "left")
    return upsert(store, updates, "userId")


def bucket_upsert(spark, sf_dir):
    """Segments of the customers in debt and payment tags, written over a store in buckets one after the other."""
    rule = {"inType": "store", "path": scratch_path(spark, "store"), "rowKey": "userId", "buckets": "16"}
    write_source(src.stored_profile(spark, sf_dir), rule)
    debtors = src.table(spark, sf_dir, "customer").where("c_acctbal < 0")
    write_source(debtors.select(F.col("c_custkey").cast("string").alias("userId"), F.col("c_mktsegment").alias("segment")), rule)
    write_source(_payment(spark, sf_dir), rule)
    return read_source(spark, {**rule, "selectFields": "userId,tagIds,segment"})


def profile_all(spark, sf_dir):
    """The matching and counting jobs as one profile, merged in a single pass."""
    users, summary = src.users(spark, sf_dir), agg.order_summary(src.orders(spark, sf_dir))
    summary = cut_lineage(summary)
    return tag_jobs.profile_of(
        attach_all_tags(
            users,
            [
                Match(fixed.GENDER_RULES, "gender", "error"),
                Match(fixed.JOB_RULES, "job", "error"),
                Match(fixed.NATIONALITY_RULES, "nationality", "drop"),
                Match(src.SEGMENT_RULES, "politicalFace", "blank"),
            ],
        ),
        tag_jobs.age_tags(users),
        tag_jobs.cycle_from(agg.member_totals(summary), fixed.CYCLE_RULES, src.AS_OF),
        tag_jobs.payment_from(summary, fixed.PAYMENT_RULES),
        stored=src.stored_profile(spark, sf_dir),
    )


def profile_run(spark, sf_dir):
    """A whole run from the catalogue to the next version of a profile in buckets."""
    rule = f"inType=parquet##path={sf_dir}/orders.parquet##selectFields=o_custkey,o_orderpriority"
    parent = fixed.TAG_IDS["payment"]
    job_tags = [(parent, rule, 4, None)] + [(i, r, 5, parent) for i, r in src.PRIORITY_RULES]
    listed = spark.createDataFrame(job_tags, "id long, rule string, level int, pid long")
    catalogue = src.catalogue(spark, sf_dir).unionByName(
        listed.withColumn("name", F.lit("payment"))
    )

    def compute(rules, orders):
        renamed = orders.withColumnsRenamed(
            {"o_custkey": "memberId", "o_orderpriority": "paymentCode"}
        )
        return tag_jobs.payment_tags(renamed, rules)

    root = scratch_path(spark, "profile")
    create_store(src.stored_profile(spark, sf_dir), root, "userId", 8)
    return read_profile(spark, run_tag_job(spark, catalogue, parent, compute, root))


QUERIES = {
    f.__name__: f
    for f in (
        merge_left,
        merge_full,
        job_profile,
        nationality_profile,
        political_profile,
        gender_saved,
        profile_upsert,
        bucket_upsert,
        profile_all,
        profile_run,
    )
}


def _merge_sql(new: str, join: str) -> str:
    return f"""WITH {src.STORED_SQL},
fresh AS (SELECT "userId" AS user_id, nullif("tagIds", '') AS tags FROM ({new}) AS n)
SELECT coalesce(fresh.user_id, stored.user_id) AS "userId",
       {src.tag_list_sql('fresh.tags', 'stored.tags')} AS "tagIds"
FROM fresh {join} stored ON fresh.user_id = stored.user_id"""


_PAYMENT = f"""WITH {PAYMENT_SQL} SELECT user_id AS "userId", tags AS "tagIds" FROM payment"""
_TAG = "CAST(r.id AS VARCHAR)"


def _all_tags_sql() -> str:
    parts = [
        matching.SQL[k]
        for k in (
            "gender_tags",
            "job_tags",
            "nationality_tags",
            "match_blank",
            "age_band",
            "purchase_cycle",
        )
    ]
    union = " UNION ALL ".join(f"SELECT * FROM ({part}) AS t" for part in [*parts, _PAYMENT])
    return f"""SELECT "userId", string_agg("tagIds", ',') AS "tagIds"
FROM ({union}) AS u GROUP BY 1"""


def _priority_sql() -> str:
    rules = src.values_sql(src.PRIORITY_RULES, "r(id, rule)")
    return f"""WITH counted AS (
  SELECT o_custkey, o_orderpriority, count(o_orderpriority) AS n FROM orders GROUP BY 1, 2),
best AS (
  SELECT o_custkey, o_orderpriority FROM counted
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1)
SELECT CAST(o_custkey AS VARCHAR) AS "userId", coalesce(CAST(r.id AS VARCHAR), '35') AS "tagIds"
FROM best LEFT JOIN {rules} ON o_orderpriority = r.rule"""


SQL = {
    "merge_left": _merge_sql(_PAYMENT, "LEFT JOIN"),
    "merge_full": _merge_sql(_PAYMENT, "FULL JOIN"),
    "job_profile": _merge_sql(equal_match_sql("job", fixed.JOB_RULES, _TAG), "LEFT JOIN"),
    "nationality_profile": _merge_sql(
        equal_match_sql("nationality", fixed.NATIONALITY_RULES, _TAG), "FULL JOIN"
    ),
    "political_profile": _merge_sql(
        equal_match_sql("politicalFace", src.SEGMENT_RULES, f"coalesce({_TAG}, '')", "LEFT JOIN"),
        "FULL JOIN",
    ),
    "gender_saved": f"""WITH {src.STORED_SQL},
fresh AS ({equal_match_sql("gender", fixed.GENDER_RULES, _TAG)})
SELECT coalesce(f."userId", s.user_id) AS "userId", coalesce(f."tagIds", s.tags) AS "tagIds"
FROM fresh f FULL JOIN stored s ON f."userId" = s.user_id""",
    "profile_upsert": f"""WITH {src.STORED_SQL}, {PAYMENT_SQL},
updates AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS segment, tags
  FROM customer LEFT JOIN payment ON CAST(c_custkey AS VARCHAR) = payment.user_id)
SELECT coalesce(u.user_id, s.user_id) AS "userId", coalesce(u.tags, s.tags) AS "tagIds", u.segment
FROM updates u FULL JOIN stored s ON u.user_id = s.user_id""",
    "bucket_upsert": f"""WITH {src.STORED_SQL}, {PAYMENT_SQL},
debtors AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS segment FROM customer WHERE c_acctbal < 0),
users AS (SELECT user_id FROM stored UNION SELECT user_id FROM debtors UNION SELECT user_id FROM payment)
SELECT u.user_id AS "userId", coalesce(p.tags, s.tags) AS "tagIds", d.segment
FROM users u LEFT JOIN stored s USING (user_id) LEFT JOIN payment p USING (user_id)
LEFT JOIN debtors d USING (user_id)""",
    "profile_all": _merge_sql(_all_tags_sql(), "FULL JOIN"),
    "profile_run": _merge_sql(_priority_sql(), "FULL JOIN"),
}
