"""Merge new tags with stored ones, and upsert rows by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import merge_tags, tag_array, tag_list
from tagloom.operators.bounded import lookup_join
from tagloom.operators.lookup import Rules, rules_frame


def one_row_per_user(*frames: DataFrame) -> DataFrame:
    """Tags of all frames as one set per user, in one shuffle.

    Sets are built on the map side first, so a user with very many rows sends each task's
    distinct tags only.
    """
    rows = reduce(DataFrame.unionByName, [_typed(f) for f in frames])
    tags = rows.select("userId", F.explode_outer(tag_array(F.col("tagIds"))).alias("tag"))
    per_user = tags.groupBy("userId").agg(F.collect_set("tag").alias("tags"))
    return per_user.select("userId", tag_list(F.col("tags")).alias("tagIds"))


def merge_profiles(new: DataFrame, old: DataFrame, how: str = "left") -> DataFrame:
    """New tags merged into stored ones as sets.

    `left` keeps the users of `new`, `full` those of both sides (P8: the key is the first
    that is not null). Both sides must hold one row per user, see `one_row_per_user`.
    """
    if how not in ("left", "full"):
        raise ValueError("how must be left or full")
    fresh = _typed(new).withColumnRenamed("tagIds", "_new")
    stored = _typed(old).withColumnRenamed("tagIds", "_old")
    merged = fresh.join(stored, "userId", how)
    return merged.select("userId", merge_tags(F.col("_new"), F.col("_old")).alias("tagIds"))


def merge_replacing(new: DataFrame, old: DataFrame, siblings: Sequence[Rules]) -> DataFrame:
    """Full merge in which a user's new tags take the place of the stored tags next to them.

    `siblings` holds one set of rules per parent tag. A stored tag goes if the user has a new tag
    under the same parent; all others stay (T0). Rules are looked up by join, however many there are.
    """
    spark = new.sparkSession
    parents = None
    for i, rules in enumerate(siblings):
        own = rules_frame(spark, rules).select(F.col("id").cast("string").alias("tag"), F.lit(i).alias("parent"))
        parents = own if parents is None else parents.unionByName(own)

    def tags_of(df: DataFrame) -> DataFrame:
        return _typed(df).select("userId", F.explode_outer(tag_array(F.col("tagIds"))).alias("tag"))

    if parents is None:
        return merge_profiles(new, old, "full")
    fresh = tags_of(new)
    renewed = lookup_join(fresh, parents, ["tag"], "inner").select("userId", "parent").distinct()
    stored = lookup_join(tags_of(old), parents, ["tag"], "left")
    kept = stored.join(renewed, ["userId", "parent"], "left_anti").select("userId", "tag")
    return one_row_per_user(new, kept.withColumnRenamed("tag", "tagIds"))


def _typed(df: DataFrame) -> DataFrame:
    return df.select(F.col("userId").cast("string"), F.col("tagIds").cast("string"))


def last_cells(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: the greatest value of each cell where a key is repeated."""
    others = [c for c in rows.columns if c != key]
    if not others:
        return rows.distinct()
    return rows.groupBy(key).agg(*[F.max(c).alias(c) for c in others]).select(*rows.columns)


def upsert(store: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """`store` with the cells of `updates` written over it by key (S3).

    A null cell writes nothing, other rows and columns stay. `store` has one row per key;
    `updates` is brought to one by `last_cells`.
    """
    fresh = last_cells(updates, key)
    written = [c for c in fresh.columns if c != key]
    joined = store.join(fresh.withColumnsRenamed({c: f"_new_{c}" for c in written}), key, "full")
    columns = [F.col(key)]
    for name in [c for c in store.columns if c != key]:
        cell = F.coalesce(f"_new_{name}", name) if name in written else F.col(name)
        columns.append(cell.alias(name))
    added = [F.col(f"_new_{c}").alias(c) for c in written if c not in store.columns]
    return joined.select(*columns, *added)
