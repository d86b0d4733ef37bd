"""Attach tags to users by rule: exact keys (J1-J4) and bands."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tagloom.functions.rules import band_end, band_start
from tagloom.operators.bounded import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_ROWS,
    FIXED_WIDTH_BYTES,
    fits_broadcast,
    local_frame,
    lookup_join,
)
from tagloom.operators.ranges import band_join_by_sweep

Rules = DataFrame | Sequence[tuple[int, str]]

# Up to so many bands are tested one after the other.
BAND_SCAN_MAX_ROWS = 64

UNMATCHED = ("drop", "error", "blank", "default")


def rules_frame(spark: SparkSession, rules: Rules) -> DataFrame:
    """Rules as a frame (id long, rule string); a short list becomes a local frame."""
    if isinstance(rules, DataFrame):
        return rules.select(F.col("id").cast("long"), F.col("rule").cast("string"))
    return local_frame(spark, list(rules), ["id", "rule"], [pa.int64(), pa.string()])


def short_rules(rules: DataFrame) -> Rules:
    """A rule frame within the broadcast bounds as a list; a larger one as it is."""
    rows = rules.select(F.col("id").cast("long"), F.col("rule").cast("string"))
    return [tuple(r) for r in rows.collect()] if fits_broadcast(rows) else rules


def _is_short_list(rules: Rules) -> bool:
    if isinstance(rules, DataFrame) or len(rules) > BROADCAST_MAX_ROWS:
        return False
    return sum(FIXED_WIDTH_BYTES + len((text or "").encode()) for _, text in rules) <= BROADCAST_MAX_BYTES


def _one_per_rule(spark: SparkSession, rules: Rules) -> DataFrame:
    """(rule, id) with the highest id where several rules have the same text."""
    if isinstance(rules, DataFrame):
        return rules_frame(spark, rules).groupBy("rule").agg(F.max("id").alias("id"))
    return rules_frame(spark, [(i, rule) for rule, i in {r: i for i, r in sorted(rules)}.items()])


def _default_tag(spark: SparkSession, rules: Rules, default_rule: str) -> Column:
    if isinstance(rules, DataFrame):
        matching = rules_frame(spark, rules).where(F.col("rule") == default_rule)
        tag = matching.agg(F.max("id")).first()[0]
    else:
        tag = max((i for i, rule in rules if rule == default_rule), default=None)
    if tag is None:
        raise ValueError(f"no rule {default_rule!r} to fall back on")
    return F.lit(str(tag))


def _tag_or_fallback(
    tag: Column, key: Column, unmatched: str, default: Callable[[], Column]
) -> Column:
    """`tag`, or what `unmatched` puts in its place where it is null."""
    if unmatched == "blank":
        return F.coalesce(tag, F.lit(""))
    if unmatched == "default":
        return F.coalesce(tag, default())
    message = F.concat(F.lit("no rule for "), F.coalesce(key, F.lit("null")))
    return F.when(tag.isNull(), F.raise_error(message).cast("string")).otherwise(tag)


def attach_tags(
    users: DataFrame,
    rules: Rules,
    key: str,
    user: str = "id",
    unmatched: str = "drop",
    default_rule: str = "other",
) -> DataFrame:
    """(userId, tagIds) by equality of `key` and rule text.

    `unmatched` says what becomes of a user whose key has no rule: `drop` (J4; a user meeting
    two rules gives two rows), `error` (J1), `blank` (J2) or `default`, the tag of
    `default_rule` (J3). The last three give one row per input row; of several rules with the
    same text the highest id counts.
    """
    if unmatched not in UNMATCHED:
        raise ValueError(f"unmatched must be one of {UNMATCHED}")
    spark = users.sparkSession
    left = users.select(
        F.col(user).cast("string").alias("userId"), F.col(key).cast("string").alias("_key")
    )
    is_small = _is_short_list(rules)
    if unmatched == "drop":
        side = rules_frame(spark, rules).withColumnRenamed("rule", "_key")
        tagged = lookup_join(left, side, ["_key"], "inner", is_small)
        return tagged.select("userId", F.col("id").cast("string").alias("tagIds"))

    side = _one_per_rule(spark, rules).withColumnRenamed("rule", "_key")
    tagged = lookup_join(left, side, ["_key"], "left", is_small)
    tag = _tag_or_fallback(
        F.col("id").cast("string"),
        F.col("_key"),
        unmatched,
        lambda: _default_tag(spark, rules, default_rule),
    )
    return tagged.select("userId", tag.alias("tagIds"))


@dataclass(frozen=True)
class Match:
    """One lookup of `attach_all_tags`: the arguments of `attach_tags`."""

    rules: Rules
    key: str
    unmatched: str = "drop"
    default_rule: str = "other"


def attach_all_tags(users: DataFrame, matches: Sequence[Match], user: str = "id") -> DataFrame:
    """(userId, tagIds) with the tags of several lookups as one comma list per input row.

    The same tags as one `attach_tags` per lookup, but the users are scanned once and each
    gives one row to a later shuffle. If all lookups drop, users without any tag give no row.
    """
    spark = users.sparkSession
    keys = [F.col(m.key).cast("string").alias(f"_key{i}") for i, m in enumerate(matches)]
    joined = users.select(F.col(user).cast("string").alias("userId"), *keys)
    tags = []
    for i, match in enumerate(matches):
        key, tag = F.col(f"_key{i}"), F.col(f"_tag{i}")
        if match.unmatched == "drop":
            ids = F.array_join(F.sort_array(F.collect_set(F.col("id").cast("string"))), ",")
            side = rules_frame(spark, match.rules).groupBy("rule").agg(ids.alias("id"))
        else:
            side = _one_per_rule(spark, match.rules)
            default = partial(_default_tag, spark, match.rules, match.default_rule)
            tag = _tag_or_fallback(tag, key, match.unmatched, default)
        side = side.select(
            F.col("rule").alias(f"_key{i}"), F.col("id").cast("string").alias(f"_tag{i}")
        )
        is_small = _is_short_list(match.rules)
        joined = lookup_join(joined, side, [f"_key{i}"], "left", is_small)
        tags.append(tag)
    tagged = joined.select("userId", F.concat_ws(",", *tags).alias("tagIds"))
    if all(match.unmatched == "drop" for match in matches):
        return tagged.where(F.col("tagIds") != "")
    return tagged


def attach_band_tags(
    users: DataFrame, rules: Rules, value: Column, user: str = "id", numeric: bool = False
) -> DataFrame:
    """(userId, tagIds) for every `a-b` rule whose band holds `value`, ends included.

    Text bands compare as text (J5); with `numeric` both ends are integers (J6). The test is
    inclusive at both ends (P5). Users outside every band give no row.
    """
    frame = rules_frame(users.sparkSession, rules)
    low, high = band_start(F.col("rule")), band_end(F.col("rule"))
    if numeric:
        low, high = low.try_cast("long"), high.try_cast("long")
        value = value.cast("long")
    tag = F.col("id").cast("string").alias("tagIds")
    bands = frame.select(tag, low.alias("low"), high.alias("high"))
    points = users.select(F.col(user).cast("string").alias("userId"), value.alias("value"))
    points = points.where(F.col("value").isNotNull())
    if fits_broadcast(bands, max_rows=BAND_SCAN_MAX_ROWS):
        inside = F.col("value").between(F.col("low"), F.col("high"))
        return points.join(F.broadcast(bands), inside).select("userId", "tagIds")
    if isinstance(bands.schema["low"].dataType, StringType):
        return band_join_by_sweep(points, bands)
    return _band_join_by_cell(points, bands)


def _band_join_by_cell(points: DataFrame, bands: DataFrame) -> DataFrame:
    """Band join of numbers as an equality join, for rule frames too large to test band by band.

    A band lies in one or two cells of the smallest power-of-two width above its span; a
    point looks into its cell at every width in use (64 at most). The band is tested again after the join, so the cells
    only narrow the candidates and the rows are those of a test band by band.
    """
    whole = bands.where(F.col("low") <= F.col("high"))
    sized = whole.withColumn("size", F.length(F.bin(F.col("high") - F.col("low"))).cast("int"))
    own = F.array_distinct(F.array(F.expr("shiftright(low, size)"), F.expr("shiftright(high, size)")))
    cells = sized.withColumn("cell", F.explode(own)).select("tagIds", "low", "high", "size", "cell")
    sizes = sorted(row[0] for row in sized.select("size").distinct().collect())
    if not sizes:
        return points.select("userId", F.lit(None).cast("string").alias("tagIds")).limit(0)
    probes = points.withColumn("size", F.explode(F.array(*[F.lit(n) for n in sizes])))
    probes = probes.withColumn("cell", F.expr("shiftright(value, size)"))
    joined = lookup_join(probes, cells, ["size", "cell"], "inner")
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return joined.where(inside).select("userId", "tagIds")
