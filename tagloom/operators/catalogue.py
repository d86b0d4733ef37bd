"""Jobs over the tag catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import SCHEDULE_FORMAT
from tagloom.session import cut_lineage

ROOT_PID = -1
PATH_LEVELS = 3
ID_BUCKET_DIGITS = 3


def children(catalogue: DataFrame, pid: int) -> DataFrame:
    """Tags directly below one tag (G1)."""
    return catalogue.where(F.col("pid") == pid)


def children_of(catalogue: DataFrame, parents: DataFrame) -> DataFrame:
    """Tags directly below each of many tags (G1): all columns of the child and `parent_name`."""
    above = parents.select(F.col("id").alias("_pid"), F.col("name").alias("parent_name"))
    return catalogue.join(above, F.col("pid") == F.col("_pid")).drop("_pid")


def tags_of_level(catalogue: DataFrame, level: int) -> DataFrame:
    """Tags of one level."""
    return catalogue.where(F.col("level") == level)


def find_tag(catalogue: DataFrame, name: str, level: int, pid: int) -> DataFrame:
    """Tag by name, level and parent."""
    return catalogue.where(
        (F.col("name") == name) & (F.col("level") == level) & (F.col("pid") == pid)
    )


def find_tags(catalogue: DataFrame, wanted: DataFrame) -> DataFrame:
    """Id of each distinct (name, level, pid) wanted, null if there is none.

    The lowest id counts if a tag is there twice.
    """
    key = ["name", "level", "pid"]
    ids = catalogue.groupBy(*key).agg(F.min("id").alias("id"))
    return wanted.select(*key).distinct().join(ids, key, "left")


def with_models(tags: DataFrame, models: DataFrame) -> DataFrame:
    """Tags with their model, nulls where a tag has none."""
    renamed = models.select(
        *[F.col(c).alias(c if c.startswith("model_") or c == "tag_id" else f"model_{c}")
          for c in models.columns]
    )
    return tags.join(renamed, F.col("id") == F.col("tag_id"), "left").drop("tag_id")


def _numbered(new: DataFrame, first: int) -> DataFrame:
    """`new` prefixes with dense ids from `first` up, level by level, without bringing the rows into one task.

    Rows are numbered within 4096 hash buckets a level; the buckets' start numbers come from a running
    sum over at most 4096 counts for each of the three levels.
    """
    path = F.concat_ws("/", "path")
    bucketed = new.withColumn("_bucket", F.substring(F.md5(path), 1, ID_BUCKET_DIGITS))
    before = Window.orderBy("level", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucketed.groupBy("level", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    starts = starts.select("level", "_bucket", start.alias("_start"))
    within = Window.partitionBy("level", "_bucket").orderBy("path")
    numbered = bucketed.join(F.broadcast(starts), ["level", "_bucket"])
    place = F.col("_start") + F.row_number().over(within) - 1
    return numbered.withColumn("id", F.lit(first) + place).drop("_bucket", "_start")


def known_paths(catalogue: DataFrame) -> DataFrame:
    """(path, level, id) of every tag of the upper levels, the path being the names from the top down.

    Of tags with the same name under the same parent the lowest id counts.
    """
    tags = catalogue.where(F.col("level").between(1, PATH_LEVELS) & F.col("name").isNotNull())
    tags = tags.groupBy("name", "level", "pid").agg(F.min("id").alias("id"))
    found = tags.where((F.col("level") == 1) & (F.col("pid") == ROOT_PID))
    found = found.select(F.array("name").alias("path"), "level", "id")
    levels = [found]
    for level in range(2, PATH_LEVELS + 1):
        below = tags.where(F.col("level") == level).select("name", "pid", F.col("id").alias("_id"))
        met = levels[-1].join(below, F.col("id") == F.col("pid"))
        path = F.concat("path", F.array("name")).alias("path")
        levels.append(met.select(path, F.lit(level).alias("level"), F.col("_id").alias("id")))
    return reduce(DataFrame.unionByName, levels)


def add_paths(catalogue: DataFrame, paths: DataFrame) -> DataFrame:
    """Catalogue rows to add so that every (level1, level2, level3) path of names exists.

    A path ends at its first null name. All levels are done at once: the distinct beginnings of all paths that no tag
    has yet are numbered by one running count, parents before children, and written; a parent is
    looked up by the beginning one name shorter, among old and new tags.
    """
    names = [f"level{i}" for i in range(1, PATH_LEVELS + 1)]
    beginnings = F.array(*(F.array(*names[:i]) for i in range(1, PATH_LEVELS + 1)))
    prefixes = paths.select(F.explode(beginnings).alias("path")).where(~F.exists("path", F.isnull)).distinct()
    prefixes = prefixes.withColumn("level", F.size("path"))
    known = known_paths(catalogue)
    first = (catalogue.agg(F.max("id")).first()[0] or 0) + 1
    fresh = cut_lineage(_numbered(prefixes.join(known.select("path"), "path", "left_anti"), first))
    above = known.select("path", "id").unionByName(fresh.select("path", "id"))
    above = above.select(F.col("path").alias("_above"), F.col("id").alias("_pid"))
    parent = F.slice("path", 1, F.col("level") - 1)
    placed = fresh.withColumn("_parent", parent).join(above, F.col("_parent") == F.col("_above"), "left")
    pid = F.coalesce("_pid", F.lit(ROOT_PID)).cast("long")
    return placed.select("id", F.element_at("path", -1).alias("name"), "level", pid.alias("pid"))


def schedule_fields(schedule: Column) -> list[Column]:
    """`frequency,start,end` text as typed columns."""
    part = F.split(schedule, ",")

    def moment(i: int) -> Column:
        return F.try_to_timestamp(F.get(part, F.lit(i)), F.lit(SCHEDULE_FORMAT))

    return [
        F.get(part, F.lit(0)).try_cast("int").alias("frequency"),
        moment(1).alias("start_time"),
        moment(2).alias("end_time"),
    ]


def schedule_text(frequency: Column, start: Column, end: Column) -> Column:
    """Typed columns back to `frequency,start,end` text; null if one of them is."""
    return F.concat(
        frequency.cast("string"),
        F.lit(","),
        F.date_format(start, SCHEDULE_FORMAT),
        F.lit(","),
        F.date_format(end, SCHEDULE_FORMAT),
    )
