"""Queries over the tag catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import catalogue as cat
from tagloom.workload import inputs as src


def tag_children(spark, sf_dir):
    """G1: the tags below every tag."""
    tags = src.catalogue(spark, sf_dir)
    return cat.children_of(tags, tags).select("id", "name", "level", "pid", "parent_name")


def tag_level(spark, sf_dir):
    """The model tags."""
    return cat.tags_of_level(src.catalogue(spark, sf_dir), 4)


def tag_lookup(spark, sf_dir):
    """The tag of every supplier, by name, level and parent, one level too deep for some."""
    wanted = src.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") >= 0, 3).otherwise(4).alias("level"),
        (F.col("s_nationkey") + src.NATION_BASE).cast("long").alias("pid"),
    )
    return cat.find_tags(src.catalogue(spark, sf_dir), wanted)


def tag_with_model(spark, sf_dir):
    """The model tags of every supplier with their model."""
    tags = src.catalogue(spark, sf_dir).where("level = 4")
    joined = cat.with_models(tags, src.models(spark, sf_dir).where("freq > 25"))
    return joined.select("id", "name", "pid", "model_id", "model_name", "model_sche_time")


def tag_path_upsert(spark, sf_dir):
    """The rows to add so that every path of names exists."""
    return cat.add_paths(src.catalogue(spark, sf_dir), src.tag_paths(spark, sf_dir))


def schedule_unpack(spark, sf_dir):
    """Schedules as typed columns and back."""
    models = src.models(spark, sf_dir)
    typed = models.select("id", *cat.schedule_fields(F.col("sche_time")))
    packed = cat.schedule_text(F.col("frequency"), F.col("start_time"), F.col("end_time"))
    return typed.select(
        "id",
        "frequency",
        F.unix_timestamp("start_time").alias("start_seconds"),
        F.unix_timestamp("end_time").alias("end_seconds"),
        packed.alias("packed"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        tag_children,
        tag_level,
        tag_lookup,
        tag_with_model,
        tag_path_upsert,
        schedule_unpack,
    )
}


#: Beginnings of paths that no tag has, numbered level by level in the order of the md5 of the path.
_PATH_UPSERT = """old AS (
  SELECT min(id) AS id, name, level, pid FROM catalogue WHERE level <= 3 GROUP BY name, level, pid),
known AS (
  SELECT id, 1 AS level, [name] AS path FROM old WHERE level = 1 AND pid = -1
  UNION ALL
  SELECT b.id, 2, [a.name, b.name] FROM old a JOIN old b ON b.pid = a.id AND b.level = 2
  WHERE a.level = 1 AND a.pid = -1
  UNION ALL
  SELECT c.id, 3, [a.name, b.name, c.name] FROM old a JOIN old b ON b.pid = a.id AND b.level = 2
  JOIN old c ON c.pid = b.id AND c.level = 3 WHERE a.level = 1 AND a.pid = -1),
wanted AS (
  SELECT 1 AS level, [level1] AS path FROM paths WHERE level1 IS NOT NULL
  UNION
  SELECT 2, [level1, level2] FROM paths WHERE level1 IS NOT NULL AND level2 IS NOT NULL
  UNION
  SELECT 3, [level1, level2, level3] FROM paths
  WHERE level1 IS NOT NULL AND level2 IS NOT NULL AND level3 IS NOT NULL),
fresh AS (
  SELECT level, path, (SELECT max(id) FROM catalogue) + row_number() OVER (
    ORDER BY level, substr(md5(array_to_string(path, '/')), 1, 3), path) AS id
  FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.path = w.path)),
above AS (SELECT path, id FROM known UNION ALL SELECT path, id FROM fresh)
SELECT f.id, f.path[-1] AS name, f.level, CAST(coalesce(a.id, -1) AS BIGINT) AS pid
FROM fresh f LEFT JOIN above a ON a.path = f.path[:f.level - 1]"""


SQL = {
    "tag_children": f"""WITH {src.CATALOGUE_SQL}
SELECT c.id, c.name, c.level, c.pid, p.name AS parent_name
FROM catalogue c JOIN catalogue p ON c.pid = p.id""",
    "tag_level": f"WITH {src.CATALOGUE_SQL} SELECT * FROM catalogue WHERE level = 4",
    "tag_lookup": f"""WITH {src.CATALOGUE_SQL},
wanted AS (
  SELECT DISTINCT s_name AS name, CASE WHEN s_acctbal >= 0 THEN 3 ELSE 4 END AS level,
         CAST(s_nationkey + {src.NATION_BASE} AS BIGINT) AS pid FROM supplier)
SELECT w.name, w.level, w.pid, c.id FROM wanted w LEFT JOIN (
  SELECT name, level, pid, min(id) AS id FROM catalogue GROUP BY ALL) AS c
ON w.name = c.name AND w.level = c.level AND w.pid = c.pid""",
    "tag_with_model": f"""WITH {src.CATALOGUE_SQL}, {src.MODELS_SQL}
SELECT c.id, c.name, c.pid, m.id AS model_id, m.model_name, m.sche_time AS model_sche_time
FROM catalogue c LEFT JOIN models m ON c.id = m.tag_id AND m.freq > 25 WHERE c.level = 4""",
    "tag_path_upsert": f"WITH {src.CATALOGUE_SQL}, {src.PATHS_SQL}, {_PATH_UPSERT}",
    "schedule_unpack": f"""WITH {src.MODELS_SQL}
SELECT id, freq AS frequency, CAST(floor(epoch(starts)) AS BIGINT) AS start_seconds,
       CAST(floor(epoch(ends)) AS BIGINT) AS end_seconds, sche_time AS packed FROM models""",
}
