"""Joins of a large frame with a rule frame: broadcast if it is small, else a plain join."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_MAX_ROWS = 10_000
BROADCAST_MAX_BYTES = 8 * 1024 * 1024
FIXED_WIDTH_BYTES = 16


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Whether `df` stays within the bounds: one count and one sum, no rows are moved."""
    width = F.lit(FIXED_WIDTH_BYTES * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    probe = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")
    )
    n, size = probe.first()
    return n <= max_rows and size <= max_bytes


def lookup_join(
    many: DataFrame, few: DataFrame, on: list[str], how: str, is_small: bool = False
) -> DataFrame:
    """Equality join of a large frame with a rule frame.

    A rule frame within the bounds is broadcast. Beyond them both sides are shuffled, and adaptive
    execution splits the tasks of a hot key of `many`, which repeats the rules of that task alone.
    """
    if is_small or fits_broadcast(few):
        return many.join(F.broadcast(few), on, how)
    return many.join(few, on, how)


def local_frame(spark: SparkSession, rows: list[tuple], names: list[str], types: list) -> DataFrame:
    """Frame over a short driver-side list, kept in the plan itself (no tasks to scan it)."""
    columns = [pa.array([row[i] for row in rows], type=t) for i, t in enumerate(types)]
    return spark.createDataFrame(pa.table(columns, names=names))
