"""Stores bucketed by key: an update joins without moving the store and rewrites only the buckets it touches.

A store is a folder. `bucket` tables below `buckets=N` hold the buckets that version N rewrote, each as a
partition whose files carry the bucket's number, as Spark's bucketed tables do; the file `manifest=N` says for every
bucket which version holds it. A manifest is written aside and renamed, and a version counts once it has one, so a job that dies
half way leaves the store as it was, and of two writers of the same version the second fails. Opening a store registers its current buckets as a table of the session under a name of its own; a join by the
key with it shuffles the other side only, and a filter on `bucket` reads no other bucket's files. Files that no manifest names any
more are left to the retention rules of the folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.operators.merge import last_cells
from tagloom.session import cut_lineage
from tagloom.sources.versions import numbers_of, path_exists, read_text, write_text_once

BUCKETS = 64
BUCKET = "bucket"
MANIFEST = "manifest="


@dataclass(frozen=True)
class Manifest:
    """Key, columns and number of buckets of a store, and the version that holds each bucket."""

    number: int
    key: str
    buckets: int
    schema: StructType
    versions: dict[int, int]


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key: Spark's own hash of bucketed tables and of shuffles."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int").alias(BUCKET)


def read_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest whole manifest, or None if there is no store at `root`."""
    numbers = numbers_of(spark, root, MANIFEST)
    if not numbers:
        return None
    number = numbers[-1]
    found = json.loads(read_text(spark, f"{root}/{MANIFEST}{number:08d}"))
    versions = {int(b): v for b, v in found["versions"].items()}
    return Manifest(number, found["key"], found["buckets"], StructType.fromJson(found["schema"]), versions)


def _save_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    text = {"key": manifest.key, "buckets": manifest.buckets, "schema": manifest.schema.jsonValue(), "versions": manifest.versions}
    write_text_once(spark, f"{root}/{MANIFEST}{manifest.number:08d}", json.dumps(text))


def _write_buckets(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Rows as bucketed files below `path`, one folder for each bucket; no table is left behind."""
    name = f"buckets_{uuid.uuid4().hex}"
    numbered = rows.withColumn(BUCKET, bucket_of(key, buckets))
    writer = numbered.write.format("parquet").partitionBy(BUCKET).bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")


def create_store(rows: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> int:
    """The first version of a store, one row per key; returns its number.

    Rows are dealt to the buckets before they are written, so that a bucket is one file.
    """
    spark = rows.sparkSession
    if read_manifest(spark, root):
        raise ValueError(f"{root} holds a store")
    if BUCKET in rows.columns:
        raise ValueError(f"a column of a store cannot be named {BUCKET}")
    whole = last_cells(rows, key)
    number = _free_number(spark, root, 0)
    path = f"{root}/buckets={number:08d}"
    _write_buckets(whole.repartition(buckets, key), path, key, buckets)
    filled = numbers_of(spark, path, f"{BUCKET}=")
    _save_manifest(spark, root, Manifest(number, key, buckets, whole.schema, dict.fromkeys(filled, number)))
    return number


def _free_number(spark: SparkSession, root: str, last: int) -> int:
    """The next number no folder has yet, also none of a version that broke off."""
    number = last + 1
    while path_exists(spark, f"{root}/buckets={number:08d}"):
        number += 1
    return number


def open_store(spark: SparkSession, root: str) -> DataFrame:
    """The current rows of a store, with column `bucket`, as a scan that knows its partitioning by key."""
    manifest = read_manifest(spark, root)
    if manifest is None:
        raise ValueError(f"store {root} is empty")
    name = f"store_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
        f"CLUSTERED BY (`{manifest.key}`) INTO {manifest.buckets} BUCKETS LOCATION '{root}/empty'"
    )
    parts = " ".join(
        f"PARTITION ({BUCKET} = {b}) LOCATION '{root}/buckets={v:08d}/{BUCKET}={b}'" for b, v in manifest.versions.items()
    )
    if parts:
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
    return spark.table(name)


def rewrite_store(
    root: str, updates: DataFrame, combine: Callable[[DataFrame, DataFrame, str], DataFrame]
) -> int:
    """The next version: `combine(stored, updates, key)` over the buckets that hold a key of the updates.

    `combine` joins both sides by key; only the updates are shuffled. Other buckets are neither read nor
    written. Returns the new number, or the current one if there are no updates.
    """
    spark = updates.sparkSession
    manifest = read_manifest(spark, root)
    if manifest is None:
        raise ValueError(f"store {root} is empty")
    key, buckets = manifest.key, manifest.buckets
    fresh = cut_lineage(last_cells(updates, key))
    touched = sorted(r[0] for r in fresh.select(bucket_of(key, buckets)).distinct().collect())
    if not touched:
        return manifest.number
    stored = open_store(spark, root).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    result = combine(stored, fresh, key)
    number = _free_number(spark, root, manifest.number)
    # The join runs by bucket, so each of its tasks writes the one file of its bucket.
    path = f"{root}/buckets={number:08d}"
    _write_buckets(result, path, key, buckets)
    kept = {b: v for b, v in manifest.versions.items() if b not in set(touched)}
    versions = kept | dict.fromkeys(numbers_of(spark, path, f"{BUCKET}="), number)
    _save_manifest(spark, root, Manifest(number, key, buckets, result.schema, dict(sorted(versions.items()))))
    return number


def files_of(spark: SparkSession, root: str) -> dict[int, Sequence[str]]:
    """The files that hold each bucket now."""
    rows = open_store(spark, root).select(BUCKET, F.input_file_name().alias("file")).distinct().collect()
    found: dict[int, list[str]] = {}
    for bucket, file in sorted(rows):
        found.setdefault(bucket, []).append(file)
    return found
