"""Stores in buckets: which files an update reads and writes."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators.merge import merge_profiles, upsert
from tagloom.sources import buckets
from tagloom.sources.readers import read_profile, read_source
from tagloom.sources.writers import write_source

STORED = [(str(i), f"t{i % 5}") for i in range(3_000)] + [("", "blank key"), ("Ü", None)]
UPDATES = [("7", "new", 1), ("42", None, 2), ("42", "late", None), ("newcomer", "n", 4)]


@pytest.fixture
def store(spark, tmp_path):
    root = f"{tmp_path}/store"
    rows = spark.createDataFrame(STORED, "userId string, tagIds string").repartition(5)
    buckets.create_store(rows, root, "userId", 16)
    return root


def test_rows_as_by_plain_upsert(spark, store):
    updates = spark.createDataFrame(UPDATES, "userId string, tagIds string, extra int")
    plain = upsert(spark.createDataFrame(STORED, "userId string, tagIds string"), updates, "userId")
    buckets.rewrite_store(store, updates, upsert)
    found = buckets.open_store(spark, store).drop("bucket")
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert found.columns == ["userId", "tagIds", "extra"]


def test_untouched_buckets_keep_their_files(spark, store):
    before = buckets.files_of(spark, store)
    updates = spark.createDataFrame(UPDATES, "userId string, tagIds string, extra int")
    touched = {r[0] for r in updates.select(buckets.bucket_of("userId", 16)).collect()}
    number = buckets.rewrite_store(store, updates, upsert)
    after = buckets.files_of(spark, store)
    assert set(before) == set(after) == set(range(16)) and all(len(files) == 1 for files in after.values())
    assert {b for b in before if before[b] != after[b]} == touched and len(touched) < 4
    assert all(f"buckets={number:08d}" in after[b][0] for b in touched)


def test_stored_side_is_not_shuffled(spark, store):
    """Stored rows of touched buckets alone are read, and no exchange stands above their scan."""
    updates = spark.createDataFrame(UPDATES, "userId string, tagIds string, extra int")
    touched = [r[0] for r in updates.select(buckets.bucket_of("userId", 16)).distinct().collect()]
    stored = buckets.open_store(spark, store).where(F.col("bucket").isin(touched)).drop("bucket")
    new = updates.groupBy("userId").agg(F.max("tagIds").alias("tagIds"))
    for joined in (upsert(stored, new, "userId"), merge_profiles(new, stored, "full")):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
        sort = max(i for i, line in enumerate(lines[:scan]) if "Sort [" in line)
        assert "SortMergeJoin" in plan and not any("Exchange" in line for line in lines[sort:scan])
        assert "PartitionFilters: [bucket#" in plan and "Bucketed: true" in plan


def test_versions(spark, store, tmp_path):
    """A version without a whole manifest does not count; no updates make no version."""
    none = spark.createDataFrame([], "userId string, tagIds string")
    assert buckets.rewrite_store(store, none, upsert) == 1
    broken = spark.createDataFrame([("1", "x")], "userId string, tagIds string")
    broken.write.parquet(f"{store}/buckets=00000002")
    buckets.rewrite_store(store, broken, upsert)
    assert buckets.read_manifest(spark, store).number == 3
    assert buckets.open_store(spark, store).where("userId = '1'").first()["tagIds"] == "x"
    with pytest.raises(ValueError):
        buckets.create_store(broken, store, "userId")
    with pytest.raises(ValueError):
        buckets.open_store(spark, f"{tmp_path}/nothing")


def test_store_of_no_rows(spark, tmp_path):
    rule = {"inType": "store", "path": f"{tmp_path}/empty", "rowKey": "userId", "buckets": "4"}
    none = spark.createDataFrame([], "userId string, tagIds string")
    write_source(none, rule)
    assert read_source(spark, rule).count() == 0
    write_source(spark.createDataFrame([("a", "1"), ("a", "0")], "userId string, tagIds string"), rule)
    assert [tuple(r) for r in read_profile(spark, rule["path"]).collect()] == [("a", "1")]


def test_two_writers_of_one_version(spark, store):
    manifest = buckets.read_manifest(spark, store)
    with pytest.raises(FileExistsError):
        buckets._save_manifest(spark, store, manifest)
    assert buckets.read_manifest(spark, store) == manifest
