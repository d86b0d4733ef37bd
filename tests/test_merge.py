import pytest
from pyspark.sql import functions as F

from tagloom.operators.merge import merge_profiles, one_row_per_user, upsert
from tagloom.sources.readers import read_profile
from tagloom.sources.versions import latest_version, save_version


@pytest.mark.parametrize(
    "new, old, how, expected",
    [
        ([("22", "10")], [("22", "23,30")], "left", {("22", "10,23,30")}),
        ([("22", "10")], [], "left", {("22", "10")}),
        ([], [("22", "23,30")], "left", set()),
        ([], [("22", "23,30")], "full", {("22", "23,30")}),
        ([("22", " ")], [("22", "23,30")], "left", {("22", "23,30")}),
        ([("22", "")], [("22", None)], "full", {("22", None)}),
        ([("1", "420")], [("2", "411")], "full", {("1", "420"), ("2", "411")}),
    ],
)
def test_merge(frame, pairs, new, old, how, expected):
    merged = merge_profiles(frame("userId,tagIds", new), frame("userId,tagIds", old), how)
    assert pairs(merged) == expected


def test_merge_knows_left_and_full(frame):
    df = frame("userId,tagIds", [("1", "2")])
    with pytest.raises(ValueError):
        merge_profiles(df, df, "inner")


def test_one_row_per_user(frame, pairs):
    a = frame("userId,tagIds", [("1", "5"), ("1", "420"), ("2", ""), ("3", "7,5")])
    b = frame("userId,tagIds", [("1", "5"), ("3", "5"), ("4", None)])
    assert pairs(one_row_per_user(a, b)) == {("1", "420,5"), ("2", None), ("3", "5,7"), ("4", None)}


def test_one_row_for_a_hot_user(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("userId"),
        (F.col("id") % 7).cast("string").alias("tagIds"),
    )
    merged = one_row_per_user(rows).where("userId = 'hot'").collect()
    assert [r["tagIds"] for r in merged] == ["0,1,2,3,4,5,6"]


def test_upsert(frame, spark):
    store = frame("userId,tagIds,city", [("1", "a", "x"), ("2", "b", None), ("3", "c", "z")])
    updates = frame("userId,tagIds,age", [("1", "n", "9"), ("2", None, "8"), ("4", "d", None)])
    rows = {tuple(r) for r in upsert(store, updates, "userId").collect()}
    assert rows == {
        ("1", "n", "x", "9"),
        ("2", "b", None, "8"),
        ("3", "c", "z", None),
        ("4", "d", None, None),
    }


def test_upsert_writes_a_repeated_key_once(frame):
    store = frame("userId,tagIds", [("1", "a")])
    rows = upsert(store, frame("userId,tagIds", [("1", "b"), ("1", "c")]), "userId").collect()
    assert [tuple(r) for r in rows] == [("1", "c")]


def test_versions(spark, frame, pairs, tmp_path):
    root = f"file://{tmp_path}/profile"
    assert latest_version(spark, root) is None
    first = save_version(frame("userId,tagIds", [("1", "a")]), root)
    assert latest_version(spark, root) == first
    # A version may be computed from the one before it.
    grown = upsert(read_profile(spark, first), frame("userId,tagIds", [("2", "b")]), "userId")
    second = save_version(grown, root)
    assert latest_version(spark, root) == second != first
    assert pairs(read_profile(spark, second)) == {("1", "a"), ("2", "b")}
    # One that broke off is neither read nor written over.
    (tmp_path / "profile" / "version=00000003").mkdir()
    assert latest_version(spark, root) == second
    assert save_version(grown, root).endswith("version=00000004")
