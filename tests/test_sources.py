import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.functions.rules import rule_options
from tagloom.operators.lookup import attach_tags
from tagloom.plans import tag_jobs
from tagloom.plans.template import new_tags, run_tag_job, run_tag_jobs
from tagloom.session import scratch_path, scratch_root
from tagloom.sources import readers
from tagloom.sources.hbase import hbase_options
from tagloom.sources.versions import save_version
from tagloom.sources.writers import write_source

CATALOGUE = "id long, name string, rule string, level int, pid long"


@pytest.fixture
def users_path(spark, frame, tmp_path):
    path = f"file://{tmp_path}/users"
    rows = [("1", "2", "3"), ("10", "2", "5"), ("101", "1", None)]
    frame("id,gender,job", rows).withColumn("job", F.col("job").cast("int")).write.parquet(path)
    return path


def test_select_fields(spark, users_path):
    df = spark.read.parquet(users_path)
    picked = readers.select_fields(df, ["job", "id", "missing"])
    assert picked.dtypes == [("job", "string"), ("id", "string"), ("missing", "string")]
    rows = {tuple(r) for r in picked.collect()}
    assert rows == {("3", "1", None), ("5", "10", None), (None, "101", None)}
    assert dict(readers.select_fields(df, ["job"], as_strings=False).dtypes) == {"job": "int"}


def test_read_source_formats(spark, users_path, tmp_path):
    rule = {"inType": "Parquet", "path": users_path, "selectFields": "id,gender"}
    assert readers.read_source(spark, rule).columns == ["id", "gender"]
    for kind in ("csv", "json", "orc"):
        path = f"file://{tmp_path}/{kind}"
        writer = spark.read.parquet(users_path).write
        writer.format(kind).option("header", "true").save(path)
        given = {"inType": kind, "path": path, "selectFields": "gender,id", "header": "true"}
        assert {tuple(r) for r in readers.read_source(spark, given).collect()} == {
            ("2", "1"),
            ("2", "10"),
            ("1", "101"),
        }
    spark.read.parquet(users_path).createOrReplaceTempView("users_view")
    assert readers.read_source(spark, {"inType": "table", "name": "users_view"}).count() == 3
    with pytest.raises(ValueError, match="unknown inType"):
        readers.read_source(spark, {"inType": "carrier pigeon"})


def test_source_filter_and_columns_reach_the_scan(spark, users_path):
    rule = {"inType": "parquet", "path": users_path, "selectFields": "id,gender"}
    df = readers.read_source(spark, rule).where("gender = '2'").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    read = plan.rpartition("ReadSchema:")[2]
    assert "EqualTo(gender,2)" in plan and "gender" in read and "job" not in read


def test_hbase_options():
    rule = {"zkHosts": "z1", "zkPort": "2181", "hbaseTable": "tbl_users", "family": "detail"}
    options = hbase_options(rule, ["id", "job"])
    cells = "_key STRING :key, id STRING detail:id, job STRING detail:job"
    assert options["hbase.columns.mapping"] == cells
    assert options["hbase.table"] == "tbl_users"
    keyed = hbase_options(rule | {"rowKey": "id"}, ["id", "job"])
    assert keyed["hbase.columns.mapping"] == "id STRING :key, job STRING detail:job"


def test_rules_of_a_tag(spark):
    rule = "inType=parquet##path=/x##selectFields=id,gender"
    rows = [(4, "g", rule, 4, 3), (5, "m", "1", 5, 4), (7, "j", None, 4, 3)]
    tags = spark.createDataFrame(rows, CATALOGUE)
    assert readers.source_options(tags, 4) == {
        "inType": "parquet",
        "path": "/x",
        "selectFields": "id,gender",
    }
    assert [tuple(r) for r in readers.level5_rules(tags, 4).collect()] == [(5, "1")]
    for tag in (7, 99):
        with pytest.raises(ValueError, match="no data-source rule"):
            readers.source_options(tags, tag)


def test_source_descriptor(spark):
    options = rule_options(F.lit("inType=HBase##zkPort=2181"))
    plain, filled = readers.source_descriptor(options), readers.source_descriptor(options, "")
    row = spark.range(1).select(plain.alias("n"), filled.alias("e")).first()
    given = {"inType": "HBase", "zkPort": "2181"}
    assert row["n"].asDict() == dict.fromkeys(fixed.SOURCE_KEYS) | given
    assert row["e"]["family"] == ""


def test_libsvm(spark, tmp_path):
    rows = [(1.0, Vectors.dense(5.1, 3.5)), (2.0, Vectors.sparse(2, [1], [4.0]))]
    path = f"file://{tmp_path}/svm"
    spark.createDataFrame(rows, ["label", "features"]).write.format("libsvm").save(path)
    for width in (2, None):
        rows = readers.read_libsvm(spark, path, width).orderBy("label").collect()
        found = [(r["label"], list(r["features"].toArray())) for r in rows]
        assert found == [(1.0, [5.1, 3.5]), (2.0, [0.0, 4.0])]


def test_measurements(spark, tmp_path):
    (tmp_path / "iris.csv").write_text("5.1,3.5,1.4,0.2,Iris-setosa\n4.9,x,1.4,0.2,Iris-setosa\n")
    rows = readers.read_measurements(spark, f"file://{tmp_path}/iris.csv").collect()
    assert rows[0].asDict() == {
        "Sepal_Length": 5.1,
        "Sepal_Width": 3.5,
        "Petal_Length": 1.4,
        "Petal_Width": 0.2,
        "Species": "Iris-setosa",
    }
    assert rows[1]["Sepal_Width"] is None


def test_preview(spark):
    assert readers.preview(spark.range(50)).count() == 10


def test_run_tag_job(spark, frame, users_path, pairs, tmp_path):
    rule = f"inType=parquet##path={users_path}##selectFields=id,gender"
    tags = spark.createDataFrame(
        [(4, "gender", rule, 4, 3), (5, "male", "1", 5, 4), (6, "female", "2", 5, 4)], CATALOGUE
    )

    def compute(rules, users):
        return tag_jobs.gender_tags(users, rules)

    assert pairs(new_tags(spark, tags, 4, compute)) == {("1", "6"), ("10", "6"), ("101", "5")}
    root = f"file://{tmp_path}/profile"
    first = run_tag_job(spark, tags, 4, compute, root)
    assert pairs(readers.read_profile(spark, first)) == {("1", "6"), ("10", "6"), ("101", "5")}
    save_version(frame("userId,tagIds", [("1", "23,30"), ("77", "9")]), root)
    last = run_tag_job(spark, tags, 4, compute, root)
    assert pairs(readers.read_profile(spark, last)) == {
        ("1", "23,30,6"),
        ("10", "6"),
        ("101", "5"),
        ("77", "9"),
    }


def test_run_tag_jobs_without_merge(spark, frame, users_path, pairs, tmp_path):
    rule = f"inType=parquet##path={users_path}##selectFields=id,gender,job"
    tags = spark.createDataFrame(
        [(4, "g", rule, 4, 3), (6, "f", "2", 5, 4), (7, "j", rule, 4, 3), (10, "x", "3", 5, 7)],
        CATALOGUE,
    )
    jobs = {
        4: lambda rules, users: attach_tags(users, rules, "gender"),
        7: lambda rules, users: attach_tags(users, rules, "job"),
    }
    root = f"file://{tmp_path}/profile"
    save_version(frame("userId,tagIds", [("1", "23"), ("77", "9")]), root)
    path = run_tag_jobs(spark, tags, jobs, root, merge=False)
    assert pairs(readers.read_profile(spark, path)) == {("1", "10,6"), ("10", "6"), ("77", "9")}


def test_scratch_is_the_folder_the_session_names(spark):
    root = scratch_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert root == (named or spark.sparkContext.getCheckpointDir())
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(root) and first != second


def test_store_source(spark, frame, pairs, tmp_path):
    rule = {"inType": "store", "path": f"file://{tmp_path}/store", "rowKey": "id"}
    with pytest.raises(ValueError, match="empty"):
        readers.read_source(spark, rule)
    write_source(frame("id,gender", [("1", "2"), ("2", "1"), ("2", "3")]), rule)
    assert pairs(readers.read_source(spark, rule)) == {("1", "2"), ("2", "3")}
    write_source(frame("id,gender,job", [("2", None, "5"), ("3", "1", None)]), rule)
    picked = readers.read_source(spark, rule | {"selectFields": "id,gender,job"})
    assert pairs(picked) == {("1", "2", None), ("2", "3", "5"), ("3", "1", None)}
    with pytest.raises(ValueError, match="rowKey"):
        write_source(picked, {"inType": "store", "path": "x"})
    with pytest.raises(ValueError, match="cannot write"):
        write_source(picked, {"inType": "parquet", "path": "x"})
