from pyspark.sql import functions as F

from tagloom.operators import catalogue as cat


def tags(spark):
    return spark.createDataFrame(
        [
            (1, "shop", None, 1, -1),
            (2, "mall", None, 2, 1),
            (3, "people", None, 3, 2),
            (4, "gender", "inType=x", 4, 3),
            (5, "male", "1", 5, 4),
            (6, "female", "2", 5, 4),
        ],
        "id long, name string, rule string, level int, pid long",
    )


def test_children_level_and_lookup(spark):
    assert {r["id"] for r in cat.children(tags(spark), 4).collect()} == {5, 6}
    assert {r["id"] for r in cat.tags_of_level(tags(spark), 5).collect()} == {5, 6}
    assert [r["id"] for r in cat.find_tag(tags(spark), "mall", 2, 1).collect()] == [2]
    assert cat.find_tag(tags(spark), "mall", 2, 9).count() == 0
    below = cat.children_of(tags(spark), tags(spark))
    assert {(r["id"], r["parent_name"]) for r in below.where("level = 5").collect()} == {
        (5, "gender"),
        (6, "gender"),
    }


def test_tags_with_models(spark):
    models = spark.createDataFrame(
        [(70, 5, "m", "10,2020-01-01 00:00:00,2020-02-01 00:00:00")],
        "id long, tag_id long, model_name string, sche_time string",
    )
    rows = cat.with_models(cat.children(tags(spark), 4), models).collect()
    assert {(r["id"], r["model_id"], r["model_name"]) for r in rows} == {
        (5, 70, "m"),
        (6, None, None),
    }


def add(spark, paths):
    df = spark.createDataFrame(paths, "level1 string, level2 string, level3 string")
    rows = cat.add_paths(tags(spark), df).collect()
    return sorted((r["id"], r["name"], r["level"], r["pid"]) for r in rows)


def test_known_path_adds_nothing(spark):
    assert add(spark, [("shop", "mall", "people")]) == []


def test_new_leaf_below_known_path(spark):
    assert add(spark, [("shop", "mall", "goods"), ("shop", "mall", "goods")]) == [(7, "goods", 3, 2)]


def test_new_path_chains_ids(spark):
    # The same names under another parent are other tags.
    assert add(spark, [("bank", "mall", "people")]) == [
        (7, "bank", 1, -1),
        (8, "mall", 2, 7),
        (9, "people", 3, 8),
    ]


def test_path_ends_at_null(spark):
    assert add(spark, [("bank", None, "people")]) == [(7, "bank", 1, -1)]


def test_many_paths_get_dense_ids_and_their_parents(spark):
    paths = [(f"a{i}", f"b{i % 7}", f"c{i % 11}") for i in range(500)]
    rows = add(spark, paths)
    assert [r[0] for r in rows] == list(range(7, 7 + 1500))
    by_id = {r[0]: r for r in rows}
    found = set()
    for _, name, level, pid in rows:
        if level == 3:
            parent = by_id[pid]
            found.add((by_id[parent[3]][1], parent[1], name))
    assert found == set(paths)


def test_schedule(spark):
    df = spark.createDataFrame(
        [("10,2019-11-20 08:00:00,2019-12-20 18:30:00",), ("x,bad",), (None,)], "s string"
    )
    typed = df.select("s", *cat.schedule_fields(F.col("s")))
    rows = typed.collect()
    assert (rows[0]["frequency"], str(rows[0]["start_time"])) == (10, "2019-11-20 08:00:00")
    assert [rows[1][c] for c in ("frequency", "start_time", "end_time")] == [None] * 3
    assert [rows[2][c] for c in ("frequency", "start_time", "end_time")] == [None] * 3
    packed = typed.select(
        cat.schedule_text(F.col("frequency"), F.col("start_time"), F.col("end_time"))
    ).first()[0]
    assert packed == "10,2019-11-20 08:00:00,2019-12-20 18:30:00"
