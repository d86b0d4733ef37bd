import random

import pytest
from pyspark.sql import functions as F

from tagloom import fixed_values as fixed
from tagloom.operators import bounded, lookup
from tagloom.operators.bounded import fits_broadcast
from tagloom.operators.lookup import Match, attach_all_tags, attach_band_tags, attach_tags
from tagloom.plans import tag_jobs


def rules_df(spark, rules):
    return spark.createDataFrame(rules, "id long, rule string")


@pytest.fixture(params=["list", "frame"])
def as_given(request, spark):
    """Rules as a list or as a catalogue frame."""
    return (lambda r: r) if request.param == "list" else (lambda r: rules_df(spark, r))


def test_gender(frame, pairs, as_given):
    users = frame("id,gender", [("1", "2"), ("10", "2"), ("100", "2"), ("101", "1")])
    tagged = tag_jobs.gender_tags(users, as_given(fixed.GENDER_RULES))
    assert pairs(tagged) == {("1", "6"), ("10", "6"), ("100", "6"), ("101", "5")}


def test_job(frame, pairs, as_given):
    users = frame("id,job", [("1", "3"), ("10", "5"), ("101", "1"), ("104", "6")])
    tagged = tag_jobs.job_tags(users, as_given(fixed.JOB_RULES))
    assert pairs(tagged) == {("1", "10"), ("10", "12"), ("101", "8"), ("104", "13")}


@pytest.mark.parametrize("gender", ["9", None])
def test_strict_lookup_fails_without_a_rule(frame, as_given, gender):
    users = frame("id,gender", [("1", gender)])
    with pytest.raises(Exception, match="no rule for"):
        tag_jobs.gender_tags(users, as_given(fixed.GENDER_RULES)).collect()


def test_drop_keeps_every_matching_rule(frame, pairs, as_given):
    users = frame("id,nationality", [("1", "1"), ("2", "2"), ("3", None)])
    tagged = tag_jobs.nationality_tags(users, as_given([(420, "1"), (421, "1")]))
    assert pairs(tagged) == {("1", "420"), ("1", "421")}


def test_blank(frame, pairs, as_given):
    users = frame("id,politicalFace", [("1", "1"), ("2", "7"), ("3", None)])
    tagged = tag_jobs.political_face_tags(users, as_given([(353, "1")]))
    assert pairs(tagged) == {("1", "353"), ("2", ""), ("3", "")}


def test_default(frame, pairs, as_given):
    rows = [("1", "alipay"), ("2", "bitcoin"), ("3", None), ("4", "cod")]
    orders = frame("memberId,paymentCode", rows)
    tagged = tag_jobs.payment_tags(orders, as_given(fixed.PAYMENT_RULES))
    assert pairs(tagged) == {("1", "30"), ("2", "35"), ("3", "35"), ("4", "34")}


def test_default_needs_its_rule(frame, as_given):
    with pytest.raises(ValueError, match="no rule 'other'"):
        attach_tags(frame("id,k", [("1", "a")]), as_given([(1, "a")]), "k", unmatched="default")


def test_highest_id_of_equal_rules(frame, pairs, as_given):
    users = frame("id,k", [("1", "a")])
    tagged = attach_tags(users, as_given([(7, "a"), (3, "a")]), "k", unmatched="blank")
    assert pairs(tagged) == {("1", "7")}


def test_all_at_once_equals_one_by_one(spark, frame, as_given):
    users = frame(
        "id,a,b,c", [("1", "x", "p", "k"), ("2", "z", None, "m"), ("3", None, "q", None)]
    )
    matches = [
        Match(as_given([(1, "x"), (2, "x"), (3, "y")]), "a", "drop"),
        Match(as_given([(11, "p"), (12, "other")]), "b", "default"),
        Match(as_given([(21, "k")]), "c", "blank"),
    ]
    found = {
        r["userId"]: {t for t in r["tagIds"].split(",") if t}
        for r in attach_all_tags(users, matches).collect()
    }
    expected = {}
    for match in matches:
        for row in attach_tags(users, match.rules, match.key, unmatched=match.unmatched).collect():
            expected.setdefault(row["userId"], set()).update(t for t in [row["tagIds"]] if t)
    assert found == expected


def test_all_at_once_without_tags_gives_no_row(frame, as_given):
    users = frame("id,a", [("1", "x"), ("2", "n")])
    tagged = attach_all_tags(users, [Match(as_given([(1, "x")]), "a")])
    assert [tuple(r) for r in tagged.collect()] == [("1", "1")]


def test_age(frame, pairs, as_given):
    days = ["1992-05-31", "1980-10-13", "1976-05-08", "1949-12-31", None]
    users = frame("id,birthday", [(str(i), day) for i, day in enumerate(days, start=1)])
    tagged = tag_jobs.age_tags(users, as_given(fixed.AGE_RULES))
    assert pairs(tagged) == {("1", "19"), ("2", "18"), ("3", "17")}


def test_cycle(spark, frame, pairs, as_given):
    as_of, day = "2020-01-31", 24 * 3600
    shifted = 1577836800  # 2020-01-01, 30 days earlier
    gaps = {"0": 0, "7": 7, "8": 8, "30": 30, "60": 60, "90": 90, "91": 91, "early": -1}
    rows = [(user, str(shifted - gap * day)) for user, gap in gaps.items()]
    rows += [("7", str(shifted - 80 * day)), ("bad", "n/a"), ("none", None)]
    orders = frame("memberId,finishTime", rows)
    tagged = tag_jobs.cycle_tags(orders, as_given(fixed.CYCLE_RULES), as_of)
    assert pairs(tagged) == {
        ("0", "24"),
        ("7", "24"),
        ("8", "25"),
        ("30", "26"),
        ("60", "27"),
        ("90", "28"),
    }


@pytest.mark.parametrize("shuffled", [True, False])
@pytest.mark.parametrize("numeric", [True, False])
def test_many_bands_join_by_cell(spark, monkeypatch, numeric, shuffled):
    """The band join by cells finds the same pairs as testing every band, also for a hot value."""
    if shuffled:
        monkeypatch.setattr(bounded, "fits_broadcast", lambda df: False)
    draw = random.Random(3)
    bands = []
    for i in range(200):
        low = draw.randrange(0, 100000)
        bands.append((i, low, low + draw.choice([0, 1, 7, 300, 40000])))
    bands += [(900, 50, 20), (901, 0, 10**8 if numeric else 99999999)]
    show = str if numeric else "{:08d}".format
    values = [draw.randrange(0, 150000) for _ in range(300)] + [4242] * 150
    users = spark.createDataFrame(list(enumerate(show(v) for v in values)), "id long, v string")
    rules = rules_df(spark, [(i, f"{show(a)}-{show(b)}") for i, a, b in bands])
    tagged = attach_band_tags(users, rules, F.col("v"), numeric=numeric)
    plan = tagged._jdf.queryExecution().toString()
    found = tagged.collect()
    expected = [(str(u), str(i)) for u, v in enumerate(values) for i, a, b in bands if a <= v <= b]
    assert sorted(tuple(r) for r in found) == sorted(expected)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("count", [64, 65, 10_000])
def test_bands_are_exact_for_any_number_of_rules(spark, count):
    """Wide, open and just too wide spans; the other rules only make the frame longer."""
    bands = [(2**54 - 1, 2**55), (0, 2**63 - 1)] + [(7, 7 + 2**b + 2) for b in range(30, 62)]
    filler = [(10**9 + i, 10**9 + i) for i in range(count - len(bands))]
    values = [2**54 + 5, 0, 2**63 - 1, 7, *(7 + 2**b + 2 for b in range(30, 62)), 2**40 + 11]
    rules = [(i, f"{a}-{b}") for i, (a, b) in enumerate(bands + filler)]
    users = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    tagged = attach_band_tags(users, rules_df(spark, rules), F.col("v"), numeric=True)
    expected = {
        (str(u), str(i)) for u, v in enumerate(values) for i, (a, b) in enumerate(bands + filler) if a <= v <= b
    }
    assert {tuple(r) for r in tagged.collect()} == expected


@pytest.mark.parametrize("count", [60, 300])
def test_text_bands_with_a_long_common_start(spark, count):
    hours = [f"2024{i // 24 // 28 + 1:02d}{i // 24 % 28 + 1:02d}{i % 24:02d}" for i in range(count)]
    bands = [(h + "0000", h + "5959") for h in hours] + [("2024", "20240101020000"), ("b", "a"), ("x", "x")]
    values = [h + "3000" for h in hours[::7]] + ["20240101", "2024", "x", "xx", "", "2024010102"]
    rules = rules_df(spark, [(i, f"{a}-{b}") for i, (a, b) in enumerate(bands)])
    users = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    found = {tuple(r) for r in attach_band_tags(users, rules, F.col("v")).collect()}
    assert found == {(str(u), str(i)) for u, v in enumerate(values) for i, (a, b) in enumerate(bands) if a <= v <= b}



def test_short_rules(spark, monkeypatch):
    rules = rules_df(spark, [(5, "1"), (6, "2")])
    assert sorted(lookup.short_rules(rules)) == [(5, "1"), (6, "2")]
    monkeypatch.setattr(lookup, "fits_broadcast", lambda df: False)
    assert lookup.short_rules(rules) is rules


def test_a_list_is_small_by_its_bytes_too(spark):
    assert lookup._is_short_list([(1, "a")])
    assert not lookup._is_short_list([(i, "x" * 100_000) for i in range(200)])  # 20 MB


def test_broadcast_only_within_bounds(spark):
    df = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 100).alias("s"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=5000)


@pytest.mark.parametrize("unmatched", lookup.UNMATCHED)
def test_lookup_beyond_the_bound_is_a_plain_join(spark, pairs, monkeypatch, unmatched):
    rules = rules_df(spark, [(i, f"k{i}") for i in range(50)] + [(99, "other"), (98, "k3")])
    keys = ["k3"] * 400 + [f"k{i % 50}" for i in range(400)]
    if unmatched != "error":
        keys += ["none", None]
    users = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    expected = pairs(attach_tags(users, rules, "k", unmatched=unmatched))
    as_one = pairs(attach_all_tags(users, [Match(rules, "k", unmatched)]))
    monkeypatch.setattr(bounded, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tagged = attach_tags(users, rules, "k", unmatched=unmatched)
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
        assert pairs(tagged) == expected
        assert pairs(attach_all_tags(users, [Match(rules, "k", unmatched)])) == as_one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
