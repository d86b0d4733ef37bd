"""All standard jobs in one run, from a catalogue and source files to a saved profile."""

import pytest

import run_tags
from tagloom import fixed_values as fixed
from tagloom.plans import tag_jobs, template
from tagloom.plans.standard import jobs_by_tag, standard_jobs
from tagloom.sources.readers import read_profile

RULES = {
    "gender": fixed.GENDER_RULES,
    "job": fixed.JOB_RULES,
    "nationality": fixed.NATIONALITY_RULES,
    "political": [(353, "1"), (354, "2")],
    "age": fixed.AGE_RULES,
    "cycle": fixed.CYCLE_RULES,
    "payment": fixed.PAYMENT_RULES,
    "rfm": fixed.RFM_RULES,
    "rfe": fixed.RFE_RULES,
    "psm": fixed.PSM_RULES,
    "usg": fixed.USG_RULES,
    "brand": [],
}
FIELDS = {
    "gender": ("users", "id,gender"),
    "job": ("users", "id,job"),
    "nationality": ("users", "id,nationality"),
    "political": ("users", "id,politicalFace"),
    "age": ("users", "id,birthday"),
    "cycle": ("orders", "memberId,finishTime"),
    "payment": ("orders", "memberId,paymentCode"),
    "rfm": ("orders", "memberId,orderSn,orderAmount,finishTime"),
    "rfe": ("views", "global_user_id,loc_url,log_time"),
    "psm": ("orders", "memberId,orderSn,orderAmount,couponCodeValue"),
    "usg": ("items", "cOrderSn,ogColor,productType"),
    "brand": ("views", "global_user_id,loc_url"),
}
USERS = [str(u) for u in range(1, 31)]
SUMMER = 1564617600  # 2019-08-01


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('run')}"

    def save(name, columns, rows):
        df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns.split(",")))
        df.write.parquet(f"{root}/{name}")

    number = [(u, int(u)) for u in USERS]
    users = [
        (u, str(n % 2 + 1), str(n % 6 + 1), str(n % 3), str(n % 4), f"19{50 + n}-06-15")
        for u, n in number
    ]
    save("users", "id,gender,job,nationality,politicalFace,birthday", users)
    codes = ["alipay", "cod", "bitcoin"]
    orders = [
        (u, f"{u}-{i}", str(100 * n), str(SUMMER - 86400 * (n + i)), codes[n % 3], str(n % 5 * 3))
        for u, n in number
        for i in range(4)
    ]
    save("orders", "memberId,orderSn,orderAmount,finishTime,paymentCode,couponCodeValue", orders)
    save(
        "items",
        "cOrderSn,ogColor,productType",
        [(o[1], "白色" if int(o[0]) % 2 else "黑色", "烤箱") for o in orders],
    )
    page = "http://shop.example/product/{}.html".format
    views = [
        (u, page(1000 + (n + i) % 9), f"2019-07-{1 + n % 28:02d} 10:00:00")
        for u, n in number
        for i in range(12)
    ]
    save("views", "global_user_id,loc_url,log_time", views)
    tags = []
    for name, rules in RULES.items():
        table, fields = FIELDS[name]
        parent = fixed.TAG_IDS[name]
        rule = f"inType=parquet##path={root}/{table}##selectFields={fields}"
        tags += [(parent, name, rule, 4, 3)] + [(i, name, r, 5, parent) for i, r in rules]
    schema = "id long, name string, rule string, level int, pid long"
    spark.createDataFrame(tags, schema).write.parquet(f"{root}/catalogue")
    return root


def run(sources, profile, *arguments):
    return run_tags.main(
        [
            "--catalogue", f"inType=parquet##path={sources}/catalogue",
            "--orders", f"inType=parquet##path={sources}/orders##selectFields=memberId,orderSn",
            "--profile", profile,
            "--as-of", "2019-10-31",
            *arguments,
        ]
    )


def test_all_jobs_in_one_run(spark, sources, tmp_path):
    path = run(sources, f"file://{tmp_path}/profile", *RULES)
    tags = {r["userId"]: set(r["tagIds"].split(",")) for r in read_profile(spark, path).collect()}
    assert set(tags) == set(USERS)
    for name in ("gender", "job", "payment", "rfe", "usg"):
        ids = {str(i) for i, _ in RULES[name]}
        assert all(len(found & ids) == 1 for found in tags.values()), name
    assert "5" in tags["2"] and "6" in tags["1"]
    natives = {u for u, found in tags.items() if "420" in found}
    assert natives == {u for u in USERS if int(u) % 3 == 1}
    assert {"16", "30"} <= tags["12"] and "35" in tags["2"]
    # Odd users buy what the rule labels female.
    assert {u for u, found in tags.items() if "58" in found} == {u for u in USERS if int(u) % 2}
    # Users without a discounted order have no price sensitivity.
    psm = {str(i) for i, _ in fixed.PSM_RULES}
    assert {u for u, found in tags.items() if found & psm} == {u for u in USERS if int(u) % 5}


def test_runs_add_up_or_replace(spark, sources, tmp_path, pairs):
    profile = f"file://{tmp_path}/profile"
    run(sources, profile, "gender")
    both = read_profile(spark, run(sources, profile, "job"))
    assert ("1", "6,9") in pairs(both)
    replaced = read_profile(spark, run(sources, profile, "--replace", "payment"))
    assert ("1", "34") in pairs(replaced)


def test_order_jobs_share_one_scan(spark, sources, tmp_path, monkeypatch, pairs):
    """Cycle, payment, customer value and price sensitivity: the orders are opened once."""
    opened = []
    read = template.read_source

    def counted(spark, rule, **arguments):
        opened.append(rule["path"].rpartition("/")[2])
        return read(spark, rule, **arguments)

    monkeypatch.setattr(template, "read_source", counted)
    names = ("cycle", "payment", "rfm", "psm")
    found = read_profile(spark, run(sources, f"file://{tmp_path}/together", *names))
    assert opened.count("orders") == 1
    root = f"file://{tmp_path}/alone"
    for name in names:
        alone = run(sources, root, name)
    assert pairs(found) == pairs(read_profile(spark, alone))


def test_settings_reach_the_jobs(spark, sources, tmp_path):
    def tags(*arguments):
        path = run(sources, f"file://{tmp_path}/{len(arguments)}", *arguments, "cycle", "psm")
        return {r["userId"]: r["tagIds"] for r in read_profile(spark, path).collect()}

    usual, shifted = tags(), tags("--set", "cycle.shift_days=0", "--set", "psm.zero_discount_eps=0.01")
    psm = {str(i) for i, _ in fixed.PSM_RULES}
    assert usual != shifted and all(set(t.split(",")) & psm for t in shifted.values())
    with pytest.raises(ValueError, match="unknown jobs"):
        tags("--set", "horoscope.k=1")


def test_new_tags_take_the_place_of_their_siblings(spark, sources, tmp_path):
    def payments(*arguments):
        path = run(sources, f"file://{tmp_path}/{len(arguments)}", "gender", "cycle")
        path = run(sources, f"file://{tmp_path}/{len(arguments)}", "--set", "cycle.shift_days=85", *arguments, "cycle")
        ids = {str(i) for i, _ in fixed.CYCLE_RULES}
        genders = {str(i) for i, _ in fixed.GENDER_RULES}
        rows = [set(r["tagIds"].split(",")) for r in read_profile(spark, path).collect()]
        assert all(len(tags & genders) == 1 for tags in rows)
        return max(len(tags & ids) for tags in rows)

    assert payments() == 2 and payments("--replace-siblings") == 1


def test_model_is_kept_between_runs(spark, sources, tmp_path, pairs):
    model = f"file://{tmp_path}/model"
    first = run(sources, f"file://{tmp_path}/a", "--rfm-model", model, "rfm")
    again = run(sources, f"file://{tmp_path}/b", "--rfm-model", model, "rfm")
    assert pairs(read_profile(spark, first)) == pairs(read_profile(spark, again)) != set()


def test_orders_in_one_pass_equal_the_single_jobs(spark, sources, pairs):
    orders = spark.read.parquet(f"{sources}/orders")
    as_of = "2019-10-31"
    single = (
        tag_jobs.cycle_tags(orders, as_of=as_of)
        .unionByName(tag_jobs.rfm_tags(orders, as_of=as_of))
        .unionByName(tag_jobs.psm_tags(orders))
    )
    found = pairs(tag_jobs.order_tags(orders, as_of=as_of))
    assert found == pairs(single) and len(found) > 60


def test_every_job_has_a_parent_tag():
    assert set(standard_jobs()) == set(fixed.TAG_IDS)


def test_unknown_job_and_missing_orders(spark, sources):
    with pytest.raises(ValueError, match="unknown tag jobs"):
        jobs_by_tag(["horoscope"])
    with pytest.raises(ValueError, match="second source"):
        standard_jobs()["usg"](None, None)
