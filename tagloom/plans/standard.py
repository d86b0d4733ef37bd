"""The standard tag jobs by name, ready for `run_tag_jobs`."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from tagloom import fixed_values as fixed
from tagloom.operators import aggregates
from tagloom.operators.lookup import Rules
from tagloom.plans import tag_jobs
from tagloom.plans.template import Compute, SharedJob


def standard_jobs(
    as_of: date | str | None = None,
    orders: DataFrame | None = None,
    rfm_model_path: str | None = None,
    settings: Mapping[str, Mapping] | None = None,
) -> dict[str, Compute]:
    """Name to `compute(rules, source)`; the parent tag of a name is in `fixed_values.TAG_IDS`.

    `orders` is the second source of the shopping-gender job, which reads order items (S8). `settings`
    holds further arguments of a job by its name, such as {"cycle": {"shift_days": 0}} or
    {"psm": {"zero_discount_eps": 0.01}}. The four order jobs share one summary of their orders.
    """
    own = {name: dict((settings or {}).get(name, {})) for name in fixed.TAG_IDS}
    unknown = sorted(set(settings or {}) - set(own))
    if unknown:
        raise ValueError(f"settings for unknown jobs {unknown}")

    def usg(rules: Rules, items: DataFrame) -> DataFrame:
        if orders is None:
            raise ValueError("the usg job needs the orders as a second source")
        return tag_jobs.usg_tags(items, orders, rules, **own["usg"])

    def from_totals(job, **arguments) -> Compute:
        return SharedJob(
            aggregates.order_summary,
            lambda rules, summary: job(aggregates.member_totals(summary), rules, **arguments),
        )

    return {
        "gender": lambda rules, users: tag_jobs.gender_tags(users, rules, **own["gender"]),
        "job": lambda rules, users: tag_jobs.job_tags(users, rules, **own["job"]),
        "nationality": lambda rules, users: tag_jobs.nationality_tags(users, rules, **own["nationality"]),
        "political": lambda rules, users: tag_jobs.political_face_tags(users, rules, **own["political"]),
        "age": lambda rules, users: tag_jobs.age_tags(users, rules, **own["age"]),
        "cycle": from_totals(tag_jobs.cycle_from, **{"as_of": as_of, **own["cycle"]}),
        "payment": SharedJob(
            aggregates.order_summary, lambda rules, summary: tag_jobs.payment_from(summary, rules)
        ),
        "rfm": from_totals(
            tag_jobs.rfm_from, **{"as_of": as_of, "model_path": rfm_model_path, **own["rfm"]}
        ),
        "rfe": lambda rules, views: tag_jobs.rfe_tags(views, rules, **{"as_of": as_of, **own["rfe"]}),
        "psm": from_totals(tag_jobs.psm_from, **own["psm"]),
        "usg": usg,
        "brand": lambda _, views: tag_jobs.brand_tags(views, **own["brand"]),
    }


def jobs_by_tag(names: list[str], **settings) -> dict[int, Compute]:
    """The named standard jobs by parent tag."""
    jobs = standard_jobs(**settings)
    unknown = sorted(set(names) - set(jobs))
    if unknown:
        raise ValueError(f"unknown tag jobs {unknown}; known are {sorted(jobs)}")
    return {fixed.TAG_IDS[name]: jobs[name] for name in names}
