"""Run tag jobs and save the next profile version, for spark-submit or a plain Python call.

    spark-submit run_tags.py --catalogue 'inType=parquet##path=/tags' --profile /profile gender age

Sources are named as in level-4 rules. The path of the new version is printed.
"""

from __future__ import annotations

import argparse
import json

from tagloom import build_session
from tagloom.fixed_values import RULE_KEY_SEPARATOR, RULE_PAIR_SEPARATOR
from tagloom.plans.standard import jobs_by_tag
from tagloom.plans.template import run_tag_jobs
from tagloom.sources.readers import read_source


def parse_rule(text: str) -> dict[str, str]:
    """A rule given on the command line, as in `functions.rules.rule_options`."""
    pairs = (part.partition(RULE_KEY_SEPARATOR) for part in text.split(RULE_PAIR_SEPARATOR))
    return {key: value for key, _, value in pairs}


def parse_settings(texts: list[str]) -> dict[str, dict]:
    """`job.name=json` texts as settings by job."""
    found: dict[str, dict] = {}
    for text in texts:
        name, _, value = text.partition("=")
        job, _, setting = name.partition(".")
        found.setdefault(job, {})[setting] = json.loads(value)
    return found


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("jobs", nargs="+", help="names of standard tag jobs")
    parser.add_argument("--catalogue", required=True, help="rule naming the tag catalogue")
    parser.add_argument("--profile", required=True, help="folder of the profile versions")
    parser.add_argument("--orders", help="rule naming the orders, for the usg job")
    parser.add_argument("--as-of", help="day to count from, yyyy-MM-dd; today if not given")
    parser.add_argument("--rfm-model", help="folder of the fitted customer-value model")
    parser.add_argument("--replace", action="store_true", help="write over stored tags")
    parser.add_argument(
        "--replace-siblings", action="store_true", help="a new tag takes the place of those next to it"
    )
    parser.add_argument(
        "--set", action="append", default=[], metavar="JOB.NAME=JSON", help="setting of a job, as cycle.shift_days=0"
    )
    args = parser.parse_args(argv)

    spark = build_session("run_tags")
    catalogue = read_source(spark, parse_rule(args.catalogue), as_strings=False)
    orders = read_source(spark, parse_rule(args.orders), as_strings=False) if args.orders else None
    jobs = jobs_by_tag(
        args.jobs, as_of=args.as_of, orders=orders, rfm_model_path=args.rfm_model, settings=parse_settings(args.set)
    )
    path = run_tag_jobs(
        spark, catalogue, jobs, args.profile, merge=not args.replace, replace_siblings=args.replace_siblings
    )
    print(path)
    return path


if __name__ == "__main__":
    main()
