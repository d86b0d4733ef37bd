"""All registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import apply_engine_conf
from tagloom.workload import catalogues, certificates, features, known_fits, learning, matching, profiles

MODULES = (matching, features, learning, known_fits, certificates, profiles, catalogues)

Query = Callable[[SparkSession, str], DataFrame]


def configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_engine_conf(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {name: configured(q) for module in MODULES for name, q in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
