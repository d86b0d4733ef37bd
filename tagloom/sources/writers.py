"""Write sources by rule and keep fitted models."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.merge import last_cells, upsert
from tagloom.sources.buckets import BUCKETS, create_store, read_manifest, rewrite_store
from tagloom.sources.hbase import HBASE_FORMAT, hbase_options
from tagloom.sources.versions import latest_version, path_exists, save_version

#: Folder of a stored model that holds the settings of its fit.
SETTINGS = "settings"


def write_source(df: DataFrame, rule: Mapping[str, str]) -> str | None:
    """Upsert `df` by the rule's `rowKey` into the source the rule names.

    `store` saves the next version below `path` and returns its path; `HBase` puts the cells
    through the connector. A store begun with `buckets` in its rule rewrites only the buckets of the keys
    written (see `sources.buckets`); its path is that of the store.
    """
    kind, key = (rule.get("inType") or "").lower(), rule.get("rowKey")
    if kind not in ("store", "hbase"):
        raise ValueError(f"cannot write to inType {rule.get('inType')!r}")
    if not key:
        raise ValueError("a rule to write by needs a rowKey")
    if kind == "hbase":
        options = hbase_options(rule, df.columns)
        df.write.format(HBASE_FORMAT).options(**options).save()
        return None
    spark, root = df.sparkSession, rule["path"]
    if read_manifest(spark, root):
        rewrite_store(root, df, upsert)
        return root
    if rule.get("buckets") and latest_version(spark, root) is None:
        create_store(df, root, key, int(rule["buckets"] or BUCKETS))
        return root
    current = latest_version(spark, root)
    if current is None:
        return save_version(last_cells(df, key), root)
    return save_version(upsert(spark.read.parquet(current), df, key), root)


def load_or_fit(
    spark: SparkSession, path: str | None, load: Callable, fit: Callable, settings: Mapping[str, Any] | None = None
) -> Any:
    """Model stored at `path`, else a new one, stored there if a path is given.

    The settings of the fit are stored beside the model, after it: a model of other settings, and one that broke
    off before they were written, is fitted anew. Settings are what the caller chooses (k, columns,
    bands, seed), not the data: the same model tags the users of later days.
    """
    wanted = json.dumps(settings or {}, sort_keys=True, default=str)
    manifest = f"{path}/{SETTINGS}"
    if path and path_exists(spark, f"{manifest}/_SUCCESS") and spark.read.text(manifest).first()[0] == wanted:
        return load(path)
    model = fit()
    if path:
        model.write().overwrite().save(path)
        spark.createDataFrame([(wanted,)], "value string").coalesce(1).write.mode("overwrite").text(manifest)
    return model
