"""Read sources named by a level-4 rule, the tag catalogue, and demo text files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tagloom.fixed_values import SOURCE_KEYS
from tagloom.functions.rules import rule_options
from tagloom.sources.buckets import BUCKET, open_store, read_manifest
from tagloom.sources.hbase import HBASE_FORMAT, hbase_options
from tagloom.sources.versions import latest_version

FILE_FORMATS = ("parquet", "orc", "json", "csv", "libsvm")

IRIS_COLUMNS = ["Sepal_Length", "Sepal_Width", "Petal_Length", "Petal_Width"]


def read_catalogue(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None
) -> DataFrame:
    """Tag catalogue over JDBC (S1); filters on id and pid reach the database."""
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def level4_rule(catalogue: DataFrame, tag_id: int) -> DataFrame:
    """Rule text of one model tag."""
    return catalogue.where(F.col("id") == tag_id).select("rule")


def level5_rules(catalogue: DataFrame, tag_id: int) -> DataFrame:
    """Value rules below one model tag."""
    return catalogue.where(F.col("pid") == tag_id).select("id", "rule")


def source_options(catalogue: DataFrame, tag_id: int) -> dict[str, str]:
    """Parsed level-4 rule of one tag, one row brought to the driver (F1)."""
    row = level4_rule(catalogue, tag_id).select(rule_options(F.col("rule"))).first()
    if row is None or row[0] is None:
        raise ValueError(f"tag {tag_id} has no data-source rule")
    return row[0]


def source_descriptor(options: Column, default: str | None = None) -> Column:
    """The seven source settings of a parsed rule as a struct (F2)."""
    fields = []
    for key in SOURCE_KEYS:
        value = F.try_element_at(options, F.lit(key))
        if default is not None:
            value = F.coalesce(value, F.lit(default))
        fields.append(value.alias(key))
    return F.struct(*fields)


def select_fields(df: DataFrame, fields: list[str], as_strings: bool = True) -> DataFrame:
    """The named fields in order; an absent one is a null string.

    `as_strings=False` leaves stored types alone, for jobs that cast what they need.
    """
    present = set(df.columns)
    columns = []
    for name in fields:
        column = F.col(f"`{name}`") if name in present else F.lit(None)
        if as_strings or name not in present:
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def read_source(
    spark: SparkSession, rule: Mapping[str, str], as_strings: bool = True
) -> DataFrame:
    """Open the source a level-4 rule names and select its fields.

    `inType` is a file format with `path`, `jdbc` with `url` and `dbtable`, `table` with
    `name`, `store` with the `path` of a store kept by `write_source`, or `HBase`. All further
    keys are handed to the reader as options.
    """
    kind = (rule.get("inType") or "").lower()
    fields = [f.strip() for f in (rule.get("selectFields") or "").split(",") if f.strip()]
    own = ("inType", "selectFields", "rowKey")
    options = {k: v for k, v in rule.items() if k not in own and v is not None}
    if kind == "hbase":
        df = spark.read.format(HBASE_FORMAT).options(**hbase_options(rule, fields)).load()
    elif kind == "table":
        df = spark.read.table(options["name"])
    elif kind == "jdbc":
        df = spark.read.format("jdbc").options(**options).load()
    elif kind == "store":
        df = read_store(spark, options["path"])
    elif kind in FILE_FORMATS:
        path = options.pop("path")
        df = spark.read.format(kind).options(**options).load(path)
    else:
        raise ValueError(f"unknown inType {rule.get('inType')!r}")
    return select_fields(df, fields, as_strings) if fields else df


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The current rows of a store, in buckets or in whole versions."""
    if read_manifest(spark, root):
        return open_store(spark, root).drop(BUCKET)
    current = latest_version(spark, root)
    if current is None:
        raise ValueError(f"store {root} is empty")
    return spark.read.parquet(current)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Stored profile (userId, tagIds) of a version, or of a store in buckets."""
    rows = read_store(spark, path) if read_manifest(spark, path) else spark.read.parquet(path)
    return rows.select(
        F.col("userId").cast("string"), F.col("tagIds").cast("string")
    )


def read_libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    """(label, features) rows (S9); naming the width saves a pass over the file."""
    reader = spark.read.format("libsvm")
    if n_features is not None:
        reader = reader.option("numFeatures", n_features)
    return reader.load(path)


def read_measurements(
    spark: SparkSession, path: str, numbers: list[str] | None = None, label: str = "Species"
) -> DataFrame:
    """Header-less CSV of numbers and a label (S10); text that is no number becomes null."""
    names = IRIS_COLUMNS if numbers is None else numbers
    schema = StructType(
        [StructField(n, DoubleType()) for n in names] + [StructField(label, StringType())]
    )
    return spark.read.csv(path, schema=schema, mode="PERMISSIVE")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First `n` rows (S12, O4); sort first if it matters which."""
    return df.limit(n)
