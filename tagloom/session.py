"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rule strings may repeat a key; the last one counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def build_session(app: str = "tagloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; pass dotted settings through `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings the jobs rely on."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, shared by all executors.

    A cluster names it in `spark.checkpoint.dir`. Only a local session may fall back to a
    temporary folder, because no other machine has to read it there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tagloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the scratch folder once and go on from the written table.

    Used where one frame feeds both a fit and the job after it, so that the scan behind it
    runs once and a lost executor re-reads the table instead of the sources.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
