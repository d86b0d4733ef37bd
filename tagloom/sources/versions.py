"""Tables kept as whole versions below one folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

VERSION_PREFIX = "version="


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists on the file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def numbers_of(spark: SparkSession, root: str, prefix: str = VERSION_PREFIX, pattern: str = "") -> list[int]:
    """Numbers of the files or folders `prefix` + number below `root`, in order."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{prefix}*{pattern}")
    fs = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(glob) or []
    paths = [status.getPath().toString() for status in found]
    return sorted(int(p.rsplit(prefix, 1)[1].split("/")[0]) for p in paths)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a string."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all; an existing one is an error."""
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(to.getParent(), f".{uuid.uuid4().hex}")
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(to) or not fs.rename(aside, to):
        raise FileExistsError(path)


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest version that was written to its end, or None."""
    done = numbers_of(spark, root, pattern="/_SUCCESS")
    return f"{root}/{VERSION_PREFIX}{done[-1]:08d}" if done else None


def save_version(df: DataFrame, root: str) -> str:
    """Write `df` as the next version below `root` and return its path.

    A frame that reads the current version can be saved this way, and a job that dies half
    way leaves the current version as it was.
    """
    begun = numbers_of(df.sparkSession, root)
    path = f"{root}/{VERSION_PREFIX}{(begun[-1] if begun else 0) + 1:08d}"
    df.write.mode("errorifexists").parquet(path)
    return path
