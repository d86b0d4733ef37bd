"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task; bounds the memory of a Python worker.
SLICE_BYTES = 2_500_000

#: Fixed by the data contract: words are runs of anything but these six characters, which are
#: also what `bytes.split()` splits at.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of `df` has it (case ignored)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def exact(name: str) -> Column:
    """The column of that very name, dots and blanks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def slice_bounds(texts: pa.Array, size: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Runs of rows with about `size` bytes of text each; a longer text is a run of its own."""
    sizes = pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes, dtype=np.int64) - sizes) // size
    cuts = (np.flatnonzero(np.diff(run)) + 1).tolist()
    return [(a, b) for a, b in zip([0, *cuts], [*cuts, len(texts)]) if b > a]


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about `size` bytes of text each."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        for a, b in slice_bounds(texts, size):
            yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()
