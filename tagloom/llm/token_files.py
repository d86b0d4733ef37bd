"""Token ids in patched frame-of-reference blocks, written and read back (operator 9).

The ids of all documents, in ascending id order and each document with the end id behind it, are
written as segments. A segment holds whole documents and is one binary value:

    bytes    content (all numbers little-endian)
    4        `PFB1`
    4, 4     number of ids, number of blocks
    4 each   index: where each block starts, counted from the end of the index; one more for the end
    blocks   least id (4), width in bits (1), number of exceptions (2), the packed bits,
             positions of the exceptions (2 each), their differences (4 each)

A block holds `BLOCK` ids (the last one fewer). The least id is taken off, and the differences
are packed at the width that fits `PERCENTILE` of them; the others are exceptions. The index lets a
reader open one block alone (`read_block`).

Spark's writer commits the segments as rows of a Parquet table, so half-written files of a lost
task are never read. Documents are range-partitioned by id: partition after partition, the files
hold them in order. Where a document starts overall is its place in its partition plus the ids of the
partitions before, which is one number for each partition.

Nulls count as empty texts and have the end id alone. Null ids come first. Rows that repeat an id are
kept, next to each other. An empty table gives empty files and no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe import Codec, byte_table, id_runs
from tagloom.llm.common import exact, text_slices

BLOCK = 512
PERCENTILE = 90
SEGMENT_IDS = 1 << 17
#: This operator holds little else in a task, so it works on longer slices and forgets later.
SLICE_BYTES, CACHE_PIECES = 6_000_000, 1_000_000
#: Pieces strung together for one call of the library.
STRING = 256
_HEAD, _BLOCK_HEAD = struct.Struct("<4sII"), struct.Struct("<IBH")


def pack_segment(ids: np.ndarray) -> bytes:
    """The bytes of a segment for any sequence of ids below 2^32."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.concatenate([ids, np.repeat(ids[-1:], blocks * BLOCK - len(ids))]).astype(np.uint32)
    grid = padded.reshape(blocks, BLOCK)
    least = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    gap = grid - least[:, None]
    typical = np.partition(gap, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100] if blocks else least
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.int64)
    body: list[bytes] = [b""] * blocks
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        bits = (gap[chosen][:, :, None] >> np.arange(width, dtype=np.uint32)).astype(np.uint8) & 1
        packed = np.packbits(bits.reshape(len(chosen), -1), axis=1, bitorder="little")
        beyond = (gap[chosen].astype(np.uint64) >> np.uint64(width)) != 0
        for row, k in enumerate(chosen):
            at = np.flatnonzero(beyond[row])
            body[k] = (
                _BLOCK_HEAD.pack(int(least[k]), int(width), len(at))
                + packed[row].tobytes()
                + at.astype("<u2").tobytes()
                + gap[k, at].astype("<u4").tobytes()
            )
    index = np.array([0, *accumulate(map(len, body))], "<u4")
    return _HEAD.pack(b"PFB1", len(ids), blocks) + index.tobytes() + b"".join(body)


def _open(segment: bytes) -> tuple[int, np.ndarray, int]:
    magic, count, blocks = _HEAD.unpack_from(segment)
    if magic != b"PFB1":
        raise ValueError("no token segment")
    index = np.frombuffer(segment, "<u4", blocks + 1, _HEAD.size)
    return count, index, _HEAD.size + 4 * (blocks + 1)


def _unpack(segment: bytes, chosen: np.ndarray) -> np.ndarray:
    """The ids of the chosen blocks, a row each (the last block with its padding).

    A value's bits are cut out of the eight bytes that begin where they begin.
    """
    _, index, base = _open(segment)
    data = np.frombuffer(segment + bytes(8), np.uint8)
    eight = np.lib.stride_tricks.as_strided(data.view(np.uint8)[:8].view("<u8"), (len(segment) + 1,), (1,))
    starts = base + index[chosen].astype(np.int64)
    heads = [_BLOCK_HEAD.unpack_from(segment, at) for at in starts.tolist()]
    least, widths, beyond = (np.array(c, np.int64) for c in zip(*heads)) if heads else (np.zeros(0, np.int64),) * 3
    out = np.empty((len(chosen), BLOCK), np.uint32)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        bit = np.arange(BLOCK) * width
        at = (starts[rows] + _BLOCK_HEAD.size)[:, None] + (bit >> 3)
        out[rows] = (eight[at] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << int(width)) - 1)
    for row in np.flatnonzero(beyond):
        at, n = int(starts[row] + _BLOCK_HEAD.size + BLOCK * widths[row] // 8), int(beyond[row])
        where = np.frombuffer(segment, "<u2", n, at)
        out[row, where] = np.frombuffer(segment, "<u4", n, at + 2 * n)
    return out + least.astype(np.uint32)[:, None]


def read_block(segment: bytes, k: int) -> np.ndarray:
    """The ids of block k alone, found through the index."""
    count = _open(segment)[0]
    return _unpack(segment, np.array([k]))[0, : min(BLOCK, count - k * BLOCK)]


def unpack_segment(segment: bytes) -> np.ndarray:
    """All ids of a segment."""
    count, index, _ = _open(segment)
    return _unpack(segment, np.arange(len(index) - 1)).reshape(-1)[:count]


@lru_cache(maxsize=2)
def library_codec(vocabulary: str) -> Codec:
    """A codec whose pieces the tokenizers library encodes; a worker process keeps it.

    Pieces that begin with a lone blank and end without white space are strung together for fewer calls, as no token reaches over
    such a blank. The ids are dealt back by the numbers of their bytes.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    spec = json.loads(vocabulary)
    id_bytes = np.array([len(b) for b in byte_table(spec)], np.int64)

    def library_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return id_runs([e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def encode_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not all(p[:1] == " " and not p[1:2].isspace() and not p[-1:].isspace() for p in pieces):
            return library_ids(pieces)
        ids, _ = library_ids(["".join(pieces[i : i + STRING]) for i in range(0, len(pieces), STRING)])
        ends = np.cumsum([len(p.encode()) for p in pieces])
        last = np.searchsorted(np.cumsum(id_bytes[ids]), ends) + 1
        return ids, np.diff(last, prepend=0)

    return Codec(spec, encode_pieces, CACHE_PIECES)


def write_token_files(
    docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0
) -> None:
    """Encode every text and write the segments to `path`, in ascending id order."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file of fixed size
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        codec, part, first, seq = library_codec(shared.value), TaskContext.get().partitionId(), 0, 0
        for rows in text_slices(batches, "text", SLICE_BYTES):
            ids, starts = codec.encode(rows.column(1))
            n = np.diff(starts)
            whole = np.insert(ids, starts[1:], end_id)
            starts = starts + np.arange(len(starts))
            cuts = np.flatnonzero(np.diff(starts[:-1] // SEGMENT_IDS)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(n)]):
                own = whole[starts[a] : starts[b]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([seq], pa.int64()),
                        pa.array([first], pa.int64()),
                        pa.array([len(own)], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), rows.column(0).slice(a, b - a)),
                        pa.array([(n[a:b] + 1).tolist()], pa.list_(pa.int64())),
                        pa.array([pack_segment(own)], pa.binary()),
                    ],
                    names=["part", "seq", "first", "n_ids", "doc_ids", "doc_sizes", "segment"],
                )
                first, seq = first + len(own), seq + 1

    schema = f"part int, seq long, first long, n_ids long, doc_ids array<{kind}>, doc_sizes array<long>, segment binary"
    ordered = docs.select(exact(id_col).alias("id"), exact(text_col).alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id")
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, tokens): each document's ids as unsigned 32-bit integers in binary."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row a partition
    before = dict(zip([r.part for r in sizes], accumulate((r.n for r in sizes), initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, doc_ids, doc_sizes, segment = (c[i] for c in batch.columns)
                data = unpack_segment(segment.as_py()).astype("<u4").tobytes()
                n = doc_sizes.values.to_numpy()
                at = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.values,
                        pa.array(before[part.as_py()] + first.as_py() + at[:-1], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([data[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    ],
                    names=["id", "start", "n_tokens", "tokens"],
                )

    read = files.select("part", "first", "doc_ids", "doc_sizes", "segment")
    rows = read.mapInArrow(run, f"id {kind}, start long, n_tokens long, tokens binary")
    return rows.withColumnRenamed("id", id_col)
