"""Near-duplicates by 64-bit fingerprints that meet at the anchors of a covering code (operator 3).

Fingerprints link if they differ in at most three bits. Of the two 32-bit halves one then differs
in at most one bit. For 31 bits of each half (the last bit is free) the code words of the
[31, 26] Hamming code are the anchors: every 31-bit value lies within distance 1 of exactly one of
them, its home, so the covering radius is 1. A fingerprint is sent to all anchors within covering
radius plus threshold, 1 + 1 = 2: its home and up to 15 more. If two fingerprints agree in a half up
to one bit, then the second is sent to the home of the first, and there they are compared in full.
One code over all 64 bits would send every fingerprint to thousands of anchors; the halves need 32.

At an anchor only links that join two groups are kept, so a crowd of near copies gives as many
links as it has members, not pairs. A group holds distinct fingerprints, 16 bytes each; exact copies
have one fingerprint and cost nothing. An anchor with more than `CROWD` fingerprints is split: they meet there by a piece of the
other half, which has four pieces of eight bits, one of them equal wherever at most three bits differ; so no link is
lost, and a crowd whose other halves differ comes in 256 parts or more. Links become components by joins (`components.connected`).

A null or empty text, or one without words, has fingerprint zero and is linked like any other.
Rows that repeat an id are judged each on its own. Null ids are never the smallest id of a component;
a component of nulls alone has a null id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SLICE_BYTES, exact, fresh
from tagloom.llm.components import connected
from tagloom.session import cut_lineage

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Fingerprints at an anchor from which on it is split.
CROWD = 20_000
PIECES, PIECE_BITS = 4, 8
_EVERY_EIGHTH = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of `size` words, or of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z alone, and the six gaps
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxh64_intdigest(b" ".join(run), SEED) for run in zip(*(words[i:] for i in range(size)))]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits set in over half of them; zero for an empty run.

    Bit j of every byte is added up in byte-wide lanes of a 64-bit sum, over 255 hashes at most.
    """
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    size = sizes[some]
    starts = np.cumsum(size) - size
    pieces = -(-size // 255)
    first = np.cumsum(pieces) - pieces
    at = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    for j in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _EVERY_EIGHTH, at)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first)
        for byte in range(8):
            out[some] |= (2 * counts[:, byte] > size).astype(np.uint64) << np.uint64(8 * byte + j)
    return out


def _fingerprints(texts: pd.Series) -> pd.Series:
    out, hashes, sizes, held = [], [], [], 0
    for i, text in enumerate(texts):
        found = shingle_hashes(text)
        hashes.extend(found)
        sizes.append(len(found))
        held += len(found)
        if held > SLICE_BYTES // 8 or i + 1 == len(texts):
            out.append(majority(np.array(hashes, np.uint64), np.array(sizes, np.int64)))
            hashes, sizes, held = [], [], 0
    return pd.Series(np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a signed long."""
    return F.pandas_udf(_fingerprints, "long")(text)


def _anchors(half: Column, number: int) -> Column:
    """Rows (half's number, anchor, whether it is the home) for 31 bits of a half."""
    x = half.bitwiseAND(0x7FFFFFFF)
    syndrome = F.lit(0)
    for i in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> i & 1)
        syndrome = syndrome + F.bit_count(x.bitwiseAND(mask)) % 2 * (1 << i)
    # lambda variables bind x and the syndrome once for all sixteen anchors
    def around(bound: Column) -> Column:
        v, s = bound["x"], bound["s"]
        one = F.lit(1).cast("long")
        home = F.when(s == 0, v).otherwise(v.bitwiseXOR(F.call_function("shiftleft", one, s - 1)))
        others = F.transform(
            F.filter(F.sequence(F.lit(1), F.lit(31)), lambda a: (s != 0) & (a != s) & (a < a.bitwiseXOR(s))),
            lambda a: v.bitwiseXOR(F.call_function("shiftleft", one, a - 1)).bitwiseXOR(
                F.call_function("shiftleft", one, a.bitwiseXOR(s) - 1)
            ),
        )
        as_row = lambda anchor, is_home: F.struct(
            (anchor * 2 + number).alias("anchor"), F.lit(is_home).alias("home")
        )
        return F.concat(F.array(as_row(home, True)), F.transform(others, lambda a: as_row(a, False)))

    bound = F.array(F.struct(x.alias("x"), syndrome.cast("int").alias("s")))
    return F.flatten(F.transform(bound, around))


def _spanning_links(homes: np.ndarray, fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links between homes (positions in `fps`) and the others that join all that is linked."""
    group = np.arange(len(fps))
    links: list[tuple[int, int]] = []
    for h in homes:
        others = np.flatnonzero(group != group[h])
        if not len(others):
            break
        near = others[np.bitwise_count(fps[others] ^ fps[h]) <= max_bits]
        if len(near):
            joined, one_of = np.unique(group[near], return_index=True)
            links += [(h, near[i]) for i in one_of]
            group[np.isin(group, joined)] = group[h]
    return links


def _links_at_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows (key of an anchor, fp, home); an anchor's rows may go over several batches."""
    held: list[tuple[np.ndarray, ...]] = []

    def links(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        anchor, fp, home = rows
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1, [len(anchor)]])
        homes = np.concatenate([[0], np.cumsum(home)])[cuts]
        out: list[np.ndarray] = []
        for g in np.flatnonzero((np.diff(cuts) > 1) & (np.diff(homes) > 0)):
            own = fp[cuts[g] : cuts[g + 1]]
            found = _spanning_links(np.flatnonzero(home[cuts[g] : cuts[g + 1]]), own, MAX_BITS)
            if found:
                out.append(own[np.array(found)])
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.uint64)
        u, v = (pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([u, v], names=["u", "v"])

    def merged() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(parts) for parts in zip(*held))

    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        home = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        last = int(np.searchsorted(anchor, anchor[-1]))  # rows are sorted: the last anchor may go on
        fp = fp.view(np.uint64)
        if last or (held and held[-1][0][-1] != anchor[0]):
            held.append((anchor[:last], fp[:last], home[:last]))
            yield links(merged())
            held.clear()
        held.append((anchor[last:], fp[last:], home[last:]))
    if held:
        yield links(merged())


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that join all within MAX_BITS."""
    halves = (F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32))
    rows = fps.select("fp", F.explode(F.concat(*(_anchors(h, i) for i, h in enumerate(halves)))).alias("a"))
    rows = rows.select(F.col("a.anchor").alias("anchor"), "fp", F.col("a.home").alias("home"))
    crowded = cut_lineage(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD))
    # The anchor's last bit tells which half it is of. Keys that fall together by chance only compare more.
    other = F.when(F.col("anchor") % 2 == 0, halves[1]).otherwise(halves[0])
    pieces = [F.shiftrightunsigned(other, PIECE_BITS * i).bitwiseAND((1 << PIECE_BITS) - 1) for i in range(PIECES)]
    parts = F.array(*(F.xxhash64("anchor", F.lit(i), piece) for i, piece in enumerate(pieces)))
    met = rows.join(crowded, "anchor", "left")
    keys = F.when(F.col("n").isNull(), F.array("anchor")).otherwise(parts)
    dealt = met.select(F.explode(keys).alias("key"), "fp", "home").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_links_at_anchors, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp, component_id) for every row; text_hash tells rows of one id apart."""
    marked = docs.select(
        exact(id_col).alias("id"),
        F.xxhash64(exact(text_col)).alias("text_hash"),
        fingerprint(exact(text_col)).alias("fp"),
    )
    marked = cut_lineage(marked)
    first = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = connected(fingerprint_links(first.select("fp")))
    placed = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = cut_lineage(placed.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "text_hash", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are the first of their component, all columns as they were."""
    name, here, there = fresh(docs, "text_hash", "kept_id", "kept_hash")
    found = near_duplicates(docs, id_col, text_col)
    kept = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(id_col).alias(here), F.col("text_hash").alias(there)).distinct()
    rows = docs.withColumn(name, F.xxhash64(exact(text_col)))
    same = exact(id_col).eqNullSafe(F.col(here)) & (F.col(name) == F.col(there))
    joined = rows.join(kept, same).dropDuplicates([id_col, name])
    return joined.select(*(exact(c) for c in docs.columns))
