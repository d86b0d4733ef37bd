"""Hard negatives for embeddings, found by a vertical scan of columnar blocks (operator 13).

Rows lie in blocks of up to `ROWS` vectors, one array for each dimension, with the least and the
largest value of each. Anchors lie in groups of about `ANCHORS`. Every pair of an anchor group and a row
block is one row of a join, so the work spreads over all tasks; the anchors are a stated
query set, every hundredth row. Within a pair each anchor reads the dimensions in the order of its own
magnitudes, the largest first, and adds up partial products. What the dimensions still to come can add at least and at
most follows from their extremes in the block; candidates that can neither enter a window nor its first `TOP`
rows leave the bitmap, and those left at the end have exact scores.

Two scans: one over rows of the anchor's label, from which the best `TOP` of all blocks become its positives, and one over
rows of other labels, with a window of scores for each positive. A task keeps the first `TOP` rows of a window over its
blocks, and a row below them leaves the bitmap early. A label with a third of all rows is only more blocks, and merging is a rank by window.

Rows with a null id, label, vector or component, or a component that is not finite, take no part. A vector is
as long as it is; components beyond the end of the shorter one of two count as zero. Components are cut off at
plus and minus `LARGEST` after scaling, so that scores are exact whole numbers up to 4,096 dimensions. Rows that repeat an id
are rows of their own as candidates, but never candidates of an anchor with that id; an anchor's repeats with equal
label and vector are one anchor. Ties go by the smaller id. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.bounded import BROADCAST_MAX_BYTES
from tagloom.session import cut_lineage

ROWS = 4_096
ANCHORS = 2_048
#: Groups of anchors whose first rows a task holds at once.
GROUPS = 8
#: Row blocks of a task: at most so many, and fewer where they would not give every core so many tasks.
BLOCKS, TASKS = 64, 4
#: Dimensions read between two looks at the bitmap.
STRIDE = 8
LARGEST = 2**24

#: Fixed by the contract: scale, relabelled rows, anchors, number of rows kept, window in hundredths.
SCALE, RELABEL, LABELS, ANCHOR, TOP, WINDOW = 256, 7, 10, 100, 5, (80, 100)

VECTORS = "vec_id long, label int, vector array<long>"
BLOCK = "ids binary, labels binary, columns binary, dims int, low array<long>, high array<long>"


def prepared(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: changed labels, whole components."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    changed = F.when(F.col("vec_id") % RELABEL == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.least(F.lit(LARGEST), F.greatest(F.lit(-LARGEST), F.floor(x.cast("double") * SCALE))).cast("long"))
    return rows.where(F.coalesce(sound, F.lit(False))).select("vec_id", changed.cast("int").alias("label"), whole.alias("vector"))


class Block:
    """Vectors by dimension: `columns[d]` holds component d of all rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray, low=None, high=None):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.low = columns.min(axis=1) if low is None else low
        self.high = columns.max(axis=1) if high is None else high

    @classmethod
    def of_rows(cls, ids: list, labels: list, vectors: list) -> Block:
        dims = max(map(len, vectors))
        columns = np.zeros((dims, len(ids)), np.int64)
        for i, vector in enumerate(vectors):
            columns[: len(vector), i] = vector
        return cls(np.array(ids, np.int64), np.array(labels, np.int32), columns)

    def record(self) -> dict:
        """The block as one row; components take as few bytes as the largest needs."""
        widest = int(max(-self.low.min(initial=0), self.high.max(initial=0)))
        columns = self.columns.astype(np.int16 if widest < 2**15 else np.int32)
        sides = {"low": self.low.tolist(), "high": self.high.tolist()}
        return {"ids": self.ids.tobytes(), "labels": self.labels.tobytes(), "columns": columns.tobytes(), "dims": len(columns), **sides}

    @classmethod
    def of_record(cls, record: dict, prefix: str = "") -> Block:
        ids = np.frombuffer(record[prefix + "ids"], np.int64)
        dims, raw = record[prefix + "dims"], record[prefix + "columns"]
        kind = np.int16 if len(raw) == 2 * dims * len(ids) else np.int32
        columns = np.frombuffer(raw, kind).reshape(dims, len(ids)).astype(np.int32)
        sides = (np.array(record[prefix + side], np.int64) for side in ("low", "high"))
        return cls(ids, np.frombuffer(record[prefix + "labels"], np.int32), columns, *sides)


def scan(block: Block, start: int, end: int, eligible: np.ndarray | None, vector: np.ndarray, windows: list[tuple[int, int]]):
    """The first `TOP` (score, id) of each window of scores, among rows start to end of a block.

    `eligible` leaves out single rows of these; `windows` are (least, largest) scores, both included.
    The bitmap is looked at where the bounds have become narrow enough to strike out a row.
    """
    dims = min(len(vector), len(block.columns))
    order = np.argsort(-np.abs(vector[:dims]), kind="stable")
    order = order[vector[order] != 0]
    ends = vector[order] * np.stack([block.low[order], block.high[order]])
    # What the dimensions from a place in the order on can add at least and at most.
    least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0).tolist()
    most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0).tolist()
    kind = np.int32 if np.abs(ends).max(axis=0).sum() < 2**31 else np.int64
    factors = vector.astype(kind)
    score, ids, taken = np.zeros(end - start, kind), block.ids[start:end], None
    product = np.empty_like(score)
    floor, ceiling = min(low for low, _ in windows), max(high for _, high in windows)
    for i, d in enumerate(order.tolist(), 1):
        column = block.columns[d, start:end]
        np.multiply(column if taken is None else column[taken], factors[d], out=product)
        score += product
        if i % STRIDE or i == len(order):
            continue
        worst, best, slack = int(score.min()), int(score.max()), most[i] - least[i]
        ranked = len(score) > TOP and worst < best - slack
        if worst + most[i] >= floor and best + least[i] <= ceiling and not ranked:
            continue
        alive = (score >= floor - most[i]) & (score <= ceiling - least[i])
        if ranked:
            alive &= _may_be_first(score, windows, least[i], most[i], eligible)
        if eligible is not None:
            alive &= eligible
        left = np.flatnonzero(alive)
        if not len(left):
            return [[] for _ in windows]
        if len(left) < 0.8 * len(score):
            taken = left if taken is None else taken[left]
            score, ids, product = score[left], ids[left], product[: len(left)]
            eligible = None
    if eligible is not None:
        score, ids = score[eligible], ids[eligible]
    return [_first(score, ids, low, high) for low, high in windows]


def _may_be_first(score: np.ndarray, windows: list[tuple[int, int]], least: int, most: int, eligible: np.ndarray | None) -> np.ndarray:
    """Rows that may be among the first of a window: no `TOP` rows surely in it are surely better."""
    found = np.zeros(len(score), bool)
    for low, high in windows:
        surely = (score >= low - least) & (score <= high - most)
        if eligible is not None:
            surely &= eligible
        inside = score[surely]
        bound = low - most
        if len(inside) >= TOP:
            bound = max(bound, int(_kth_largest(inside, TOP)) + least - most)
        found |= (score >= bound) & (score <= high - least)
    return found


def _kth_largest(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def _first(score: np.ndarray, ids: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    inside = np.flatnonzero((score >= low) & (score <= high))
    if len(inside) > TOP:
        inside = inside[score[inside] >= _kth_largest(score[inside], TOP)]
    best = inside[np.lexsort((ids[inside], -score[inside].astype(np.int64)))][:TOP]
    return list(zip(score[best].tolist(), ids[best].tolist()))


def make_blocks(size: int):
    """Function that gathers the rows of a partition to blocks of up to `size` rows."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("ids", pa.binary()), ("labels", pa.binary()), ("columns", pa.binary()), ("dims", pa.int32())]
            + [("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))]
        )
        held: tuple[list, list, list] = ([], [], [])

        def flush():
            found = Block.of_rows(*held).record()
            for part in held:
                part.clear()
            return pa.RecordBatch.from_pylist([found], schema)

        for batch in batches:
            for start in range(0, len(batch), 1_024):
                piece = batch.slice(start, 1_024)
                for part, name in zip(held, ("vec_id", "label", "vector")):
                    part.extend(piece.column(name).to_pylist())
                if len(held[0]) + 1_024 > size:
                    yield flush()
        if held[0]:
            yield flush()

    return gather


def row_blocks(vectors: DataFrame) -> DataFrame:
    """All vectors in blocks sorted by label, written to the scratch folder."""
    blocks = vectors.sortWithinPartitions("label", "vec_id").mapInArrow(make_blocks(ROWS), BLOCK)
    return cut_lineage(blocks.withColumn("block", F.monotonically_increasing_id()))


def grid(anchors: DataFrame, blocks: DataFrame, n_anchors: int, n_values: int, n_rows: int) -> DataFrame:
    """Every pair of an anchor group and a row block, for `n_anchors` anchors with `n_values` components in all.

    Anchors within the bounds are broadcast, each group once, and a block crosses the network once. Beyond them both
    sides are shuffled by the numbers of their groups, each copied as often as the other one has groups: with n rows,
    n / 204,800 times for the rows and n / 4,096 times for the hundredth of them that are anchors. The copies are never
    broadcast, however small adaptive execution takes them to be.
    """
    across, down = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // ROWS))

    def every(groups: int):
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    group = F.pmod(F.xxhash64("vec_id", "key"), F.lit(across)).cast("int")
    listed = anchors.groupBy(group.alias("anchor_group")).agg(F.collect_list(F.struct(*anchors.columns)).alias("anchors"))
    if across <= GROUPS and 8 * n_values <= BROADCAST_MAX_BYTES:
        cores = blocks.sparkSession.sparkContext.defaultParallelism
        dealt = blocks.repartition(max(min(down, TASKS * cores), -(-down // BLOCKS)))
        return dealt.withColumn("anchor_group", every(across)).join(F.broadcast(listed), "anchor_group")
    row_group = F.pmod(F.xxhash64("block"), F.lit(down)).cast("int")
    rows = blocks.withColumn("row_group", row_group).withColumn("anchor_group", every(across))
    return rows.hint("merge").join(listed.withColumn("row_group", every(down)).hint("merge"), ["anchor_group", "row_group"])


FOUND = "anchor_id long, key long, place int, positive_id long, positive_score long, vec_id long, score long"


def _found(records: Iterable[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in FOUND.split(", ")]
    kinds = [pa.int32() if name == "place" else pa.int64() for name in names]
    columns = zip(*records) if (records := list(records)) else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class Sought:
    """An anchor, its windows of scores, and the first `TOP` (score, id) of each so far."""

    def __init__(self, anchor: dict, windows: list[tuple]):
        """`windows` are (least, largest) score, both included, and what the rows of the window belong to."""
        self.vec_id, self.key, self.label = anchor["vec_id"], anchor["key"], anchor["label"]
        self.vector = np.array(anchor["vector"], np.int64)
        self.windows = [w for w in windows if w[0] <= w[1]]
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.windows]

    def add(self, block: Block, start: int, end: int, eligible: np.ndarray | None) -> None:
        """Takes in rows start to end of a block; rows below those already held leave the scan early."""
        held = zip(self.windows, self.best)
        windows = [(max(low, best[-1][0]) if len(best) == TOP else low, high) for (low, high, _), best in held]
        for best, found in zip(self.best, scan(block, start, end, eligible, self.vector, windows)):
            if found:
                best[:] = sorted(best + found, key=lambda row: (-row[0], row[1]))[:TOP]

    def found(self) -> Iterator[tuple]:
        for (_, _, belongs), best in zip(self.windows, self.best):
            for score, vec_id in best:
                yield self.vec_id, self.key, *belongs, vec_id, score


def _scanned(batches: Iterable[pa.RecordBatch], sought, take) -> Iterator[pa.RecordBatch]:
    """The rows found for the anchors of each group over all blocks of a task; `sought` opens an anchor, `take` adds a block."""
    groups: dict[int, list[Sought]] = {}

    def flush():
        while groups:
            yield _found(row for anchor in groups.pop(next(iter(groups))) for row in anchor.found())

    for batch in batches:
        for i in range(len(batch)):
            cell = batch.slice(i, 1)
            group = cell.column("anchor_group")[0].as_py()
            if group not in groups:
                if len(groups) >= GROUPS:
                    yield from flush()
                groups[group] = [sought(anchor) for anchor in cell.column("anchors")[0].as_py()]
            block = Block.of_record(cell.select(["ids", "labels", "columns", "dims", "low", "high"]).to_pylist()[0])
            for anchor in groups[group]:
                take(anchor, block)
    yield from flush()


def scan_positives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best rows of each anchor's label in the blocks of a task, whose rows are sorted by label."""

    def sought(anchor: dict) -> Sought:
        return Sought(anchor, [(-(2**61), 2**61, (None, None, None))])

    def take(anchor: Sought, block: Block) -> None:
        start, end = np.searchsorted(block.labels, [anchor.label, anchor.label + 1])
        others = block.ids[start:end] != anchor.vec_id
        if others.any():
            anchor.add(block, start, end, None if others.all() else others)

    return _scanned(batches, sought, take)


def scan_negatives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first rows of other labels in the window of each of an anchor's positives, in the blocks of a task."""

    def sought(anchor: dict) -> Sought:
        windows = [
            (-(-WINDOW[0] * p["score"] // 100), WINDOW[1] * p["score"] // 100, (p["place"], p["positive_id"], p["score"]))
            for p in anchor["positives"]
        ]
        return Sought(anchor, windows)

    def take(anchor: Sought, block: Block) -> None:
        others = (block.labels != anchor.label) & (block.ids != anchor.vec_id)
        if others.any() and anchor.windows:
            anchor.add(block, 0, len(block.ids), others)

    return _scanned(batches, sought, take)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor."""
    vectors = cut_lineage(prepared(embeddings))
    anchors = vectors.where(F.col("vec_id") % ANCHOR == 0).distinct().withColumn("key", F.xxhash64("vec_id", "label", "vector"))
    values = F.sum(F.when(F.col("vec_id") % ANCHOR == 0, F.size("vector")))
    n_anchors, n_values, n_rows = vectors.agg(F.count_if(F.col("vec_id") % ANCHOR == 0), F.coalesce(values, F.lit(0)), F.count(F.lit(1))).first()
    blocks = row_blocks(vectors)
    order = (F.desc("score"), F.asc("vec_id"))

    near = grid(anchors, blocks, n_anchors, n_values, n_rows).mapInArrow(scan_positives, FOUND)
    placed = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor_id", "key").orderBy(*order)))
    positives = placed.where(F.col("place") <= TOP).groupBy("key", F.col("anchor_id").alias("vec_id"))
    positives = positives.agg(F.collect_list(F.struct("place", F.col("vec_id").alias("positive_id"), "score")).alias("positives"))
    with_positives = anchors.join(positives, ["vec_id", "key"])

    far = grid(with_positives, blocks, n_anchors, n_values, n_rows).mapInArrow(scan_negatives, FOUND)
    ranked = far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id", "key", "place").orderBy(*order)))
    return ranked.where(F.col("rank") <= TOP).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


#: Products of whole components, summed; the same scores, windows and ties.
OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.vector, b.vector), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s
  ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
