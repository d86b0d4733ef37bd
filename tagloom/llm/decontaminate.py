"""Test items found in training text by rare seeds and local alignment (operator 8).

Words are compared in lower case without signs. A pair is two words of an item next to each other or with
one word between them. An alignment of M matches and E edits scores 2 M - E; of its M - 1 steps from match to match
at most E / 2 have two edits or more, so at least M - 1 - E / 2 = score / 2 - 1 of them are pairs of the item that
the document also holds as pairs. An item is reported from a share `THRESHOLD` of its best score on, or, as an excerpt of a long item is
a passage too, from the score of `PASSAGE` words without edits. So the least score tells how many different places of
the item a document holds pairs from, however the edits lie and however frequent the pairs are.

Pairs are counted over all documents. If a document must hold c of an item's P places, then at least k of any
P - c + k are among them: the seeds are the P - c + k places in the fewest documents (k is `AGREE`, or c if that
is less), and a document with k of them is a candidate. So seeds are rare as the corpus has it and the commonest pairs are never
joined, yet no document that reaches the least score is lost. Candidates are aligned by Smith-Waterman wherever c
pairs lie close enough, and the score is the share of the best possible one.

The one thing sent to all tasks is a bit table of fixed size (`TABLE_BITS`) over the items' pairs; what passes it by
chance falls out in the join that follows. Counts, seeds and candidates are joins and aggregations, so
neither corpus nor benchmark has to fit anywhere.

Null and empty texts, and items without words, match nothing; an item of one word is looked for as that word, one of
two words as a pair. Rows that repeat an id are judged each on its own text, items that repeat an id give the best score.
Null document ids are kept. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tagloom.llm.common import exact, fresh, text_slices
from tagloom.llm.repeats import _joined, word_codes
from tagloom.session import cut_lineage

#: Words from the first to the second of a pair.
STEPS = (1, 2)
AGREE = 5
TABLE_BITS = 22
#: Items a task keeps ready, cut into words; they change nothing but its speed.
CACHE_ITEMS = 5_000
#: Words not of ASCII letters that a task remembers, and the longest of them; they change nothing but its speed.
KNOWN_WORDS, SHORT_WORD = 1 << 17, 64
THRESHOLD = 0.5
PASSAGE = 13
MATCH, MISMATCH, GAP = 2, -1, -1
_SIGNS = re.compile(r"[\W_]+")


def _plain_word(word: str) -> bytes:
    return _SIGNS.sub("", word.lower()).encode()


_known_word = lru_cache(KNOWN_WORDS)(_plain_word)


def _strings(words: pa.Array) -> list:
    """As `to_pylist`, without a scalar object for every word."""
    return words.to_numpy(zero_copy_only=False).tolist()


def _plain(words: pa.Array) -> list[bytes]:
    """Words in lower case without signs; those of ASCII letters all at once, the others one by one, short ones by
    what is known of the words met before."""
    plain = _strings(pc.replace_substring_regex(pc.ascii_lower(words), "[^a-z0-9]+", "").cast(pa.binary()))
    others = np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
    for i, word in zip(others.tolist(), _strings(words.take(pa.array(others)))):
        plain[i] = _known_word(word) if len(word) <= SHORT_WORD else _plain_word(word)
    return plain


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word in lower case without signs, its place among all words, and where each text's hashes and
    words start."""
    codes, words, starts = word_codes(texts)
    plain = _plain(words)
    hashes = np.fromiter(map(xxh3_64_intdigest, plain), np.uint64, len(plain))
    some = np.fromiter(map(bool, plain), bool, len(plain))[codes]
    place = np.flatnonzero(some)
    return hashes[codes[place]], place, np.concatenate([[0], np.cumsum(some)])[starts], starts


def least_score(n_words: int, threshold: float) -> float:
    """Score from which on an alignment with an item counts: a share of the best one, or a passage."""
    return MATCH * min(threshold * n_words, PASSAGE)


def pairs_needed(n_words: int, threshold: float) -> int:
    """Places of an item whose pairs a text holds if their alignment has the least score."""
    return max(1, math.ceil(least_score(n_words, threshold) / 2 - 1e-9) - 1)


def _keys(words: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(words in the key, place of its last word after the first, hashes by first word) of words and pairs."""
    return [(1, 0, words), *((2, step, _joined(words, words, step)) for step in STEPS)]


def _item_runs(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "text"):
            words, _, bounds, _ = plain_words(rows.column(1))
            n_words = np.diff(bounds)
            text = np.repeat(np.arange(len(n_words)), n_words)
            needed = np.array([pairs_needed(n, threshold) for n in n_words.tolist()], np.int32)
            cells: list[tuple] = []
            for size, step, runs in _keys(words):
                inside = np.flatnonzero(text[: len(runs)] == text[step : step + len(runs)])
                inside = inside[(n_words[text[inside]] > 1) == (size > 1)]
                cells.append((text[inside], inside - bounds[text[inside]], runs[inside], np.full(len(inside), size)))
            of, at, run, size = (np.concatenate(c) for c in zip(*cells))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(of)),
                    pa.array(at, pa.int32()),
                    pa.array(run.view(np.int64)),
                    pa.array(size, pa.int32()),
                    pa.array(needed[of], pa.int32()),
                ],
                names=["item", "at", "run", "size", "needed"],
            )

    return run


def _hits(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        some = table.any(axis=1)
        for rows in text_slices(batches, "text"):
            words, _, bounds, _ = plain_words(rows.column(2))
            whose, held = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for size, step, runs in _keys(words):
                if not some[size - 1]:
                    continue
                slot = runs >> np.uint64(64 - TABLE_BITS)
                near = np.flatnonzero((table[size - 1][slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1))
                text = np.searchsorted(bounds, near, "right") - 1
                near, text = (a[near + step < bounds[text + 1]] for a in (near, text))
                whose.append(text)
                held.append(runs[near])
            text, run = np.concatenate(whose), np.concatenate(held)
            order = np.lexsort((run, text))
            text, run = text[order], run[order]
            new = np.ones(len(run), bool)
            new[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
            of = pa.array(text[new])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(of), rows.column(1).take(of), pa.array(run[new].view(np.int64))],
                names=["id", "t1", "run"],
            )

    return run


def _bit_tables(runs: DataFrame) -> np.ndarray:
    """A bit for the leading bits of every run, one table for each number of words; TABLE_BITS is the bound."""
    slot = F.shiftrightunsigned("run", 64 - TABLE_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    rows = runs.groupBy("size", F.shiftright(slot, 6).alias("cell")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros((2, 1 << (TABLE_BITS - 6)), np.uint64)
    for size, cell, bits in rows:
        table[size - 1, cell] = np.uint64(bits & 0xFFFFFFFFFFFFFFFF)
    return table


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, first word of the text in it, word behind its last).

    A row of the matrix is worked out at once: the best way along the row is a running maximum.
    """
    steps = GAP * np.arange(len(text) + 1)
    above, origin = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(text == word, MATCH, MISMATCH)
        down = above[1:] + GAP
        row = np.concatenate([[0], np.maximum(np.maximum(diagonal, down), 0)])
        start = np.concatenate([[0], np.where(diagonal >= down, origin[:-1], origin[1:])])
        start[row == 0] = np.flatnonzero(row == 0)
        lifted = row - steps
        top = np.maximum.accumulate(lifted)
        left = np.maximum.accumulate(np.where(lifted == top, np.arange(len(row)), 0))
        above, origin = top + steps, start[left]
        j = int(above.argmax())
        if above[j] > best[0]:
            best = (int(above[j]), int(origin[j]), j)
    return best


def best_score(item: np.ndarray, text: np.ndarray) -> int:
    """The score of `align` alone. Scores are held with the cost of the words left of them added, so that a way along the
    row is a running maximum of the row itself."""
    floor = -GAP * np.arange(len(text) + 1)
    above, most = floor.copy(), floor.copy()
    for word in item:
        row = np.maximum(above + GAP, floor)
        np.maximum(row[1:], above[:-1] + ((text == word) * (MATCH - MISMATCH) + (MISMATCH - GAP)), out=row[1:])
        np.maximum.accumulate(row, out=row)
        np.maximum(most, row, out=most)
        above = row
    return int((most - floor).max())


class Places:
    """Where the words and pairs of a text begin, looked up by key; each size is sorted when first asked for."""

    def __init__(self, words: np.ndarray):
        self.words, self.sorted = words, {}

    def of(self, size: int, keys: np.ndarray) -> np.ndarray:
        """The sorted distinct places of any of the keys."""
        if size not in self.sorted:
            runs = [runs for n, _, runs in _keys(self.words) if n == size]
            every = np.concatenate(runs)
            order = np.argsort(every, kind="stable")
            self.sorted[size] = every[order], np.concatenate([np.arange(len(r)) for r in runs])[order]
        found, at = self.sorted[size]
        ends = np.searchsorted(found, keys, "left"), np.searchsorted(found, keys, "right")
        return np.unique(np.concatenate([at[a:b] for a, b in zip(*(e.tolist() for e in ends)) if b > a] or [at[:0]]))


class Item:
    """The words of an item, and the distinct keys it is found by: pairs, or its one word."""

    def __init__(self, words: np.ndarray):
        self.words, self.size = words, min(2, max(1, len(words)))
        self.keys = np.unique(np.concatenate([runs for n, _, runs in _keys(words) if n == self.size]))


def _near_pairs(item: Item, text: Places, threshold: float) -> list[tuple[int, int]]:
    """Stretches of the text that hold every alignment with the item that has the least score.

    Such an alignment has at most 3 n words of the text less its score, and `pairs_needed` pairs begin in it.
    """
    n = len(item.words)
    if not n:
        return []
    at = text.of(item.size, item.keys)
    needed = pairs_needed(n, threshold)
    reach = math.floor(3 * n - least_score(n, threshold) + 1e-9)
    first, last = at[: max(0, len(at) - needed + 1)], at[needed - 1 :]
    close = last - first < reach
    out: list[tuple[int, int]] = []
    for a, b in zip(np.maximum(last[close] - reach, 0).tolist(), np.minimum(first[close] + reach, len(text.words)).tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _aligned(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, Item] = {}
        for rows in text_slices(batches, "text"):
            words, place, bounds, starts = plain_words(rows.column(2))
            out: list[tuple] = []
            for i, items in enumerate(rows.column(3).to_pylist()):
                text = words[bounds[i] : bounds[i + 1]]
                places = Places(text)
                if len(met) > CACHE_ITEMS:
                    met.clear()
                new = {x["item"]: x["text"] for x in items if x["item"] not in met}
                own, _, ends, _ = plain_words(pa.array(new.values(), pa.string()))
                met |= {item: Item(own[ends[k] : ends[k + 1]]) for k, item in enumerate(new)}
                for item in items:
                    known = met[item["item"]]
                    wanted, best = known.words, (0, 0, 0)
                    whole = MATCH * max(1, len(wanted))
                    least = least_score(len(wanted), threshold)
                    for a, b in _near_pairs(known, places, threshold):
                        # Most stretches fall short; where an alignment lies is asked of the others alone.
                        score = best_score(wanted, text[a:b])
                        if score > best[0] and (score / whole >= threshold or score >= least):
                            score, first, end = align(wanted, text[a:b])
                            best = (score, a + first, a + end)
                    share = best[0] / whole
                    if best[0]:
                        first, last = (int(place[bounds[i] + p] - starts[i]) for p in (best[1], best[2] - 1))
                        out.append((i, item["item"], share, first, last + 1))
            cells = list(zip(*out)) or [()] * 5
            whose = pa.array(cells[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(whose),
                    rows.column(1).take(whose),
                    pa.array(cells[1], rows.schema.field(3).type.value_type.field("item").type),
                    pa.array(cells[2], pa.float64()),
                    pa.array(cells[3], pa.int32()),
                    pa.array(cells[4], pa.int32()),
                ],
                names=["id", "t1", "item", "score", "first_word", "end_word"],
            )

    return run


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, t1, item, score, first_word, end_word): documents with a passage like a test item.

    `t1` is the hash of the document's text; the words are counted by white space.
    """
    spark = docs.sparkSession
    text = exact(text_col)
    items = items.select(exact(item_col).alias("item_id"), text.alias("text")).where("text is not null").distinct()
    items = items.withColumn("item", F.xxhash64("item_id", "text"))
    schema = "item long, at int, run long, size int, needed int"
    runs = cut_lineage(items.select("item", "text").mapInArrow(_item_runs(threshold), schema))
    shared = spark.sparkContext.broadcast(_bit_tables(runs))
    base = docs.select(exact(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.coalesce(text, F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    hits = base.select("id", "t1", "text").mapInArrow(_hits(shared), f"id {kind}, t1 long, run long")
    hits = cut_lineage(hits)
    held = hits.groupBy("run").agg(F.count(F.lit(1)).alias("docs"))
    places = runs.join(held, "run", "left").groupBy("item", "at", "needed").agg(F.sum(F.coalesce("docs", F.lit(0))).alias("docs"))
    of_item = Window.partitionBy("item")
    places = places.withColumn("rank", F.row_number().over(of_item.orderBy("docs", "at")))
    places = places.withColumn("n", F.count(F.lit(1)).over(of_item)).withColumn("agree", F.least("needed", F.lit(AGREE)))
    places = places.where("rank <= n - needed + agree").select("item", "at", "agree")
    seeds = cut_lineage(runs.join(places, ["item", "at"]).select("run", "item", "at", "agree").distinct())
    found = hits.join(seeds, "run").groupBy("id", "t1", "item", "agree").agg(F.count_distinct("at").alias("places"))
    found = found.where("places >= agree").select("id", "t1", "item")
    found = found.join(items.select("item", "text"), "item")
    found = found.groupBy("id", "t1").agg(F.collect_list(F.struct("item", "text")).alias("items"))
    wanted = found.select(F.col("id").alias("found_id"), F.col("t1").alias("found_t1"), "items")
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("t1") == F.col("found_t1"))
    rows = base.join(wanted, same).select("id", "t1", "text", "items")
    schema = f"id {kind}, t1 long, item long, score double, first_word int, end_word int"
    return rows.mapInArrow(_aligned(threshold), schema).join(items.select("item", "item_id"), "item").select(
        "id", "t1", "item_id", "score", "first_word", "end_word"
    )


def best_matches(found: DataFrame) -> DataFrame:
    """One row for each document row and item: the best score and where it lies."""
    best = F.max(F.struct("score", -F.col("first_word"), "end_word")).alias("best")
    rows = found.groupBy("id", "t1", "item_id").agg(best)
    return rows.select(
        "id", "t1", "item_id", "best.score", (-F.col("best").getField("col2")).alias("first_word"), "best.end_word"
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of `docs` without a passage like a test item, all columns as they were."""
    name, key, hashed = fresh(docs, "text_hash", "found_id", "found_hash")
    found = contaminated(docs, items, id_col=id_col, text_col=text_col, threshold=threshold)
    found = cut_lineage(found.select(F.col("id").alias(key), F.col("t1").alias(hashed)).distinct())
    rows = docs.withColumn(name, F.xxhash64(exact(text_col)))
    same = exact(id_col).eqNullSafe(F.col(key)) & (F.col(name) == F.col(hashed))
    return rows.join(found, same, "left_anti").drop(name)
