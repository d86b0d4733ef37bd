"""Passages that repeat across documents, found by shared seeds and window hashes (operator 10).

Seeds are winnowed: of the `WINDOW - SEED + 1` runs of `SEED` words in a window of `WINDOW` words
the one with the least hash is taken. Equal windows have equal seeds, so a window can only repeat
in another text if its seed is shared between texts; all others are dropped after one aggregation of
seeds (about one for every sixteen words). Documents that hold shared seeds are read again, and all
windows that such a seed is the least in are hashed; in place of an extension word by word, which
would need pairs of holders, windows are compared by these hashes. The first document of every
window is one more aggregation, by 128-bit hashes; a window of a later document is a repeat. Runs of
repeated windows, merged, are the maximal repeats over the length threshold.

No pairs of documents are made: a passage held by a third of all documents is one key whose least
id is found by partial aggregation and joined back, and adaptive execution splits such a join. Exact
copies of a text are settled by the text's hash and not extended at all.

Nulls and empty texts have no words. A window repeats only from a smaller id: rows that repeat an id
do not take from each other, null ids neither take nor give. Texts of fewer than `WINDOW` words
stay whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import exact, fresh, text_slices
from tagloom.session import cut_lineage

WINDOW = 50
SEED = 20
_FACTOR, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9FB21C651E98DF25)
_GAP = b" \t\n\x0b\x0c\r"


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of every word, the distinct words, and where each text's words start."""
    trimmed = pc.ascii_trim(texts.fill_null(""), characters=_GAP.decode())
    split = pc.ascii_split_whitespace(trimmed)
    bounds = split.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    if empty.any():  # an empty text is split into one empty word
        real = ~empty[codes]
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    return codes, coded.dictionary, bounds


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run `a` followed, `size` words on, by the run `b`."""
    n = max(0, min(len(a), len(b) - size))
    return _mixed(a[:n] * _FACTOR + b[size : size + n])


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each place on, by doubling."""
    powers, size = [words], 1
    while 2 * size <= length:
        powers.append(_joined(powers[-1], powers[-1], size))
        size *= 2
    out, done = powers[-1], size
    for k in range(len(powers) - 2, -1, -1):
        if length - done >= 1 << k:
            out = _joined(out, powers[k], done)
            done += 1 << k
    return out


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of the `span` values from each place on, by doubling."""
    size = 1
    while 2 * size <= span:
        values = np.minimum(values[:-size], values[size:]) if len(values) > size else values[:0]
        size *= 2
    rest = span - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """The windows of some texts: whose they are, where they start, and their seeds."""

    def __init__(self, texts: pa.Array, window: int, seed: int):
        from xxhash import xxh3_128_intdigest

        codes, words, self.bounds = word_codes(texts)
        digests = [xxh3_128_intdigest(w) for w in words.cast(pa.binary()).to_pylist()]
        low = np.array([d & 0xFFFFFFFFFFFFFFFF for d in digests], np.uint64)
        high = np.array([d >> 64 for d in digests], np.uint64)
        self.low, self.high, self.window = low[codes], high[codes], window
        text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        whole = np.flatnonzero(text[: max(0, len(text) - window + 1)] == text[window - 1 :]) if len(text) >= window else np.zeros(0, np.int64)
        self.at, self.text = whole, text[whole]
        self.seeds = _least(run_hashes(self.low, seed), window - seed + 1)[whole]

    def hashes(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(run_hashes(w, self.window)[self.at[chosen]] for w in (self.high, self.low))


def _seeds(window: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "text"):
            w = Windows(rows.column(1), window, seed)
            if not len(w.at):
                continue
            new = np.concatenate([[True], (w.seeds[1:] != w.seeds[:-1]) | (w.text[1:] != w.text[:-1])])
            pairs = np.unique(np.stack([w.text[new].astype(np.uint64), w.seeds[new]]), axis=1)
            whose = rows.column(0).take(pa.array(pairs[0].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1].view(np.int64)), whose], names=["seed", "t1"])

    return run


def _extended(window: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "text"):
            w = Windows(rows.column(2), window, seed)
            shared = np.unique(rows.column(3).flatten().to_numpy()).view(np.uint64)
            chosen = np.flatnonzero(np.isin(w.seeds, shared))
            if not len(chosen):
                continue
            high, low = w.hashes(chosen)
            text = pa.array(w.text[chosen])
            start = w.at[chosen] - w.bounds[w.text[chosen]]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(text),
                    rows.column(1).take(text),
                    pa.array(start, pa.int32()),
                    pa.array(high.view(np.int64)),
                    pa.array(low.view(np.int64)),
                ],
                names=["id", "t1", "start", "high", "low"],
            )

    return run


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(id, t1, whole, starts): for each row with repeats, where repeated windows start.

    `t1` is the text's hash; `whole` says that the whole text stands in a document with a smaller id.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = exact(text_col)
    base = docs.select(
        exact(id_col).alias("id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    keys = cut_lineage(base.drop("text"))
    # Aggregates are written before they are joined back: the join then shuffles both sides anew, and
    # adaptive execution can split a key that a large share of the rows has.
    first = cut_lineage(keys.groupBy("t1", "t2").agg(F.min("id").alias("first_id")))
    seeds = cut_lineage(base.select("t1", "text").mapInArrow(_seeds(window, seed), "seed long, t1 long"))
    shared = seeds.groupBy("seed").agg(F.min("t1").alias("a"), F.max("t1").alias("b")).where("a <> b").select("seed")
    shared = cut_lineage(shared)
    held = seeds.join(shared, "seed").groupBy("t1").agg(F.collect_set("seed").alias("seeds"))
    once = first.join(held, "t1").where("first_id is not null")
    once = cut_lineage(once.select(F.col("first_id").alias("id"), "t1", "t2", "seeds"))
    rows = base.join(once, ["id", "t1", "t2"]).select("id", "t1", "text", "seeds")
    found = rows.mapInArrow(_extended(window, seed), f"id {kind}, t1 long, start int, high long, low long")
    found = cut_lineage(found)
    origin = found.groupBy("high", "low").agg(F.min("id").alias("origin"), F.max("id").alias("last"))
    origin = cut_lineage(origin.where("origin < last").drop("last"))
    later = found.join(origin, ["high", "low"]).where("id > origin")
    starts = later.groupBy("id", "t1").agg(F.collect_list("start").alias("starts"))
    copies = keys.join(first, ["t1", "t2"]).where("id > first_id").select("id", "t1").distinct()
    none = F.array().cast("array<int>")
    return cut_lineage(
        starts.select("id", "t1", F.lit(False).alias("whole"), "starts").unionByName(
            copies.select("id", "t1", F.lit(True).alias("whole"), none.alias("starts"))
        )
    )


def _kept(text: str, whole: bool | None, starts: list[int] | None, window: int) -> tuple:
    """Number of words, the removed intervals, and the parts (words with the gap behind) kept."""
    parts = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
    gone = np.zeros(len(parts) + 1, np.int64)
    if whole and len(parts) >= window:
        starts = [0, *range(0, len(parts) - window + 1, window), len(parts) - window]
    for s in starts if starts is not None else ():
        gone[s] += 1
        gone[s + window] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
    spans = edge.reshape(-1, 2).tolist()
    return len(parts), spans, [parts[i] for i in np.flatnonzero(~gone)]


def _cutter(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "text"):
            text, whole, starts = (rows.column(i).to_pylist() for i in (1, 2, 3))
            out: list[tuple] = []
            for t, w, s in zip(text, whole, starts):
                if w or s:
                    n, spans, parts = _kept(t, w, s, window)
                    words = " ".join(p.rstrip(_GAP.decode()) for p in parts)
                    out.append((n, sum(b - a for a, b in spans), spans, words, "".join(parts) if spans else t))
                else:
                    split = t.encode().split()
                    out.append((len(split), 0, [], b" ".join(split).decode(), t))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.string(), pa.string())
            cells = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *cells], names=["id", "n_words", "n_removed", "spans", "kept_words", "kept_text"]
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """(id, n_words, n_removed, spans, kept_words, kept_text) for every row.

    `spans` are the maximal repeats as [first word, word behind the last]; `kept_words` the other
    words with single blanks, `kept_text` the same with the gaps of the text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = _marked(docs, id_col, text_col, window, seed)
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text"), "whole", "starts")
    schema = "n_words long, n_removed long, spans array<array<int>>, kept_words string, kept_text string"
    return rows.mapInArrow(_cutter(window), f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def _marked(docs: DataFrame, id_col: str, text_col: str, window: int, seed: int) -> DataFrame:
    marks = repeated_windows(docs, id_col, text_col, window, seed)
    marks = marks.groupBy("id", "t1").agg(F.max("whole").alias("whole"), F.flatten(F.collect_list("starts")).alias("starts"))
    rows = docs.select(exact(id_col).alias("key"), exact(text_col).alias("text"), F.xxhash64(exact(text_col)).alias("hash"))
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("t1"))
    return rows.join(marks, same, "left").select(F.col("key").alias("id"), "text", "whole", "starts")


def cut_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """`docs` with the repeats cut out of the text; a null text stays null, other columns as they were."""
    name, key, whole, starts = fresh(docs, "text_hash", "key_id", "whole_repeat", "repeat_starts")
    marks = repeated_windows(docs, id_col, text_col, window, seed)
    marks = marks.groupBy(F.col("id").alias(key), F.col("t1").alias("t1_")).agg(
        F.max("whole").alias(whole), F.flatten(F.collect_list("starts")).alias(starts)
    )
    rows = docs.withColumn(name, F.xxhash64(exact(text_col)))
    same = exact(id_col).eqNullSafe(F.col(key)) & (F.col(name) == F.col("t1_"))

    def cut(texts, wholes, starts_of):
        import pandas as pd

        return pd.Series(
            ["".join(_kept(t, w, s, window)[2]) for t, w, s in zip(texts, wholes, starts_of)], dtype=object
        )

    marked = rows.join(marks, same, "left")
    found = F.coalesce(F.col(whole), F.lit(False)) | (F.size(F.col(starts)) > 0)
    shorter = F.pandas_udf(cut, "string")(
        F.when(found, exact(text_col)).otherwise(F.lit("")), F.coalesce(F.col(whole), F.lit(False)), F.col(starts)
    )
    out = marked.withColumn(text_col, F.when(found, shorter).otherwise(exact(text_col)))
    return out.select(*(exact(c) for c in docs.columns))
