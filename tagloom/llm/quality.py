"""Quality scores by a factorisation machine (operator 1).

A text is a vector of hashed word counts (scaled to length one) and of statistics of its structure and
size. The machine scores it with a bias, a weight for each feature and the pairwise interactions of
all features, each held as the product of two short vectors:

    score = sigmoid(b + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ])

The bracket is the sum-of-squares identity: all pairs cost one pass over the features a text has.

The model is fitted on a sample of labelled rows of bounded size (`SAMPLE_ROWS`, the ids least by a hash, one text of
each); their vectors are all that reaches the driver. Rows whose crc32(id) mod 5 is 0 are held out. Label, language,
source and id are no inputs. Scoring reads every text whole, in one pass without a shuffle.

Null and empty texts are scored like any text, as one without words. Null ids are never held out. Without labelled
rows of both kinds the score is the smoothed share of label 1. Repeated rows get equal scores;
an empty table gives no rows; other columns do not count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import exact, fresh, slice_bounds
from tagloom.llm.repeats import word_codes

BUCKETS = 2048
FACTORS = 8
SAMPLE_ROWS = 6000
THRESHOLD = 0.3
_SIGN, _UPPER, _LOWER, _DIGIT = (r"[#*$%&|<>~^_=+\\/@{}\[\]]", r"\p{Lu}", r"\p{Ll}", r"[0-9]")
N_STATS = 16


def _word_traits(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and traits of every distinct word."""
    from xxhash import xxh32_intdigest

    bucket = np.array([xxh32_intdigest(w) % BUCKETS for w in words.cast(pa.binary()).to_pylist()], np.int64)
    count = lambda pattern: pc.count_substring_regex(words, pattern).to_numpy()
    size = pc.utf8_length(words).to_numpy().astype(np.float64)
    upper, lower = count(_UPPER), count(_LOWER)
    traits = [
        size,
        (upper > 1) & (lower == 0),
        count(_SIGN) > 0,
        count("!") > 0,
        count(_DIGIT) > 0,
        pc.match_substring_regex(words, r"[.?;:]$").to_numpy(zero_copy_only=False),
        pc.match_substring_regex(words, r",$").to_numpy(zero_copy_only=False),
        (upper > 0) & (lower > 0),
        upper + lower == 0,
        size > 20,
    ]
    return bucket, np.stack([np.asarray(t, np.float64) for t in traits], axis=1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse word features (text, bucket, value) and dense statistics of whole texts."""
    codes, words, bounds = word_codes(texts)
    n_texts, n_words = len(texts), np.diff(bounds)
    bucket, traits = _word_traits(words)
    text = np.repeat(np.arange(n_texts), n_words)
    safe = np.maximum(n_words, 1).astype(np.float64)
    shares = np.stack([np.bincount(text, traits[codes, j], n_texts) / safe for j in range(traits.shape[1])], axis=1)
    next_to = (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])
    adjacent = np.bincount(text[1:][next_to], minlength=n_texts) / safe
    exact_pairs, times = np.unique(text * np.int64(max(1, len(words))) + codes, return_counts=True)
    of_text = exact_pairs // max(1, len(words))
    distinct = np.bincount(of_text, minlength=n_texts)
    top = np.zeros(n_texts)
    np.maximum.at(top, of_text, times)
    lines = [t.split("\n") for t in texts.fill_null("").to_pylist()]
    twice = np.array([1 - len(set(own)) / len(own) for own in lines])
    stats = np.column_stack(
        [
            shares,
            adjacent,
            distinct / np.sqrt(safe),
            top / safe,
            twice,
            np.log1p(n_words),
            np.log1p(n_words / np.array([len(own) for own in lines])),
        ]
    )
    pairs, times = np.unique(text * np.int64(BUCKETS) + bucket[codes], return_counts=True)
    row, column = pairs // BUCKETS, pairs % BUCKETS
    norm = np.sqrt(np.bincount(row, times.astype(np.float64) ** 2, n_texts))
    return row, column, times / norm[row], np.sqrt(np.abs(stats))


@dataclass
class Machine:
    """A fitted machine: word buckets first, then the statistics (scaled by mean and spread)."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        row, column, value, stats = features(texts)
        n = len(texts)
        dense = np.clip((stats - self.mean) / self.spread, -5, 5)
        w_words, w_stats = self.weights[:BUCKETS], self.weights[BUCKETS:]
        v_words, v_stats = self.factors[:BUCKETS], self.factors[BUCKETS:]
        total = self.bias + dense @ w_stats + np.bincount(row, w_words[column] * value, n)
        for f in range(self.factors.shape[1]):
            each = v_words[column, f] * value
            sums = dense @ v_stats[:, f] + np.bincount(row, each, n)
            squares = (dense**2) @ (v_stats[:, f] ** 2) + np.bincount(row, each**2, n)
            total += 0.5 * (sums**2 - squares)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _constant(share: float) -> Machine:
    size = BUCKETS + N_STATS
    return Machine(
        float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, 1)), np.zeros(N_STATS), np.ones(N_STATS)
    )


def fit_machine(
    x: np.ndarray, stats: np.ndarray, label: np.ndarray, factors: int = FACTORS, epochs: int = 25, seed: int = 7
) -> Machine:
    """Fit by Adam on mini-batches of the word vectors `x` (dense) and the statistics."""
    if len(set(label.tolist())) < 2:
        return _constant((label.sum() + 1) / (len(label) + 2))
    mean, spread = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    x = np.concatenate([x, np.clip((stats - mean) / spread, -5, 5)], axis=1).astype(np.float32)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(x.shape[1], np.float32), rng.normal(0, 0.02, (x.shape[1], factors)).astype(np.float32)
    b = np.array(np.log(label.mean() / (1 - label.mean())), np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (b, w, v)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            own, y = x[order[i : i + 256]], label[order[i : i + 256]]
            square = own**2
            sums = own @ v
            z = b + own @ w + 0.5 * ((sums**2).sum(axis=1) - square @ (v**2).sum(axis=1))
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y).astype(np.float32) / len(y)
            grads = (
                error.sum(),
                own.T @ error + 1e-4 * w,
                own.T @ (error[:, None] * sums) - v * (square.T @ error)[:, None] + 1e-3 * v,
            )
            step += 1
            new = []
            for p, g, s in zip((b, w, v), grads, state):
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.999 * s[1] + 0.001 * g * g
                new.append(p - 0.02 * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-8))
            b, w, v = new
    return Machine(float(b), w.astype(np.float64), v.astype(np.float64), mean, spread)


def held_out(id_column: Column) -> Column:
    """Whether a row is kept for testing: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """Fit on at most `sample_rows` labelled rows that are not held out."""
    chosen = labels.where(exact(label_col).isin(0, 1) & ~held_out(exact(id_col)))
    chosen = chosen.groupBy(exact(id_col).alias("id")).agg(F.max(exact(label_col)).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(exact(id_col).alias("id"), exact(text_col).alias("text")).join(F.broadcast(chosen), "id")
    # One text for each id, so that ids with many rows keep to the bound.
    rows = rows.groupBy("id", "label").agg(F.min_by("text", F.coalesce(F.xxhash64("text"), F.lit(0))).alias("text"))

    def vectors(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                row, column, value, stats = features(part.column(0))
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(column, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(value, pa.float32())),
                        pa.array(list(stats), pa.list_(pa.float64())),
                    ],
                    names=["label", "columns", "vals", "stats"],
                )

    schema = "label int, columns array<int>, vals array<float>, stats array<double>"
    found = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(vectors, schema).toArrow()
    x = np.zeros((found.num_rows, BUCKETS), np.float32)
    at = found.column("columns").combine_chunks()
    x[np.repeat(np.arange(len(x)), pc.list_value_length(at).to_numpy()), at.flatten().to_numpy()] = (
        found.column("vals").combine_chunks().flatten().to_numpy()
    )
    label = found.column("label").to_numpy().astype(np.float32)
    stats = found.column("stats").combine_chunks().flatten().to_numpy().reshape(len(x), N_STATS)
    order = np.lexsort((*stats.T, label))  # the same model however the rows came
    return fit_machine(x[order], stats[order], label[order])


def score(machine: Machine, text: Column) -> Column:
    """The score of a whole text, 0 to 1."""

    def scores(texts: pa.Array) -> pa.Array:
        parts = [machine.score(texts.slice(a, b - a)) for a, b in slice_bounds(texts)]
        pa.default_memory_pool().release_unused()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(scores, "double")(text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, all columns as they were."""
    (name,) = fresh(docs, "quality_score")
    machine = train(docs, labels, text_col=text_col)
    return docs.withColumn(name, score(machine, exact(text_col))).where(F.col(name) >= threshold).drop(name)
