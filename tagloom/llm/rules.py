"""Quality rules of documents, and verdicts on their hosts (operator 6). Columns and joins alone.

Every text is measured in its own row: words, signs, repeated lines, and words in three-word windows that
occur twice or more. For the windows, the whole 64-bit hash of each and its place are sorted, and neighbours with
equal hashes are repeats, in texts of any length: among ten million words an equal hash of unlike windows is
expected three times in a million texts.

Rule failures are counted by host. A host's failure rate is shrunk to the mean of all hosts by a beta
prior whose strength is taken from the spread of the hosts' rates beyond what chance gives hosts of their size (moments), so
a host with few documents is not judged by chance. A host over `HOST_LIMIT` is rejected with all its documents. Counts are partial
aggregates, so a host with a third of all rows costs as much as any.

Null and empty texts have no words and fail; null hosts are one host of their own; repeated rows count
each; null ids are carried along. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import WORD_GAP, exact
from tagloom.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SIGN_PERCENT = 30
MAX_LINE_PERCENT = 50
HOST_LIMIT = 0.7
#: The prior counts as so many documents at least and at most.
PRIOR_LEAST, PRIOR_MOST = 2.0, 1000.0
#: A spread of the hosts' rates up to here is none: the strongest prior.
LEAST_SPREAD = 1e-12
_GAP_CHARS = " \t\n\x0b\x0c\r"
_SIGNS = r"[#*$%&|<>]"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_places(words: Column) -> Column:
    """Sorted places of the three-word windows that occur twice or more."""
    def windows(w: Column) -> Column:
        first = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        return F.transform(
            first,
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("hash"), i.alias("place")),
        )

    def same(a: Column, b: Column) -> Column:
        return a["hash"].eqNullSafe(b["hash"])

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1)))

    found = _bound(F.sort_array(_bound(words, windows)), repeated)
    return F.sort_array(F.transform(found, lambda x: x["place"].cast("long")))


def _covered(places: Column) -> Column:
    """Number of words in the windows that start at the sorted places."""
    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    return _bound(places, total)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host) and the base measures of every whole text."""
    text = F.coalesce(exact(text_col), F.lit(""))
    rows = docs.select(exact(id_col).alias("id"), exact(host_col).alias("host"), text.alias("text"))
    trimmed = F.trim("text", F.lit(_GAP_CHARS))
    rows = rows.select("*", F.filter(F.split(trimmed, WORD_GAP), lambda w: w != "").alias("words"))
    rows = rows.select("*", F.size("words").alias("n"))
    lines = F.filter(F.split("text", "\n"), lambda s: F.trim(s, F.lit(_GAP_CHARS)) != "")
    return rows.select(
        "id",
        "host",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(_SIGNS)).cast("long").alias("n_symbols"),
        _bound(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        _bound(lines, F.size).cast("long").alias("n_lines"),
        _covered(_repeat_places(F.col("words"))).alias("n_repeat_words"),
    )


def _prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength of the beta prior of failure rates, from their moments over the hosts (n, f).

    Rates of small hosts vary by chance alone; that part, the mean variance of a sample of each host's size, is
    taken off the spread first. What is left is how much hosts differ. Averages are taken of decimals, so no order of
    the rows changes them.
    """
    rate = F.col("f") / F.col("n")
    averages = [F.avg(x.cast("decimal(20,18)")).cast("double") for x in (rate, rate * rate, 1 / F.col("n"))]
    mean, square, per_row = (x or 0.0 for x in hosts.agg(*averages).first())  # one row
    spread = square - mean * mean - mean * (1 - mean) * per_row
    if spread <= LEAST_SPREAD:
        return mean, PRIOR_MOST
    return mean, min(PRIOR_MOST, max(PRIOR_LEAST, mean * (1 - mean) / spread - 1))


def with_verdicts(measured: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """The measures with base_failed, the host's shrunk failure rate and kept."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = (
        base
        | (100 * F.col("n_symbols") > MAX_SIGN_PERCENT * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > MAX_LINE_PERCENT * F.col("n_lines"))
    )
    rows = cut_lineage(measured.withColumn("base_failed", base).withColumn("rule_failed", failed))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("f"))
    hosts = cut_lineage(hosts)
    mean, strength = _prior(hosts)
    shrunk = (F.col("f") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    judged = hosts.select(F.col("host").alias("of"), shrunk.alias("host_rate"))
    judged = rows.join(judged, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= host_limit))


#: The same in DuckDB, with the windows compared as words.
OP6_SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM base),
places AS (
  SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM worded),
windows AS (
  SELECT r, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS w FROM places),
twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(3, coalesce(next - p, 3))) AS n FROM (
    SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS next FROM twice) GROUP BY r),
measured AS (
  SELECT w.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM worded w LEFT JOIN covered c ON w.r = c.r),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured),
ruled AS (
  SELECT *, base_failed OR 100 * n_symbols > {MAX_SIGN_PERCENT} * n_words
    OR 100 * n_dup_lines > {MAX_LINE_PERCENT} * n_lines AS rule_failed FROM judged),
hosts AS (
  SELECT source, count(*) AS n, sum(CAST(rule_failed AS INT)) AS f FROM ruled GROUP BY source),
prior AS (
  SELECT m, CASE WHEN spread <= {LEAST_SPREAD} THEN {PRIOR_MOST}
    ELSE least({PRIOR_MOST}, greatest({PRIOR_LEAST}, m * (1 - m) / spread - 1)) END AS s
  FROM (SELECT avg(f / n) AS m, avg((f / n) * (f / n)) - avg(f / n) * avg(f / n)
          - avg(f / n) * (1 - avg(f / n)) * avg(1 / n) AS spread FROM hosts) AS moments),
rates AS (
  SELECT source, (f + m * s) / (n + s) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= {HOST_LIMIT} AS kept
FROM ruled JOIN rates ON ruled.source IS NOT DISTINCT FROM rates.source
"""
