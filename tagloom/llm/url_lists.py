"""Dated URL lists joined to captures as of their fetch time (operator 7). Columns and joins alone.

A list is a log of dated entries: on a day, a key (a domain, a host, or a host with a path) is
put on or taken off. Per list and key the entries of a day become one (taking off wins), and the next day
of change ends the interval: [from, to). A capture is looked up under all keys it could be listed by: its host,
each parent domain, and the host with each leading part of its path. The as-of join is an equality join on key
and month, into which intervals are laid out, with the fetch time inside the interval. Intervals of one list and key do
not overlap, so a capture meets at most one of each; a host with a third of the captures is a skewed key of a
plain join that adaptive execution splits.

URLs are compared without scheme, user, port, query and fragment, hosts in lower case and paths as they are. A null or host-less URL, or a
null fetch time, matches nothing and is kept. Repeated captures are judged each; repeated entries count once. Intervals still open end at
the day after the last capture. Empty tables give no rows, or nothing listed. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import exact
from tagloom.session import cut_lineage

_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case; null if there is none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(host != "", host)


def keys_of(url: Column) -> Column:
    """All keys a URL may be listed by, the longest path first, the last label alone left out."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, count), "."),
    )
    parts = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda p: p != "")
    paths = F.transform(
        F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
    )
    return F.when(host.isNotNull(), F.array_distinct(F.concat(paths, domains)))


def listed_key(key: Column) -> Column:
    """A key as captures are looked up by: its host in lower case, its path as it is."""
    host = F.substring_index(key, "/", 1)
    return F.concat(F.lower(host), F.substr(key, F.length(host) + 1))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, from_day, to_day) from dated entries (list, key, day, listed); to_day is null while open.

    One row a day remains for each list and key, so a window holds at most as many rows as the log has days.
    """
    known = entries.where("list is not null and key is not null and day is not null and listed is not null")
    days = known.groupBy("list", listed_key(F.col("key")).alias("key"), "day").agg(F.min("listed").alias("listed"))
    order = Window.partitionBy("list", "key").orderBy("day")
    days = days.withColumn("before", F.lag("listed").over(order)).where("listed <> coalesce(before, false)")
    days = days.withColumn("to_day", F.lead("day").over(order))
    return days.where("listed").select("list", "key", F.col("day").alias("from_day"), "to_day")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(row columns, blocked, lists) for captures (capture, url, fetched): the lists active at fetch time."""
    rows = cut_lineage(captures.withColumn("row", F.monotonically_increasing_id()))
    keyed = rows.select("row", F.to_date("fetched").alias("on"), F.explode(keys_of(F.col("url"))).alias("key"))
    keyed = keyed.withColumn("month", F.trunc("on", "month"))
    on = F.to_date("fetched")
    first, last = rows.agg(F.min(on), F.date_add(F.max(on), 1)).first()  # two values
    # Only the months with captures are laid out, however far an interval reaches.
    spans = intervals(entries).withColumn("until", F.least(F.coalesce("to_day", F.lit(last)), F.lit(last)).cast("date"))
    spans = spans.withColumn("from_day", F.greatest("from_day", F.lit(first)).cast("date")).where("from_day < until").select(
        "list",
        F.col("key").alias("listed_key"),
        "from_day",
        "until",
        F.explode(
            F.sequence(F.trunc("from_day", "month"), F.trunc(F.date_sub("until", 1), "month"), F.expr("interval 1 month"))
        ).alias("in_month"),
    )
    asof = (
        (F.col("key") == F.col("listed_key"))
        & (F.col("month") == F.col("in_month"))
        & (F.col("on") >= F.col("from_day"))
        & (F.col("on") < F.col("until"))
    )
    hits = keyed.join(cut_lineage(spans), asof).groupBy("row").agg(F.collect_set("list").alias("lists"))
    none = F.array().cast("array<string>")
    judged = rows.join(hits, "row", "left").withColumn("lists", F.coalesce(F.sort_array("lists"), none))
    return judged.withColumn("blocked", F.size("lists") > 0).drop("row")


# The given pages have no fetch times and there is no list, so both are derived from their ids and URLs:
# md5 of a text as a number, which DuckDB can follow.


def _number(text: Column, modulus: int) -> Column:
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % modulus).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time of some day in two years."""
    day = _number(F.concat(F.lit("fetch"), F.col("page_id").cast("string")), 730)
    fetched = F.date_add(F.lit("2023-01-01").cast("date"), day).cast("timestamp")
    return pages.select("page_id", "url", fetched.alias("fetched"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A log of two lists: one of hosts and domains, one of single paths; on, off, and on again."""
    host = host_of(F.col("url"))
    hosts = pages.select(F.lit("spam").alias("list"), host.alias("key")).where("key is not null").distinct()
    domains = hosts.select(F.lit("malware").alias("list"), F.regexp_extract("key", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("key"))
    path = F.concat(host, F.rtrim(F.regexp_extract("url", _PATH, 1), F.lit("/")))
    paths = pages.where(_number(F.col("url"), 5) == 0).select(F.lit("pages").alias("list"), path.alias("key"))
    keys = hosts.unionByName(domains.where("key <> ''").distinct()).unionByName(paths.where("key is not null").distinct())
    name = F.concat_ws("|", "list", "key")
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda i: F.struct(
            F.date_add(F.lit("2023-01-01").cast("date"), _number(F.concat(name, i.cast("string")), 700)).alias("day"),
            (i % 2 == 0).alias("listed"),
        ),
    )
    rows = keys.where(_number(name, 3) > 0).select("list", "key", F.explode(steps).alias("s"))
    return rows.select("list", "key", "s.day", "s.listed")


OP7_SQL = r"""
WITH parts AS (
  SELECT page_id, url, DATE '2023-01-01' + CAST(CAST('0x' || md5('fetch' || page_id)[1:8] AS BIGINT) % 730 AS INT) AS fetched,
    nullif(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
keys AS (
  SELECT 'spam' AS list, host AS key FROM parts WHERE host IS NOT NULL
  UNION SELECT 'malware', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM parts
    WHERE regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) <> ''
  UNION SELECT 'pages', host || rtrim(path, '/') FROM parts
    WHERE host IS NOT NULL AND CAST('0x' || md5(url)[1:8] AS BIGINT) % 5 = 0),
log AS (
  SELECT list, lower(split_part(key, '/', 1)) || substr(key, length(split_part(key, '/', 1)) + 1) AS key, DATE '2023-01-01'
    + CAST(CAST('0x' || md5(list || '|' || key || i)[1:8] AS BIGINT) % 700 AS INT) AS day, i % 2 = 0 AS listed
  FROM keys, range(4) AS steps(i) WHERE CAST('0x' || md5(list || '|' || key)[1:8] AS BIGINT) % 3 > 0),
days AS (SELECT list, key, day, bool_and(listed) AS listed FROM log GROUP BY ALL),
spans AS (
  SELECT list, key, day, listed, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM days),
split AS (
  SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS steps FROM parts),
looked AS (
  SELECT DISTINCT page_id, url, fetched, unnest(list_concat(
    list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[1:i], '/')))) AS key
  FROM split WHERE host IS NOT NULL),
hits AS (
  SELECT page_id, url, list_sort(list(DISTINCT list)) AS lists FROM looked l JOIN spans s
    ON l.key = s.key AND s.listed AND l.fetched >= s.day AND (s.until IS NULL OR l.fetched < s.until)
  GROUP BY page_id, url)
SELECT p.page_id, p.url, strftime(p.fetched, '%Y-%m-%d') AS fetched_on, h.lists IS NOT NULL AS blocked,
  coalesce(array_to_string(h.lists, ','), '') AS lists
FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND p.url IS NOT DISTINCT FROM h.url
"""
