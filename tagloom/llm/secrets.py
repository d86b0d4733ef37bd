"""Secrets in texts, with weak parts reported only where parts that complete them are near (operator 12).

Three kinds of spans are strong enough alone (the base): an assignment to a telling name, an access key, a
long hexadecimal run. Three more are too common to be reported alone: a name of an account (`identifier`), a
mixed token of the shape of a key (`secret`) and an address of a service (`endpoint`). A weak part counts only within
a scope that holds what it lacks to be of use:

* a scope is the stretch of `SCOPE` code points before and behind an identifier or access key;
* an identifier counts if its scope holds a secret (weak, assigned or hexadecimal);
* a secret counts if it lies in the scope of an identifier or access key;
* an endpoint counts if it lies in a scope that holds a secret too.

Scopes and parts meet in an interval join within a document: scopes are entered under every cell of `SCOPE` code points
they touch, parts under the cell they start in, and the ends are compared. Parts of one role do not overlap, so a scope
holds a bounded number of them (at most one for each of its code points), however long the text is, and the number of pairs
grows with the text. Only spans are shuffled, never texts; the
key is the row and the cell, so a long text is spread as well.

Null and empty texts have no spans. Rows that repeat an id are rows of their own, kept apart by a number given when they are
read. A weak part that overlaps a base span is not added. Places are code points, ends exclusive. An empty
table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import text_slices
from tagloom.session import cut_lineage

SCOPE = 200

#: Fixed by the contract: the base kinds in their order, what they match, and how long they must be.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGNED = 12
BASE = ("assign", "access", "hex")
#: The same least lengths as part of the pattern, as no run that is too short holds a longer match.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: The weak parts: a named account, a token that may be a key, a service with scheme or port.
IDENTIFIER = re.compile(r"""(?i:\b(?:user(?:name|_?id)?|login|account|client_?id|(?:access_?)?key_?id)["']?\x20{0,4}[:=]\x20{0,4}["']?)[A-Za-z0-9._@+-]{3,64}""", re.ASCII)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""(?<![\w.+-])(?:[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D"'<>]{3,}|(?:[a-z0-9-]{1,63}\.){1,8}[a-z]{2,24}:\d{2,5}\b)""", re.ASCII)
WEAK = ("identifier", "secret", "endpoint")
KINDS = (*BASE, *WEAK)

#: Kinds that name an account and so have a scope, and kinds that open it.
NAMING, OPENING = ("access", "identifier"), ("assign", "hex", "secret")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base kinds; matches that are too short are dropped after matching."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def mixed(token: str) -> bool:
    """A token of small and capital letters and digits, as keys are and words are not."""
    return any(c.isdigit() for c in token) and token.upper() != token and token.lower() != token


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """(start, end, kind) of weak parts that no base span overlaps."""
    found = [(m.start(), m.end(), "identifier") for m in IDENTIFIER.finditer(text)]
    found += [(m.start(), m.end(), "secret") for m in TOKEN.finditer(text) if mixed(m[0])]
    found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    return _clear_of(sorted(found), base)


def _clear_of(spans: list[Span], others: list[Span]) -> list[Span]:
    """The spans that none of the others, sorted by start, overlaps."""
    starts, ends = [], []
    for start, end, _ in others:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def clear(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or ends[before - 1] <= start

    return [span for span in spans if clear(span[0], span[1])]


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
FOUND = "doc_id {0}, n_assign long, n_access long, n_hex long, base_sha256 string, base {1}, weak {1}"
SPAN_DDL = "array<struct<start: long, kind: int, end: long>>"


def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of every text, and weak parts of those that name an account at all."""
    for batch in text_slices(batches, "text"):
        counts: tuple[list, list, list] = ([], [], [])
        digests, base_column, weak_column = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            weak = weak_spans(text or "", base)
            kinds = [kind for _, _, kind in base]
            for column, kind in zip(counts, BASE):
                column.append(kinds.count(kind))
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            base_column.append([(start, KINDS.index(kind), end) for start, end, kind in base])
            named = any(kind in NAMING for _, _, kind in (*base, *weak))
            weak_column.append([(start, KINDS.index(kind), end) for start, end, kind in weak] if named else [])
        columns = [batch.column("doc_id"), *map(pa.array, counts), pa.array(digests, pa.string())]
        columns += [pa.array(base_column, SPAN), pa.array(weak_column, SPAN)]
        names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "weak")
        types = [batch.column("doc_id").type] + [pa.int64()] * 3 + [pa.string(), SPAN, SPAN]
        yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], list(names))


def _is(kind: Column, kinds: Iterable[str]) -> Column:
    return kind.isin(*(KINDS.index(k) for k in kinds))


def linked_parts(found: DataFrame) -> DataFrame:
    """(row, linked): the weak parts of each row that parts near them complete."""
    parts = found.where(F.size("weak") > 0).select("row", F.explode(F.concat("base", "weak")).alias("part")).select("row", "part", "part.*")
    low, high = F.greatest(F.lit(0), F.col("start") - SCOPE), F.col("end") + SCOPE
    scopes = parts.where(_is(F.col("kind"), NAMING)).select("row", F.col("part").alias("name"), low.alias("low"), high.alias("high"))
    cells = F.sequence(F.floor(F.col("low") / SCOPE), F.floor((F.col("high") - 1) / SCOPE))
    scopes = scopes.withColumn("cell", F.explode(cells))
    members = parts.where(_is(F.col("kind"), (*OPENING, "endpoint"))).withColumn("cell", F.floor(F.col("start") / SCOPE))
    met = scopes.join(members, ["row", "cell"]).where("low <= start AND start < high")
    opened = F.max(_is(F.col("kind"), OPENING)).over(Window.partitionBy("row", "name"))
    met = met.withColumn("opened", opened)
    weak_name, member = _is(F.col("name.kind"), WEAK), F.col("part")
    counted = F.array(
        F.when(weak_name & F.col("opened"), F.col("name")),
        F.when(_is(F.col("kind"), ("secret",)) | (_is(F.col("kind"), ("endpoint",)) & F.col("opened")), member),
    )
    linked = met.select("row", F.explode(counted).alias("part")).where(F.col("part").isNotNull())
    return linked.groupBy("row").agg(F.collect_set("part").alias("linked"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, found) of every document.

    `found` has every span as (start, number of the kind in `KINDS`, end), in order; the method adds those beyond the base kinds.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    # The number of a row is its place in the written table.
    searched = docs.select("doc_id", "text").mapInArrow(search, FOUND.format(kind, SPAN_DDL))
    found = cut_lineage(cut_lineage(searched).withColumn("row", F.monotonically_increasing_id()))
    linked = linked_parts(found).withColumnRenamed("row", "of")
    added = F.coalesce("linked", F.array().cast(SPAN_DDL))
    spans = F.array_sort(F.concat("base", added))
    counts = ("n_assign", "n_access", "n_hex", "base_sha256")
    return found.join(linked, F.col("row") == F.col("of"), "left").select("doc_id", *counts, spans.alias("found"))


def spans_text(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
