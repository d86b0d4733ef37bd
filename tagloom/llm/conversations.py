"""Conversations brought back to a legal order of roles by the auction method (operator 11).

A conversation is legal if the first letters of its roles read `(s?(ua)+)?`. Its repair is a
shortest path through a lattice: a node is (rows read, state of that pattern), an arc is an edit with
an integer cost. The auction method finds it: every node has a price, never above the cost
of an arc plus the price at its end; a path grows from the origin along the cheapest end, and where no arc
is worth its price the price is raised and the path drawn back. When the path reaches the
destination, the prices on it are exact distances, and every other shortest path consists of tight arcs (price =
cost + price at the end). The audit is traced along tight arcs, least letter first; before a step is
taken, the auction goes on from the node it leads to, so that its price is exact too.

Conversations of any length: rows go in order (turn, then role and checksum of the text) to range
partitions, so one with a third of all rows lies in many. There it is cut into pieces of `PIECE` rows,
whose lattice gives the least cost between each pair of border states, and pieces are summed up to spans of
`SPAN` rows. Spans are chained twice along a conversation, one small row each: backwards for the price of
every border state, forwards for the state each span is entered in. Each span is traced
from every state it may be entered in. Equal pieces are solved once in a task (`CACHE` of them are kept). Only
checksums of texts are shuffled for all this; the texts follow by a join.

Nulls in role and text, and in the key of the damage, count as one space; rows without a turn come first;
rows without conv_id form one conversation. Empty texts are blank. Rows of equal turn go by role, then by the
checksum of the text; repeated rows are duplicates. A role with another initial than s, u or a can only be given
another role or deleted. An empty table gives no rows. Columns other than conv_id, turn, role and text are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import cut_lineage

PIECE = 8
SPAN = 8_192
CACHE = 50_000

#: Fixed by the contract: what the edits cost, and that undeleted truncated rows cost one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Fixed by the contract: role initials that may follow each other, and damage by crc32 modulo 20.
LEGAL = ("su", "ua", "au")
DAMAGES = {"drop": 0, "empty": 1, "unstop": 2, "repeat": 3, "as_user": 4}

#: States of the pattern: nothing yet, after s, after u, after a; where each initial leads.
STATES = range(4)
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that may be given or inserted in a state.
NEXT_ROLE = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
FAR = float("inf")

#: Fixed by the contract: what a blank text consists of.
GAPS = " \t\n\x0b\x0c\r"


class Lattice:
    """The edits of a run of rows, from its entry states to one destination behind its last row.

    `rows` has two characters for each row: the initial of its role (anything but s, u, a for another) and `.` for a
    sound row, `t` for a truncated one, `x` for one that must go. `ends` is the cost from each state
    behind the last row to the destination. Rows may be inserted before every row, and behind the
    last one if the run is the last of its conversation (`closing`).
    """

    def __init__(self, rows: str, ends: tuple, closing: bool):
        self.rows, self.ends, self.closing = rows, ends, closing
        self.levels = len(rows) // 2
        self.goal = 4 * (self.levels + 1)
        self.arcs = [self._arcs(*divmod(node, 4)) for node in range(self.goal)]
        self.price = [0.0] * self.goal + [0.0]
        for node in range(self.goal):
            if not closing and not any(ends[q] < FAR for q in _within_reach(node % 4)):
                self.price[node] = FAR

    def _arcs(self, level: int, state: int) -> list[tuple[str, float, int]]:
        """(letter, cost, node) of every edit at a node, in the order of the letters."""
        inserted = 4 * level + STEPS[state][NEXT_ROLE[state]]
        if level == self.levels:
            ends = [("", self.ends[state], self.goal)] if self.ends[state] < FAR else []
            return ends + [("I", INSERT, inserted)] * self.closing
        initial, fault = self.rows[2 * level : 2 * level + 2]
        down = 4 * (level + 1)
        arcs = [("D", DELETE, down + state), ("I", INSERT, inserted)]
        if fault != "x":
            more = TRUNCATED if fault == "t" else 0
            if initial in STEPS[state]:
                arcs.append(("K", KEEP + more, down + STEPS[state][initial]))
            arcs.append(("R", REROLE + more, down + STEPS[state][NEXT_ROLE[state]]))
        return arcs

    def auction(self, origin: int) -> float:
        """The exact distance of the origin; prices are raised until its path reaches the goal."""
        price, arcs, path = self.price, self.arcs, [origin]
        while path[-1] != self.goal:
            node = path[-1]
            best, follower = FAR, -1
            for _, cost, to in arcs[node]:
                if cost + price[to] < best:
                    best, follower = cost + price[to], to
            if price[node] < best:  # draw back
                price[node] = best
                if len(path) > 1:
                    path.pop()
                elif best == FAR:
                    break
            elif follower < 0:  # no way to the goal
                break
            else:
                path.append(follower)
        return price[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """(letters, state behind the last row) of the least audit among the shortest paths."""
        node, letters = state, []
        self.auction(node)
        while True:
            for letter, cost, to in self.arcs[node]:
                if self.price[node] == cost + self.price[to] and (to == self.goal or self.price[node] == cost + self.auction(to)):
                    break
            else:
                raise AssertionError("a node on a shortest path has a tight arc")
            if to == self.goal:
                return "".join(letters), node % 4
            letters.append(letter)
            node = to


def _within_reach(state: int) -> tuple[int, ...]:
    """States that may follow, itself included; no row leads back to the states before u."""
    return ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))[state]


@lru_cache(CACHE)
def distances(rows: str) -> tuple[tuple[float, ...], ...]:
    """Least cost of a piece from each border state to each, by one lattice for each end."""
    by_end = []
    for end in STATES:
        lattice = Lattice(rows, tuple(0 if q == end else FAR for q in STATES), False)
        by_end.append([lattice.auction(q) if end in _within_reach(q) else FAR for q in STATES])
    return tuple(zip(*by_end))


@lru_cache(CACHE)
def traced(rows: str, ends: tuple, closing: bool, state: int) -> tuple[str, int]:
    return Lattice(rows, ends, closing).trace(state)


@lru_cache(1)
def closing_prices() -> tuple[float, ...]:
    """Cost from each state behind the last row to the end of a conversation: what must be added."""
    lattice = Lattice("", (0, FAR, FAR, 0), True)
    return tuple(lattice.auction(q) for q in STATES)


def through(costs: Iterable, prices: tuple) -> tuple[float, ...]:
    """Prices before a piece from the prices behind it."""
    return tuple(min(c + p for c, p in zip(row, prices)) for row in costs)


def pieces_of(rows: str) -> list[str]:
    return [rows[i : i + 2 * PIECE] for i in range(0, len(rows), 2 * PIECE)]


def span_distances(rows: str) -> list[float]:
    """Least cost of a span from each border state to each, row by row."""
    total = [[0 if q == e else FAR for e in STATES] for q in STATES]
    for piece in pieces_of(rows):
        costs = list(zip(*distances(piece)))
        total = [[min(map(sum, zip(row, column))) for column in costs] for row in total]
    return [c for row in total for c in row]


def trace_span(rows: str, prices: tuple, closing: bool, states: Iterable[int]) -> dict[int, tuple[str, int]]:
    """{state the span is entered in: (letters, state behind it)}, given the prices behind it.

    Prices enter a piece less their least, so that equal pieces are found in the cache.
    """
    pieces = pieces_of(rows)
    behind = [closing_prices() if closing else prices]
    for piece in reversed(pieces):
        behind.append(through(distances(piece), behind[-1]))
    behind.reverse()
    found = {}
    for entered in states:
        if behind[0][entered] == FAR:
            continue
        state, letters = entered, []
        for i, (piece, ends) in enumerate(zip(pieces, behind[1:])):
            if closing and i + 1 == len(pieces):
                part, state = traced(piece, (0, FAR, FAR, 0), True, state)
            else:
                least = min(ends)
                part, state = traced(piece, tuple(p - least for p in ends), False, state)
            letters.append(part)
        found[entered] = ("".join(letters), state)
    return found


# Rows


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by the crc32 of `conv_id:turn`: (conv_id, turn, role, text)."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    hit = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    hit_by = {name: hit == number for name, number in DAMAGES.items()}
    role = F.when(hit_by["as_user"], "user").otherwise(role)
    text = F.when(hit_by["empty"], "").when(hit_by["unstop"], F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.where(~hit_by["drop"]).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(hit_by["repeat"], 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")


def text_key() -> Column:
    return F.unhex(F.md5("text"))


def faults(rows: DataFrame) -> DataFrame:
    """Rows without their texts: (conv_id, turn, role, key, seen, fault), the fault `b`, `t` or `.`.

    `seen`: another turn before this one has the same role and text. Repeats within a turn stand next to each
    other when sorted and are found there.
    """
    last = F.substring(F.rtrim(F.col("text"), F.lit(GAPS)), -1, 1)
    fault = F.when(last == "", "b").when(last.isin(".", "!", "?"), ".").otherwise("t")
    bare = cut_lineage(rows.select("conv_id", "turn", "role", text_key().alias("key"), fault.alias("fault")))
    same = ["conv_id", "role", "key"]
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    often = bare.where("fault <> 'b'").groupBy(*same).agg(F.min(turn).alias("first"), F.max(turn).alias("last")).where("first <> last")
    # Written, so that its size is known: few rows are sent to all tasks, many are joined.
    often = cut_lineage(often.select(*(F.col(c).alias(f"{c}_") for c in same), "first"))
    met = F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("role") == F.col("role_")) & (F.col("key") == F.col("key_"))
    seen = F.col("first").isNotNull() & (F.col("fault") != "b") & (turn > F.col("first"))
    return bare.join(often, met, "left").select(*bare.columns, F.coalesce(seen, F.lit(False)).alias("seen"))


SPAN_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("seq", pa.int64()),
        ("rows", pa.string()),
        ("first_turn", pa.int64()),
        ("last_turn", pa.int64()),
        ("turns", pa.int64()),
        ("illegal", pa.int64()),
        ("first_role", pa.string()),
        ("last_role", pa.string()),
        ("blank", pa.int64()),
        ("duplicate", pa.int64()),
        ("truncated", pa.int64()),
        ("costs", pa.list_(pa.float64())),
        ("turn", pa.list_(pa.int64())),
        ("role", pa.list_(pa.string())),
        ("key", pa.list_(pa.binary())),
    ]
)
SPAN_DDL = (
    "conv_id long, part int, seq long, rows string, first_turn long, last_turn long, turns long, illegal long, first_role string, "
    "last_role string, blank long, duplicate long, truncated long, costs array<double>, turn array<long>, role array<string>, key array<binary>"
)


def span_record(conv_id, part: int, seq: int, run: list[tuple]) -> dict:
    """One span as a row: its edits' costs, its counts and its rows. `run` has (turn, role, key, fault)."""
    marks = "".join((role[:1] or "-") + ("x" if fault in "bd" else fault) for _, role, _, fault in run)
    initials = [role[:1] for _, role, _, _ in run]
    known = [turn for turn, *_ in run if turn is not None]
    found = [fault for *_, fault in run]
    return {
        "conv_id": conv_id,
        "part": part,
        "seq": seq,
        "rows": marks,
        "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None,
        "turns": len(set(known)),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_role": initials[0],
        "last_role": initials[-1],
        "blank": found.count("b"),
        "duplicate": found.count("d"),
        "truncated": found.count("t"),
        "costs": span_distances(marks),
        "turn": [turn for turn, *_ in run],
        "role": [role for _, role, _, _ in run],
        "key": [key for _, _, key, _ in run],
    }


def _batches(records: Iterable[dict], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for record in records:
        held.append(record)
        if len(held) >= size or len(record.get("turn", ())) >= SPAN:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def cut_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows of a partition as spans of one conversation each."""

    def records():
        now, run, seq, before = None, [], 0, None
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("part", "conv_id", "turn", "role", "key", "fault", "seen"))
            for part, conv_id, turn, role, key, fault, seen in zip(*columns):
                same = now == (conv_id, part)
                if run and (not same or len(run) == SPAN):
                    yield span_record(*now, seq, run)
                    run, seq = [], seq + 1
                if not same:
                    now, seq, before = (conv_id, part), 0, None
                if fault != "b" and (seen or (turn, role, key) == before):
                    fault = "d"
                before = (turn, role, key)
                run.append((turn, role, key, fault))
        if run:
            yield span_record(*now, seq, run)

    return _batches(records(), SPAN_SCHEMA)


def spans(rows: DataFrame) -> DataFrame:
    """All conversations of damaged or raw rows as spans, written to the scratch folder.

    Rows that agree in all sort keys come into one partition, so repeats within a turn meet.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()]
    bare = cut_lineage(faults(rows))
    dealt = bare.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    return cut_lineage(dealt.sortWithinPartitions(*order).mapInArrow(cut_spans, SPAN_DDL))


def _by_conversation(df: DataFrame, *order: Column) -> DataFrame:
    """Rows of a conversation in one task, in order; read as a stream there."""
    return df.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


def price_borders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prices of the states behind every span; the last span of a conversation comes first."""
    keys = [("conv", pa.int64()), ("part_", pa.int32()), ("seq_", pa.int64())]
    schema = pa.schema([*keys, ("prices", pa.list_(pa.float64())), ("closing", pa.bool_()), ("opening", pa.bool_())])

    def records():
        held, prices = None, ()
        for batch in batches:
            for conv_id, part, seq, costs in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "part", "seq", "costs"))):
                closing = held is None or held["conv"] != conv_id
                if held:
                    yield held | {"opening": closing}
                if closing:
                    prices = closing_prices()
                held = {"conv": conv_id, "part_": part, "seq_": seq, "prices": prices, "closing": closing}
                prices = through([costs[i : i + 4] for i in range(0, 16, 4)], prices)
        if held:
            yield held | {"opening": True}

    return _batches(records(), schema, 20_000)


def trace_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every span with its audit for each state it may be entered in."""
    ways = pa.list_(pa.struct([("letters", pa.string()), ("exit", pa.int32())]))
    for batch in batches:
        found = []
        for rows, prices, closing, opening in zip(*(batch.column(name).to_pylist() for name in ("rows", "prices", "closing", "opening"))):
            ways_in = trace_span(rows, tuple(prices), closing, (0,) if opening else STATES)
            found.append([{"letters": ways_in[q][0], "exit": ways_in[q][1]} if q in ways_in else None for q in STATES])
        yield batch.append_column("ways", pa.array(found, ways))


def cost_of(rows: str, letters: str) -> int:
    """What edits cost, given as letters of a run of rows."""
    stay = "".join(letters.split("I"))
    truncated = sum(rows[2 * i + 1] == "t" for i, letter in enumerate(stay) if letter != "D")
    prices = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
    return TRUNCATED * truncated + sum(cost * letters.count(letter) for letter, cost in prices.items())


PICK_SCHEMA = pa.schema([*(f for f in SPAN_SCHEMA if f.name not in ("costs",)), ("entered", pa.int32()), ("letters", pa.string()), ("cost", pa.int64())])


def pick_ways(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every span with the audit of the state it is entered in, and counts that regard the span before."""

    def records():
        now, state, turn, role = (), 0, None, None
        for batch in batches:
            for span in batch.to_pylist():
                if now != (span["conv_id"],):
                    now, state, turn, role = (span["conv_id"],), 0, None, None
                if role is not None and role + span["first_role"] not in LEGAL:
                    span["illegal"] += 1
                if turn is not None and turn == span["first_turn"]:
                    span["turns"] -= 1
                way = span["ways"][state]
                span["entered"], span["letters"] = state, way["letters"]
                span["cost"] = cost_of(span["rows"], way["letters"])
                state, role = way["exit"], span["last_role"]
                turn = turn if span["last_turn"] is None else span["last_turn"]
                yield {name: span[name] for name in PICK_SCHEMA.names}

    return _batches(records(), PICK_SCHEMA)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation, one row for each span, written to the scratch folder.

    `letters` are the edits of the span's rows, `entered` the state before it; the other columns are those
    of `span_record`.
    """
    cut = spans(rows)
    borders = _by_conversation(cut.select("conv_id", "part", "seq", "costs"), F.desc("part"), F.desc("seq"))
    prices = borders.mapInArrow(price_borders, "conv long, part_ int, seq_ long, prices array<double>, closing boolean, opening boolean")
    met = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("part_")) & (F.col("seq") == F.col("seq_"))
    priced = cut.drop("costs").join(prices, met).drop("conv", "part_", "seq_")
    ways = "ways array<struct<letters: string, exit: int>>"
    traced_spans = priced.mapInArrow(trace_spans, f"{_ddl(priced)}, {ways}").drop("prices", "closing", "opening")
    ordered = _by_conversation(traced_spans, F.asc("part"), F.asc("seq"))
    picked = ordered.mapInArrow(pick_ways, SPAN_DDL.replace("costs array<double>, ", "") + ", entered int, letters string, cost long")
    return cut_lineage(picked)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def edited_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that stay or are inserted: (conv_id, part, seq, place, edit, turn, role, key, new_role)."""
    schema = pa.schema(
        [("conv", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("place", pa.int64()), ("edit", pa.string())]
        + [("at", pa.int64()), ("old_role", pa.string()), ("text_key", pa.binary()), ("new_role", pa.string())]
    )

    def records():
        for batch in batches:
            for span in batch.to_pylist():
                state, row = span["entered"], 0
                for place, letter in enumerate(span["letters"]):
                    out = {"conv": span["conv_id"], "part": span["part"], "seq": span["seq"], "place": place, "edit": letter}
                    initial = NEXT_ROLE[state]
                    if letter != "I":
                        out |= {"at": span["turn"][row], "old_role": span["role"][row], "text_key": span["key"][row]}
                        initial = out["old_role"][:1] if letter == "K" else initial
                        row += 1
                    if letter != "D":
                        state = STEPS[state][initial]
                        yield out | {"new_role": out["old_role"] if letter == "K" else ROLES[initial]}

    return _batches(records(), schema, 5_000)


def _row_key(*columns: str | Column) -> Column:
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.struct(*(c.alias(f"k{i}") for i, c in enumerate(columns)))


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, part, seq, place, edit, turn, role, text), ordered by part, seq, place.

    An undeleted row is the only one of its conversation, turn, role and text, so the join with the
    texts, of which each is kept once, pairs single rows. The key is one struct, in which nulls are equal, so that the texts are
    shuffled once for both.
    """
    ddl = "conv long, part int, seq long, place long, edit string, at long, old_role string, text_key binary, new_role string"
    kept = edits.mapInArrow(edited_rows, ddl)
    kept = kept.withColumn("row", _row_key("conv", "at", "old_role", "text_key"))
    texts = rows.select(_row_key("conv_id", "turn", "role", text_key()).alias("row"), "text").groupBy("row").agg(F.first("text").alias("text"))
    found = kept.join(texts, "row", "left")
    out = ("part", "seq", "place", "edit", F.col("at").alias("turn"), F.col("new_role").alias("role"))
    return found.select(F.col("conv").alias("conv_id"), *out, F.coalesce("text", F.lit("")).alias("text"))


def digest_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the `role:text` lines of every conversation, read as a stream of sorted rows."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string())])

    def records():
        now, digest = (), None
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))):
                if now != (conv_id,):
                    if digest:
                        yield {"conv": now[0], "repaired_sha256": digest.hexdigest()}
                    now, digest = (conv_id,), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if digest:
            yield {"conv": now[0], "repaired_sha256": digest.hexdigest()}

    return _batches(records(), schema, 20_000)


def audits(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of `conversations`: counts, cost, audit and digest of the repaired `rows`."""
    edits = repair(rows)
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "letters"))), lambda s: s["letters"]), "")
    totals = edits.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        letters.alias("audit"),
    )
    ordered = _by_conversation(repaired(rows, edits), F.asc("part"), F.asc("seq"), F.asc("place"))
    digests = ordered.mapInArrow(digest_lines, "conv long, repaired_sha256 string")
    ids = conversations.select("conv_id").distinct()
    totals = totals.withColumnRenamed("conv_id", "of")
    met = ids.join(totals, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.coalesce("audit", F.lit(""))
    return met.select("conv_id", *counts, audit.alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
