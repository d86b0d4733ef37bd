"""Byte-pair encoding by a walk over a prefix trie, and decoding (operator 2).

The encoding of a word by ranked merges has this property: the encoding of any of its prefixes is
the encoding of a shorter prefix plus one last token. So it is enough to know the last token of
every prefix. The distinct words of a slice of text go into a trie; a depth-first walk finds the
last token of each node from the states of its ancestors, and a prefix that many words share is
worked out once. A token may follow the state before it if ranked merges would not have merged
across the border between both, which `_border_holds` tests by undoing merges, latest first.

Texts repeat their words, so each task keeps the ids of the pieces it has met, up to
`CACHE_PIECES` of them; then it forgets them all, which costs time and changes nothing. There is no
shuffle: every task works on the rows it has read, and a lost task is simply run again.

Nulls count as empty texts, an empty text has no ids; repeated rows are encoded each on its own;
other columns of the frame, whatever their names, are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import exact, fresh, slice_bounds, text_slices

CACHE_PIECES = 400_000
#: Where encoding is all a task does, slices are longer and pieces are kept longer.
LONE_SLICE_BYTES, LONE_CACHE_PIECES = 6_000_000, 1_000_000
CACHE_BORDERS = 200_000
TRIE_WORDS = 50_000

#: A blank between two characters that are no white space: no token reaches over it.
_SPACE = r"[\s\pZ\x0b\x1c-\x1f\x{85}]"  # for Arrow's regular expressions
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")


class TrieEncoder:
    """Ranked merges of one vocabulary, applied to sets of words."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only plain byte-level BPE is supported")
        self.ids: dict[str, int] = {}
        vocab = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for token, i in vocab.items():
            if len(token) == 1:
                self.ids[token] = i
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = rank
            if whole not in self.made:
                self.made[whole], self.parts[whole] = rank, (a, b)
                self.ids[left + right] = whole
        self.begins = {token[:i] for token in self.ids for i in range(len(token) + 1)}
        self.alone: dict[int, bool] = {}
        self.borders: dict[tuple[int, int], bool] = {}
        self.states: dict[str, tuple] = {}

    def _border_holds(self, a: int, b: int) -> bool:
        """Whether merging a's and b's characters together gives a and b again."""
        held = self.borders.get((a, b))
        if held is None:
            if len(self.borders) >= CACHE_BORDERS:
                self.borders.clear()
            held = self.borders[a, b] = self._undo_border(a, b, len(self.rank))
        return held

    def _undo_border(self, a: int, b: int, limit: int) -> bool:
        """Undo the merges of a and b, latest first; none may be later than one across the border."""
        rank, made, parts = self.rank, self.made, self.parts
        while True:
            if rank.get((a, b), limit) < limit:
                return False
            made_a, made_b = made.get(a, -1), made.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = made_a, parts[a][1]
            else:
                limit, b = made_b + 1, parts[b][0]

    def _stands_alone(self, token: int) -> bool:
        """Whether the token's own characters are merged to the token."""
        held = self.alone.get(token)
        if held is None:
            held = token not in self.parts
            if not held:
                a, b = self.parts[token]
                held = self._stands_alone(a) and self._stands_alone(b)
                held = held and self._undo_border(a, b, self.made[token])
            self.alone[token] = held
        return held

    def _state(self, end: str) -> tuple[list[tuple[int, int]], dict, str]:
        """State of the walk after characters that end in `end`: tokens there, and next states by character.

        `end` is the longest end of the path that begins a token; all states together are the
        token automaton, made as far as it is met.
        """
        while end not in self.begins:
            end = end[1:]
        state = self.states.get(end)
        if state is None:
            tokens = ((len(end) - i, self.ids.get(end[i:])) for i in range(len(end)))
            state = self.states[end] = ([(n, t) for n, t in tokens if t is not None], {}, end)
        return state

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each word, a string over the byte alphabet."""
        trie: dict = {}
        for word in words:
            node = trie
            for char in word:
                node = node.setdefault(char, {})
            node[""] = word
        out: dict[str, tuple[int, ...]] = {}
        longest = max(map(len, words), default=0)
        last, before = [0] * (longest + 1), [0] * (longest + 1)  # by length of the path's prefix
        root = self._state("")
        todo = [(node, char, root, 1) for char, node in trie.items() if char]
        if "" in trie:
            out[""] = ()
        borders, holds, alone = self.borders, self._border_holds, self.alone
        while todo:
            node, char, above, depth = todo.pop()
            state = above[1].get(char)
            if state is None:
                state = above[1][char] = self._state(above[2] + char)
            for size, token in state[0]:
                start = depth - size
                if start:
                    held = borders.get((last[start], token))
                    if held is None:
                        held = holds(last[start], token)
                else:
                    held = alone.get(token)
                    if held is None:
                        held = self._stands_alone(token)
                if held:
                    last[depth], before[depth] = token, start
                    break
            else:
                raise ValueError(f"no token ends at {char!r}")
            depth += 1
            for char, child in node.items():
                if char:
                    todo.append((child, char, state, depth))
                else:
                    at, ids = depth - 1, []
                    while at:
                        ids.append(last[at])
                        at = before[at]
                    out[child] = tuple(ids[::-1])
        return out


class Codec:
    """Texts to ids and back. `encode_pieces` gives all ids of distinct pieces of text, and each one's number.

    A piece is what stands between two lone blanks, with the blank before it; no token can reach
    over such a blank, so pieces are encoded one by one.
    """

    def __init__(self, spec: dict, encode_pieces: Callable[[list[str]], tuple], cache_pieces: int | None = None):
        self.encode_pieces, self.cache_pieces = encode_pieces, cache_pieces or CACHE_PIECES
        self.added = {}
        for token in spec.get("added_tokens") or []:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError("added tokens that look at their surroundings are not supported")
            self.added[token["content"]] = token["id"]
        if spec.get("normalizer"):
            raise ValueError("normalizers are not supported")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.slow = "|".join([f"^{_SPACE}|{_SPACE}$|^$", *map(re.escape, longest_first)])
        self.bytes_of = byte_table(spec)
        self.byte_start = np.zeros(len(self.bytes_of) + 1, np.int64)
        np.cumsum([len(b) for b in self.bytes_of], out=self.byte_start[1:])
        self.byte_flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.bare: dict[str, int] = {}
        self.spaced: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 12, np.int64)
        self.count = 0
        for content, i in self.added.items():
            self._learn(self.bare, [content], np.array([i]), np.array([1]))

    def _learn(self, known: dict[str, int], keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        end, more = int(self.start[self.count]), len(ids)
        while self.count + len(keys) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while end + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[end : end + more] = ids
        self.start[self.count + 1 : self.count + 1 + len(keys)] = end + np.cumsum(sizes)
        known.update(zip(keys, range(self.count, self.count + len(keys))))
        self.count += len(keys)

    def _codes(self, known: dict[str, int], keys: list[str]) -> np.ndarray:
        """The numbers of pieces, unknown ones encoded first; `known` is for bare or for spaced ones."""
        code = np.fromiter(map(known.get, keys, repeat(-1)), np.int64, len(keys))
        unknown = np.flatnonzero(code < 0)
        if len(unknown):
            new = list(dict.fromkeys(keys[i] for i in unknown))
            lead = " " if known is self.spaced else ""
            self._learn(known, new, *self.encode_pieces([lead + k for k in new]))
            code[unknown] = [known[keys[i]] for i in unknown]
        return code

    def _slow_codes(self, text: str) -> np.ndarray:
        """The pieces of a text with added tokens, or with blanks next to other white space."""
        codes = []
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if part:
                first, *rest = [part] if i % 2 else _LONE_BLANK.split(part)
                codes += [self._codes(self.bare, [first]), self._codes(self.spaced, rest)]
        return np.concatenate(codes) if codes else np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start (one more than texts)."""
        if self.count > self.cache_pieces:
            self._forget()
        split = pc.split_pattern(texts.fill_null(""), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = split.flatten().dictionary_encode()
        number, pieces = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        slow = pc.match_substring_regex(coded.dictionary, self.slow).to_numpy(zero_copy_only=False)
        later = np.ones(len(number), bool)
        later[bounds[:-1]] = False
        used = np.zeros(len(pieces), bool)
        used[number[later]] = True
        code = np.zeros(len(pieces), np.int64)
        good = np.flatnonzero(used & ~slow)
        code[good] = self._codes(self.spaced, [pieces[i] for i in good] if len(good) < len(pieces) else pieces)
        code = code[number]
        first = number[bounds[:-1]]
        fast = np.flatnonzero(~slow[first])
        code[bounds[:-1][fast]] = self._codes(self.bare, [pieces[i] for i in first[fast]])
        again = np.flatnonzero(np.add.reduceat(slow[number], bounds[:-1]) if len(texts) else [])
        if len(again):
            runs = np.split(code, bounds[1:-1])
            for i in again:
                runs[i] = self._slow_codes(texts[int(i)].as_py() or "")
            code = np.concatenate(runs)
            np.cumsum([len(r) for r in runs], out=bounds[1:])
        ids, offsets = gather(self.flat, self.start[code], self.start[code + 1])
        return ids, offsets[bounds]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become the replacement character."""
        flat, offsets = gather(self.byte_flat, self.byte_start[ids], self.byte_start[ids + 1])
        data, at = flat.tobytes(), offsets[starts]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])]


def id_runs(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the lists one after the other, and the lists' sizes."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def gather(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs [start, end) of `flat` one after the other, and the offsets of the runs."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    kind = np.int32 if max(offsets[-1], len(flat)) < 1 << 31 else np.int64
    at = np.repeat((start - offsets[:-1]).astype(kind), size)
    at += np.arange(offsets[-1], dtype=kind)
    return flat[at], offsets


def byte_table(spec: dict) -> list[bytes]:
    """The bytes of every id.

    Byte-level vocabularies write a byte as a printable character: itself if it is printable
    Latin-1, else the next free character from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    vocab = spec["model"]["vocab"]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    out = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, i in vocab.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    for token, i in added.items():
        out[i] = token.encode()
    return out


@lru_cache(maxsize=2)
def trie_codec(vocabulary: str, cache_pieces: int | None = None) -> Codec:
    """A codec for the content of a vocabulary file; a worker process keeps it."""
    from tokenizers import Tokenizer

    spec = json.loads(vocabulary)
    encoder, cut = TrieEncoder(spec), Tokenizer.from_str(vocabulary).pre_tokenizer.pre_tokenize_str

    def words_of(piece: str) -> list[str]:
        if piece.isascii():  # letters and at most one sign after them need no library call
            body = piece[1:] if piece[:1] == " " else piece
            lead = "Ġ" if body is not piece else ""
            if body.isalpha():
                return [lead + body]
            if body[:-1].isalpha() and body[-1] in ".,;:!?":
                return [lead + body[:-1], body[-1]]
        return [w for w, _ in cut(piece)]

    def encode_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [words_of(p) for p in pieces]
        distinct = list({w for ws in words for w in ws})
        ids: dict[str, tuple[int, ...]] = {}
        for i in range(0, len(distinct), TRIE_WORDS):
            ids.update(encoder.encode_words(distinct[i : i + TRIE_WORDS]))
        return id_runs([ids[ws[0]] if len(ws) == 1 else sum((ids[w] for w in ws), ()) for ws in words])

    return Codec(spec, encode_pieces, cache_pieces)


def read_vocabulary(path: str) -> str:
    """The content of a vocabulary file on the driver's disk (about 2 MB), to be sent to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string): every whole text encoded, and its ids decoded again."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = trie_codec(shared.value, LONE_CACHE_PIECES)
        for rows in text_slices(batches, "text", LONE_SLICE_BYTES):
            ids, starts = codec.encode(rows.column(1))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
            decoded = pa.array(codec.decode(ids, starts), pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), lists, decoded], names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    two = docs.select(exact(id_col).alias("id"), exact(text_col).alias("text"))
    return two.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """`docs` with one more column: the ids of the text (an empty array for null)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def ids_of(texts: pa.Array) -> pa.Array:
        codec, parts = trie_codec(shared.value), []
        for a, b in slice_bounds(texts):
            ids, starts = codec.encode(texts.slice(a, b - a))
            parts.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())))
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    (name,) = fresh(docs, out_col)
    return docs.withColumn(name, F.arrow_udf(ids_of, "array<int>")(exact(text_col)))


def decode(docs: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`docs` with one more column: the text of the ids (empty for null)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def text_of(lists: pa.Array) -> pa.Array:
        codec, parts = trie_codec(shared.value), []
        for i in range(0, len(lists), 1000):
            some = lists.slice(i, 1000)
            starts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(some), 0).to_numpy())])
            parts.append(pa.array(codec.decode(some.flatten().to_numpy(), starts), pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    (name,) = fresh(docs, out_col)
    return docs.withColumn(name, F.arrow_udf(text_of, "string")(exact(ids_col)))


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
