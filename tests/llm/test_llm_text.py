"""Text operators against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from tagloom.llm import bpe, decontaminate, quality, repeats, simhash, token_files
from tagloom.llm.queries import QUERIES, VOCABULARY
from tagloom.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHING = "id long, t1 long, text_hash long, fp long, ids long, decoded long, quality_score long, item long, row long"
WORDS = ["the", "of", "and", "ring", "ever", "tone", "Über", "été", "stone", "river", "cloud", "lamp"]


def sentence(draw, n):
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))


def awkward_rows():
    draw = random.Random(5)
    text, long = sentence(draw, 120), sentence(draw, 30_000)
    return [
        (1, ""),
        (2, None),
        (3, " \n\t \x0b"),
        (4, text),
        (4, text),
        (5, text),
        (6, text + " and more"),
        (7, "lead " + text),
        (8, long),
        (9, long[: len(long) // 2]),
        (10, "one"),
        (11, "a  b  c   d\r\n\r\n<|endoftext|> x<|endoftext|>"),
        (12, "word " * 200),
        (13, "word " * 200),
        (14, "\n".join(["same line here", "other"] * 40)),
        (None, text),
        (None, None),
    ]


@pytest.fixture(scope="module")
def awkward(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in awkward_rows()], SCHEMA)
    for column in CLASHING.split(", "):
        docs = docs.withColumn(column.split()[0], F.lit(7).cast("long"))
    return docs


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], f"{SCHEMA}, {CLASHING}")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


# Encoding (2) and token files (9)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_trie_equals_the_library_for_every_character(library):
    codec = bpe.trie_codec(bpe.read_vocabulary(VOCABULARY))
    points = [*range(0x20, 0x600), *range(0x1680, 0x1690), *range(0x2000, 0x2070), *range(0x3000, 0x3010), 0xFEFF, 0x1F600]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} x {chr(c)} y{chr(c)} {chr(c)}1 " for c in [*range(0x20), *points]]
    draw = random.Random(1)
    alphabet = [" ", "  ", "\n", "\t", "a", "don't", "'ll", "1", "é", "<|endoftext|>", "!", "\x85", " ", "the", " of", "😀"]
    texts += ["".join(draw.choice(alphabet) for _ in range(draw.randrange(14))) for _ in range(4000)]
    ids, starts = codec.encode(pa.array(texts))
    decoded = codec.decode(ids, starts)
    for text, a, b, back in zip(texts, starts[:-1], starts[1:], decoded):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == expected, text
        assert back == library.decode(expected, skip_special_tokens=False)


def test_forgetting_pieces_changes_nothing(monkeypatch, documents):
    texts = pa.array([r.text for r in documents.collect()])
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    bpe.trie_codec.cache_clear()
    whole = bpe.trie_codec(vocabulary).encode(texts)[0].tolist()
    for name in ("CACHE_PIECES", "CACHE_BORDERS", "TRIE_WORDS"):
        monkeypatch.setattr(bpe, name, 50)
    bpe.trie_codec.cache_clear()
    codec = bpe.trie_codec(vocabulary)
    parts = [codec.encode(texts.slice(i, 20))[0].tolist() for i in range(0, len(texts), 20)]
    bpe.trie_codec.cache_clear()
    assert sum(parts, []) == whole


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("frame", ["documents", "awkward"])
def test_encode_decode(request, library, frame):
    docs = request.getfixturevalue(frame)
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    found = bpe.digests(bpe.encode_decode(docs, vocabulary)).collect()
    expected = []
    for row in docs.select("doc_id", "text").collect():
        ids = ids_of(library, row.text)
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((row.doc_id, len(ids), listed, hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_encode_and_decode_columns_keep_the_rest(awkward, empty, library):
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    both = bpe.decode(bpe.encode(awkward, vocabulary), vocabulary, ids_col="ids_")
    assert both.columns == [*awkward.columns, "ids_", "decoded_"]
    for row in both.collect():
        assert row.ids_ == ids_of(library, row.text) and row.decoded_ == (row.text or "")
    assert bpe.encode(empty, vocabulary).count() == bpe.encode_decode(empty, vocabulary).count() == 0


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 2**32 - 1])
def test_segments_round_trip(size, top):
    draw = np.random.default_rng(size + top)
    ids = draw.integers(0, top, size, dtype=np.uint32)
    ids[::37] = draw.integers(0, 2**32 - 1, len(ids[::37]), dtype=np.uint32)
    segment = token_files.pack_segment(ids)
    assert (token_files.unpack_segment(segment) == ids).all()
    for k in range(-(-size // token_files.BLOCK)):
        part = ids[k * token_files.BLOCK : (k + 1) * token_files.BLOCK]
        assert (token_files.read_block(segment, k) == part).all()


def test_usual_ids_take_about_two_bytes():
    ids = np.random.default_rng(1).integers(0, 50_257, 100_000, dtype=np.uint32)
    assert len(token_files.pack_segment(ids)) < 2.1 * len(ids)


@pytest.mark.parametrize("frame", ["documents", "awkward", "empty"])
def test_token_files(request, spark, library, frame, monkeypatch):
    docs = request.getfixturevalue(frame)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, bpe.read_vocabulary(VOCABULARY), path)
    found = token_files.read_token_files(spark, path).orderBy("start").collect()
    rows = docs.select("doc_id", "text").collect()
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    sizes, start = sorted((r.doc_id is not None, r.doc_id, *ids_of(library, r.text), 0) for r in rows if r.doc_id is not None), 0
    assert sorted((True, r.doc_id, *np.frombuffer(r.tokens, "<u4").tolist()) for r in found if r.doc_id is not None) == sizes
    for row in found:
        assert (row.start, row.n_tokens * 4) == (start, len(row.tokens))
        start += row.n_tokens


# SimHash (3)


def brute_components(rows):
    upper = {c: chr(c + 32) for c in range(65, 91)}
    fps = []
    for _, text in rows:
        w = words((text or "").translate(upper))
        runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
        hashes = [xxh64_intdigest(r.encode(), seed=42) for r in runs]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(rows)))
    for i, a in enumerate(fps):
        for j in range(i):
            if bin(a ^ fps[j]).count("1") <= 3 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, format(fp, "016x"), least.get(g)) for (i, _), fp, g in zip(rows, fps, group)]


@pytest.mark.parametrize("frame", ["documents", "awkward", "empty"])
def test_near_duplicates(request, frame):
    docs = request.getfixturevalue(frame)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_components(rows), key=str)


def test_links_among_crowded_fingerprints(spark):
    """Crowds around a few centres: the components are those of all pairs within three bits."""
    draw = random.Random(8)
    fps = set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(5))))
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    mask = (1 << 64) - 1
    assert all(bin((u ^ v) & mask).count("1") <= 3 for u, v in links)

    def groups(pairs):
        of = {f: f for f in signed}
        for u, v in pairs:
            a, b = of[u], of[v]
            if a != b:
                of = {k: a if g == b else g for k, g in of.items()}
        named = {}
        for k, g in of.items():
            named.setdefault(g, set()).add(k)
        return {frozenset(s) for s in named.values()}

    near = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= 3]
    assert groups(links) == groups(near)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(1, 80)] + [(900, 900), (700, 699)]
    from tagloom.llm.components import connected

    found = dict(map(tuple, connected(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(61)}, **{500 + i: 500 for i in range(80)}, 699: 699, 700: 699}


def test_one_document_of_each_group_stays(awkward, empty):
    kept = simhash.deduplicate(awkward)
    assert kept.columns == awkward.columns
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    groups = brute_components(rows)
    expected = {(i, t) for (i, t), (_, _, c) in zip(rows, groups) if i == c}
    assert sorted((tuple(r) for r in kept.select("doc_id", "text").collect()), key=str) == sorted(expected, key=str)
    assert simhash.deduplicate(empty).count() == 0


# Repeated passages (10)


def brute_repeats(rows, window):
    first = {}
    for i, text in rows:
        if i is not None:
            w = words(text)
            for k in range(len(w) - window + 1):
                run = tuple(w[k : k + window])
                first[run] = min(i, first.get(run, i))
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("frame, window, seed", [("documents", 50, 20), ("awkward", 50, 20), ("awkward", 8, 3), ("empty", 50, 20)])
def test_repeats(request, frame, window, seed):
    docs = request.getfixturevalue(frame)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = repeats.remove_repeats(docs, window=window, seed=seed).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_words) for r in found]
    assert sorted(got, key=str) == sorted(brute_repeats(rows, window), key=str)
    assert all(sum(b - a for a, b in r.spans) == r.n_removed for r in found)


def test_shared_passages_of_any_length(spark):
    """Passages of random length around the threshold, in random surroundings and repeated in one text."""
    draw = random.Random(2)
    shared = [sentence(draw, n) for n in (6, 7, 8, 9, 15, 16, 31, 40)]
    rows = []
    for i in range(60):
        parts = [draw.choice(shared) if draw.random() < 0.6 else sentence(draw, draw.randrange(1, 12)) for _ in range(5)]
        rows.append((i, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs, window=8, seed=3).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_words) for r in found) == sorted(brute_repeats(rows, 8))


def test_cut_repeats_keeps_rows_and_gaps(awkward, empty):
    cut = repeats.cut_repeats(awkward)
    assert cut.columns == awkward.columns
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    kept = {(i, t): k for (i, t), (_, _, _, k) in zip(rows, brute_repeats(rows, 50))}
    found = [tuple(r) for r in cut.select("doc_id", "text").collect()]
    assert sorted((i, " ".join(words(t))) for i, t in found if i) == sorted((i, k) for (i, t), k in
        [((i, t), kept[i, t]) for i, t in rows] if i)
    assert sum(t is None for _, t in found) == 2 and repeats.cut_repeats(empty).count() == 0


# Quality (1)


def test_sum_of_squares_equals_all_pairs(documents):
    draw = np.random.default_rng(4)
    size = quality.BUCKETS + quality.N_STATS
    machine = quality.Machine(
        0.3, draw.normal(size=size), draw.normal(size=(size, 3)), np.zeros(quality.N_STATS), np.ones(quality.N_STATS)
    )
    texts = pa.array([r.text for r in documents.limit(4).collect()] + ["", None, "one two two"])
    row, column, value, stats = quality.features(texts)
    for i, score in enumerate(machine.score(texts)):
        x = np.zeros(size)
        x[column[row == i]] = value[row == i]
        x[quality.BUCKETS :] = np.clip(stats[i], -5, 5)
        some = np.flatnonzero(x)
        total = machine.bias + machine.weights @ x
        for a, p in enumerate(some):
            for q in some[a + 1 :]:
                total += machine.factors[p] @ machine.factors[q] * x[p] * x[q]
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op1_quality_fm"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out and quality is not null").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 500 and right / len(rows) > 0.98


def test_scores_of_awkward_rows(spark, awkward, empty, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    machine = quality.train(documents, labels)
    rows = awkward.select("doc_id", "text", quality.score(machine, F.col("text")).alias("s")).collect()
    assert len(rows) == awkward.count() and all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if r.doc_id in (4, 5)}) == 1
    assert quality.keep_good(awkward, labels).columns == awkward.columns
    assert quality.keep_good(empty, labels).count() == 0
    none = labels.where("false")
    assert quality.train(documents, none).score(pa.array(["x"]))[0] == pytest.approx(0.5)
    one_kind = quality.train(documents, labels.where("quality = 1"))
    assert one_kind.score(pa.array(["x"]))[0] > 0.9


def test_sample_bound_is_kept_and_model_repeats(spark, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    a = quality.train(documents, labels, sample_rows=30)
    b = quality.train(documents.repartition(5), labels, sample_rows=30)
    assert np.allclose(a.weights, b.weights, atol=1e-5)


def test_usual_sample_bound():
    """The bound was once lowered to save memory; the fit uses what fits on the driver."""
    assert quality.SAMPLE_ROWS == 6000


# Decontamination (8)


def test_scores_alone_and_words_met_before():
    """A score without its place is that of the alignment; remembered words are normalised as others are."""
    rng = random.Random(21)
    for _ in range(300):
        item, text = (np.array([rng.randrange(5) for _ in range(rng.randrange(n))], np.uint64) for n in (20, 40))
        assert decontaminate.best_score(item, text) == decontaminate.align(item, text)[0]
    words = ["".join(rng.choice("aZ0_-İΣß中²½́'") for _ in range(rng.randrange(100))) for _ in range(2_000)]
    want = [re.sub(r"[\W_]+", "", w.lower()).encode() for w in words]
    assert decontaminate._plain(pa.array(words)) == want == decontaminate._plain(pa.array(words))
    assert decontaminate._known_word.cache_info().hits > 0


def brute_align(item, text):
    best, table = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            diagonal = table[i][j] + (2 if a == b else -1)
            table[i + 1][j + 1] = max(0, diagonal, table[i][j + 1] - 1, table[i + 1][j] - 1)
            best = max(best, table[i + 1][j + 1])
    return best


def test_alignment_equals_the_plain_table():
    draw = np.random.default_rng(6)
    for _ in range(200):
        item, text = draw.integers(0, 5, draw.integers(1, 15)), draw.integers(0, 5, draw.integers(1, 40))
        score, first, end = decontaminate.align(item.astype(np.uint64), text.astype(np.uint64))
        assert score == brute_align(item, text)
        if score:
            assert brute_align(item, text[first:end]) == score


def plain(text):
    return [p for p in (re.sub(r"[\W_]+", "", w.lower()) for w in words(text)) if p]


def test_matches_equal_alignment_with_every_item(spark, documents):
    """Every document with every item, aligned in full: what reaches the threshold is found, nothing else."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    draw = random.Random(3)
    rows = [tuple(r) for r in documents.select("doc_id", "text").limit(25).collect()]
    rows = [(i, " ".join(t.split()[:150])) for i, t in rows]
    for i, text in items[:30]:
        w = [x if draw.random() > 0.12 else "edited" for x in text.split()]
        rows.append((1000 + i, f"Before, {' '.join(x for x in w if draw.random() > 0.04)} after."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.best_matches(decontaminate.contaminated(docs, bench)).collect()
    code = {}
    numbers = lambda ws: np.array([code.setdefault(w, len(code)) for w in ws], np.uint64)
    expected = {}
    for d, text in rows:
        for i, item in items:
            share = decontaminate.align(numbers(plain(item)), numbers(plain(text)))[0] / (2 * len(plain(item)))
            if share >= decontaminate.THRESHOLD:
                expected[d, i] = share
    got = {(r.id, r.item_id): r.score for r in found}
    assert set(got) ^ set(expected) == set()
    assert got == pytest.approx(expected)
    assert sum(d >= 1000 and d - 1000 == i for d, i in expected) >= 28


def test_contaminated_awkward_rows(spark, awkward, empty):
    text = awkward_rows()[3][1]
    items = [(1, " ".join(text.split()[5:40])), (1, " ".join(text.split()[5:40])), (2, None), (3, ""), (4, "one"), (5, "!!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(awkward, bench).collect()
    assert {(r.id, r.item_id) for r in found} == {(i, 1) for i in (4, 5, 6, 7, None)} | {(10, 4)}
    kept = decontaminate.drop_contaminated(awkward, bench)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 8, 9, 11, 12, 13, 14, None}
    assert decontaminate.drop_contaminated(empty, bench).count() == 0
    assert decontaminate.drop_contaminated(awkward, bench.limit(0)).count() == awkward.count()


def every_match(rows, items):
    """Share of every (document, item) that counts by the plain alignment of all pairs."""
    code, out = {}, {}
    numbers = lambda ws: np.array([code.setdefault(w, len(code)) for w in ws], np.uint64)
    for d, text in rows:
        for i, item in items:
            score, n = decontaminate.align(numbers(plain(item)), numbers(plain(text)))[0], len(plain(item))
            if score >= min(decontaminate.THRESHOLD * 2 * n, 2 * decontaminate.PASSAGE):
                out[d, i] = score / (2 * n)
    return out


def test_edited_copies_beside_exact_ones(spark):
    """Each item once as it is and once in every way of edits that leaves half of the best score."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").limit(12).collect()]
    edits = [
        lambda w: w,
        lambda w: [x if k % 4 < 3 else "edited" for k, x in enumerate(w)],
        lambda w: [x if k % 3 < 2 else "edited" for k, x in enumerate(w)],
        lambda w: [y for k, x in enumerate(w) for y in ((x, "new") if k % 3 == 2 else (x,))],
        lambda w: [y for x in w for y in (x, "new")],
        lambda w: [x for k, x in enumerate(w) if k % 4 < 3],
    ]
    rows = [(100 * k + i, " ".join(e(t.split()))) for k, e in enumerate(edits) for i, t in items]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.best_matches(decontaminate.contaminated(docs, bench)).collect()
    expected = every_match(rows, items)
    assert {(r.id, r.item_id): r.score for r in found} == pytest.approx(expected)
    for k in (0, 1, 3, 4, 5):
        assert all((100 * k + i, i) in expected for i, _ in items)


def test_excerpts_of_long_items(spark):
    """A passage of an item is found though it is less than half of it; one word less is not."""
    item = [f"w{k}" for k in range(300)]
    rows = [(n, " ".join(["lead", *item[50 : 50 + n], "tail"])) for n in (12, 13, 25, 140)]
    rows.append((1000, " ".join(x if k % 5 else "edited" for k, x in enumerate(item[:60]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, " ".join(item)), (2, " ".join(f"v{k}" for k in range(40)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.best_matches(decontaminate.contaminated(docs, bench)).collect()
    assert {(r.id, r.item_id): r.score for r in found} == pytest.approx(every_match(rows, items))
    assert {r.id for r in found} == {13, 25, 140, 1000}
    assert {(r.first_word, r.end_word) for r in found if r.id == 25} == {(1, 26)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [12]


def test_places_of_keys():
    """Where any key of an item begins in a text, by looking at every word and pair of it."""
    rng = random.Random(9)
    for n, m in [(1, 9), (2, 40), (9, 60), (30, 200), (3, 0), (5, 1)]:
        words = [np.array([rng.randrange(12) for _ in range(k)], np.uint64) for k in (n, m)]
        item, text = decontaminate.Item(words[0]), words[1].tolist()
        own = words[0].tolist()
        pairs = {(own[i], own[i + s]) for s in (1, 2) for i in range(n - s)}
        if n == 1:
            want = [i for i, w in enumerate(text) if w == own[0]]
        else:
            want = [i for i in range(m) if any(i + s < m and (text[i], text[i + s]) in pairs for s in (1, 2))]
        assert decontaminate.Places(words[1]).of(item.size, item.keys).tolist() == want


def test_bound_of_the_label_sample_with_repeated_ids(spark, monkeypatch):
    """An id with very many rows gives one of them to the fit; the same whatever the order."""
    rows = [(7, f"text {i} of the same id!") for i in range(500)] + [(i, f"good text of words {i}.") for i in range(10, 60)]
    docs = spark.createDataFrame([*rows, (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0), *((i, i % 2) for i in range(10, 60))], "doc_id long, quality int")
    seen = []
    fit = quality.fit_machine
    monkeypatch.setattr(quality, "fit_machine", lambda x, stats, label: seen.append(len(x)) or fit(x, stats, label))
    first = quality.train(docs, labels, sample_rows=30)
    again = quality.train(docs.repartition(7), labels, sample_rows=30)
    assert seen[0] == seen[1] <= 30
    texts = pa.array(["text 3 of the same id!", "good text of words 12.", ""])
    assert first.score(texts).tolist() == again.score(texts).tolist()


@pytest.mark.parametrize("crowd", [1, 6])
def test_crowded_anchors_lose_no_link(spark, monkeypatch, crowd):
    """Anchors split by pieces of the other half give the components of all pairs."""
    rng = random.Random(crowd)
    base = [rng.getrandbits(64) for _ in range(8)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1) for b in base for _ in range(40)}
    fps |= {(base[0] & 0xFFFFFFFF) | rng.getrandbits(32) << 32 for _ in range(150)}  # one half agrees, the other does not
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rows = spark.createDataFrame([(fp - 2**64 if fp >= 2**63 else fp,) for fp in fps], "fp long").repartition(4)
    links = [(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.fingerprint_links(rows).collect()]
    assert all((u ^ v).bit_count() <= 3 for u, v in links)

    def roots(pairs):
        root = {fp: fp for fp in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for u, v in pairs:
            a, b = sorted((find(u), find(v)))
            root[b] = a
        return {fp: find(fp) for fp in fps}

    assert roots(links) == roots([(u, v) for i, u in enumerate(fps) for v in fps[:i] if (u ^ v).bit_count() <= 3])
