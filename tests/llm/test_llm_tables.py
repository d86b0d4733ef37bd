"""Operators on tables, pages and URLs, and the pipeline: brute force, twins, awkward rows."""

import random
import time
import zlib
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check_twins import difference, duck
from tagloom.llm import bpe, decontaminate, hash_tree, main_text, quality, repeats, rules, simhash, url_lists
from tagloom.llm.queries import QUERIES, SQL, VOCABULARY
from tagloom.session import cut_lineage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_twins(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["op4_hash_tree", "op6_host_rules", "op7_temporal_lists"])
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_every_operator_is_registered():
    found = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) <= set(found) and "pipeline" in found


# Main text (5)


@pytest.mark.parametrize("part", ["<div>word ", "<svg>x ", "<div><li>a</li></p>", "<p class=content>A line of text.<a href=x>b</a>"])
def test_pages_of_any_depth_take_linear_time(part):
    """A page four times as long takes about four times as long, not sixteen."""

    def seconds(n):
        start = time.process_time()
        main_text.extract(part * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(40_000) < 8 * seconds(10_000) + 0.5


# Shards (4)

DOCS = "doc_id long, text string, source string, id long, part int, row long, shard int, host string, n int"


def awkward(spark):
    rows = [(i, f"text {i % 7}" * (i % 5)) for i in range(300)] + [(5, "x"), (5, "x"), (None, "y"), (None, None), (7, None)]
    rows += [(1000, "Überß 中"), (1001, " \n ")] + [(42, "hot")] * 200
    return spark.createDataFrame([(i, t, "s", 1, 2, 3, 4, "h", 5) for i, t in rows], DOCS)


def test_shards_of_awkward_rows(spark):
    docs = awkward(spark)
    found = hash_tree.place(docs.repartition(5)).collect()
    rows = docs.select("doc_id", "text").collect()
    size = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == size
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert len({(r.shard, r.grown_shard) for r in found if r.doc_id == 42}) == 1
    assert hash_tree.place(docs.limit(0)).count() == 0


def test_weights_and_movement(spark):
    """Shares follow the weights; a heavier rack takes documents, no other subtree gives or takes among itself."""
    tree = hash_tree.topology()
    heavy = {k: list(v) for k, v in tree.items()}
    heavy["r1k0"] = [*heavy["r1k0"], ("16", 1.0)]
    heavy["r1"] = [("r1k0", 5.0), ("r1k1", 4.0)]
    heavy[""] = [("r0", 8.0), ("r1", 9.0)]
    ids = spark.range(40_000)
    placed = ids.select(
        hash_tree.shard_of(F.col("id"), tree).alias("a"),
        hash_tree.shard_of(F.col("id"), heavy).alias("b"),
        hash_tree.shard_of(F.col("id"), hash_tree.topology(added=1)).alias("c"),
    ).collect()
    share = Counter(r.a for r in placed)
    assert len(share) == 16 and all(abs(n - 2500) < 250 for n in share.values())
    assert all(r.c in (r.a, 16) for r in placed) and abs(Counter(r.c for r in placed)[16] - 40_000 / 17) < 250
    moved = [(r.a, r.b) for r in placed if r.a != r.b]
    assert all(b >= 8 for _, b in moved)  # into the region that grew
    assert all(b in (8, 9, 10, 11, 16) for a, b in moved if a >= 8)  # within it, into the rack that grew


# Pages (5)


def brute_cut(scores, ties):
    best = None
    for bits in range(1 << len(scores)):
        side = [bits >> i & 1 for i in range(len(scores))]
        cost = sum(max(s, 0) for s, x in zip(scores, side) if not x) + sum(max(-s, 0) for s, x in zip(scores, side) if x)
        cost += sum(c for a, b, c in ties if side[a] != side[b])
        key = (cost, sum(side))
        best = min(best, (key, side)) if best else (key, side)
    return [bool(x) for x in best[1]]


def test_minimum_cut_equals_all_labellings():
    draw = random.Random(9)
    for _ in range(300):
        n = draw.randrange(1, 9)
        scores = [draw.randrange(-9, 10) for _ in range(n)]
        ties = [(i, i + 1, draw.randrange(5)) for i in range(n - 1)]
        ties += [(a, b, draw.randrange(4)) for a in range(n) for b in range(a + 2, n) if draw.random() < 0.3]
        assert main_text.content_side(scores, ties) == brute_cut(scores, ties)


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>"</script></head><body class="has-sidebar">
<div id="header"><a href="/">Site</a></div><nav><ul><li><a>Home</a><li><a>News</a></ul></nav>
<div class="cookie-notice">We use cookies, please accept them now.</div>
<div class="content"><h1>A  headline</h1><p>The first paragraph, with <b>bold<br>and</b> &amp; a <a href="x">link</a>, is long enough.
<!-- <p>not this</p> --><p>Short one.</p><div class="ad">Buy this today, it is cheap.</div><blockquote>Quoted words.</blockquote>
<form><label>Name</label><input value="x"><button>Send</button></form></div>
<aside><p>Related stories you may like to read as well.</p></aside>
<section class="comments"><p>Great article, I liked it and want to say thanks to all.</p></section>
<footer>&copy; 2020 somebody. All rights reserved.</footer></body></html>"""


def test_page_parts():
    expected = "A headline\n\nThe first paragraph, with bold and & a link, is long enough.\n\nShort one.\n\nQuoted words."
    assert main_text.extract(PAGE) == expected


def test_given_pages(spark):
    """All pages: what stands in the article, and nothing else."""
    import re
    from html import unescape

    for row in QUERIES["op5_min_cut"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/pages.parquet"), ["page_id", "url"]).collect():
        inner = re.split(r"</?article>", row.html)[1]
        parts = [unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split() for p in re.split(r"</?(?:p|h1)>", inner)]
        assert row.text == "\n\n".join(" ".join(p) for p in parts if p) and row.n_chars == len(row.text)


def test_awkward_pages(spark):
    deep = "<div>" * 3000 + "<p>deep words here.</p>"
    wide = "<article>" + "<p>some text here.</p>" * 3000 + "</article>" + "<nav>" + "<p><a>link</a></p>" * 3000
    rows = [None, "", "<", "<p", "<!--", "<script>x", "<p>one</p>", "<p>one</p>", deep, wide, "plain words, no tags at all.", '<p a="x>y</p>']
    pages = spark.createDataFrame([(i, "u", h, "t") for i, h in enumerate(rows)], "page_id long, url string, html string, text string")
    found = {r.page_id: r.text_ for r in main_text.with_main_text(pages).collect()}
    assert len(found) == len(rows) and all(t is not None for t in found.values())
    assert [found[i] for i in (0, 1, 2, 4, 5)] == [""] * 5 and found[6] == found[7]
    assert found[9].count("some text here.") == 3000 and "link" not in found[9]
    assert found[10] == rows[10] and main_text.with_main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", "noscript object video audio select canvas svg template".split())
def test_unclosed_elements_do_not_take_the_rest(name):
    start, rest = "<article><p>The first paragraph is here.</p>", "<p>The second paragraph is here.</p></article>"
    both = "The first paragraph is here.\n\nThe second paragraph is here."
    assert main_text.extract(f"{start}<{name}>{rest}") == both
    assert main_text.extract(f"{start}<{name}>left out</{name}>{rest}") == both
    assert main_text.extract(f"{start}<script>{rest}") == "The first paragraph is here."


def test_quotes_open_values_behind_the_sign_alone():
    page = "<article><p title=it's>One paragraph is here.</p><p>Two paragraphs are here.</p><p>It's the third one.</p></article>"
    whole = "One paragraph is here.\n\nTwo paragraphs are here.\n\nIt's the third one."
    assert main_text.extract(page) == whole
    assert main_text.extract(page.replace("title=it's", "title = 'a > b' lang=x'y")) == whole
    assert main_text.extract(page.replace("title=it's", "title=a=\"b")) == whole


def test_formulas_are_text():
    page = "<article><p>The law <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds for all of them.</p></article>"
    assert main_text.extract(page) == "The law E=m holds for all of them."


# Rules (6)


def test_rules_of_awkward_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    junk = "a b c " * 40
    rows = [(1, text, "good"), (2, junk, "good"), (3, None, None), (4, "", None), (5, "#* " + text, "good"), (1, text, "good"), (None, text, None)]
    rows += [(100 + i, junk, "bad") for i in range(40)] + [(200, text, "bad"), (6, f"{text}\n{text}\n \n{text}", "good")]
    docs = spark.createDataFrame([(i, t, s, 1, "z") for i, t, s in rows], "doc_id long, text string, source string, n int, host string")
    found = rules.with_verdicts(rules.measures(docs)).collect()
    by = {r.id: r for r in found}
    assert len(found) == len(rows)
    assert (by[1].n_words, by[1].n_repeat_words, by[1].n_symbols, by[1].kept) == (60, 0, 0, True)
    assert (by[2].n_repeat_words, by[2].base_failed, by[2].kept) == (120, True, False)
    assert (by[3].n_words, by[3].word_chars, by[3].base_failed) == (0, 0, True) and by[4].kept is False
    assert (by[5].n_symbols, by[5].n_words) == (2, 61)
    assert (by[6].n_dup_lines, by[6].n_repeat_words) == (2, 180)
    assert not by[200].base_failed and not by[200].kept  # its host fails nearly always
    assert by[None].n_words == 60
    assert rules.with_verdicts(rules.measures(docs.limit(0))).count() == 0


def test_repeated_windows_of_long_texts(spark):
    draw = random.Random(4)
    texts = [" ".join(str(draw.randrange(k)) for _ in range(n)) for k, n in ((3, 2000), (40, 30_000), (5, 3), (2, 2), (9, 1))]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for row in rules.measures(docs).collect():
        w = texts[row.id].split()
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        inside = {p + k for p in range(len(w) - 2) if seen[tuple(w[p : p + 3])] > 1 for k in range(3)}
        assert row.n_repeat_words == len(inside)


def test_windows_with_like_hash_bits_do_not_repeat(spark):
    """The first 43 bits of the two windows' hashes are equal: what was left beside a place in a text of this length."""
    text = "a b x1335794 " + " ".join(map(str, range(1 << 20))) + " a b x2411739"
    docs = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    assert rules.measures(docs).first().n_repeat_words == 0


def test_small_hosts_are_shrunk_to_the_mean(spark):
    """A thousand hosts of one document tell nothing apart but by chance: none is rejected for one failure."""
    names = ["id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]
    rows = [(i, f"h{i}", 10 if i % 3 == 0 else 100, 400, 0, 0, 1, 0) for i in range(1_000)]
    measured = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == 'host' else 'long'}" for n in names))
    judged = rules.with_verdicts(measured)
    assert judged.where("NOT base_failed AND NOT kept").count() == 0
    low, high = judged.agg(F.min("host_rate"), F.max("host_rate")).first()
    assert high - low < 0.01
    # Hosts that differ by far more than chance keep their rates.
    rows += [(i, f"b{i // 10 % 5}", 10 if i % 10 else 100, 400, 0, 0, 1, 0) for i in range(1_000, 2_000)]
    rows += [(i, f"g{i % 5}", 100, 400, 0, 0, 1, 0) for i in range(2_000, 3_000)]
    big = [r for r in rows if r[1][0] in "bg"]
    judged = rules.with_verdicts(spark.createDataFrame(big, measured.schema))
    assert judged.where("host LIKE 'b%' AND NOT base_failed AND kept").count() == 0
    assert judged.where("host LIKE 'g%' AND NOT kept").count() == 0


# URL lists (7)


def test_keys_of_urls(spark):
    urls = ["https://User@A.b.Example.com:80/x/y?q#f", "http://example.com", "nothing", None, "//host/p", ""]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(url_lists.keys_of(F.col("u"))).collect()
    assert [r[0] for r in rows] == [
        ["a.b.example.com/x", "a.b.example.com/x/y", "a.b.example.com", "b.example.com", "example.com"],
        ["example.com"], None, None, ["host/p", "host"], None,
    ]


def test_lists_as_of_fetch_time(spark):
    draw = random.Random(11)
    keys = ["a.com", "x.a.com", "x.a.com/p", "b.org", "B.org", "X.a.com/P", "x.A.com/P/Q"]
    day = lambda n: date.fromordinal(738_000 + n)
    log = [(draw.choice("LM"), draw.choice(keys), day(draw.randrange(200)), draw.random() < 0.6) for _ in range(90)]
    log += [("L", "b.org", date(1, 1, 1), True), ("M", "X.a.com/P", date(9999, 1, 1), True)]
    log += [log[0], (None, "a.com", day(1), True), ("L", None, day(1), True), ("L", "a.com", None, True), ("L", "a.com", day(3), None)]
    urls = ["http://x.a.com/p/q", "http://a.com/", "http://b.org/z", "http://c.net/", None, "junk", "http://x.A.com/P/Q/r", "//x.a.com/P/q"]
    rows = [(i, draw.choice(urls), datetime.combine(day(draw.randrange(-5, 230)), datetime.min.time()), "k") for i in range(300)]
    rows += [(900, urls[0], None, "k"), (901, urls[0], rows[0][2], "k"), (901, urls[0], rows[0][2], "k")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched timestamp, key string")
    entries = spark.createDataFrame(log, "list string, key string, day date, listed boolean")
    found = url_lists.judge(captures, entries)
    assert found.columns == [*captures.columns, "lists", "blocked"]

    def active(name, key, on):
        def same(k):
            host, slash, path = (k or "").partition("/")
            return host.lower() + slash + path == key

        past = [(d, listed) for n, k, d, listed in log if n == name and same(k) and d and listed is not None and d <= on]
        last = max((d for d, _ in past), default=None)
        return bool(past) and all(listed for d, listed in past if d == last)

    for r in found.collect():
        own = {None: [], "junk": [], urls[0]: keys[:3], urls[1]: keys[:1], urls[2]: ["b.org"], urls[3]: []}
        own |= {urls[6]: [*keys[:2], "x.a.com/P", "x.a.com/P/Q"], urls[7]: [*keys[:2], "x.a.com/P"]}
        own = own[r.url]
        lists = sorted({n for n in "LM" for k in own if r.fetched and active(n, k, r.fetched.date())})
        assert (r.lists, r.blocked) == (lists, bool(lists)), r
    assert found.count() == len(rows)
    assert url_lists.judge(captures.limit(0), entries).count() == 0
    assert url_lists.judge(captures, entries.limit(0)).where("blocked").count() == 0


# Pipeline


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, held against its operator worked out plainly."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = cut_lineage(stage(spark, docs, SF_DIR))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count() > 0
        if i < 4:
            assert docs.columns == columns
        if i == 0:
            frame = spark.createDataFrame(list(before.values()), "doc_id long, text string, lang string, source string, n_chars long")
            machine = quality.train(frame, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            scores = frame.select("doc_id", quality.score(machine, F.col("text")).alias("s")).collect()
            assert set(after) == {r.doc_id for r in scores if r.s >= quality.THRESHOLD}
        if i == 1:
            found = simhash.near_duplicates(spark.createDataFrame(list(before.values()))).collect()
            assert set(after) == {r.component_id for r in found}
        if i == 2:
            shingles = Counter()
            for d in sorted(after):
                w = after[d].text.split()
                own = {tuple(w[k : k + repeats.WINDOW]) for k in range(len(w) - repeats.WINDOW + 1)}
                shingles.update(own)
                assert after[d].n_chars == len(after[d].text)
            assert set(after) == set(before)
        if i == 3:
            items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            gone = [before[d].text for d in set(before) - set(after)]
            flat = lambda t: " ".join(t.lower().split())
            assert all(not any(flat(x) in flat(after[d].text) for x in items) for d in after) and gone
        if i == 4:
            encoded = bpe.encode_decode(docs, bpe.read_vocabulary(VOCABULARY)).collect()
            assert {r.doc_id: r.ids for r in encoded} == {d: after[d].ids for d in after}
            assert all(after[d].decoded == after[d].text for d in after)
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(after)
    assert decontaminate.THRESHOLD == 0.5


def test_pipeline_of_awkward_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "word " * 3000)]
    docs = spark.createDataFrame([(i, t, None, None, None, "e") for i, t in rows], schema)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = cut_lineage(stage(spark, frame, SF_DIR))
        assert "extra" in frame.columns and "ids" in frame.columns
