"""Near-duplicates, decontamination, page text, quality, and the pipeline."""

import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import WORD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from slumberline.llm import decontaminate, html_text, near_dups, quality, queries

SF = "/root/testdata/sf0.001"


# --- near-duplicates -----------------------------------------------------------------------------------


def features(text, idf):
    words = WORD.findall(text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    raw = (text or "").encode()
    names, _, counts = near_dups.shingles(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    assert sorted(Counter(runs).values()) == sorted(counts.tolist())
    return dict(zip(names.tolist(), near_dups.weights_of(names, counts, idf).tolist()))


def expected_classes(docs, idf, least=0.8):
    """Least id per component over all pairs."""
    texts = sorted({t or "" for _, t in docs})
    known = [features(t, idf) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            shared = sum(min(w, known[j][n]) for n, w in known[i].items() if n in known[j])
            if shared and shared / (sum(known[i].values()) + sum(known[j].values()) - shared) >= least:
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for doc_id, text in docs:
        if WORD.search(text or "") and doc_id is not None:
            members[root(texts.index(text))].append(doc_id)
    found = {}
    for doc_id, text in docs:
        own = members[root(texts.index(text or ""))] if WORD.search(text or "") else [doc_id]
        found[(doc_id, text)] = min(own) if own else None
    return found


def groups(seed, sizes, edits):
    """Groups of near copies of random texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs = []
    for size in sizes:
        base = [word() for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = word()
            docs.append((len(docs) * 3 + 1, " ".join(copy)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed, sizes, edits", [(1, [1, 2, 3, 40, 7], 3), (2, [60, 25, 1, 1], 6)])
def test_classes_against_all_pairs(documents, seed, sizes, edits):
    docs = groups(seed, sizes, edits) + [(2, None), (5, ""), (8, "a b"), (11, "a b"), (14, "a c"), (None, "a b")]
    frame = documents(*docs)
    idf = near_dups.inverse_frequencies(frame)
    got = near_dups.classes(frame.withColumn("cid", F.lit("clash"))).collect()
    expected = expected_classes(docs, idf)
    texts = dict(docs)
    assert len(got) == len(docs)
    for row in got:
        assert row.class_id == expected[(row.doc_id, texts[row.doc_id])]
    kept = near_dups.keep_one(frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in expected.values()})
    assert kept.columns == frame.columns


def test_copies_rows_and_empty_tables(documents):
    text = " ".join(f"w{i}" for i in range(30))
    frame = documents((4, text), (4, text), (9, text), (None, text), (7, None), (7, None), (None, " "))
    kept = sorted((r.doc_id or -1, r.text or "") for r in near_dups.keep_one(frame).collect())
    assert kept == [(-1, " "), (4, text), (7, "")]
    assert near_dups.classes(frame.filter("false")).collect() == []
    assert near_dups.keep_one(frame.filter("false")).collect() == []


@pytest.mark.parametrize("parts, part_rows", [(64, 1024), (3, 4)])
def test_large_buckets_are_exact(documents, monkeypatch, parts, part_rows):
    """With one centre and no small buckets all links within a bucket hang on the second round; with small parts every
    bucket and central text is dealt over several."""
    monkeypatch.setattr(near_dups, "PARTS", parts)
    monkeypatch.setattr(near_dups, "PART_ROWS", part_rows)
    monkeypatch.setattr(near_dups, "SMALL", 1)
    monkeypatch.setattr(near_dups, "CENTRES", 1)
    docs = groups(3, [30, 20], 7)
    frame = documents(*docs)
    expected = expected_classes(docs, near_dups.inverse_frequencies(frame))
    texts = dict(docs)
    assert all(r.class_id == expected[(r.doc_id, texts[r.doc_id])] for r in near_dups.classes(frame).collect())


def test_rows_meet_what_their_key_has_whatever_the_parts(spark, monkeypatch):
    """A key with a third of the rows, keys without a partner, and null keys."""
    monkeypatch.setattr(near_dups, "PARTS", 5)
    rows = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id")
    found = spark.range(0, 300, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 7).alias("seven"))
    got = near_dups.dealt(rows, found, "k", "id").collect()
    keys = {i: 0 if i % 3 == 0 else i for i in range(300) if i % 3 < 2}
    assert sorted((r.id, r.k, r.seven) for r in got) == [(i, k, 7 * k) for i, k in keys.items() if k % 2 == 0]


def test_one_row_stays_of_a_class_without_ids_or_with_one(documents):
    base = [f"w{i}" for i in range(120)]
    copies = [" ".join(base[: 10 + 12 * k] + [f"edit{k}"] + base[11 + 12 * k :]) for k in range(4)]
    other = [" ".join(f"x{i}" for i in range(120)), " ".join(f"y{i}" for i in range(120))]
    frame = documents(*[(None, t) for t in [*copies, copies[0], *other]])
    kept = [r.text for r in near_dups.keep_one(frame).collect()]
    assert sorted(t in copies for t in kept) == [False, False, True] and set(other) < set(kept)
    again = documents(*[(7, t) for t in [*copies, *other]])
    assert Counter(r.text in copies for r in near_dups.keep_one(again).collect()) == {True: 1, False: 2}
    mixed = documents((None, copies[0]), (9, copies[1]), (9, copies[2]), (12, copies[3]), *[(20 + i, f"{i} {other[0][40 * i :]}") for i in range(5)])
    assert [r.doc_id for r in near_dups.keep_one(mixed).collect() if r.text in copies] == [9]


@pytest.mark.parametrize("others", [8, 16, 80])
def test_a_hot_group_is_as_similar_as_in_a_mixed_corpus(documents, others):
    """Half, a third and a tenth of the rows: each member has an own edit, and plain Jaccard 0.841 with the others."""
    base = [f"w{i}" for i in range(120)]
    members = [" ".join(base[: 10 + 12 * k] + [f"edit{k}"] + base[11 + 12 * k :]) for k in range(8)]
    rest = [" ".join(f"r{n}x{i}" for i in range(120)) for n in range(others)]
    frame = documents(*enumerate(members + rest))
    got = {r.doc_id: r.class_id for r in near_dups.classes(frame).collect()}
    assert got == {i: 0 if i < 8 else i for i in range(8 + others)}


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(5)
    names = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
    weights = rng.choice(np.array([1.5, 4, 4, 8], dtype=np.float32), 400)
    one, other = np.sort(np.arange(0, 320)), np.sort(np.arange(60, 400))
    order = lambda at: at[np.argsort(names[at])]
    one, other = order(one), order(other)
    exact = near_dups.similarity((names[one], weights[one]), (names[other], weights[other]))
    equal = total = 0
    for shift in range(40):
        moved = names * np.uint64(2 * shift + 1)
        keys = [
            near_dups.sample(moved[at], np.zeros(len(at), dtype=np.int64), weights[at], 1, near_dups.draws())
            for at in (one, other)
        ]
        equal += int((keys[0] == keys[1]).sum())
        total += near_dups.BANDS
    assert abs(equal / total - exact**near_dups.ROWS) < 0.05


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (11, 12), (20, 21), (21, 20)] + [(30, i) for i in range(31, 60)]
    chain = [(100 + i, 101 + i) for i in range(40)]
    key = lambda i: i.to_bytes(4, "big")
    links = spark.createDataFrame([(key(a), key(b)) for a, b in edges + chain], "a binary, b binary")
    number = lambda raw: int.from_bytes(raw, "big")
    classes = [set(range(1, 6)), {10, 11, 12}, {20, 21}, set(range(30, 60)), set(range(100, 141))]

    def check(labels, classes):
        members = defaultdict(set)
        for row in labels.collect():
            members[row.label].add(number(row.cid))
        assert sorted(map(sorted, members.values())) == sorted(map(sorted, classes))

    labels = near_dups.components(links)
    check(labels, classes)
    more = spark.createDataFrame([(key(12), key(200)), (key(4), key(31)), (key(300), key(301))], "a binary, b binary")
    joined = [classes[0] | classes[3], {10, 11, 12, 200}, {20, 21}, classes[4], {300, 301}]
    check(near_dups.merged(labels, more), joined)
    check(near_dups.components(links.filter("false")), [])


# --- decontamination -----------------------------------------------------------------------------------


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_whole_table_against_brute_force(spark):
    found = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, SF).collect()}
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    expected = set()
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = tokens(row.text)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item, own in items.items():
            covered = {i + k for i in range(len(own) - 4) if tuple(own[i : i + 5]) in runs for k in range(5)}
            if len(covered) >= 0.8 * len(own):
                expected.add((row.doc_id, item))
    assert found == expected and found


BENCHMARK = "item_id long, text string"


def test_reordered_changed_and_partial_passages(spark, documents):
    words = [f"word{i}" for i in range(40)]
    item = " ".join(words)
    reordered = " ".join(words[30:] + ["x"] + words[10:30] + ["y"] + words[:10])
    shouting = ", ".join(words).upper() + "!"
    part = " ".join(words[:28])
    scattered = " x ".join(" ".join(words[i : i + 4]) for i in range(0, 40, 4))
    docs = documents((1, f"pre {item} post"), (2, reordered), (3, shouting), (4, part), (5, scattered), (6, None), (7, ""))
    bench = spark.createDataFrame([(9, item), (10, "too short"), (11, None), (12, item)], BENCHMARK)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(i, n) for i in (1, 2, 3) for n in (9, 12)}
    assert [(t["doc_word"], t["item_word"], t["words"]) for t in got[(2, 9)].tiles] == [(0, 30, 10), (11, 10, 20), (32, 0, 10)]
    assert got[(2, 9)].coverage == 1.0
    kept = decontaminate.clean(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7] and kept.columns == docs.columns


def test_an_item_that_repeats_itself_needs_as_many_tiles(spark, documents):
    words = [f"w{i}" for i in range(6)]
    bench = spark.createDataFrame([(1, " ".join(words * 5))], BENCHMARK)
    docs = documents((1, " ".join(words)), (2, " ".join(words * 5)), (3, " x ".join([" ".join(words)] * 5)))
    assert sorted(r.doc_id for r in decontaminate.contaminated(docs, bench).collect()) == [2, 3]


def test_decontamination_edges(spark, documents):
    bench = spark.createDataFrame([(1, "a b c d e f")], BENCHMARK)
    docs = documents((None, "a b c d e f"), (None, "a b c d e f"), (3, "z " * 30000 + "A B, C d e f")).withColumn("seeds", F.lit(1))
    assert sorted(r.doc_id or 0 for r in decontaminate.contaminated(docs, bench).collect()) == [0, 0, 3]
    assert decontaminate.clean(docs, bench).collect() == []
    assert decontaminate.contaminated(docs.filter("false"), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.filter("false")).collect() == []
    assert decontaminate.clean(docs, bench.filter("false")).count() == 3


def test_clean_documents_stay_whatever_id_they_share(spark, documents):
    bench = spark.createDataFrame([(1, "a b c d e f")], BENCHMARK)
    held, fine = "x A b c d e f y", [f"clean text number {i}" for i in range(6)]
    docs = documents((None, held), (None, held), (5, held), *[(None, t) for t in fine], (5, fine[0]), (5, None), (None, None))
    kept = decontaminate.clean(docs, bench)
    expected = [(None, t) for t in fine] + [(5, fine[0]), (5, None), (None, None)]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(expected) and kept.columns == docs.columns


def greedy(item, doc, least):
    """String tiling by the definition: the longest free common run first."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_i[i + n] and free_d[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append(n)
        free_i[i : i + n] = [False] * n
        free_d[j : j + n] = [False] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), max_size=40))
def test_tiling_takes_the_longest_first(item, doc):
    made = decontaminate.tile(np.array(item, dtype=np.uint64), np.array(doc, dtype=np.uint64), 3)
    for at_doc, at_item, n in made:
        assert doc[at_doc : at_doc + n] == item[at_item : at_item + n]
    for side in (0, 1):
        spans = sorted((t[side], t[side] + t[2]) for t in made)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    expected = greedy(item, doc, 3)
    assert max((t[2] for t in made), default=0) == max(expected, default=0)
    assert not decontaminate.free_matches(
        np.array(item, dtype=np.uint64),
        np.array(doc, dtype=np.uint64),
        ~np.isin(np.arange(len(item)), [t[1] + k for t in made for k in range(t[2])]),
        ~np.isin(np.arange(len(doc)), [t[0] + k for t in made for k in range(t[2])]),
        3,
    )


@pytest.mark.parametrize("period", [1, 3, 10])
def test_tiling_repetitive_texts_takes_linear_time(period):
    def seconds(n):
        item, doc = (np.arange(size, dtype=np.uint64) % np.uint64(period) for size in (n, 4 * n))
        start = time.process_time()
        assert decontaminate.tile(item, doc) == [(0, 0, n)]
        return time.process_time() - start

    seconds(500)
    assert seconds(2000) < 1
    assert seconds(64000) < 64 * seconds(2000) + 2


# --- page text -----------------------------------------------------------------------------------------

LONG = "A sentence that is long enough to count as a part of the article, with commas and all."

PAGES = [
    (None, ""),
    ("", ""),
    ("just text &amp; more", "just text & more"),
    (f"<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>{LONG}<br>x</p></article><footer>f</footer>", f"T {LONG} x"),
    (
        f"<html><body><header><h1>Site</h1></header><div id=wrap><div class='side-bar sidebar'>{LONG}</div><div><p>{LONG}"
        f"<p>a <b>b</b>c&nbsp;d<p>{LONG}</div></div><div class='comments'><p>{LONG}</p></div></body></html>",
        f"{LONG} a bc d {LONG}",
    ),
    (f"<article><section><p>{LONG}</p><p>{LONG}</p></section><section><p>short</p></section></article>", f"{LONG} {LONG} short"),
    (f"<div><p>{LONG}</p><script>var a='<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<div><p>{LONG}</p><form><input><button>Send</button></form><aside>no</aside><p>{LONG}</p><p hidden>no</p></div>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p><div class=ad>Buy</div><div role=complementary>no</div><p>1 &lt; 2 &#233; &quot;q&quot; &am</p>", f'{LONG} 1 < 2 é "q" &am'),
    (f"<article><ul><li>one<li>two</ul><p>{LONG}</p><table><tr><td>a<td>b<tr><td>c</table></article>", f"one two {LONG} a b c"),
    (f"<article><p>{LONG}</p></article><!-- never closed <p>{LONG}</p>", LONG),
    (f"<article><p>{LONG}</p><script>never closed", LONG),
    (f"<article><p>{LONG}</p><p class='x", LONG),
    ("<script>var t='</p>'", ""),
    ("<nav><a href=/>only a menu</a></nav>", ""),
    (f"<div class='layout no-sidebar'><article><p>{LONG}</p></article></div>", LONG),
    (f"<article class='post share-on'><p>{LONG}</p></article>", LONG),
    (f"<div id=content class='menu-left'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<div><p>Press <button>Go</button>, <label>see</label>. {LONG}</p><button>Share</button></div>", f"Press Go, see. {LONG}"),
    (f"<article><p>{LONG}</p></article><section id=comments><article class=comment><p>{LONG} {LONG}</p></article></section>", LONG),
    (f"<div><p>{LONG}</p></div><div class=comments>{f'<p>{LONG}</p>' * 9}</div>", LONG),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_page(html, text):
    assert html_text.main_text(html) == text


def test_deep_and_long_pages():
    deep = "<div>" * 20000 + f"<p>{LONG}</p>"
    assert html_text.main_text(deep) == LONG
    long = "<article>" + f"<p>{LONG}</p>" * 20000 + "</article>"
    assert html_text.main_text(long) == " ".join([LONG] * 20000)


@pytest.mark.parametrize("tags", ["<div>", "<b>", "<p>", "<li><div>", "<table><tr><td>", "</p>", "<b></i>", "<body>", "<a '"])
def test_markup_is_read_in_linear_time(tags):
    import time

    def seconds(n):
        start = time.perf_counter()
        html_text.main_text(tags * n + "x")
        return time.perf_counter() - start

    seconds(500)
    assert seconds(32_000) < 10 * max(seconds(8_000), 0.05)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-&;ap \"'=divscript", max_size=80))
def test_any_markup_is_read(html):
    assert html_text.main_text(html) == " ".join(html_text.main_text(html).split())


def test_pages_of_a_whole_table(spark):
    import html as h

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.op9_html(spark, SF).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[row.page_id], re.S).group(1)
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert row.text == " ".join(p for p in parts if p)
        assert row.n_chars == len(row.text)


def without_furniture(page):
    """The text of a page without its menu, advert and footer, which these pages mark in one way each."""
    import html as h

    body = re.search(r"<body>(.*?)(</body>|$)", page, re.S).group(1)
    body = re.sub(r"<nav>.*?</nav>|<!--.*?-->|<div class=\"ad\">.*?</div>|<footer>.*?</footer>|<script>.*?</script>", "", body, flags=re.S)
    parts = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|div|article)>", body)]
    return " ".join(p for p in parts if p)


def test_density_finds_the_article_without_its_tag(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]
    assert len(pages) == 2500
    wrong = 0
    for page in pages:
        expected = without_furniture(page)
        assert html_text.main_text(page) == expected
        wrong += html_text.main_text(re.sub(r"(</?)article\b", r"\1div", page)) != expected
    # Where the advert is longer than the whole article.
    assert wrong <= 25


def test_page_edges(spark):
    rows = [(None, None, "<p>x</p>"), (1, "u", None), (1, "u", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(5))
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in html_text.extract(frame).collect())
    assert got == [(0, "x", 1), (1, "", 0), (1, "", 0)]
    assert html_text.extract(frame.filter("false")).collect() == []


# --- quality -------------------------------------------------------------------------------------------


def base_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


AWKWARD = ["", None, "\n\n", "a\na\n a\na", "é ü\né ü\n", "<|>#", "w " * 40000, "x y z\n" * 9, "one", "\n a b\n a b"]


def test_counts_against_brute_force(spark, documents):
    texts = AWKWARD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    frame = documents(*enumerate(texts))
    empty = spark.createDataFrame([], quality.MODEL_SCHEMA)
    for row in quality.assess(frame, empty, ["doc_id"]).collect():
        expected = base_counts(texts[row.doc_id])
        assert tuple(row[name] for name in quality.COUNTS) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert row.base_failed == failed and row.kept == (not failed)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    row = model.first()
    assert row.n_held_out >= 50 and row.accuracy >= 0.95
    scored = quality.assess(docs, model, ["doc_id"]).join(labels, "doc_id").filter("not base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in scored.groupBy("quality", "kept").count().collect()}
    assert counts[(1, True)] >= 0.99 * (counts[(1, True)] + counts.get((1, False), 0))
    assert counts[(0, False)] >= 0.9 * (counts[(0, False)] + counts.get((0, True), 0))
    # The same sample gives the same model, whatever the layout.
    assert quality.train(docs.repartition(5), labels.repartition(3)).first().weights == row.weights


def test_quality_edges(spark, documents):
    docs = documents((1, "w " * 30), (1, "w " * 30), (None, " ".join(f"w{i}" for i in range(30))), (2, None))
    docs = docs.withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame([(1, None), (None, 0), (2, 1), (2, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model.collect() == []
    got = quality.assess(docs, model)
    assert sorted((r.doc_id or 0, r.kept) for r in got.collect()) == [(0, True), (1, False), (1, False), (2, False)]
    assert quality.assess(docs.filter("false"), model).collect() == []
    assert quality.train(docs.filter("false"), labels.filter("false")).collect() == []


def test_few_labels_and_labels_of_absent_documents(spark, documents):
    good = [" ".join(f"fine{i % 7} prose{n}x{i}" for i in range(30)) for n in range(2)]
    bad = [" ".join(f"junk{i % 5} spam{n}x{i}" for i in range(30)) for n in range(2)]
    docs = documents(*enumerate(good + bad))
    rows = [(i, int(i < 2)) for i in range(4)]
    model = quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert model.first().n_held_out == 0
    assert {r.doc_id: r.kept for r in quality.assess(docs, model).collect()} == {0: True, 1: True, 2: False, 3: False}
    absent = [(100 + i, i % 2) for i in range(200)]
    model = quality.train(docs, spark.createDataFrame(rows + absent, "doc_id long, quality int"), per_class=2)
    assert model.first().n_train == 4


def made_sample(n, words):
    rng = random.Random(5)
    texts = [" ".join(f"{'fine' if i % 2 else 'junk'}{rng.randrange(3000)}" for _ in range(words)) for i in range(n)]
    return pa.table({"doc_id": list(range(n)), "text": texts, "quality": [i % 2 for i in range(n)]})


def test_the_fit_holds_one_slice_beside_the_entries(monkeypatch):
    """Slots of all texts, and arrays as long as all entries in every round, were 36 bytes for each byte of the texts."""
    monkeypatch.setattr(quality, "ROUNDS", 2)
    sample = made_sample(800, 1000)
    tracemalloc.start()
    list(quality.train_task(0.5)(sample.to_batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * sample.column("text").nbytes


def test_the_fit_does_not_hang_on_the_slices(monkeypatch):
    """Against the sums over all entries at once."""
    sample, cut = made_sample(40, 60), quality.tk.slices
    monkeypatch.setattr(quality, "ROUNDS", 20)
    whole = list(quality.train_task(0.5)(sample.to_batches()))[0].to_pydict()
    monkeypatch.setattr(quality.tk, "slices", lambda places: cut(places, 2000))
    parts = list(quality.train_task(0.5)(sample.to_batches()))[0].to_pydict()
    one, other = (np.frombuffer(r["weights"][0], dtype=np.float32) for r in (whole, parts))
    assert one.any() and np.allclose(one, other, rtol=1e-4, atol=1e-6)
    assert whole["accuracy"] == parts["accuracy"] and whole["n_train"] == parts["n_train"] == [32]


# --- pipeline ------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        seen[name] = docs
        assert docs.columns == columns + (["shard", "slot"] if name == "sharding" else [])
    count = {name: frame.count() for name, frame in seen.items()}
    assert count["quality"] > count["near_dups"] > 0
    assert count["near_dups"] >= count["decontamination"] > 0
    rejected = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").join(seen["quality"], "doc_id")
    assert rejected.count() <= 2
    assert decontaminate.contaminated(seen["decontamination"], spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert near_dups.keep_one(seen["near_dups"]).count() == count["near_dups"]
    sizes = [r["count"] for r in seen["sharding"].groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == count["mixing"]
    twice = seen["mixing"].groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert twice == 2
    assert corpus_pipeline.run(spark, SF).count() == count["sharding"]


def test_pipeline_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
