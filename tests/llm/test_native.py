"""Sanitising, mixing, chat formatting and sharding."""

import hashlib
import math
import os
import re
from collections import Counter

import duckdb
import pytest
from brute import entity_spans
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slumberline.llm import chat, mixing, pii, queries, sharding
from slumberline.llm.arithmetic import mixed32, mixed32_py

SF = "/root/testdata/sf0.001"


def oracle(name, sf_dir=SF):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    result = connection.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    return sorted((dict(zip(columns, row)) for row in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, name, sf_dir):
    got = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(r[c] for c in columns) for r in oracle(name, sf_dir)), key=repr)


# --- personal data -------------------------------------------------------------------------------------

TEXTS = [
    None,
    "",
    "a@b.c",
    "a@b",
    "x a.b+c%d_e-f@mail-1.example.com. next@one.org,two@three.net",
    "a@b.cd_e@f.gh a@b.c@d.e ..q@r.s..t@u.v w@.x y@z..a b@c.d.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 1.2.3 0255.1.1.001 9.9.9.999.1.1.1.1 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 378282246310005",
    "0000000000000 00000000000000000000 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 x4111111111111111y",
    "+1 (386) 555-3733 +12 +49 30 1234567 ext. +1-2-3 ++1 234 567 890 +1234567890123456",
    "é +1 (386) 555-3733 ü x@y.zz ñ 1.1.1.1 \U0001f600 4111111111111111",
    "mark \u0001 4111\u00011111 a@b\u0001c.d \u0002 1\u00012.3.4.5",
    "1" * 30000 + " " + "a" * 30000 + "@ " + "b." * 20000 + " " + "1 " * 9000 + "+" * 5000,
    "a@" + "b." * 20000 + "c " + "1." * 9999 + "2",
]


def spans_of(row):
    return [(s["kind"], s["start"], s["end"]) for s in row.base]


def test_entities_equal_the_patterns(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for row in pii.find(documents(*rows)).collect():
        text = TEXTS[row.doc_id] or ""
        assert spans_of(row) == entity_spans(text), row.doc_id
        assert all(s["value"] == text[s["start"] : s["end"]] for s in row.base)


def test_entities_of_a_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in queries.op1_pii(spark, SF).collect():
        spans = entity_spans(docs[row.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.spans == listed or row.spans.startswith(listed)
        kinds = Counter(k for k, _, _ in spans)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds[k] for k in pii.KINDS]


@settings(max_examples=15, deadline=None)
@given(text=st.text(alphabet="a1.@+- (é", max_size=60))
def test_entities_of_any_text(spark, text):
    frame = spark.range(1).select(pii.entities(F.lit(text)).alias("base"))
    assert spans_of(frame.first()) == entity_spans(text)


def test_terms_that_go_with_an_entity(documents):
    """``Zorblatt`` stands next to one address only, in different texts; the other words are everywhere."""
    rows = [(i, f"common words here number {i}") for i in range(40)]
    rows += [(100 + i, f"common Zorblatt words zorblatt@x.org here variant {'abcdefgh'[i] * 3}") for i in range(4)]
    found = {r.doc_id: r for r in pii.find(documents(*rows)).collect()}
    assert [(s["kind"], s["value"]) for s in found[101].added] == [("removed", "Zorblatt"), ("removed", "variant")]
    assert found[101].sanitised == "common  words [EMAIL] here  bbb"
    assert found[3].added == [] and found[3].sanitised is None
    # Without evidence from different texts nothing is added.
    copies = [(i, "common Zorblatt words zorblatt@x.org") for i in range(9)]
    assert all(r.added == [] for r in pii.find(documents(*copies, *rows[:40])).collect())


def test_terms_that_go_with_a_class_of_entities(documents):
    """No address, number or card is in two texts, but their domain, network, area and issuer are."""
    rows = [(i, f"common words and number {i}") for i in range(400)]
    values = {
        "Zorblatt": lambda i: f"user{i}@zorb.org",
        "Quuxnet": lambda i: f"10.20.{i}.7",
        "Xyzzytown": lambda i: f"+49 893 555-{1000 + i}",
    }
    for k, (term, value) in enumerate(values.items()):
        rows += [(1000 * k + 1000 + i, f"common {term} words {value(i)} {'abcdefgh'[i] * 3}{k}") for i in range(8)]
    rows += [(5000 + i, f"common words other{i}@place{i}.net and 30.{i}.1.1 and +33 1{i}2 345 6789") for i in range(20)]
    # Two texts with a term are too few, whatever the share.
    rows += [(6000 + i, f"common Rarity words last{i}@few.org {'ab'[i] * 3}") for i in range(2)]
    found = {r.doc_id: r for r in pii.find(documents(*rows)).collect()}
    for k, term in enumerate(values):
        for i in range(8):
            assert [(s["kind"], s["value"]) for s in found[1000 * k + 1000 + i].added] == [("removed", term)]
    assert all(r.added == [] for i, r in found.items() if i < 1000 or i >= 5000)


def plain_shares(docs, generalise=pii.GENERALISE, support=pii.SUPPORT):
    """The largest share of each revealing term, by counting over plain Python sets."""
    texts = Counter(docs)
    n = len(docs)

    def names(text):
        found = set()
        for kind, start, end in entity_spans(text):
            value = text[start:end]
            digits = re.sub("[^0-9]", "", value)
            found |= {f"{kind}:{value}", f"{kind}/kind:"}
            levels = {
                "email": [("domain", value.rsplit("@", 1)[-1].lower())],
                "ip": [("24", ".".join(value.split(".")[:3])), ("16", ".".join(value.split(".")[:2]))],
                "card": [("issuer", digits[:6])],
                "phone": [("line", digits[:-4]), ("area", digits[:-7])],
            }
            found |= {f"{kind}/{level}:{part}" for level, part in levels[kind]}
        return found

    def terms(text):
        for kind, start, end in entity_spans(text):
            if kind == "email":
                text = text[:start] + " " * (end - start) + text[end:]
        return {t for t in re.findall(r"[^\W\d_]{3,}", text.lower())}

    held, n_entity, n_term, both = Counter(), Counter(), Counter(), {}
    for text, times in texts.items():
        entities, words = names(text), terms(text)
        for word in {t for t in re.findall(r"[^\W\d_]{3,}", text.lower())}:
            n_term[word] += times
        for entity in entities:
            held[entity] += 1
            n_entity[entity] += times
            for word in words:
                pair = both.setdefault((entity, word), [0, 0])
                pair[0] += times
                pair[1] += 1
    shares = {}
    for (entity, word), (times, units) in both.items():
        if units < support or held[entity] < support or n_entity[entity] == n:
            continue
        share = math.log(times * n / (n_entity[entity] * n_term[word])) / math.log(n / n_entity[entity])
        chance = n_entity[entity] * n_term[word] / n
        surprise = units * math.log(units / chance) - (units - chance)
        exact = not re.match("[a-z]+/", entity)
        if share >= generalise and (exact or units > chance and surprise >= -math.log(pii.CHANCE)):
            shares[word] = max(share, shares.get(word, 0))
    return shares


def test_terms_of_a_given_table(spark):
    """Against counts in plain Python. On this table a word goes with a kind of entity; it is found in all documents."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    shares = plain_shares(list(docs.values()))
    assert shares
    expected = []
    for doc_id, text in docs.items():
        emails = [(a, b) for kind, a, b in entity_spans(text) if kind == "email"]
        for match in re.finditer(r"[^\W\d_]+", text):
            if match.group().lower() in shares and not any(a < match.end() and match.start() < b for a, b in emails):
                kind = "removed" if shares[match.group().lower()] >= pii.REMOVE else "term"
                expected.append((doc_id, kind, match.start(), match.end()))
    found = pii.find(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    added = [(r.doc_id, s["kind"], s["start"], s["end"]) for r in found.filter(F.size("added") > 0).collect() for s in r.added]
    assert sorted(added) == sorted(expected)
    without = {doc_id for doc_id, *_ in added if not entity_spans(docs[doc_id])}
    assert without


@pytest.mark.parametrize("few", [0, 50_000])
def test_generalised_terms(documents, monkeypatch, few):
    """A term gives its entity away in documents that do not name it as well."""
    monkeypatch.setattr(pii, "BROADCAST_ROWS", few)
    rows = [(i, f"common words number {i}") for i in range(200)]
    rows += [(300 + i, f"Zorblatt a@x.org {'abcdefgh'[i] * 3}") for i in range(4)]
    rows += [(400, "zorblatt elsewhere"), (401, "again: ZORBLATT, zorblatts"), (None, "zorblatt"), (None, "nothing")]
    found = {r.doc_id: r for r in pii.find(documents(*rows)).collect()}
    assert found[300].sanitised == "[8 letters] [EMAIL] aaa"
    assert found[400].base == [] and found[400].sanitised == "[8 letters] elsewhere"
    assert found[401].sanitised == "again: [8 letters], zorblatts" and found[3].sanitised is None
    assert len(found) == 207
    assert sorted(r.sanitised or "" for r in pii.find(documents(*rows)).filter("doc_id IS NULL").collect()) == ["", "[8 letters]"]


def test_spans_that_overlap_are_replaced_together(spark):
    text = "ab +1 234 567 8901 2345 6789 cd x@1.2.3.4 ef" + "é" * 9000 + " 8.8.8.8 " + "ü" * 5000
    frame = spark.range(1).select(F.lit(text).alias("text"), pii.entities(F.lit(text)).alias("spans"))
    row = frame.select("spans", pii.sanitised(F.col("text"), F.col("spans")).alias("made")).first()
    spans = sorted((s["start"], -s["end"], s["kind"]) for s in row.spans)
    made, upto = [], 0
    while spans:
        start, less, kind = spans.pop(0)
        end = -less
        while spans and spans[0][0] < end:
            end = max(end, -spans.pop(0)[1])
        made += [text[upto:start], f"[{kind.upper()}]"]
        upto = end
    assert row.made == "".join(made) + text[upto:]


def test_long_texts_take_time_in_proportion(spark, documents):
    import time

    def seconds(n):
        docs = documents((1, "word 10.1.2.3 x@y.org " * n)).select("text").coalesce(1)
        start = time.perf_counter()
        spans = docs.select("text", pii.entities(F.col("text")).alias("spans"))
        made = spans.select(F.size("spans"), F.length(pii.sanitised(F.col("text"), F.col("spans")))).first()
        assert tuple(made) == (2 * n, n * len("word [IP] [EMAIL] "))
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 8 * max(seconds(10_000), 0.3)


def test_pii_edges(documents):
    assert pii.find(documents((1, "x")).filter("false")).collect() == []
    rows = pii.find(documents((None, "a@b.c"), (None, "a@b.c"), (1, None)).withColumn("spans", F.lit(3))).collect()
    assert sorted(len(r.base) for r in rows) == [0, 1, 1]


# --- mixing --------------------------------------------------------------------------------------------


def water_filling(sizes, weights, share, repeats):
    """The targets in rounds: cap who is above, share what is left by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, target, open_names = share * sum(sizes.values()), {}, set(names)
    while open_names:
        level = budget / sum(weight[s] for s in open_names)
        above = {s for s in open_names if level * weight[s] >= repeats * sizes[s]}
        if not above:
            target.update({s: level * weight[s] for s in open_names})
            break
        for s in above:
            target[s] = float(repeats * sizes[s])
            budget -= target[s]
        open_names -= above
    return target


def test_targets_and_what_is_taken(documents):
    rows = [(i, "w " * (i % 7 + 1), None if i % 5 == 0 else f"s{i * i % 11}") for i in range(600)]
    got = mixing.mix(documents(*rows)).collect()
    sizes = Counter()
    for r in got:
        sizes[r.source] += r.size
    target = water_filling(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.REPEATS)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 7 for s in sizes)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mixing_repeats_whatever_the_layout(documents):
    rows = [(i, "w " * (i % 5), f"s{i % 3}") for i in range(200)]
    runs = [
        sorted((r.doc_id, r.taken) for r in mixing.mix(documents(*rows, partitions=n)).collect()) for n in (1, 7)
    ]
    assert runs[0] == runs[1]


def test_a_larger_share_only_adds(documents):
    docs = documents(*[(i, "w " * (i % 9 + 1), "s") for i in range(300)])
    small = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.4).collect()}
    large = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.7).collect()}
    assert all(large[i] >= n for i, n in small.items())
    total = sum(i % 9 + 1 for i in range(300))
    assert abs(sum(small.values()) - 0.4 * total) <= 9


def test_mixing_edges(documents):
    assert mixing.mix(documents((1, "a", "s")).filter("false")).collect() == []
    rows = [(1, None, "a"), (2, "", None), (None, "x y", "a"), (None, "x y", "a"), (3, "long " * 50000, "b")]
    got = mixing.mix(documents(*rows).withColumn("size", F.lit("clash"))).collect()
    assert sorted((r.source or "", r.size) for r in got) == [("", 0), ("a", 0), ("a", 2), ("a", 2), ("b", 50000)]
    same = {r.taken for r in got if r.doc_id is None}
    assert len(same) == 1
    only_empty = mixing.mix(documents((1, None, None), (2, "", "x"))).collect()
    assert [(r.size, r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 2


# --- chat ----------------------------------------------------------------------------------------------

LOG = "conv_id long, msg long, seq long, kind string, role string, text string"


def turns(frame):
    read = frame.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"))
    return {r.conv_id: [(t["role"], t["text"]) for t in r.turns] for r in read.collect()}


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 1, 1, "message", "user", "Hello"),
        (1, 2, 2, "message", "assistant", None),
        (1, 2, 4, "delta", None, "wor"),
        (1, 2, 3, "delta", None, "Hi "),
        (1, 2, 5, "delta", None, "ld"),
        (1, 3, 6, "message", "user", "Again, please"),
        (1, 4, 7, "message", "assistant", "lost"),
        (1, 2, 8, "regenerate", None, None),
        (1, 2, 9, "delta", None, "New "),
        (1, 2, 10, "delta", None, "answer"),
        (1, 1, 11, "edit", None, "Hello there"),
        (1, 1, 12, "delta", None, "!"),
        (1, 5, 13, "message", "user", "Bye"),
        (2, 9, 1, "delta", None, "never opened"),
        (2, 1, 2, "message", "assistant", "x"),
        (2, 1, 3, "unknown", None, "y"),
        (None, 1, None, "message", None, None),
        (3, 7, 1, "delta", None, "only a delta"),
    ]
    frame = spark.createDataFrame(log, LOG).repartition(4)
    assert turns(chat.format_log(frame)) == {
        1: [("user", "Hello there!"), ("assistant", "New answer"), ("user", "Bye")],
        2: [("assistant", "x")],
        None: [("", "")],
    }


def test_round_trip_of_any_text(spark):
    texts = ["</turn>\n", "<turn:user>", "&lt;", "&amp;lt;", "a<b>c&d", "", "\\", "\n\n", "é\U0001f600", "x" * 100_000]
    rows = [(i, t, role, text) for i, role in enumerate(("user", "assistant", "a>b\n")) for t, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_log(chat.rows_as_events(frame))
    assert turns(formatted) == {i: [(role, t) for t in texts] for i, role in enumerate(("user", "assistant", "a>b\n"))}
    loss = formatted.select("conv_id", chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    assert {r.conv_id: r.loss for r in loss.collect()} == {0: "", 1: "".join(texts), 2: ""}


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 0, "assistant", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("q"))
    got = turns(chat.format_log(chat.rows_as_events(frame)))
    assert got == {1: [("", "first"), ("user", ""), ("user", "")], None: [("assistant", "x")]}
    assert chat.format_log(chat.rows_as_events(frame.filter("false"))).collect() == []


# --- sharding ------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 30))
def test_places_are_a_permutation(n, seed):
    some = range(0, n, max(n // 50, 1))
    places = [sharding.place_of(i, n, seed) for i in some]
    assert len(set(places)) == len(places) and all(0 <= p < n for p in places)
    assert [sharding.number_at(p, n, seed) for p in places] == list(some)


def test_whole_permutation():
    for n in (1, 2, 3, 24, 997, 1000):
        assert sorted(sharding.place_of(i, n) for i in range(n)) == list(range(n))


def test_grid_leaves_few_places_over():
    for n in (1, 2, 7, 997, 51282, 256410, 10**9 + 7):
        a, b = sharding.grid(n)
        assert 0 <= a * b - n < a


def test_columns_equal_the_formula(spark):
    for n in (1, 5, 997, 4096):
        rows = sharding.permuted(spark.range(n).select(F.col("id").alias("at"), "id"), "at", n).collect()
        assert {r.id: r["at"] for r in rows} == {i: sharding.place_of(i, n) for i in range(n)}
    hashes = spark.createDataFrame([(0,), (-1,), (1 << 62,), (12345,)], "v long").select("v", mixed32(F.col("v"), 77).alias("h"))
    assert all(r.h == mixed32_py(r.v, 77) for r in hashes.collect())


def test_shards_are_even_gapless_and_repeat(documents):
    rows = [(i // 2 if i % 3 else i, f"t{i % 5}") for i in range(1000)] + [(None, None)] * 30
    runs = []
    for n in (1, 6):
        got = sharding.shard(documents(*rows, partitions=n), 7, ties=("text",)).collect()
        runs.append(sorted((r.shard, r.slot, repr((r.doc_id, r.text))) for r in got))
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert {len(s) for s in slots.values()} <= {147, 148}
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert runs[0] == runs[1]


def test_sharding_edges(documents):
    assert sharding.shard(documents((1, "x")).filter("false")).collect() == []
    one = sharding.shard(documents((1, None)).withColumns({"shard": F.lit("x"), "slot": F.lit("y")})).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def test_buckets_are_put_one_after_another(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 16)
    numbered, n = sharding.numbered(documents(*[(i, "x") for i in range(300)]), "doc_id", (), "number")
    assert n == 300 and sorted(r.number for r in numbered.collect()) == list(range(300))


@pytest.mark.parametrize("kind", ["long", "double", "string"])
def test_ranges_of_the_key_change_no_number(documents, monkeypatch, kind):
    """A task numbers whole rows, texts among them: those of one range of a bucket, not of the bucket."""
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 200)
    rows = documents(*[(None if i % 10 == 0 else i // 2, f"t{i % 7}") for i in range(1000)])
    rows = rows.withColumn("doc_id", F.col("doc_id").cast(kind))
    if kind == "double":
        rows = rows.withColumn("doc_id", F.when(F.col("doc_id") % 9 == 0, float("nan")).otherwise(-F.col("doc_id")))
    n, cuts = sharding.counted(rows, "doc_id")
    assert n == 1000 and len(cuts) == (0 if kind == "string" else sharding.RANGES - 1)
    if kind == "long":
        ids = [r.doc_id for r in rows.collect() if r.doc_id is not None]
        ends = [min(ids), *cuts, max(ids) + 1]
        assert max(sum(a <= i < b for i in ids) for a, b in zip(ends, ends[1:])) <= 1.2 * len(ids) / sharding.RANGES
    made = []
    for ranges in (sharding.RANGES, 1):
        monkeypatch.setattr(sharding, "RANGES", ranges)
        numbered, _ = sharding.numbered(rows, "doc_id", ("text",), "number")
        made.append(sorted((r.number, repr(r.doc_id), r.text) for r in numbered.collect()))
    assert made[0] == made[1] and [r[0] for r in made[0]] == list(range(1000))


def test_rows_of_a_hot_key_are_spread_over_buckets(documents, monkeypatch):
    """A third of all rows have no id. No bucket, and so no task that numbers one, may hold them all."""
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 16)
    rows = documents(*[(None if i % 3 == 0 else i, f"text {i}") for i in range(600)])
    numbered, n = sharding.numbered(rows, "doc_id", ("text",), "number")
    got = numbered.filter("doc_id is null").select("number").collect()
    everything = numbered.agg(F.count_distinct("number"), F.min("number"), F.max("number")).first()
    assert everything == (600, 0, 599) and n == 600
    # Numbers of a bucket lie together; those of the hot key must not be one run.
    places = sorted(r.number for r in got)
    assert max(b - a for a, b in zip(places, places[1:])) > 1 and places[-1] - places[0] > 2 * len(places)
