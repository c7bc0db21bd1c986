"""Repeated windows and strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from brute import WORD, n_runs, removed_tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slumberline.llm import queries, substring_dedup, suffix_dedup
from slumberline.llm import tokens as tk

SF = "/root/testdata/sf0.001"


def by_id(rows):
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.kept))


def expected_words(docs, length):
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    masks = removed_tokens(words, length)
    return [
        (i, len(w), sum(m), " ".join(x for x, gone in zip(w, m) if not gone)) for (i, w), m in zip(words, masks)
    ]


def expected_bytes(docs, length):
    raw = [(i, (t or "").encode()) for i, t in docs]
    masks = removed_tokens([(i, list(b)) for i, b in raw], length)
    return [
        (i, len(b), sum(m), n_runs(m), bytes(x for x, gone in zip(b, m) if not gone)) for (i, b), m in zip(raw, masks)
    ]


def random_documents(seed, n, alphabet, join):
    """Texts that share runs of all lengths, at their starts, ends and in between."""
    rng = random.Random(seed)
    pool = [[rng.choice(alphabet) for _ in range(rng.randint(1, 60))] for _ in range(12)]
    docs = []
    for i in range(n):
        parts = [rng.choice(pool) if rng.random() < 0.6 else [rng.choice(alphabet)] * rng.randint(1, 9) for _ in range(6)]
        docs.append((i, join.join(x for part in parts for x in part)))
    return docs


AWKWARD = [
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (1, "a b c d e f g h"),
    (3, "a b c d e f g h"),
    (3, "a b c d e f g h"),
    (None, "x a b c d e f g h"),
    (None, "x a b c d e f g h"),
    (8, "é ü a b c d e f g"),
    (9, "h " * 2000),
    (10, "h " * 30),
]


@pytest.mark.parametrize("length, anchor", [(5, 2), (8, 8), (4, 1)])
def test_words_against_brute_force(spark, documents, length, anchor):
    docs = random_documents(length, 40, ["a", "b", "ccc", "dd", "é"], " ")
    for rows in (docs, AWKWARD):
        got = substring_dedup.remove_repeated_windows(documents(*rows), length, anchor).collect()
        expected = expected_words(rows, length)
        assert [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in by_id(got)] == sorted(
            expected, key=lambda r: (r[0] is None, r[0] or 0, r[3])
        )


@pytest.mark.parametrize("length, anchor", [(10, 4), (20, 8), (6, 6)])
def test_bytes_against_brute_force(spark, documents, length, anchor):
    for rows in (random_documents(length, 30, "abcé", ""), AWKWARD):
        got = suffix_dedup.remove_repeated_strings(documents(*rows), length, anchor).collect()
        expected = expected_bytes(rows, length)
        assert [(r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in by_id(got)] == sorted(
            expected, key=lambda r: (r[0] is None, r[0] or 0, r[4])
        )


def test_queries_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op3_substring_dedup(spark, SF).collect()}
    for i, n, gone, kept in expected_words(docs, 50):
        digest = hashlib.sha256(kept.encode()).hexdigest()
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, gone, digest)
    got = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, SF).collect()}
    for i, n, gone, spans, kept in expected_bytes(docs, 50):
        digest = hashlib.sha256(kept).hexdigest()
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (n, gone, spans, digest)


def test_many_bins_and_a_passage_found_everywhere(spark, documents, monkeypatch):
    from slumberline.llm import recurring

    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, f"{' '.join(f'u{i}x{j}' for j in range(400))} {passage} tail{i}") for i in range(300)]
    docs = documents(*rows)
    monkeypatch.setattr(recurring.F, "octet_length", lambda c: F.length(c) * 20)
    kept = substring_dedup.remove_repeated_windows(docs)
    assert kept.agg(F.sum("n_removed"), F.max("n_removed"), F.countDistinct("doc_id")).first()[:] == (299 * 70, 70, 300)


def test_removed_intervals(spark, documents):
    docs = documents((1, "a b c d x x a b c d"), (2, "z a b c d z z a b c d"))
    rows = {r.doc_id: r for r in substring_dedup.remove_repeated_windows(docs, 4, 2).collect()}
    assert [tuple(x) for x in rows[2].removed] == [(1, 5), (7, 11)]
    assert rows[1].removed == []


def test_empty_table_and_clashing_columns(spark, documents):
    empty = documents((1, "x")).filter("false")
    assert substring_dedup.remove_repeated_windows(empty).collect() == []
    assert suffix_dedup.remove_repeated_strings(empty).collect() == []
    clashing = documents((1, "a b c"), (2, "a b c")).withColumns({"bin": F.lit("x"), "kept": F.lit(1), "z": F.lit(2)})
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated_windows(clashing, 3, 2).collect()}
    assert got == {1: 0, 2: 3}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=6), st.integers(1, 9))
def test_rolling_and_run_hashes_agree(texts, length):
    values = tk.byte_values()[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    rolling = tk.rolling_hashes(values, length)
    starts = np.arange(max(len(values) - length + 1, 0))
    assert (rolling == tk.mix(tk.run_hashes(values, starts, starts + length))).all()


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=120), st.integers(1, 50), st.lists(st.integers(0, 120), max_size=6))
def test_refined_buckets_are_equal_where_strings_are(text, depth, cuts):
    raw = text.encode()
    values = np.frombuffer(raw, dtype=np.uint8)
    ends = sorted({c for c in cuts if c <= len(raw) - depth})
    first, last = np.array(ends[::2][: len(ends) // 2], dtype=np.int64), np.array(ends[1::2], dtype=np.int64)
    if len(first) == 0:
        assert not suffix_dedup.string_names(values, depth, first, last).any()
        return
    starts, bucket = suffix_dedup.refined_buckets(values, depth, first, last)
    assert starts.tolist() == sorted({p for a, b in zip(first, last) for p in range(a, b + 1)})
    strings = [raw[p : p + depth] for p in starts]
    assert len(set(bucket.tolist())) == len(set(strings)) == len(set(zip(bucket.tolist(), strings)))
    names = suffix_dedup.string_names(values, depth, first, last)[starts]
    assert len(set(names.tolist())) == len(set(strings)) == len(set(zip(names.tolist(), strings)))


def test_rows_of_one_id_and_without_id_spread_over_bins(spark, documents, monkeypatch):
    from slumberline.llm import recurring

    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"{passage} {'x' * 3000} a{i}") for i in range(200)] + [(None, f"{passage} {'y' * 3000} b{i}") for i in range(200)]
    rows += [(2, "same words " * 40)] * 150 + [(3, "same words " * 40)] * 2 + [(None, None)] * 20
    docs = documents(*rows)
    monkeypatch.setattr(recurring.F, "octet_length", lambda c: F.length(c) * 40)
    got = [(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeated_windows(docs).collect()]
    # All of id 1 stay whole, of rows without id the passage goes; copies under one id stay, those under a larger one go.
    expected = [(1, 62, 0)] * 200 + [(None, 62, 60)] * 200 + [(2, 80, 0)] * 150 + [(3, 80, 80)] * 2 + [(None, 0, 0)] * 20
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_rounds_may_get_the_rows_in_another_order_each(spark, documents):
    rows = random_documents(3, 60, "abcdef", " ") + [(7, "a b c d e f " * 4)] * 3 + [(None, "x y z " * 9)] * 2
    docs = documents(*rows)

    def disorder(batches):
        import random

        for batch in batches:
            for k in random.SystemRandom().sample(range(len(batch)), len(batch)):
                yield batch.slice(k, 1)

    # Without the reuse of exchanges each round reads the rows anew, as tasks of a cluster get them: in any order.
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        docs = docs.mapInArrow(disorder, docs.schema)
        words = by_id(substring_dedup.remove_repeated_windows(docs, 8, 3).collect())
        strings = by_id(suffix_dedup.remove_repeated_strings(docs, 20, 8).collect())
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in words] == sorted(expected_words(rows, 8), key=order)
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in strings]
    assert got == sorted(expected_bytes(rows, 20), key=order)


def test_equal_windows_have_equal_anchors_in_bins_of_any_size(monkeypatch):
    from slumberline.llm import recurring

    monkeypatch.setattr(recurring.tk, "mix", lambda x: x.copy())
    rule = recurring.Rule(4, 1, None, lambda values, gram: values, None)
    window = [1 << 60, (1 << 50) + 0x300, (1 << 50) + 0x200, 1 << 61]
    places = []
    for more in (0, 1 << 16):
        values = np.array(window + [1 << 62] * more, dtype=np.uint64)
        found = recurring.blocks_of(np.array([1]), values, np.array([0, len(values)]), rule)
        places.append(int(found.at[0]))
    assert places == [1, 1]


def test_word_spans_equal_the_pattern():
    texts = ["", " a\tb ", "é\x0bc\x0cd\x1fe", "x", "\n", "last word "]
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
    places = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, bounds = tk.word_spans(buffer, places)
    words = [buffer[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    assert [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])] == [WORD.findall(t) for t in texts]
