"""Fingerprints and components against plain Python."""

import random

import numpy as np
import pytest
import xxhash
from brute import WORD

from slumberline.llm import queries, simhash

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Component id per row from all pairs; rows are (doc_id, fingerprint)."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [(doc_id, fp, least.get(top(i))) for i, (doc_id, fp) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, value or 0) for value in row])


def found(docs):
    return ordered((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.classes(docs).collect())


def test_whole_table_against_all_pairs(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    expected = sorted((i, f"{fp:016x}", c) for i, fp, c in plain_components(rows))
    result = queries.op11_simhash(spark, SF_DIR)
    assert result.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(r) for r in result.collect()) == expected
    assert len({c for _, _, c in expected}) < len(expected)


def test_edge_rows(documents):
    rows = [
        (4, None), (2, ""), (9, " \t\n"), (None, None), (5, "one"), (6, "ONE"), (7, "one two"), (8, "one  two"),
        (3, "Ärger ÄRGER ärger Über"), (1, "x y z"), (1, "x y z"), (None, "lonely words of no id here"), (11, "x\x85y z w"),
    ]
    expected = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    got = found(documents(*rows))
    assert got == ordered(expected)
    of = {i: c for i, _, c in got}
    assert of[4] == of[2] == of[9] == 2 and of[6] == 5 and of[8] == 7


def test_empty_table_and_other_columns(spark, documents):
    assert simhash.classes(documents()).count() == 0
    docs = documents((1, "a b c"), (2, "a b c"))
    for name in ("fp", "component_id", "label", "cid", "variant", "least"):
        docs = docs.selectExpr("*", f"'other' AS {name}")
    assert [c for _, _, c in found(docs)] == [1, 1]


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_pieces_of_a_text_give_the_same(size):
    rng = random.Random(3)
    text = "".join(rng.choice(["ab ", "Cde\n", " ", "ü", "xyz\t"]) for _ in range(400))
    assert simhash.fingerprint(text.encode(), size) == plain_fingerprint(text)


def test_long_text_in_linear_time():
    import time

    def seconds(n):
        text = " ".join(f"w{i % 977}" for i in range(n)).encode()
        start = time.perf_counter()
        simhash.fingerprint(text)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(800_000) < 16 * max(seconds(200_000), 0.05)


def planted_values(rng):
    """Values at 0 to 5 bits from others, chains of three bits, and a cloud around one value."""
    values = [rng.getrandbits(64) for _ in range(40)]
    for value in values[:30]:
        for bits in range(6):
            near = value
            for bit in rng.sample(range(64), bits):
                near ^= 1 << bit
            values.append(near)
    chain = rng.getrandbits(64)
    for step in range(30):
        for bit in rng.sample(range(64), 3):
            chain ^= 1 << bit
        values.append(chain)
    return list(dict.fromkeys(values))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_join_whatever_is_within_three_bits(spark, seed):
    values = planted_values(random.Random(seed))
    expected = plain_components(list(enumerate(values)))
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    distinct = spark.createDataFrame(rows, "least bigint, fp bigint").repartition(3)
    edges = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(distinct).collect()]
    assert len(edges) < 4 * 49 * len(values)
    of = {v: i for i, v in enumerate(values)}
    label = simhash.least_linked(len(values), [(np.array([of[a] for a, _ in edges]), np.array([of[b] for _, b in edges]))])
    assert [int(x) for x in label] == [c for _, _, c in expected]


@pytest.mark.parametrize("spread", [6, 10, 16])
def test_a_run_is_linked_alike_by_matrix_and_by_table(spread, monkeypatch):
    rng = np.random.default_rng(spread)
    block, base = 2, np.uint64(rng.integers(1 << 62))
    turned = simhash.rotated(np.array([base]), block)[0] >> np.uint64(16) << np.uint64(16)
    low = rng.integers(1 << spread, size=1200).astype(np.uint64)
    flips = simhash.flips()[rng.integers(49, size=1200) * (rng.random(1200) < 0.5)]
    members = (turned ^ flips) | low
    back = np.uint64(block * 16)
    members = np.unique((members << back) | (members >> np.uint64(64 - block * 16)))
    variant = int(turned) | block
    by_table = simhash.linked_run(variant, members)
    monkeypatch.setattr(simhash, "MATRIX", 1 << 20)
    by_matrix = simhash.linked_run(variant, members)
    # Equal flips of two or three bits meet in the run of their own value, so classes of the table are at most split.
    away = np.bitwise_count((simhash.rotated(members, block) ^ np.uint64(variant)) >> np.uint64(16)) == 0
    assert all(by_matrix[i] == by_matrix[j] for i, j in enumerate(by_table))
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= 3
    kept = np.bitwise_count((members[:, None] ^ members[None, :]) & ~np.uint64(0xFFFF << (block * 16)))
    here = near & ((kept > 0) | away[:, None] & away[None, :])
    a, b = np.nonzero(np.triu(here, 1))
    assert np.array_equal(simhash.least_linked(len(members), [(a, b)]), by_table)


def test_group_of_a_third_of_all_rows(documents):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=300)
    rows = [(i, " ".join(base)) for i in range(200)]
    for i in range(200, 500):
        near = list(base)
        near[rng.randrange(300)] = "other"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(rng.choices(words, k=50))) for i in range(500, 700)]
    expected = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    assert found(documents(*rows)) == ordered(expected)
