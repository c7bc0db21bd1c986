"""Near-duplicates by SimHash: fingerprints of 64 bits, linked by meet-in-the-middle ball hashing.

A text's words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased, its shingles all runs of three words joined by one
space, repeats included; fewer words are one shingle, no words give the fingerprint zero. A bit of the fingerprint
is 1 if more than half of the shingles' XXH64 (seed 42) have it. Fingerprints link at ``RADIUS`` (3) or fewer differing
bits; a document's component is the least id that links reach.

1. One pass over the texts makes the fingerprints. Equal ones become one row before anything else, so that a group
   of copies, whatever its size, is one fingerprint.
2. Half the radius is one bit, and the odd bit in the middle is left out: of the 64 bits one of the ``BLOCKS`` (4) blocks
   of 16 bits is blanked at a time. Every fingerprint emits all variants of the 48 bits that are left within one bit of
   it, 4 * 49 in all. Of two fingerprints with three differing bits at least one bit lies in some block; with that
   block blanked at most two are left, and flipping one of them on either side makes the variants meet. Emitting
   all variants of 64 bits within two bits instead would be 2,081 a fingerprint.
3. Rows are shuffled on variants and sorted by them, and a task reads the runs of equal variants from the stream of
   its sorted rows. Members of a run differ in at most two of the 48 bits, and are told apart by the 16 blanked ones:
   a run is at most 49 * 2**16 rows, however many documents there are.
4. Runs are verified without making all their pairs: small ones by the matrix of their differing bits, large ones
   by looking up all neighbours of a blanked block's value (1 + 16 + 120 + 560 of them) in a table of 2**16. A run leaves
   one link from each member to the least member of its group of linked members.
5. Links are deduplicated by Spark, and connected components are found by renaming.

Defined results: a null text has no words; a row of any id, null or repeated, is a document of its own, and a component
without any id has a null id; texts are read whole, in pieces of ``PIECE`` bytes, so a very long one needs a few times
its own size; repeated rows stay; extra columns are neither read nor returned (``classes`` takes the two it needs by name); an empty
table gives an empty result. There are no ties: a bit that exactly half of the shingles have is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumberline.llm import near_dups
from slumberline.session import materialize

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
BLOCKS = 4
WIDTH = BITS // BLOCKS
PIECE = 1 << 20
# Runs up to this size are verified by their matrix of differing bits.
MATRIX = 512
_space = re.compile(rb"[\x20\x09-\x0D]")
_cache: dict = {}


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, about ``size`` bytes at a time."""
    at = 0
    while at < len(text):
        cut = _space.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def shingle_hashes(text: bytes, size: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, piece by piece; the last words of a piece go before the next one's."""
    digest, seed, carried, any_yet = xxhash.xxh64_intdigest, SEED, [], False
    for words in pieces(text, size):
        words = carried + words
        if len(words) >= SHINGLE:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-SHINGLE] + 1))
            runs = zip(starts.tolist(), ends[SHINGLE - 1 :].tolist())
            yield np.array([digest(joined[a:b], seed) for a, b in runs], dtype=np.uint64)
            any_yet = True
        carried = words[1 - SHINGLE :]
    if carried and not any_yet:
        yield np.array([digest(b" ".join(carried), seed)], dtype=np.uint64)


def fingerprint(text: bytes | None, size: int = PIECE) -> int:
    """The bits that more than half of the shingles' hashes have."""
    counts, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text or b"", size):
        total += len(hashes)
        for start in range(0, len(hashes), 1 << 16):
            part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprint_task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        made = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` (as a signed 64-bit integer) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(fingerprint_task, f"doc_id {kind}, fp bigint")


def flips() -> np.ndarray:
    """The 49 changes of the 48 bits outside block 0: none, or one bit."""
    return np.array([0] + [1 << bit for bit in range(WIDTH, BITS)], dtype=np.uint64)


def rotated(fps: np.ndarray, block: int) -> np.ndarray:
    """The bits rotated so that ``block`` comes lowest."""
    turn = np.uint64(block * WIDTH)
    return fps if not block else (fps >> turn) | (fps << np.uint64(BITS - block * WIDTH))


def variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The variants of each fingerprint as one number each, 48 bits above the block's number, and whose they are."""
    made = []
    for block in range(BLOCKS):
        kept = rotated(fps, block) >> np.uint64(WIDTH) << np.uint64(WIDTH)
        made.append(((kept[:, None] ^ flips()[None, :]) | np.uint64(block)).ravel())
    return np.concatenate(made), np.tile(np.repeat(fps, BITS - WIDTH + 1), BLOCKS)


def variant_task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column(0)).view(np.uint64)
        for start in range(0, len(fps), 1 << 12):
            key, fp = variants(fps[start : start + (1 << 12)])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["variant", "fp"])


def neighbours() -> list[np.ndarray]:
    """All changes of a block's bits by the number of bits, up to the radius."""
    if "neighbours" not in _cache:
        every = np.arange(1 << WIDTH, dtype=np.uint32)
        bits = np.bitwise_count(every)
        _cache["neighbours"] = [every[bits == d] for d in range(RADIUS + 1)]
    return _cache["neighbours"]


def least_linked(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least node that links reach from each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        before = label.copy()
        for a, b in links:
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def linked_run(variant: int, fps: np.ndarray) -> np.ndarray:
    """For each fingerprint of a run (distinct, sorted) the index of the least one linked to it within the run."""
    n = len(fps)
    if n <= MATRIX:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= RADIUS
        a, b = np.nonzero(np.triu(near, 1))
        return least_linked(n, [(a, b)])
    block = variant & (BLOCKS - 1)
    turned = rotated(fps, block)
    value = (turned & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
    away = np.bitwise_count((turned ^ np.uint64(variant)) >> np.uint64(WIDTH) << np.uint64(WIDTH))
    # Members with one value differ in two bits at most, so they are linked; the first stands for all.
    order = np.argsort(value, kind="stable")
    first = np.full(1 << WIDTH, -1, dtype=np.int64)
    first[value[order][::-1]] = order[::-1]
    exact = np.full(1 << WIDTH, -1, dtype=np.int64)
    exact[value[away == 0]] = np.flatnonzero(away == 0)
    links = [(np.arange(n), first[value])]
    heads = np.flatnonzero(first >= 0)
    cores = np.flatnonzero(exact >= 0)
    # One bit apart: any two. Two: one of them must be the variant itself. Three: both.
    for d, (start, table) in enumerate(((heads, first), (cores, first), (cores, exact)), 1):
        own = first if d == 1 else exact
        for change in neighbours()[d]:
            other = start ^ int(change)
            there = table[other] >= 0
            if there.any():
                links.append((own[start[there]], table[other[there]]))
    # Equal flips with two or three blanked bits apart meet where both are unflipped.
    return least_linked(n, links)


def link_task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Links from rows sorted by variant. A run may go on in the next batch, so the last one is carried over."""
    key, fp = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for batch in batches:
        more = [np.asarray(batch.column(i)).view(np.uint64) for i in (0, 1)]
        key, fp = np.concatenate((key, more[0])), np.concatenate((fp, more[1]))
        last = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1:])[0]) if len(key) else 0
        yield links_of(key[:last], fp[:last])
        key, fp = key[last:], fp[last:]
    yield links_of(key, fp)


def links_of(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(key)))
    a, b = [], []
    two = starts[sizes == 2]
    near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= RADIUS]
    a.append(fp[near])
    b.append(fp[near + 1])
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        run = np.sort(fp[start : start + size])
        label = linked_run(int(key[start]), run)
        other = label != np.arange(size)
        a.append(run[label[other]])
        b.append(run[other])
    columns = [pa.array(np.concatenate(side).view(np.int64)) for side in (a, b)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints ``fp``, all different, that join whatever is within the radius."""
    emitted = distinct.select("fp").mapInArrow(variant_task, "variant bigint, fp bigint")
    together = emitted.repartition("variant").sortWithinPartitions("variant")
    found = together.mapInArrow(link_task, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id``, ``fp`` and ``component_id``."""
    made = materialize(fingerprints(docs), "fingerprints")
    distinct = materialize(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    labels = near_dups.components(materialize(links(distinct), "fingerprint-links"))
    labels = labels.select(F.col("cid").alias("fp"), "label")
    linked = labels.join(distinct, "fp")
    # Stored, so that the join below has a plain exchange on both sides and a large component can be split.
    of_label = materialize(linked.groupBy("label").agg(F.min("least").alias("component")), "components")
    of_fp = labels.join(of_label, "label").select("fp", "component")
    # A fingerprint without links is a component of its own; the rest of its rows is found by it alone.
    of_fp = distinct.join(of_fp, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    return made.join(materialize(of_fp, "fingerprint-components"), "fp", "left").select("doc_id", "fp", "component_id")
