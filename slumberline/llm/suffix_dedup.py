"""Repeated byte strings: every ``depth`` bytes that a document with a smaller id also has.

Equal strings are found by bucket-pointer refinement, on the positions of a bin of texts that may repeat (``recurring``
leaves out those near whose anchor, picked by a rolling hash, no other document has anything). The positions are sorted
into buckets of equal 8-grams, and each is given its bucket's pointer: the slot at which the bucket starts. A bucket of
depth h with several positions is refined by sorting it on the pointers of the positions h bytes later, in its own slots; the
new pointers are used by the next round, for the buckets of all positions before them: 8, 16, 32, 50. A bucket of one
position is done. The last depth is met exactly, so a round takes all its pointers at one depth. A bucket of the full depth
sends one fingerprint of its string, whatever its size, to be compared with the other bins'.

Defined results: a null text is empty; a text shorter than ``depth`` keeps all; a null id counts as the
largest; rows with the same id never remove from each other; other columns are ignored, whatever their
names; an empty table gives an empty table. What is kept may be no valid UTF-8, so it is binary. A round is a sort, so that a
very long text, also one that repeats a single byte, takes four sorts of its positions; of equal strings those of the smallest
id stay, all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slumberline.llm import tokens as tk
from slumberline.llm.recurring import Rule, recurring_windows
from slumberline.llm.substring_dedup import runs

DEPTH = 50
ANCHOR_BYTES = 25
FIRST_GRAM = 8
SCHEMA = "doc_id long, n_bytes long, n_removed long, kept binary, removed array<struct<first:long,last:long>>"


def read_bytes(texts: list[bytes]) -> tuple:
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return buffer, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), buffer


def byte_grams(values: np.ndarray, gram: int) -> np.ndarray:
    return tk.rolling_hashes(tk.byte_values()[values], gram)


def first_keys(values: np.ndarray, places: np.ndarray, gram: int) -> np.ndarray:
    """The ``gram`` bytes at each place, eight at most, as one number."""
    keys = np.zeros(len(places), dtype=np.uint64)
    for k in range(gram):
        keys = keys << np.uint64(8) | values[places + k]
    return keys


def pointers(keys: np.ndarray) -> np.ndarray:
    """Of sorted keys: the slot at which the bucket of each starts."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def refined_buckets(values: np.ndarray, depth: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All starts of strings in the given ranges, and their buckets: equal where ``depth`` bytes are."""
    reach = min(FIRST_GRAM, depth)
    places = covered(len(values), first, last + depth - reach)
    wanted = covered(len(values), first, last)
    keys = first_keys(values, places, reach)
    order = np.argsort(keys)
    slots = places[order]
    bucket = np.zeros(len(values) + depth, dtype=np.int64)  # 1 and up; 0 where nothing needs a bucket
    bucket[slots] = pointers(keys[order]) + 1
    while reach < depth:
        step = min(reach, depth - reach)
        own = bucket[slots]
        shared = np.zeros(len(slots), dtype=bool)
        shared[1:] = own[1:] == own[:-1]
        shared[:-1] |= shared[1:]
        at = np.flatnonzero(shared)
        members = slots[at]
        # Sorted by bucket first, a bucket stays within its slots.
        keys = (own[at] << 32 | bucket[members + step]).astype(np.uint64)
        order = np.argsort(keys)
        slots[at] = members = members[order]
        if len(at):
            bucket[members] = at[pointers(keys[order])] + 1
        reach += step
    return wanted, bucket[wanted]


def covered(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All places in the given ranges, each once."""
    step = np.bincount(first, minlength=size + 1)[: size + 1] - np.bincount(last + 1, minlength=size + 1)[: size + 1]
    return np.flatnonzero(np.cumsum(step[:size]) > 0)


def string_names(values: np.ndarray, depth: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """At the start of each string: the fingerprint of its bucket, made from one string of the bucket."""
    names = np.zeros(len(values), dtype=np.uint64)
    if len(first) == 0:
        return names
    starts, bucket = refined_buckets(values, depth, first, last)
    chosen = np.full(int(bucket.max()) + 1, -1, dtype=np.int64)
    chosen[bucket] = starts
    some = np.flatnonzero(chosen >= 0)
    fingerprint = np.zeros(len(chosen), dtype=np.uint64)
    fingerprint[some] = tk.mix(tk.run_hashes(tk.byte_values()[values], chosen[some], chosen[some] + depth))
    names[starts] = fingerprint[bucket]
    return names


def keep_bytes(ids: pa.Array, texts: list[bytes], bounds: np.ndarray, more: np.ndarray, mask: np.ndarray) -> pa.Table:
    kept, removed, counts = [], [], []
    for n in range(len(texts)):
        lo, hi = bounds[n], bounds[n + 1]
        gone = mask[lo:hi]
        kept.append(more[lo:hi][~gone].tobytes())
        first, last = runs(gone)
        removed.append([{"first": int(a), "last": int(b)} for a, b in zip(first, last)])
        counts.append((int(hi - lo), int(gone.sum())))
    return pa.table(
        {
            "doc_id": ids,
            "n_bytes": pa.array([c[0] for c in counts], pa.int64()),
            "n_removed": pa.array([c[1] for c in counts], pa.int64()),
            "kept": pa.array(kept, pa.binary()),
            "removed": pa.array(removed, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        }
    )


def remove_repeated_strings(docs: DataFrame, depth: int = DEPTH, anchor: int = ANCHOR_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) without the bytes of repeated strings, and the removed byte ranges."""
    rule = Rule(depth, min(anchor, depth), read_bytes, byte_grams, string_names)
    return recurring_windows(docs.select("doc_id", "text"), rule, keep_bytes, SCHEMA)
