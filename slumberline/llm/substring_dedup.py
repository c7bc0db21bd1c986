"""Repeated word windows: every run of ``length`` words that a document with a smaller id also has.

Karp-Rabin hashes of every window of ``length`` words come from running sums. Spark groups equal
hashes and finds the smallest document of each (``recurring`` holds back windows that cannot repeat);
the windows to remove are merged into maximal intervals.

Defined results: a null text has no words; a text shorter than a window keeps all; a null id counts as
the largest; rows with the same id never remove from each other; other columns are ignored, whatever
their names; an empty table gives an empty table. Time is linear in the length of a text, of which a task holds some ten
times the size; of equal windows those of the smallest id stay, all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slumberline.llm import tokens as tk
from slumberline.llm.recurring import Rule, recurring_windows

WINDOW_WORDS = 50
ANCHOR_WORDS = 10
SCHEMA = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<first:long,last:long>>"


def read_words(texts: list[bytes]) -> tuple:
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    places = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts, ends, bounds = tk.word_spans(buffer, places)
    return tk.word_names(buffer, starts, ends), bounds, (buffer, starts, ends)


def karp_rabin_windows(values: np.ndarray, length: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return tk.rolling_hashes(values, length)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last place of every run of true values."""
    step = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def keep_words(ids: pa.Array, texts: list[bytes], bounds: np.ndarray, more: tuple, mask: np.ndarray) -> pa.Table:
    buffer, starts, ends = more
    kept, removed, counts = [], [], []
    for n in range(len(texts)):
        lo, hi = bounds[n], bounds[n + 1]
        gone = mask[lo:hi]
        stay = np.flatnonzero(~gone) + lo
        words = [buffer[s:e].tobytes() for s, e in zip(starts[stay], ends[stay])]
        kept.append(b" ".join(words).decode("utf-8"))
        first, last = runs(gone)
        removed.append([{"first": int(a), "last": int(b)} for a, b in zip(first, last)])
        counts.append((int(hi - lo), int(gone.sum())))
    return pa.table(
        {
            "doc_id": ids,
            "n_words": pa.array([c[0] for c in counts], pa.int64()),
            "n_removed": pa.array([c[1] for c in counts], pa.int64()),
            "kept": pa.array(kept, pa.string()),
            "removed": pa.array(removed, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        }
    )


def remove_repeated_windows(docs: DataFrame, length: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """``docs`` (doc_id, text) without repeated windows: the kept words joined by a space, and the
    removed intervals of word numbers (``last`` exclusive)."""
    rule = Rule(length, min(anchor, length), read_words, tk.rolling_hashes, karp_rabin_windows)
    return recurring_windows(docs.select("doc_id", "text"), rule, keep_words, SCHEMA)
