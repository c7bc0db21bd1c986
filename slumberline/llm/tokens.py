"""Texts as numpy arrays: bytes, words, names of token runs. Runs inside tasks.

A word is ``[^\\x20\\x09-\\x0D]+``. The separators are ASCII, so words can be found in UTF-8 bytes.
All names are 64-bit fingerprints that hang on the content alone: two runs of equal tokens have equal
names in every task, and no table of names is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
BASE = 0x9E3779B97F4A7C15
_cache: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def join_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of a run from the names of two runs that cover it."""
    x = left * U64(0xD6E8FEB86659FD93)
    x += right
    x ^= x >> U64(32)
    x *= U64(0xC2B2AE3D27D4EB4F)
    x ^= x >> U64(29)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if n > len(_cache.get("powers", ((),))[0]):
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(BASE, -1, 1 << 64)
        made = []
        for base in (BASE, inverse):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=U64))
        _cache["powers"] = tuple(made)
    return _cache["powers"]


def byte_values() -> np.ndarray:
    if "bytes" not in _cache:
        _cache["bytes"] = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
    return _cache["bytes"]


def space_flags() -> np.ndarray:
    if "spaces" not in _cache:
        flags = np.zeros(256, dtype=bool)
        flags[list(SPACES)] = True
        _cache["spaces"] = flags
    return _cache["spaces"]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of ``values[start:end]``, all from one pass of running sums modulo 2**64."""
    power, inverse = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def rolling_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Mixed Karp-Rabin hash of every run of ``length`` values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    power, inverse = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[length:] - sums[:n]) * inverse[:n])


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in one array, and where each text starts in it (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    places = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or places[-1] == places[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[places[0] : places[-1]], places - places[0]


def slices(places: np.ndarray, limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Cut texts into groups of about ``limit`` bytes; a longer text is a group of its own."""
    found, first, n = [], 0, len(places) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(places, places[first] + limit, "right")) - 1)
        last = min(last, n)
        found.append((first, last))
        first = last
    return found


def word_spans(
    buffer: np.ndarray, places: np.ndarray, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each text (one more at the end). ``inside``
    tells the bytes of words if they aren't all but white space."""
    inside = ~space_flags()[buffer] if inside is None else inside
    before = np.zeros(len(buffer) + 1, dtype=bool)
    before[1:] = inside
    before[places] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(buffer) + 1, dtype=bool)
    after[:-1] = inside
    after[places] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, places)


def word_names(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(run_hashes(byte_values()[buffer], starts, ends))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def windows_within(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Every start of a window of ``length`` tokens that lies within one text, and the text's number."""
    counts = np.maximum(np.diff(bounds) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(bounds[:-1] - before, counts), text
