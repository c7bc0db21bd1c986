"""Spelling variants: words at one edit from each other, found by Gram matrices of letter counts.

Words are the maximal runs of Latin letters, ``[A-Za-z\\u00C0-\\u00FF]+``, with A-Z lower-cased, of at least ``LEAST_LENGTH``
code points and ``LEAST_COUNT`` occurrences. Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word with the largest count (ties: the least in code-point order), if that count
is at least ``DOMINANCE`` times its own; its root is where following the forms ends. Counts at least double from a
word to its form, so there are no cycles and few steps.

Each document may get a few planted typing errors (``TYPO_MODULUS``), a fixed rule of document and word.

1. Words are counted within each task before the shuffle.
2. The letter counts of a word are a vector. An insertion or deletion changes its squared distance to 1, a replacement
   to 2, and the squared distances of all pairs of two blocks come from one matrix product (``|a|**2 + |b|**2 - 2 ab``).
   Only pairs of equal length at 2 and of adjacent lengths at 1 can be near; these, few, are verified letter by letter.
3. The letters are dealt into ``PARTS`` (4) parts of about equal use. An edit touches the counts of two parts at most, so of the
   six pairs of parts at least one has the same counts in both words: blocks are made for each pair of parts, of the words with
   equal counts there, and for each length with the next one. A near pair is counted in the first block where it meets.
   Against blocks by length alone this leaves one product in about a hundred.
4. A block of over ``TILE`` words of a length is cut into tiles by a hash of the word, and each pair of tiles is a task
   of its own, so no task holds more than some tiles whatever the vocabulary.
5. Tasks emit for each word how many near words they saw and the best of them, not the pairs.

Defined results: a null text has no words; a null id counts as the empty string in the rule for typing errors; texts are read whole,
in pieces of ``PIECE`` code points; repeated rows count as often as they occur; a word without near words has
``n_near`` 0, null ``form`` and ``form_n``, and is its own root; equal counts are no form of each other; an
empty table, or one without words, gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumberline.session import materialize

LEAST_LENGTH = 5
LEAST_COUNT = 3
DOMINANCE = 2
TYPO_MODULUS = 97
PARTS = 4
# Words of a tile, of up to ``TILE_LENGTH`` letters; of longer ones as many fewer.
TILE = 2048
TILE_LENGTH = 16
PIECE = 1 << 20
# Distinct words that a task holds before it passes its counts on.
HELD = 1 << 18
# The letters after A-Z are lower-cased: a-z and the letters of Latin-1, with the two signs among them.
FIRST, HIGH, LAST = ord("a"), 0xC0, 0xFF
N_LETTERS = 26 + LAST - HIGH + 1
_run = re.compile("[a-zÀ-ÿ]+")
_gap = re.compile("[^a-zÀ-ÿ]")


# --- counting -----------------------------------------------------------------------------------


def runs(text: str, size: int = PIECE) -> Iterator[Counter]:
    """How often each run of letters occurs, about ``size`` code points of the text at a time."""
    # Lower-casing bytes touches A-Z alone.
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    at = 0
    while at < len(text):
        cut = _gap.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield Counter(_run.findall(text, at, end))
        at = end


def typed(doc_id: object, run: str, modulus: int = TYPO_MODULUS) -> str:
    """The run as the document has it: one in ``modulus`` loses a letter."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_task(modulus: int, least_length: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for found in runs(text) if text else ():
                    for run, n in found.items():
                        if len(run) >= least_length:
                            word = typed(doc_id, run, modulus)
                            if len(word) >= least_length:
                                counts[word] += n
                    if len(counts) > HELD:
                        yield counted(counts)
                        counts = Counter()
        yield counted(counts)

    return task


def counted(counts: Counter) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def vocabulary(
    docs: DataFrame, modulus: int = TYPO_MODULUS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word`` and its count ``n`` over all documents (doc_id, text)."""
    partial = docs.select("doc_id", "text").mapInArrow(count_task(modulus, least_length), "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- blocks -------------------------------------------------------------------------------------


def letters_of(words: list[str]) -> np.ndarray:
    """Code points, one row a word, padded with zeros."""
    width = max(map(len, words), default=0)
    return np.array(words, dtype=f"<U{max(width, 1)}").view(np.uint32).reshape(len(words), -1)


def alike(words: list[str], limit: int = 1 << 20) -> Iterator[np.ndarray]:
    """Numbers of words in groups of similar length, of about ``limit`` letters when padded."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order, start = np.argsort(sizes, kind="stable"), 0
    while start < len(order):
        end = start + max(1, limit // int(max(sizes[order[start]], 1)))
        # The longest of the group sets the width.
        fits = sizes[order[start:end]] * np.arange(1, len(order[start:end]) + 1) <= limit
        end = start + max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
        yield order[start:end]
        start = end


def counts_of(letters: np.ndarray) -> np.ndarray:
    """The letter counts of each word, in one column per letter."""
    n, width = letters.shape
    slot = np.where(letters < HIGH, letters.astype(np.int64) - FIRST, letters.astype(np.int64) - HIGH + 26)
    rows = np.repeat(np.arange(n), width).reshape(n, width)
    used = letters > 0
    flat = np.bincount(rows[used] * N_LETTERS + slot[used], minlength=n * N_LETTERS)
    return flat.reshape(n, N_LETTERS)


def letter_use_task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    total = np.zeros(N_LETTERS, dtype=np.int64)
    for batch in batches:
        words = batch.column(0).to_pylist()
        for some in alike(words):
            total += counts_of(letters_of([words[k] for k in some])).sum(axis=0)
    columns = [pa.array(np.arange(N_LETTERS)), pa.array(total)]
    yield pa.RecordBatch.from_arrays(columns, names=["letter", "uses"])


def dealt(words: DataFrame, parts: int = PARTS) -> np.ndarray:
    """The part of each letter: letters by falling use, each to the part that is used least so far.

    The driver gets one row per letter.
    """
    uses = words.select("word").mapInArrow(letter_use_task, "letter bigint, uses bigint")
    rows = uses.groupBy("letter").agg(F.sum("uses").alias("uses")).collect()
    part, load = np.zeros(N_LETTERS, dtype=np.int64), [0] * parts
    for row in sorted(rows, key=lambda r: (-r["uses"], r["letter"])):
        least = load.index(min(load))
        part[row["letter"]] = least
        load[least] += row["uses"]
    return part


def signatures(counts: np.ndarray, part: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """For each word and part a 64-bit name of the counts of that part's letters."""
    odd = np.random.default_rng(13).integers(1 << 62, size=(N_LETTERS,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    scaled = counts.astype(np.uint64) * odd[None, :]
    return np.stack([scaled[:, part == p].sum(axis=1, dtype=np.uint64) for p in range(parts)], axis=1)


def pairs_of_parts(parts: int = PARTS) -> list[tuple[int, int]]:
    return list(itertools.combinations(range(parts), 2))


def block_task(part: np.ndarray, parts: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            name = np.zeros((len(words), parts), dtype=np.uint64)
            length = np.fromiter(map(len, words), np.int64, len(words))
            for some in alike(words):
                name[some] = signatures(counts_of(letters_of([words[k] for k in some])), part, parts)
            for number, (i, j) in enumerate(pairs_of_parts(parts)):
                key = (name[:, i] * np.uint64(0x9E3779B97F4A7C15) ^ name[:, j]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(number)
                columns = [pa.array(key.view(np.int64)), pa.array(length), batch.column(0), batch.column(1)]
                columns.append(pa.array(np.full(len(words), number, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names=["block", "length", "word", "n", "number"])

    return task


def tiled(blocks: DataFrame, tile: int = TILE) -> DataFrame:
    """The rows of ``blocks`` once for every task they take part in: a pair of tiles, ``x`` of one length and ``y`` of the same
    or the next one. ``side`` tells the place of the row: 0 for x, 1 for y, 2 for both (a tile with itself)."""
    sizes = blocks.groupBy("block", "length").agg(F.count(F.lit(1)).alias("size"))
    # A tile of long words has fewer of them.
    letters = F.col("size") * F.greatest(F.col("length"), F.lit(TILE_LENGTH))
    sizes = sizes.select("block", "length", F.ceil(letters / (tile * TILE_LENGTH)).cast("int").alias("tiles"))
    next_sizes = sizes.select("block", (F.col("length") - 1).alias("length"), F.col("tiles").alias("tiles_above"))
    last_sizes = sizes.select("block", (F.col("length") + 1).alias("length"), F.col("tiles").alias("tiles_below"))
    sizes = sizes.join(next_sizes, ["block", "length"], "left").join(last_sizes, ["block", "length"], "left")
    sizes = materialize(sizes.na.fill(0, ["tiles_above", "tiles_below"]), "block-sizes")
    rows = blocks.join(sizes, ["block", "length"])
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    place = lambda length, x, y, side: F.struct(
        length.cast("int").alias("base"), x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side")
    )
    length, none = F.col("length"), F.array().cast("array<struct<base:int,x:int,y:int,side:int>>")
    # y = -1 stands for the tile itself; tiles of the next length are numbered from the number of own tiles.
    same = F.transform(
        numbers(F.col("tiles")),
        lambda t: place(
            length, F.least(own, t), F.greatest(own, t), F.when(t == own, 2).when(own < t, 0).otherwise(1)
        ),
    )
    above = F.when(
        F.col("tiles_above") > 0,
        F.transform(numbers(F.col("tiles_above")), lambda t: place(length, own, F.col("tiles") + t, F.lit(0))),
    ).otherwise(none)
    below = F.when(
        F.col("tiles_below") > 0,
        F.transform(
            numbers(F.col("tiles_below")), lambda t: place(length - 1, t, F.col("tiles_below") + own, F.lit(1))
        ),
    ).otherwise(none)
    return rows.select("block", "number", "word", "n", F.inline(F.concat(same, above, below)))


# --- within a pair of tiles -----------------------------------------------------------------------


def is_one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two words (rows of letters, padded alike) of equal or adjacent lengths, ``y`` not the shorter, differ
    by one replacement or insertion."""
    longer = (y > 0).sum(axis=1) - (x > 0).sum(axis=1)
    differ = x != y
    replaced = (longer == 0) & (differ.sum(axis=1) == 1)
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    # Behind the first difference the longer word goes on as the shorter one, one letter later.
    later = np.concatenate((y[:, 1:], np.zeros((len(y), 1), y.dtype)), axis=1)
    rest = np.arange(x.shape[1])[None, :] >= first[:, None]
    inserted = (longer == 1) & ~((later != x) & rest).any(axis=1)
    return replaced | inserted


def near_pairs(x: np.ndarray, y: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the near pairs among the words ``x``, or of ``x`` with ``y`` of the same or the next length."""
    # Squares are whole numbers below the precision of either type.
    kind = np.float32 if x.shape[1] < 4000 else np.float64
    a = counts_of(x).astype(kind)
    b = a if y is None else counts_of(y).astype(kind)
    other = x if y is None else y
    distance = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    gap = (other > 0).sum(axis=1)[None, :] - (x > 0).sum(axis=1)[:, None]
    close = distance == np.where(gap == 0, 2.0, 1.0)
    if y is None:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    width = max(x.shape[1], other.shape[1])
    x, other = (np.pad(side, ((0, 0), (0, width - side.shape[1]))) for side in (x, other))
    found = [np.zeros(0, dtype=bool)]
    for start in range(0, len(i), 1 << 16):
        part = slice(start, start + (1 << 16))
        found.append(is_one_edit(x[i[part]], other[j[part]]))
    found = np.concatenate(found)
    return i[found], j[found]


def met_before(x: np.ndarray, y: np.ndarray, number: int, pairs: list[tuple[int, int]]) -> np.ndarray:
    """Whether two words have equal counts in an earlier pair of parts as well."""
    equal = x == y
    met = np.zeros(len(x), dtype=bool)
    for i, j in pairs[:number]:
        met |= equal[:, i] & equal[:, j]
    return met


def best_of(n_words: int, mine: np.ndarray, other: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many near words each word has, and which of them counts most (ties: least rank); -1 without any."""
    near = np.bincount(mine, minlength=n_words)
    order = np.lexsort((rank[other], -n[other], mine))
    best = np.full(n_words, -1, dtype=np.int64)
    best[mine[order][::-1]] = other[order][::-1]
    return near, best


def match_task(part: np.ndarray, parts: int):
    """Rows sorted by the pair of tiles; what a batch cuts is carried over."""
    pairs = pairs_of_parts(parts)
    columns = ["word", "near", "best_n", "best"]

    def matched(words: list[str], n: np.ndarray, side: np.ndarray, number: int) -> tuple | None:
        letters = letters_of(words)
        if (side == 2).all():
            i, j = near_pairs(letters, None)
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                return None
            i, j = near_pairs(letters[left], letters[right])
            i, j = left[i], right[j]
        if not len(i):
            return None
        names = signatures(counts_of(letters), part, parts)
        new = ~met_before(names[i], names[j], number, pairs)
        # Equal names of blocks with other counts are no reason to count a pair twice.
        own = np.array(pairs[number])
        new &= (names[i][:, own] == names[j][:, own]).all(axis=1)
        i, j = i[new], j[new]
        rank = np.empty(len(words), dtype=np.int64)
        rank[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
        near, best = best_of(len(words), np.concatenate((i, j)), np.concatenate((j, i)), n, rank)
        return near, best

    def of_rows(table: pa.Table) -> pa.RecordBatch:
        out: tuple[list, list, list, list] = ([], [], [], [])
        keys = [np.asarray(table.column(name)) for name in ("block", "base", "x", "y", "number")]
        change = np.zeros(table.num_rows, dtype=bool)
        change[:1] = True
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], table.num_rows)
        n, side = np.asarray(table.column("n")), np.asarray(table.column("side"))
        words = table.column("word").combine_chunks()
        for start, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            run = words.slice(start, end - start).to_pylist()
            found = matched(run, n[start:end], side[start:end], int(keys[4][start]))
            if found:
                near, best = found
                for k in np.flatnonzero(near).tolist():
                    out[0].append(run[k])
                    out[1].append(int(near[k]))
                    out[2].append(int(n[start + best[k]]))
                    out[3].append(run[best[k]])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=columns)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            # The last run may go on in the next batch.
            last = table.num_rows
            ends = [table.column(name) for name in ("block", "base", "x", "y", "number")]
            final = [column[-1].as_py() for column in ends]
            same = np.ones(table.num_rows, dtype=bool)
            for column, value in zip(ends, final):
                same &= np.asarray(column) == value
            last = int(np.flatnonzero(same)[0])
            if last:
                yield of_rows(table.slice(0, last).combine_chunks())
                held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield of_rows(pa.Table.from_batches(held).combine_chunks())

    return task


def near_words(words: DataFrame, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """Per word of ``words`` (word, n) that has any: ``n_near``, and of the best near word ``best_n`` and ``best``."""
    part = dealt(words, parts)
    schema = "block bigint, length bigint, word string, n bigint, number int"
    blocks = words.select("word", "n").mapInArrow(block_task(part, parts), schema)
    keys = ["block", "base", "x", "y", "number"]
    together = tiled(blocks, tile).repartition(*keys).sortWithinPartitions(*keys)
    seen = together.mapInArrow(match_task(part, parts), "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    grouped = seen.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("first"))
    return grouped.select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def rooted(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for rows (word, form): each round doubles the steps that are followed."""
    known = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if known.join(further, "root", "left_semi").isEmpty():
            return known
        known = known.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        known = materialize(known, "forms")


def variants(
    docs: DataFrame,
    modulus: int = TYPO_MODULUS,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    dominance: int = DOMINANCE,
    tile: int = TILE,
) -> DataFrame:
    """Per word of ``docs`` (doc_id, text): ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = materialize(vocabulary(docs, modulus, least_length, least_count), "vocabulary")
    near = words.join(near_words(words, tile=tile), "word", "left")
    strong = F.col("best_n") >= dominance * F.col("n")
    near = near.select(
        "word",
        F.when(strong, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best_n")).alias("form_n"),
    )
    near = materialize(near, "near-words")
    roots = rooted(near.filter("form IS NOT NULL"))
    joined = near.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
