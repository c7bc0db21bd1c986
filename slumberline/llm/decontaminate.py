"""Documents that hold benchmark items, found by greedy string tiling.

Tokens are runs of letters and digits in lower case (ASCII punctuation parts them), so that a passage is found
whatever its punctuation and case. An item is covered by a document's *tiles*: common token runs of ``MIN_MATCH`` or more
that overlap neither in the item nor in the document, the longest taken first. As tiles may stand in any
order, an item whose sentences were moved around is found, too. A document is contaminated by an item of
which tiles cover the share ``COVERAGE`` or more.

1. A tile holds a seed, a run of ``MIN_MATCH`` tokens of the item. The names of all seeds are marked in a
   bitmap of fixed size (8 MB), which the tasks that read the documents look up; documents with fewer marked
   seeds than the coverage of any item needs are done with. The others are stored, compressed.
2. Their seeds are joined to the items' seeds: only pairs that share enough different seeds go on.
3. Each pair is tiled by running Karp-Rabin: hash all free runs of the search length in the item, look up the
   document's rolling hashes, extend the hits, mark the longest free matches, then search for shorter ones.

Defined results: a null text has no tokens; an item of fewer than ``MIN_MATCH`` tokens is never found; items
with equal ids or texts are matched one by one, equal rows of ``benchmark`` once; null and repeated ids of
documents are kept apart by row; other columns are ignored, whatever their names; an empty table on either
side gives an empty table. Of runs of equal length the one that comes first in the item, then in the document, is taken.
Tiling takes time with the length of a text and the number of maximal common runs, which for texts that repeat one
token or a few is the number of their tokens, not its square.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumberline.llm import tokens as tk
from slumberline.llm.columns import put_back, set_aside
from slumberline.session import materialize

U64 = np.uint64
MIN_MATCH = 5
COVERAGE = 0.8
SEARCH_FROM = 40
BITMAP_BITS, PIECE_BITS = 26, 20
CARRIED = ("row", "doc_id", "digest")
TILES = "array<struct<doc_word:long,item_word:long,words:long>>"


def token_bytes() -> np.ndarray:
    """Which bytes of a text in lower case belong to tokens: ASCII letters and digits, and all beyond ASCII."""
    return np.array([byte >= 128 or chr(byte).isalnum() for byte in range(256)])


def token_names(buffer: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The name of every token, and the first token of each text."""
    starts, ends, bounds = tk.word_spans(buffer, places, token_bytes()[buffer])
    return tk.word_names(buffer, starts, ends), bounds


def needed_seeds(times: np.ndarray, n_tokens: int, coverage: float) -> int:
    """The fewest different seeds that tiles covering an item can hold: a seed that the item has ``times`` times
    stands for as many tiles of the least length."""
    most = np.cumsum(np.sort(times)[::-1]) * MIN_MATCH
    return min(int(np.searchsorted(most, coverage * n_tokens - 1e-9)) + 1, max(len(times), 1))


def item_task(coverage: float):
    def items(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            buffer, places = tk.text_buffer(batch.column("text"))
            names, bounds = token_names(buffer, places)
            rows = []
            for n in range(batch.num_rows):
                own = names[bounds[n] : bounds[n + 1]]
                seeds, times = np.unique(tk.rolling_hashes(own, MIN_MATCH), return_counts=True)
                rows.append((own.tobytes(), seeds.view(np.int64), needed_seeds(times, len(own), coverage)))
            columns = [batch.column("item_id"), pa.array([r[0] for r in rows], pa.binary())]
            columns += [pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "names", "seeds", "need"])

    return items


def mark_task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    marks = np.zeros(1 << BITMAP_BITS, dtype=bool)
    for batch in batches:
        seeds = batch.column("seeds").flatten().to_numpy(zero_copy_only=False).view(U64)
        marks[(seeds >> U64(64 - BITMAP_BITS)).astype(np.int64)] = True
    pieces = marks.reshape(-1, 1 << PIECE_BITS)
    some = [i for i in range(len(pieces)) if pieces[i].any()]
    columns = [pa.array(some, pa.int32()), pa.array([np.packbits(pieces[i]).tobytes() for i in some], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["piece", "marks"])


def join_marks(key: tuple, group: pa.Table) -> pa.Table:
    marks = np.bitwise_or.reduce([np.frombuffer(m.as_buffer(), dtype=np.uint8) for m in group.column("marks")])
    return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "marks": pa.array([marks.tobytes()], pa.binary())})


def bitmap(items: DataFrame) -> np.ndarray:
    """One bit for each value that the top bits of a name can have."""
    schema = "piece int, marks binary"
    found = np.zeros(1 << BITMAP_BITS - 3, dtype=np.uint8)
    size = 1 << PIECE_BITS - 3
    marked = items.select("seeds").mapInArrow(mark_task, schema).groupBy("piece").applyInArrow(join_marks, schema)
    for piece, marks in marked.collect():
        found[piece * size : (piece + 1) * size] = np.frombuffer(marks, dtype=np.uint8)
    return found


def suspect_task(marks: np.ndarray, need: int):
    def suspects(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            buffer, places = tk.text_buffer(batch.column("text"))
            for lo, hi in tk.slices(places):
                part, at = buffer[places[lo] : places[hi]], places[lo : hi + 1] - places[lo]
                names, bounds = token_names(part, at)
                start, doc = tk.windows_within(bounds, MIN_MATCH)
                if len(start) == 0:
                    continue
                seeds = tk.rolling_hashes(names, MIN_MATCH)[start]
                bit = seeds >> U64(64 - BITMAP_BITS)
                hit = marks[(bit >> U64(3)).astype(np.int64)] >> (7 - (bit & U64(7))).astype(np.uint8) & 1
                seeds, doc = seeds[hit == 1], doc[hit == 1]
                order = np.lexsort((seeds, doc))
                seeds, doc = seeds[order], doc[order]
                new = np.ones(len(seeds), dtype=bool)
                new[1:] = (seeds[1:] != seeds[:-1]) | (doc[1:] != doc[:-1])
                seeds, doc = seeds[new], doc[new]
                counts = np.bincount(doc, minlength=hi - lo)
                some = np.flatnonzero(counts >= need)
                if len(some) == 0:
                    continue
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                columns = [batch.column(name).slice(lo, hi - lo).take(pa.array(some)) for name in CARRIED]
                columns.append(pa.array([press.compress(part[at[i] : at[i + 1]].tobytes()) for i in some], pa.binary()))
                columns.append(pa.array([seeds[cut[i] : cut[i + 1]].view(np.int64) for i in some], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [*CARRIED, "z", "seeds"])

    return suspects


def tile(item: np.ndarray, doc: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling by running Karp-Rabin: (place in doc, place in item, tokens) of every tile."""
    free_item, free_doc = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    search = max(min(SEARCH_FROM, len(item)), least)
    while True:
        matches = free_matches(item, doc, free_item, free_doc, search)
        if not matches:
            if search <= least:
                return tiles
            search = max(search // 2, least)
            continue
        longest = matches[0][2]
        if longest > 2 * search:
            search = longest  # very long matches are worth a search of their own
            continue
        for at_doc, at_item, words in matches:
            whole = free_item[at_item : at_item + words].all() and free_doc[at_doc : at_doc + words].all()
            if whole:
                tiles.append((at_doc, at_item, words))
                free_item[at_item : at_item + words] = False
                free_doc[at_doc : at_doc + words] = False
        # What a longer tile cut into is searched for again at the length it may still have.


def free_runs(free: np.ndarray) -> np.ndarray:
    """How many tokens are free from each place on."""
    places = np.arange(len(free))
    stops = np.where(free, len(free), places)
    return np.minimum.accumulate(stops[::-1])[::-1] - places


def first_pairs(
    own: np.ndarray, own_before: np.ndarray, own_starts: np.ndarray, own_at: np.ndarray,
    theirs: np.ndarray, their_before: np.ndarray, their_starts: np.ndarray, their_at: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places with equal hashes but for those where a run that starts one token earlier has them: those of one
    hash and the same token before. ``starts`` tells places with no free token before them. Runs of one
    token, or of a short period, thus give as many pairs as places, not their product."""

    def classes(hashes: np.ndarray, before: np.ndarray, starts: np.ndarray) -> dict:
        found: dict = {}
        for n, (h, token, first) in enumerate(zip(hashes.tolist(), before.tolist(), starts.tolist())):
            found.setdefault(h, {}).setdefault(None if first else token, []).append(n)
        return found

    left, right = [], []
    mine = classes(own, own_before, own_starts)
    for h, parts in classes(theirs, their_before, their_starts).items():
        for token, members in parts.items():
            for other, places in mine[h].items():
                if token is None or token != other:
                    left.append(np.repeat(places, len(members)))
                    right.append(np.tile(members, len(places)))
    if not left:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    return own_at[np.concatenate(left)], their_at[np.concatenate(right)]


def free_matches(
    item: np.ndarray, doc: np.ndarray, free_item: np.ndarray, free_doc: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """Maximal common runs of free tokens, ``length`` or longer: the longest first, then by place in the item and the document."""
    if length > len(item) or length > len(doc):
        return []
    own, theirs = tk.rolling_hashes(item, length), tk.rolling_hashes(doc, length)
    run_item, run_doc = free_runs(free_item), free_runs(free_doc)
    at_item = np.flatnonzero(run_item[: len(own)] >= length)
    at_doc = np.flatnonzero(run_doc[: len(theirs)] >= length)
    at_doc = at_doc[np.isin(theirs[at_doc], own[at_item])]
    at_item = at_item[np.isin(own[at_item], theirs[at_doc])]
    if len(at_doc) == 0:
        return []
    parts = []
    for hashes, tokens, free, at in ((own, item, free_item, at_item), (theirs, doc, free_doc, at_doc)):
        parts += [hashes[at], tokens[at - 1], (at == 0) | ~free[at - 1], at]
    i, j = first_pairs(*parts)
    # How far each pair goes on: its length is found by halving, as hashes of longer runs differ once those of shorter ones do.
    least, most = np.full(len(i), length), np.minimum(run_item[i], run_doc[j])
    while len(i) and (least < most).any():
        middle = (least + most + 1) // 2
        same = tk.run_hashes(item, i, i + middle) == tk.run_hashes(doc, j, j + middle)
        least, most = np.where(same, middle, least), np.where(same, most, middle - 1)
    order = np.lexsort((j, i, -least))
    return list(zip(j[order].tolist(), i[order].tolist(), least[order].tolist()))


def tile_task(coverage: float):
    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        last, doc = None, None
        for batch in batches:
            kept, shares, found = [], [], []
            for n in range(batch.num_rows):
                row = batch.column("row")[n].as_py()
                if row != last:
                    text = np.frombuffer(press.decompress(batch.column("z")[n].as_buffer()), dtype=np.uint8)
                    last, doc = row, token_names(text, np.array([0, len(text)]))[0]
                item = np.frombuffer(batch.column("names")[n].as_buffer(), dtype=U64)
                made = tile(item, doc)
                share = sum(t[2] for t in made) / len(item)
                if share >= coverage - 1e-12:
                    kept.append(n)
                    shares.append(share)
                    found.append([{"doc_word": a, "item_word": b, "words": c} for a, b, c in sorted(made)])
            here = batch.select([*CARRIED, "item_id"]).take(pa.array(kept, pa.int64()))
            kind = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))
            columns = [*here.columns, pa.array(shares, pa.float64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*CARRIED, "item_id", "coverage", "tiles"])

    return tiles


def text_digest(text: Column) -> Column:
    """128 bits of MD5; the same at every read, unlike a row's number."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it holds: row, doc_id, item_id, coverage, tiles. ``row`` is the
    ``row`` column of ``docs``, if there is one, and tells documents with equal ids apart."""
    found = holdings(docs, benchmark, coverage).drop("digest")
    return found if "row" in docs.columns else found.drop("row")


def holdings(docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """The rows of ``contaminated`` with ``row`` and the ``digest`` of the document's text."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.lower("text").alias("text")).distinct()
    made = items.mapInArrow(item_task(coverage), "item_id long, names binary, seeds array<long>, need int")
    made = made.filter(F.size("seeds") > 0).withColumn("item", F.xxhash64("names"))
    made = materialize(made, "items")
    need = made.agg(F.min("need")).first()[0]
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(
        row.cast("bigint").alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_digest(F.col("text")).alias("digest"),
        F.lower("text").alias("text"),
    )
    schema = "row long, doc_id long, digest binary, z binary, seeds array<long>"
    if need is None:
        suspects = rows.limit(0).mapInArrow(suspect_task(np.zeros(1 << BITMAP_BITS - 3, np.uint8), 1), schema)
    else:
        suspects = materialize(rows.mapInArrow(suspect_task(bitmap(made), need), schema), "suspects")
    doc_seeds = suspects.select("row", F.explode("seeds").alias("seed"))
    item_seeds = made.select("item", "need", F.explode("seeds").alias("seed")).distinct()
    shared = doc_seeds.join(item_seeds, "seed").groupBy("row", "item", "need").agg(F.count(F.lit(1)).alias("n"))
    pairs = shared.filter(F.col("n") >= F.col("need")).select("row", "item")
    found = pairs.join(suspects.drop("seeds"), "row").join(made.select("item", "item_id", "names"), "item")
    return found.select(*CARRIED, "z", "item_id", "names").mapInArrow(
        tile_task(coverage), f"row long, doc_id long, digest binary, item_id long, coverage double, tiles {TILES}"
    )


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that hold no benchmark item. Rows that agree in id and text go or stay together; of other rows
    with the same id, null for one, only those that hold an item go."""
    held = holdings(docs.select("doc_id", "text"), benchmark, coverage)
    docs, aside = set_aside(docs, ("_held", "_digest"))
    held = held.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("_held"), F.col("digest").alias("_digest"))
    same = docs["doc_id"].eqNullSafe(F.col("_held")) & (text_digest(docs["text"]) == F.col("_digest"))
    return put_back(docs.join(held.distinct(), same, "left_anti"), aside)
