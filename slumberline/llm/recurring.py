"""Which fixed-length windows of a document also start in a document with a smaller id: exactly, at scale.

Shipping a name for every window would move many times the corpus. Almost all windows are found
nowhere else, and most of the others lie in long common runs, so they are looked at in three rounds:

1. Every window picks its *anchor*: among the k-grams inside it the one with the smallest hash. Equal
   windows pick equal anchors at the same place. Successive windows share anchors (a *block*), so there
   are about 2 / (length - k + 2) anchors per token. Only their names travel; an anchor whose name no
   other document has cannot belong to a common window.
2. Blocks whose anchor recurs travel as one name for all tokens that the block's windows span. A block
   that a document with a smaller id has in full is common in full: all its windows are decided at
   once. What is left are blocks that are the first of their kind while others share their anchor.
3. Only their windows are named and compared one by one.

Documents are dealt into bins of about equal bytes by a hash of id and text, so that the rows of one id, or
without id, spread over all bins, and a bin sends one packed row per bucket of names
and round; the answer is one bit per name. A bin names each anchor, block and window once, whatever
number of its documents have it, so that a passage found everywhere costs one name per bin. Rows that agree in id
and text are one row with a count from the task that reads them on. The
compressed texts are shuffled once; all rounds read that one exchange, and what a round found out about its blocks
goes to the next one of the bin beside the answers, by the blocks' numbers. An exchange hands over its rows in another order
each time it is read, so every round sorts the texts of its bin first (``in_order``). Windows are told apart by 80 bits (a
64-bit name and 16 bits of their anchor's), blocks by 64; for n different windows the odds of one false match are about n**2 / 2**81.
Anchors, for which a false match costs time only, travel as 32 bits.

Bin and bucket sizes follow the total size of the texts, which is summed beforehand. Null ids count as
larger than all others and as equal to one another; rows with equal ids never count for each other.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumberline.llm import tokens as tk

U64 = np.uint64
LAST_ID = np.int64((1 << 63) - 1)
REPEATED, BLOCK, KINDS, WINDOW, CARRIED = 1, 2, 3, 4, 5
ENTRY = "kind int, bucket int, bin int, a binary, b binary, ids binary, at binary"
REPLY = "bin int, kind int, bucket int, flags binary"
ENTRY_ARROW = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("bin", pa.int32())]
    + [(name, pa.binary()) for name in ("a", "b", "ids", "at")]
)
REPLY_ARROW = pa.schema(
    [("bin", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary())]
)


@dataclass(frozen=True)
class Rule:
    """``length`` tokens make a window, ``gram`` tokens an anchor. ``read`` turns the texts of a bin into (token array,
    first token of each text, what ``finish`` needs besides); ``grams(values, gram)`` names all runs of an anchor's length;
    ``windows(values, length, first, last)`` names, at their places in an array, the windows that start in the given ranges."""

    length: int
    gram: int
    read: Callable
    grams: Callable
    windows: Callable
    buckets: int = 64


@dataclass
class Bin:
    """The blocks of one bin; ``doc`` is the number of the text, ``ids`` the id of each text."""

    ids: np.ndarray
    values: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    at: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return self.ids[self.doc]


def pack_texts(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Compress the texts; rows of a batch that agree in id and text become one with their number."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        copies = Counter(zip(batch.column("bin").to_pylist(), batch.column("doc_id").to_pylist(), texts.to_pylist()))
        columns = [pa.array([key[0] for key in copies], pa.int32()), pa.array([key[1] for key in copies], pa.int64())]
        columns.append(pa.array([press.compress(key[2]) for key in copies], pa.binary()))
        columns.append(pa.array(list(copies.values()), pa.int32()))
        yield pa.RecordBatch.from_arrays(columns, ["bin", "doc_id", "z", "copies"])


def unpack_texts(group: pa.Table) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(z.as_buffer()) for z in group.column("z")]


def in_order(group: pa.Table) -> tuple[pa.Array, list[bytes], np.ndarray]:
    """Ids and texts of a bin, each pair once, in the same order in every round; and the place of each row of the group there."""
    rows = list(zip(group.column("doc_id").to_pylist(), unpack_texts(group)))
    ranked = sorted(set(rows), key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    place = {row: n for n, row in enumerate(ranked)}
    ids = pa.array([row[0] for row in ranked], pa.int64())
    return ids, [row[1] for row in ranked], np.array([place[row] for row in rows], dtype=np.int64)


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(int(LAST_ID)).to_numpy().astype(np.int64)


def blocks_of(ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, rule: Rule) -> Bin:
    """Cut the windows of a bin's texts into blocks that share an anchor; ``at`` is the anchor's place."""
    start, doc = tk.windows_within(bounds, rule.length)
    if len(start) == 0:
        none = np.zeros(0, dtype=np.int64)
        return Bin(ids, values, none, none, none, none.astype(U64), none)
    grams = rule.grams(values, rule.gram)
    low = U64(0xFFFFFFFF)  # in bins of any size, so that windows pick the same one of two grams of about equal hashes
    ranked = tk.mix(grams)
    ranked &= ~low
    ranked |= np.arange(len(grams), dtype=U64)
    place = (tk.sliding_min(ranked, rule.length - rule.gram + 1) & low).astype(np.int64)[start]
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    first, last = start[cut], start[np.concatenate([cut[1:], [len(start)]]) - 1]
    return Bin(ids, values, doc[cut], first, last, grams[place[cut]], place[cut])


def groups_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by the keys, the first one first. Gives the order, where groups of equal keys start in it,
    and the group of each sorted entry."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
    for key in keys:
        ranked = key[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


@dataclass
class Named:
    """What a bin sends in a round: one entry per distinct (bucket, a, b), and the entry of each item."""

    bucket: np.ndarray
    a: np.ndarray
    b: np.ndarray
    lowest: np.ndarray
    several: np.ndarray
    entry: np.ndarray


def name_items(bucket: np.ndarray, a: np.ndarray, b: np.ndarray, owner: np.ndarray) -> Named:
    order, starts, group = groups_of(bucket, a, b)
    entry = np.empty(len(order), dtype=np.int64)
    entry[order] = group
    lowest = np.minimum.reduceat(owner[order], starts) if len(order) else owner
    highest = np.maximum.reduceat(owner[order], starts) if len(order) else owner
    head = order[starts]
    return Named(bucket[head], a[head], b[head], lowest, lowest < highest, entry)


def sent(kind: int, number: int, named: Named, with_b: bool, with_ids: bool) -> list[dict]:
    """One row per bucket, with entries in the order of ``named``."""
    rows = []
    cuts = np.flatnonzero(np.concatenate([[True], named.bucket[1:] != named.bucket[:-1]])) if len(named.bucket) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(named.bucket)]):
        row = {"kind": kind, "bucket": int(named.bucket[lo]), "bin": number, "a": named.a[lo:hi].tobytes()}
        if with_b:
            row["b"] = named.b[lo:hi].tobytes()
        if with_ids:
            ids, at = np.unique(named.lowest[lo:hi], return_inverse=True)
            row["ids"] = ids.tobytes()
            row["at"] = at.astype(np.uint16 if len(ids) < 1 << 16 else np.uint32).tobytes()
        rows.append(row)
    return rows


def table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def carried(number: int, *arrays: np.ndarray) -> dict:
    """What the next round of the bin needs to know: flags as bits, numbers byte by byte, so that leading zeros cost nothing."""
    parts = [np.packbits(x) if x.dtype == bool else x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.copy() for x in arrays]
    known = pickle.dumps([(len(x), part) for x, part in zip(arrays, parts)])
    return {"kind": CARRIED, "bucket": number, "bin": number, "a": zstandard.ZstdCompressor(level=1).compress(known)}


def recalled(number: int, replies: dict) -> list[np.ndarray]:
    known = pickle.loads(zstandard.ZstdDecompressor().decompress(replies[CARRIED, number]))
    return [
        np.unpackbits(part, count=n).astype(bool) if part.ndim == 1 else part.T.copy().view(np.uint32).ravel().astype(np.int64)
        for n, part in known
    ]


def marked(size: int, places: np.ndarray) -> np.ndarray:
    flags = np.zeros(size, dtype=bool)
    flags[places] = True
    return flags


def answers(buckets: np.ndarray, kind: int, replies: dict) -> np.ndarray:
    """The bit that came back for each entry of a round."""
    flags = np.zeros(len(buckets), dtype=bool)
    cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(buckets)]):
        bits = replies.get((kind, int(buckets[lo])))
        if bits is not None:
            flags[lo:hi] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=hi - lo)
    return flags


def name_anchors(found: Bin, rule: Rule) -> Named:
    """32 bits of the name besides the bucket's."""
    bucket = ((found.anchor >> U64(32)) % U64(rule.buckets)).astype(np.int32)
    a = (found.anchor & U64(0xFFFFFFFF)).astype(np.uint32)
    return name_items(bucket, a, np.zeros(len(a), dtype=np.uint8), found.owner)


def name_blocks(found: Bin, kept: np.ndarray, windows: np.ndarray, rule: Rule) -> tuple[Named, Named]:
    """Blocks by all of their tokens; and by anchor, to see which anchors stand in different blocks."""
    anchor, owner, first, last = found.anchor[kept], found.owner[kept], found.first[kept], found.last[kept]
    shape = ((found.at[kept] - first) << 32 | (last - first)).astype(U64)
    # Two windows less than a window apart cover all tokens of the block.
    span = tk.join_names(tk.join_names(windows[first], windows[last]), shape)
    key = span ^ (anchor << U64(17) | anchor >> U64(47))
    bucket = (tk.mix(anchor + span * U64(3)) % U64(rule.buckets)).astype(np.int32)
    whole = name_items(bucket, key, np.zeros(len(key), dtype=np.uint8), owner)
    bucket = ((anchor >> U64(32)) % U64(rule.buckets)).astype(np.int32)
    kinds = name_items(bucket, (anchor & U64(0xFFFFFFFF)).astype(np.uint32), span, owner)
    return whole, kinds


def name_windows(found: Bin, blocks: np.ndarray, windows: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, Named]:
    """Every window of the given blocks: its start, its block and its entry."""
    counts = found.last[blocks] - found.first[blocks] + 1
    before = np.cumsum(counts) - counts
    start = np.arange(int(counts.sum())) + np.repeat(found.first[blocks] - before, counts)
    block = np.repeat(blocks, counts)
    name = windows[start] if len(start) else np.zeros(0, dtype=U64)
    bucket = (tk.mix(name) % U64(rule.buckets)).astype(np.int32)
    tag = (found.anchor[block] >> U64(48)).astype(np.uint16)
    return start, block, name_items(bucket, name, tag, found.owner[block])


def ask_blocks(number: int, found: Bin, rule: Rule, replies: dict) -> list[dict]:
    """After the first round: the blocks whose anchor recurs."""
    anchors = name_anchors(found, rule)
    repeated = answers(anchors.bucket, REPEATED, replies) | anchors.several
    kept = np.flatnonzero(repeated[anchors.entry])
    windows = rule.windows(found.values, rule.length, found.first[kept], found.last[kept])
    whole, kinds = name_blocks(found, kept, windows, rule)
    behind = found.owner[kept] > whole.lowest[whole.entry]
    lengths = [np.bincount(named.bucket) for named in (whole, kinds)]
    known = carried(number, marked(len(found.first), kept), behind, whole.entry, kinds.entry, *lengths)
    return [*sent(BLOCK, number, whole, False, True), *sent(KINDS, number, kinds, True, False), known]


def ask_windows(number: int, found: Bin, rule: Rule, replies: dict) -> list[dict]:
    """After the second round: blocks common in full go, and windows of those that share an anchor only are asked for."""
    kept, behind, whole, kinds, whole_lengths, kinds_lengths = recalled(number, replies)
    kept = np.flatnonzero(kept)
    earlier = answers(np.repeat(np.arange(len(whole_lengths)), whole_lengths), BLOCK, replies)[whole]
    contested = answers(np.repeat(np.arange(len(kinds_lengths)), kinds_lengths), KINDS, replies)[kinds]
    gone = earlier | behind
    removed, open_blocks = kept[gone], kept[~gone & contested]
    _, _, named = windows_of(found, open_blocks, rule)
    return [*sent(WINDOW, number, named, True, True), carried(number, *(marked(len(found.first), x) for x in (removed, open_blocks)))]


def windows_of(found: Bin, blocks: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, Named]:
    windows = rule.windows(found.values, rule.length, found.first[blocks], found.last[blocks])
    return name_windows(found, blocks, windows, rule)


def removed_windows(number: int, found: Bin, rule: Rule, replies: dict) -> tuple[np.ndarray, np.ndarray]:
    """After the third round: first and last window start of every run of windows to remove."""
    removed, open_blocks = (np.flatnonzero(flags) for flags in recalled(number, replies))
    start, block, named = windows_of(found, open_blocks, rule)
    earlier = answers(named.bucket, WINDOW, replies)[named.entry]
    single = start[earlier | (found.owner[block] > named.lowest[named.entry])]
    return np.concatenate([found.first[removed], single]), np.concatenate([found.last[removed], single])


def removal_mask(number: int, found: Bin, n_tokens: int, rule: Rule, replies: dict) -> np.ndarray:
    first, last = removed_windows(number, found, rule, replies)
    step = np.zeros(n_tokens + 1, dtype=np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last + rule.length, -1)
    return np.cumsum(step[:-1]) > 0


def settle(key: tuple, group: pa.Table) -> pa.Table:
    """Compare what all bins sent to a bucket; one bit per entry goes back."""
    kind, bucket = key[0].as_py(), key[1].as_py()
    if kind == CARRIED:
        return group.select(["bin", "kind", "bucket", "a"]).rename_columns(REPLY_ARROW.names)
    wide = {REPEATED: np.uint32, KINDS: np.uint32}.get(kind, np.uint64)
    parts = [np.frombuffer(x.as_buffer(), dtype=wide) for x in group.column("a")]
    sizes = [len(x) for x in parts]
    a = np.concatenate(parts)
    if kind in (BLOCK, WINDOW):
        owner = np.concatenate(
            [
                np.frombuffer(i.as_buffer(), dtype=np.int64)[
                    np.frombuffer(x.as_buffer(), dtype=np.uint16 if len(i.as_buffer()) < 8 << 16 else np.uint32)
                ]
                for i, x in zip(group.column("ids"), group.column("at"))
            ]
        )
    if kind in (KINDS, WINDOW):
        wide_b = np.uint64 if kind == KINDS else np.uint16
        b = np.concatenate([np.frombuffer(x.as_buffer(), dtype=wide_b) for x in group.column("b")])
    flags = np.zeros(len(a), dtype=bool)
    if kind == REPEATED:
        order, starts, member = groups_of(a)
        flags[order] = (np.diff(np.append(starts, len(a))) > 1)[member]
    elif kind == KINDS:
        order, starts, member = groups_of(a)
        ranked = b[order]
        differs = np.minimum.reduceat(ranked, starts) < np.maximum.reduceat(ranked, starts)
        flags[order] = differs[member]
    else:
        order, starts, member = groups_of(a) if kind == BLOCK else groups_of(a, b)
        ranked = owner[order]
        flags[order] = ranked > np.minimum.reduceat(ranked, starts)[member]
    cuts = np.cumsum([0, *sizes])
    rows = [
        {"bin": n, "kind": kind, "bucket": bucket, "flags": np.packbits(flags[lo:hi]).tobytes()}
        for n, lo, hi in zip(group.column("bin").to_pylist(), cuts[:-1], cuts[1:])
    ]
    return table(rows, REPLY_ARROW)


def replies_of(group: pa.Table) -> dict:
    columns = [group.column(name).to_pylist() for name in ("kind", "bucket", "flags")]
    return {(kind, bucket): flags for kind, bucket, flags in zip(*columns)}


def recurring_windows(docs: DataFrame, rule: Rule, finish: Callable, schema: str) -> DataFrame:
    """Run the rounds over ``docs`` (doc_id long, text). ``finish(ids, texts, values, bounds, mask)``
    makes the rows of a bin from the tokens and the mask of those to remove, as an Arrow table."""
    # A bin holds about 1 MB of text, up to 8 MB where there is so much that bins would get too many.
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(max(total >> 13, 1 << 20), 1 << 23)
    bins = int(total // size) + 1
    rule = replace(rule, buckets=max(64, bins // 64))

    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(bins)).cast("int")
    rows = docs.select(number.alias("bin"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    binned = rows.mapInArrow(pack_texts, "bin int, doc_id long, z binary, copies int")
    texts = binned.groupBy("bin")

    def first_round(key: tuple, group: pa.Table) -> pa.Table:
        ids, raw, _ = in_order(group)
        values, bounds, _ = rule.read(raw)
        named = name_anchors(blocks_of(ids_of(ids), values, bounds, rule), rule)
        return table(sent(REPEATED, key[0].as_py(), named, False, False), ENTRY_ARROW)

    def asked(ask: Callable) -> Callable:
        def later_round(key: tuple, group: pa.Table, back: pa.Table) -> pa.Table:
            ids, raw, _ = in_order(group)
            values, bounds, _ = rule.read(raw)
            found = blocks_of(ids_of(ids), values, bounds, rule)
            return table(ask(key[0].as_py(), found, rule, replies_of(back)), ENTRY_ARROW)

        return later_round

    def last_round(key: tuple, group: pa.Table, back: pa.Table) -> pa.Table:
        ids, raw, place = in_order(group)
        values, bounds, more = rule.read(raw)
        found = blocks_of(ids_of(ids), values, bounds, rule)
        mask = removal_mask(key[0].as_py(), found, len(values), rule, replies_of(back))
        return finish(ids, raw, bounds, more, mask).take(place).append_column("copies", group.column("copies"))

    def settled(entries: DataFrame) -> DataFrame:
        return entries.groupBy("kind", "bucket").applyInArrow(settle, REPLY)

    one = settled(texts.applyInArrow(first_round, ENTRY))
    two = settled(texts.cogroup(one.groupBy("bin")).applyInArrow(asked(ask_blocks), ENTRY))
    three = settled(texts.cogroup(two.groupBy("bin")).applyInArrow(asked(ask_windows), ENTRY))
    made = texts.cogroup(three.groupBy("bin")).applyInArrow(last_round, f"{schema}, copies int")
    columns = [name for name in made.columns if name != "copies"]
    return made.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*columns)
