"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A text's features are its shingles of five words, weighed by count times ``1 + min(log(N / df), log 2)``. The
document frequency is counted over all documents in 2**18 hashed slots, copies included; the bound on the
logarithm lets only what more than half of the documents share weigh less, so that members of a group of
copies with up to half of the rows are as similar as they would be in a mixed corpus. Two texts are linked if the weighted Jaccard similarity
of their features, sum of minima over sum of maxima, is 0.8 or more; classes are the connected components.

1. Exact copies are one text (128 bits of MD5), which is sampled and stored compressed once.
2. ``BANDS * ROWS`` samples per text. A sample is the feature with the least
   ``log c - r (t - b + 1)`` with ``t = floor(log(weight) / r + b)`` (Ioffe 2010), and two texts have the same
   feature and t with the probability of their similarity. The random r, c, b of a feature are looked up
   by a hash of the feature in a table of 65,536 draws. At similarity 0.8 a pair shares a band with
   probability 0.9998.
3. Texts that share a band are candidates. What a text shares with any other candidate bounds what it shares
   with one of them: all of its weight that others have, less the least weight for each feature whose
   bit, in a set of 1,024, the other text lacks. The bound is close, so copies that differ too much drop
   out before a pair of them is made. It needs one exchange of packed 32-bit names (``recurring``).
4. In buckets of up to ``SMALL`` texts all pairs that the bound allows are compared. In larger ones every text is
   paired with the ``CENTRES`` most central ones, which is linear in the bucket's size. Texts outside the
   bucket's largest class then meet ``MORE_CENTRES`` of its texts, and at last all texts of other classes
   that the bound allows: every pair of the bucket is settled, or in one class already.
5. Candidates are verified on the whole texts.

Where rows meet by a bucket, a class or a text that many of them share, they are dealt over parts of that key, and its one
row, or few, goes to each part.

Components: nodes take the name of their least neighbour and links are renamed until none is left; tables are
written between the rounds, and nothing but counts reaches the driver.

Defined results: texts of fewer than five words have one shingle of all their words; null counts as empty,
and texts without words are no duplicates of anything, each a class of its own; ``class_id`` is the least
id of a class (null if it has none), and one row of a class is kept, also among rows with one id or none; rows that agree in id and text are copies; other columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slumberline.llm import recurring
from slumberline.llm import tokens as tk
from slumberline.llm.columns import put_back, set_aside
from slumberline.session import materialize

U64 = np.uint64
SHINGLE = 5
# Names that the columns of documents may not have meanwhile.
INTERNAL = ("_c", "_n", "_id", "_cid")
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
SMALL, CENTRES, MORE_CENTRES = 16, 4, 16
SET_WORDS = 16
# Parts over which the rows of one key are dealt, and rows of a text or a bucket that make a part of their own.
PARTS, PART_ROWS = 64, 1024
SLOT_BITS, CHUNK_BITS = 18, 12
IDF_LIMIT = float(np.log(2))
DRAW_BITS = 16
SEED = 31


def shingles(buffer: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text, in the order of the texts: name, text, count."""
    starts, ends, bounds = tk.word_spans(buffer, places)
    names = tk.word_names(buffer, starts, ends)
    at, doc = tk.windows_within(bounds, SHINGLE)
    long = tk.rolling_hashes(names, SHINGLE)[at] if len(at) else np.zeros(0, dtype=U64)
    counts = np.diff(bounds)
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    short = tk.mix(tk.run_hashes(names, bounds[few], bounds[few + 1])) if len(few) else np.zeros(0, dtype=U64)
    name, doc = np.concatenate([long, short]), np.concatenate([doc, few])
    order = np.lexsort((name, doc))
    name, doc = name[order], doc[order]
    new = np.ones(len(name), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return name[first], doc[first], np.diff(np.append(first, len(name)))


def frequency_task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Documents per slot of one partition, in chunks; chunk -1 holds the number of documents."""
    table = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    docs = 0
    for batch in batches:
        buffer, places = tk.text_buffer(batch.column("text"))
        docs += batch.num_rows
        for lo, hi in tk.slices(places):
            name, doc, _ = shingles(buffer[places[lo] : places[hi]], places[lo : hi + 1] - places[lo])
            slot = np.unique(doc.astype(np.int64) << SLOT_BITS | (name >> U64(64 - SLOT_BITS)).astype(np.int64))
            table += np.bincount(slot & ((1 << SLOT_BITS) - 1), minlength=len(table))
    size = 1 << CHUNK_BITS
    chunks = [(i, table[i * size : (i + 1) * size]) for i in range(len(table) // size)]
    chunks = [(i, c) for i, c in chunks if c.any()] + [(-1, np.array([docs], dtype=np.int64))]
    columns = [pa.array([i for i, _ in chunks], pa.int32()), pa.array([c.tobytes() for _, c in chunks], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["chunk", "counts"])


def sum_chunks(key: tuple, group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_buffer(), dtype=np.int64) for c in group.column("counts"))
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The weight of every slot: a table of fixed size, 1 MB."""
    schema = "chunk int, counts binary"
    sums = docs.select("text").mapInArrow(frequency_task, schema).groupBy("chunk").applyInArrow(sum_chunks, schema)
    table, n = np.zeros(1 << SLOT_BITS, dtype=np.int64), 0
    for chunk, counts in sums.collect():
        counts = np.frombuffer(counts, dtype=np.int64)
        if chunk < 0:
            n = int(counts[0])
        else:
            table[chunk << CHUNK_BITS : (chunk + 1) << CHUNK_BITS] = counts
    known = np.log(max(n, 1) / np.maximum(table, 1))
    return (1 + np.clip(known, 0, IDF_LIMIT)).astype(np.float32)


def weights_of(name: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return count.astype(np.float32) * idf[(name >> U64(64 - SLOT_BITS)).astype(np.int64)]


def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, log c and b of the table."""
    random = np.random.default_rng(SEED)
    n = 1 << DRAW_BITS
    r, c = random.gamma(2, 1, n), random.gamma(2, 1, n)
    return r.astype(np.float32), np.log(c).astype(np.float32), random.random(n).astype(np.float32)


def ranks(index: np.ndarray, weight: np.ndarray, table: tuple) -> tuple[np.ndarray, np.ndarray]:
    r, log_c, b = (column[index] for column in table)
    t = np.floor(np.log(weight) / r + b)
    return log_c - r * (t - b + 1), t


def ordered(value: np.ndarray) -> np.ndarray:
    """32-bit floats as integers that sort alike."""
    bits = value.astype(np.float32).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(U64)


def sample(name: np.ndarray, doc: np.ndarray, weight: np.ndarray, n: int, table: tuple) -> np.ndarray:
    """The band keys of ``n`` texts; texts without features have zeros."""
    keys = np.zeros((n, BANDS), dtype=U64)
    if len(name) == 0:
        return keys
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    texts = doc[first]
    # Most features have the weight of a rare shingle found once: for it the ranks are looked up.
    usual = np.float32(1 + IDF_LIMIT)
    all_draws = np.arange(1 << DRAW_BITS)
    usual_rank, usual_t = ranks(all_draws, np.full(len(all_draws), usual), table)
    usual_rank = ordered(usual_rank) << U64(32)
    odd = np.flatnonzero(weight != usual)
    place = np.arange(len(name), dtype=U64)
    for band in range(BANDS):
        key = np.full(len(texts), band + 1, dtype=U64)
        for row in range(ROWS):
            # An odd multiplier of its own for every sample.
            k = U64((2 * (band * ROWS + row) + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1)
            index = ((name * k) >> U64(64 - DRAW_BITS)).astype(np.int32)
            rank = usual_rank[index]
            if len(odd):
                own, own_t = ranks(index[odd], weight[odd], table)
                rank[odd] = ordered(own) << U64(32)
            rank |= place
            least = (np.minimum.reduceat(rank, first) & U64(0xFFFFFFFF)).astype(np.int64)
            t = usual_t[index[least]]
            rare = weight[least] != usual
            if rare.any():
                t = np.where(rare, ranks(index[least], weight[least], table)[1], t)
            key = tk.join_names(key, name[least] + t.astype(np.int64).astype(U64))
        keys[texts, band] = key
    return keys


def sign_task(idf: np.ndarray, table: tuple):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            buffer, places = tk.text_buffer(batch.column("text"))
            for lo, hi in tk.slices(places):
                part, at = buffer[places[lo] : places[hi]], places[lo : hi + 1] - places[lo]
                name, doc, count = shingles(part, at)
                keys = sample(name, doc, weights_of(name, count, idf), hi - lo, table)
                some = np.flatnonzero(keys.any(axis=1))
                bands = pa.FixedSizeListArray.from_arrays(pa.array(keys[some].astype(np.int64).ravel()), BANDS)
                packed = [press.compress(part[at[i] : at[i + 1]].tobytes()) for i in some]
                columns = [batch.column("cid").slice(lo, hi - lo).take(pa.array(some)).cast(pa.binary())]
                columns += [bands.cast(pa.list_(pa.int64())), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["cid", "bands", "z"])

    return sign


def similarity(one: tuple, other: tuple) -> float:
    """Weighted Jaccard of two (sorted names, weights)."""
    _, i, j = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(one[1][i], other[1][j]).sum(dtype=np.float64))
    return shared / max(float(one[1].sum(dtype=np.float64) + other[1].sum(dtype=np.float64)) - shared, 1e-9)


def verify_task(idf: np.ndarray, least: float):
    def features(z: bytes) -> tuple:
        buffer = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), dtype=np.uint8)
        name, _, count = shingles(buffer, np.array([0, len(buffer)]))
        return name, weights_of(name, count, idf)

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            kept = []
            for n in range(batch.num_rows):
                a = batch.column("a")[n].as_buffer().to_pybytes()
                if a != last:
                    last, known = a, features(batch.column("za")[n].as_buffer())
                if similarity(known, features(batch.column("zb")[n].as_buffer())) >= least:
                    kept.append(n)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return verify


def features_of(group: pa.Table, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a bin's texts: name, text, weight."""
    raw = recurring.unpack_texts(group)
    places = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    name, doc, count = shingles(np.frombuffer(b"".join(raw), dtype=np.uint8), places)
    return name, doc, weights_of(name, count, idf)


def bit_sets(name: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` texts a set of bits, one for each feature, as 64-bit words."""
    bit = (tk.mix(name) >> U64(54)).astype(np.int64)
    marks = np.zeros((n, 64 * SET_WORDS), dtype=bool)
    marks[doc, bit] = True
    return np.packbits(marks, axis=1).view(np.int64)


def shared_weights(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """Per text ``w`` (weight of all features), ``k`` (of those that another of the texts has, too), the ``least``
    weight of one of these, and their ``bits``. A false match of the 32-bit names could only loosen the bound."""
    bins = int((texts.agg(F.sum(F.octet_length("z"))).first()[0] or 0) // (1 << 19)) + 1
    buckets = max(64, bins // 64)
    binned = texts.select(F.pmod(F.xxhash64("cid"), F.lit(bins)).cast("int").alias("bin"), "cid", "z").groupBy("bin")

    def named(name: np.ndarray, doc: np.ndarray) -> recurring.Named:
        bucket = ((name >> U64(32)) % U64(buckets)).astype(np.int32)
        low = (name & U64(0xFFFFFFFF)).astype(np.uint32)
        return recurring.name_items(bucket, low, np.zeros(len(low), dtype=np.uint8), doc)

    def send(key: tuple, group: pa.Table) -> pa.Table:
        name, doc, _ = features_of(group, idf)
        rows = recurring.sent(recurring.REPEATED, key[0].as_py(), named(name, doc), False, False)
        return recurring.table(rows, recurring.ENTRY_ARROW)

    def weigh(key: tuple, group: pa.Table, back: pa.Table) -> pa.Table:
        name, doc, weight = features_of(group, idf)
        entries = named(name, doc)
        found = recurring.answers(entries.bucket, recurring.REPEATED, recurring.replies_of(back)) | entries.several
        found = found[entries.entry]
        n = group.num_rows
        every = np.bincount(doc, weights=weight, minlength=n)
        shared = np.bincount(doc, weights=weight * found, minlength=n)
        least = np.full(n, np.inf)
        np.minimum.at(least, doc[found], weight[found].astype(np.float64))
        bits = bit_sets(name[found], doc[found], n).ravel()
        sets = pa.FixedSizeListArray.from_arrays(pa.array(bits), SET_WORDS).cast(pa.list_(pa.int64()))
        columns = [group.column("cid"), pa.array(every), pa.array(shared), pa.array(least), sets]
        return pa.table(columns, names=["cid", "w", "k", "least", "bits"])

    entries = binned.applyInArrow(send, recurring.ENTRY)
    replies = entries.groupBy("kind", "bucket").applyInArrow(recurring.settle, recurring.REPLY)
    schema = "cid binary, w double, k double, least double, bits array<long>"
    return binned.cogroup(replies.groupBy("bin")).applyInArrow(weigh, schema)


def shared_at_most(one: str, other: str) -> Column:
    """Weight of ``one`` that ``other`` can have."""
    bits = lambda side, i: F.col(f"{side}.bits")[i]
    lacking = [F.bit_count(bits(one, i).bitwiseAND(F.bitwise_not(bits(other, i)))) for i in range(SET_WORDS)]
    return F.col(f"{one}.k") - F.col(f"{one}.least") * sum(lacking[1:], lacking[0])


def may_be_similar(least: float) -> Column:
    """The bound; the weights of both texts alone are looked at first."""
    total = F.col("x.w") + F.col("y.w")
    rough = F.least("x.k", "y.k")
    close = F.least(shared_at_most("x", "y"), shared_at_most("y", "x"))
    enough = F.lit(least - 1e-6)
    return (rough >= enough * (total - rough)) & (close >= enough * (total - close))


def dealt(rows: DataFrame, found: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with what ``found``, one row per ``key``, has for their key. The rows of a key are dealt over ``PARTS`` parts
    by a hash of ``by``, so that no task gets the whole of a large group."""
    parted = rows.withColumn("part", F.pmod(F.xxhash64(by), F.lit(PARTS)))
    wanted = parted.select(key, "part").distinct().join(found, key)
    return parted.join(wanted, [key, "part"]).drop("part")


def parts_of(n: Column) -> Column:
    """The parts of a group of ``n`` rows."""
    return F.ceil(n / PART_ROWS)


def each_part(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))


def pairs(left: DataFrame, right: DataFrame, least: float, apart: bool = False, few: bool = False) -> DataFrame:
    """Texts of ``left`` with those of ``right`` in the same bucket that the bound allows, each pair once.
    With ``apart`` only texts of different labels. ``few`` tells that a bucket has few texts in ``right``: they
    go to all parts over which the texts of a large bucket are dealt."""
    parts = parts_of(F.col("n")) if few else F.lit(1).cast("bigint")
    left = left.withColumn("part", F.pmod(F.xxhash64("cid"), parts))
    right = right.select("*", each_part(parts).alias("part"))
    differ = F.col("x.label") != F.col("y.label") if apart else F.col("x.cid") != F.col("y.cid")
    here = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.part") == F.col("y.part"))
    same = here & differ & may_be_similar(least)
    joined = left.alias("x").join(right.alias("y"), same)
    return joined.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()


def verified(candidates: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """The candidate pairs (a, b) that are similar enough, stored. A text with many pairs goes to several tasks."""
    both, sent = candidates, {}
    for side, other in (("b", "a"), ("a", "b")):
        parts = candidates.groupBy(side).agg(parts_of(F.count(F.lit(1))).alias("parts"))
        own = texts.select(F.col("cid").alias(side), F.col("z").alias(f"z{side}")).join(parts, side)
        sent[side] = own.select(side, f"z{side}", each_part(F.col("parts")).alias(f"part_{side}"))
        both = dealt(both, parts, side, other)
        both = both.withColumn(f"part_{side}", F.pmod(F.xxhash64(other), F.col("parts"))).drop("parts")
    for side, texts_of_side in sent.items():
        both = both.join(texts_of_side, [side, f"part_{side}"])
    both = both.select("a", "b", "za", "zb")
    return materialize(both.mapInArrow(verify_task(idf, least), "a binary, b binary"), "links")


def components(links: DataFrame) -> DataFrame:
    """``cid`` and ``label`` for all texts with links (a, b); equal labels within a component; stored.

    Each round every node takes the name of the least node next to it, and the links are renamed. A node and
    the node it is named after stay linked by the link between them, so nothing comes apart, and links
    within a name vanish; few rounds are left with any.
    """
    swapped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = materialize(links.select("a", "b").unionByName(swapped).filter("a != b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("cid"), F.col("a").alias("label")).distinct()
    while edges.limit(1).count():
        least = edges.groupBy(F.col("a").alias("old")).agg(F.least(F.min("a"), F.min("b")).alias("new"))
        least = materialize(least, "least")
        labels = labels.join(least, labels["label"] == least["old"], "left")
        labels = materialize(labels.select("cid", F.coalesce("new", "label").alias("label")), "labels")
        renamed = edges.join(least, edges["a"] == least["old"]).select(F.col("new").alias("a"), "b")
        renamed = renamed.join(least, renamed["b"] == least["old"]).select("a", F.col("new").alias("b"))
        edges = materialize(renamed.filter("a != b").distinct(), "edges")
    return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels with more links: only classes are linked anew."""
    of_a = labels.select(F.col("cid").alias("a"), F.col("label").alias("of_a"))
    of_b = labels.select(F.col("cid").alias("b"), F.col("label").alias("of_b"))
    between = links.join(of_a, "a", "left").join(of_b, "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    found = components(between)
    renamed = found.select(F.col("cid").alias("old"), F.col("label").alias("new"))
    known = labels.join(renamed, labels["label"] == renamed["old"], "left")
    known = known.select("cid", F.coalesce("new", "label").alias("label"))
    return materialize(known.unionByName(found.join(labels, "cid", "left_anti")), "labels")


def central(members: DataFrame, n: int) -> DataFrame:
    """Of every bucket the ``n`` texts that have the least of their own and are nearest to the mean weight: the
    likeliest partners of all others. Spark keeps the first ``n`` of each task before the shuffle, so no bucket
    is gathered."""
    means = members.groupBy("bucket").agg(F.avg(F.log("w")).alias("mean"))
    off = (1 - F.col("k") / F.col("w")) + F.abs(F.log("w") - F.col("mean"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("off", "cid"))
    ranked = dealt(members, means, "bucket", "cid").withColumn("off", off).withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= n).select(*members.columns)


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with texts of several classes, with their ``label`` and the largest, ``main``."""
    labelled = members.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    parts = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("part"))
    largest = F.max(F.struct("part", "label"))["label"].alias("main")
    main = parts.groupBy("bucket").agg(largest, F.count(F.lit(1)).alias("parts")).filter(F.col("parts") > 1)
    return materialize(dealt(labelled, main.drop("parts"), "bucket", "cid"), "apart")


def shared_buckets(members: DataFrame) -> DataFrame:
    """The members of buckets that hold several texts, with their number ``n``."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dealt(members, sizes, "bucket", "cid")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id``, ``cid`` (MD5 of the text), ``class_id``, and whether it is ``kept``."""
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", F.unhex(F.md5(text.cast("binary"))).alias("cid"), text.alias("text"))
    idf = inverse_frequencies(named)
    signed = named.select("cid", "text").mapInArrow(sign_task(idf, draws()), "cid binary, bands array<long>, z binary")
    texts = materialize(signed.groupBy("cid").agg(F.first("bands").alias("bands"), F.first("z").alias("z")), "texts")

    members = shared_buckets(texts.select("cid", F.explode("bands").alias("bucket"))).drop("n")
    members = materialize(members, "buckets")
    here = materialize(texts.select("cid", "z").join(members.select("cid").distinct(), "cid", "left_semi"), "candidate-texts")
    shares = shared_weights(here, idf).filter(F.col("k") >= F.lit(least - 1e-6) * F.col("w"))
    members = materialize(shared_buckets(members.join(shares, "cid")), "buckets")

    small, large = members.filter(F.col("n") <= SMALL), members.filter(F.col("n") > SMALL)
    with_central = pairs(large, central(large, CENTRES), least, few=True)
    candidates = pairs(small, small, least).unionByName(with_central).distinct()
    candidates = materialize(candidates, "candidates")
    links = verified(candidates, here, idf, least)
    labels = components(links)

    # Large buckets in which texts are still apart: whoever isn't of the largest class meets more of its
    # central texts, and at last all texts of other classes.
    for some in (True, False):
        labelled = apart(large, labels)
        strays, main = F.col("label") != F.col("main"), F.col("label") == F.col("main")
        others = central(labelled.filter(main), MORE_CENTRES) if some else labelled
        rest = pairs(labelled.filter(strays), others, least, apart=True, few=some)
        rest = rest.join(candidates, ["a", "b"], "left_anti")
        rest = materialize(rest, "candidates")
        more = verified(rest, here, idf, least)
        if more.limit(1).count():
            labels = merged(labels, more)
        candidates = candidates.unionByName(rest)

    # Of a class that row stays whose id is least; among rows with the same id, or none, the least cid decides.
    ids = materialize(named.select("doc_id", "cid", F.monotonically_increasing_id().alias("row")), "ids")
    lowest = ids.groupBy("cid").agg(F.min("doc_id").alias("lowest"))
    first = F.min(F.struct(F.col("lowest").isNull().alias("none"), "lowest", "cid"))
    of_label = labels.join(lowest, "cid").groupBy("label").agg(first.alias("first"))
    linked = dealt(labels, of_label, "label", "cid").select("cid", "first")
    own = F.struct(F.col("lowest").isNull().alias("none"), "lowest", "cid")
    of_cid = lowest.join(linked, "cid", "left").select("cid", F.coalesce("first", own).alias("first"))
    # Texts without words were not signed.
    of_cid = of_cid.join(texts.select("cid", F.lit(True).alias("signed")), "cid", "left")
    joined = dealt(ids, of_cid, "cid", "row")
    stays = F.col("doc_id").eqNullSafe(F.col("first.lowest")) & (F.col("cid") == F.col("first.cid"))
    return joined.select(
        "doc_id",
        "cid",
        F.when(F.col("signed"), F.col("first.lowest")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("signed"), stays).otherwise(F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: of every class the document with the least id, once."""
    found = classes(docs, least).filter("kept")
    docs, aside = set_aside(docs, INTERNAL)
    found = found.select(F.col("doc_id").alias("_id"), F.col("cid").alias("_cid")).distinct()
    cid = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    keyed = docs.withColumn("_c", cid)
    once = Window.partitionBy("doc_id", "_c").orderBy(F.lit(0))
    match = keyed["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_c") == F.col("_cid"))
    kept = keyed.withColumn("_n", F.row_number().over(once)).filter("_n = 1").join(found, match, "left_semi")
    return put_back(kept.select(*docs.columns), aside)
