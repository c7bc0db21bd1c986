"""Quality of documents: fixed rules, and a classifier over hashed word and character n-grams.

The classifier is a logistic regression. Its features are the relative frequencies of word 1- and 2-grams
and of byte 3- and 4-grams, each kind hashed into 65,536 slots, so that a score is a mean of looked-up
weights per kind and needs no table of n-grams. It is fitted in one task on a bounded sample of
the labelled documents: of each class the ``SAMPLE_PER_CLASS`` with the smallest hash of the id, whole texts.
A fifth of the sample is held out; on it the scores are calibrated to probabilities (Platt scaling, with the
classes weighed as they stand in all labels) and the accuracy is measured. The driver gets the weights
(1 MB, whatever the input) and ships them with the scoring tasks, which work on Arrow batches.

A document is kept if it passes the rules and its probability of good quality is at least ``KEEP_FROM``.

Defined results: a null or empty text has no words and fails the rules; a document that is labelled twice
counts as bad if one label says so, null labels say nothing; without labels of both classes the rules
decide alone; null and repeated ids are scored like others; other columns are carried through, and
columns with the names of the results are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slumberline.llm import tokens as tk
from slumberline.llm.arithmetic import mixed32
from slumberline.session import materialize

U64 = np.uint64
SAMPLE_PER_CLASS = 1500
HELD_OUT = 5
SAMPLE_KEY = 271828
SLOT_BITS = 16
ROUNDS = 120
RATE = 0.3
PENALTY = 1e-4
SCALE = 30.0
KEEP_FROM = 0.5
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*COUNTS, "base_failed", "probability", "kept")


def slots(buffer: np.ndarray, places: np.ndarray, names: np.ndarray, bounds: np.ndarray) -> list[tuple]:
    """For each kind of n-gram the slot at every position, and first and last position of each text."""
    shift = U64(64 - SLOT_BITS)
    wide = buffer.astype(np.uint32)
    found = []
    for n in (3, 4):
        last = np.maximum(places[1:] - n + 1, places[:-1])
        if len(wide) >= n:
            gram = wide[: len(wide) - n + 1].copy()
            for i in range(1, n):
                gram |= wide[i : len(wide) - n + 1 + i] << np.uint32(8 * i)
            gram *= np.uint32(0x9E3779B1)
            found.append(((gram >> np.uint32(32 - SLOT_BITS)).astype(np.int32), places[:-1], last))
        else:
            found.append((np.zeros(0, np.int32), np.zeros_like(last), np.zeros_like(last)))
    found.append(((names >> shift).astype(np.int32), bounds[:-1], bounds[1:]))
    if len(names) > 1:
        pairs = tk.join_names(names[:-1], names[1:])
        last = np.maximum(bounds[1:] - 1, bounds[:-1])
        found.append(((pairs >> shift).astype(np.int32), bounds[:-1], last))
    else:
        found.append((np.zeros(0, np.int32), np.zeros_like(bounds[1:]), np.zeros_like(bounds[1:])))
    return found


def scores(kinds: list[tuple], weights: np.ndarray) -> np.ndarray:
    """Sum over the kinds of the mean weight of a text's n-grams."""
    total = np.zeros(len(kinds[0][1]))
    for (slot, first, last), table in zip(kinds, weights):
        sums = np.concatenate([[0.0], np.cumsum(table[slot], dtype=np.float64)])
        total += SCALE * (sums[last] - sums[first]) / np.maximum(last - first, 1)
    return total


def per_text(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[places[1:]] - sums[places[:-1]]


def repeated_words(names: np.ndarray, bounds: np.ndarray, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Words per text in windows that the text holds twice or more."""
    start, doc = tk.windows_within(bounds, width)
    if len(start) == 0:
        return np.zeros(len(bounds) - 1, dtype=np.int64)
    key = tk.rolling_hashes(names, width)[start] ^ tk.mix(doc.astype(U64))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(names) + 1, dtype=np.int64)
    np.add.at(step, start[twice], 1)
    np.add.at(step, start[twice] + width, -1)
    return per_text(np.cumsum(step[:-1]) > 0, bounds)


def repeated_lines(buffer: np.ndarray, places: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines per text that hold a word and equal an earlier line."""
    n = len(places) - 1
    breaks = np.flatnonzero(buffer == 10)
    starts = np.unique(np.concatenate([places[:-1], breaks + 1]))
    starts = starts[starts < len(buffer)]
    if len(starts) == 0:
        return np.zeros(n, dtype=np.int64)
    ends = np.concatenate([starts[1:], [len(buffer)]])
    ends = ends - (buffer[ends - 1] == 10)
    words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    starts, ends = starts[words > 0], ends[words > 0]
    doc = np.searchsorted(places, starts, "right") - 1
    hashes = tk.mix(tk.run_hashes(tk.byte_values()[buffer], starts, ends) + (ends - starts).astype(U64))
    order = np.lexsort((hashes, doc))
    again = (hashes[order[1:]] == hashes[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    return np.bincount(doc[order[1:][again]], minlength=n).astype(np.int64)


def measure(buffer: np.ndarray, places: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The counts of each text; names of all words and the first word of each text."""
    starts, ends, bounds = tk.word_spans(buffer, places)
    names = tk.word_names(buffer, starts, ends)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    visible = ~tk.space_flags()[buffer] & ((buffer & 0xC0) != 0x80)
    counts = {
        "n_words": np.diff(bounds),
        "word_chars": per_text(visible, places),
        "n_symbols": per_text(symbol[buffer], places),
        "n_dup_lines": repeated_lines(buffer, places, starts),
        "n_repeat_words": repeated_words(names, bounds),
    }
    return counts, names, bounds


def entries(kinds: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, value and text of all that the texts of one slice hold, kind by kind."""
    size = 1 << SLOT_BITS
    index, value, doc = [], [], []
    for k, (slot, first, last) in enumerate(kinds):
        counts = last - first
        before = np.cumsum(counts) - counts
        pair = slot[np.arange(int(counts.sum())) + np.repeat(first - before, counts)].astype(np.int64)
        pair += np.repeat(np.arange(len(counts), dtype=np.int64) * size, counts)
        pair, times = np.unique(pair, return_counts=True)
        text = pair // size
        index.append((pair % size + k * size).astype(np.int32))
        value.append((SCALE * times / counts[text]).astype(np.float32))
        doc.append(text.astype(np.int32))
    return np.concatenate(index), np.concatenate(value), np.concatenate(doc)


def fit(features: Iterable[list[tuple]], labels: np.ndarray) -> np.ndarray:
    """Weights of the logistic regression: full-batch Adam from zero, so the same sample gives the same model.

    Of a slice only the entries stay, and each round goes through them slice by slice, so beside them no array is as
    long as the sample."""
    size = 1 << SLOT_BITS
    parts, done = [], 0
    for kinds in features:
        here = slice(done, done + len(kinds[0][1]))
        parts.append((here, *entries(kinds)))
        done = here.stop
    share = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    w, bias = np.zeros(4 * size), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        error, gradient = np.zeros(len(labels)), np.zeros_like(w)
        for here, index, value, doc in parts:
            margin = np.bincount(doc, weights=value * w[index], minlength=here.stop - here.start) + bias
            error[here] = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[here]) * share[here]
            # Adds one by one in this order, so the sums don't hang on how the slices are cut off from each other.
            np.add.at(gradient, index, value * error[here][doc])
        gradient += PENALTY * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.999 * vb + 0.001 * error.sum() ** 2
        rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        bias -= rate * mb / (np.sqrt(vb) + 1e-8)
    return w.reshape(4, size).astype(np.float32)


def calibrate(margin: np.ndarray, labels: np.ndarray, good_share: float) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps. Targets are smoothed, so that a perfect
    separation gives finite figures; the classes count as in all labels."""
    good, bad = max((labels == 1).sum(), 1), max((labels == 0).sum(), 1)
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    weight = np.where(labels == 1, good_share / good, (1 - good_share) / bad) * len(labels)
    spread = margin.std() or 1.0
    x = np.stack([(margin - margin.mean()) / spread, np.ones_like(margin)], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * theta
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        theta -= np.clip(move, -2, 2)
    return float(theta[0] / spread), float(theta[1] - theta[0] * margin.mean() / spread)


MODEL_SCHEMA = "weights binary, slope double, offset double, n_train long, n_held_out long, accuracy double"


def train_task(good_share: float):
    def train(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        if rows.num_rows == 0:
            return
        rows = rows.sort_by("doc_id")
        buffer, places = tk.text_buffer(rows.column("text"))
        labels = rows.column("quality").to_numpy().astype(np.float64)
        held = np.arange(len(labels)) % HELD_OUT == HELD_OUT - 1
        if len(np.unique(labels[~held])) < 2:
            return

        def features() -> Iterable[tuple[list[tuple], np.ndarray]]:
            """The slots of one slice at a time, and which of its texts are trained on."""
            for lo, hi in tk.slices(places):
                part, at = buffer[places[lo] : places[hi]], places[lo : hi + 1] - places[lo]
                starts, ends, bounds = tk.word_spans(part, at)
                yield slots(part, at, tk.word_names(part, starts, ends), bounds), ~held[lo:hi]

        taken = ([(slot, first[keep], last[keep]) for slot, first, last in kinds] for kinds, keep in features())
        weights = fit(taken, labels[~held])
        margin = np.concatenate([scores(kinds, weights) for kinds, _ in features()])
        # Few labels leave no class, or one, in the held-out part: then the training rows set the scale.
        scale = held if len(np.unique(labels[held])) == 2 else ~held
        slope, offset = calibrate(margin[scale], labels[scale], good_share)
        right = ((slope * margin[held] + offset >= 0) == (labels[held] == 1)).mean() if held.any() else 0.0
        yield pa.RecordBatch.from_pydict(
            {
                "weights": pa.array([weights.tobytes()], pa.binary()),
                "slope": [slope],
                "offset": [offset],
                "n_train": [int((~held).sum())],
                "n_held_out": [int(held.sum())],
                "accuracy": [float(right)],
            }
        )

    return train


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The model as a stored table of one row, or none if a class is missing."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = known.agg(F.count(F.lit(1)), F.sum((F.col("quality") != 0).cast("long"))).first()
    good_share = (counts[1] or 0) / max(counts[0], 1)
    order = mixed32(F.col("doc_id").cast("bigint"), SAMPLE_KEY)
    classes = [
        known.filter(known["quality"] == F.lit(0) if bad else known["quality"] != F.lit(0))
        .orderBy(order, "doc_id")
        .limit(per_class)
        for bad in (True, False)
    ]
    sample = classes[0].unionByName(classes[1])
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    picked = picked.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    picked = picked.withColumn("quality", (F.col("quality") != 0).cast("int")).coalesce(1)
    return materialize(picked.mapInArrow(train_task(good_share), MODEL_SCHEMA), "quality-model")


def score_task(model: dict | None, carry: Sequence[str], schema: pa.Schema):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        weights = np.frombuffer(model["weights"], dtype=np.float32).reshape(4, -1) if model else None
        for batch in batches:
            buffer, places = tk.text_buffer(batch.column("text"))
            for lo, hi in tk.slices(places):
                part, at = buffer[places[lo] : places[hi]], places[lo : hi + 1] - places[lo]
                counts, names, bounds = measure(part, at)
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
                )
                if model:
                    margin = model["slope"] * scores(slots(part, at, names, bounds), weights) + model["offset"]
                    probability = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                else:
                    probability = np.ones(hi - lo)
                here = batch.slice(lo, hi - lo)
                columns = [here.column(name) for name in carry]
                columns += [pa.array(counts[name].astype(np.int64)) for name in COUNTS]
                columns += [pa.array(failed), pa.array(probability), pa.array(~failed & (probability >= KEEP_FROM))]
                arrays = [c.cast(f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return score


def assess(docs: DataFrame, model: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """Add the counts, ``base_failed``, ``probability`` and ``kept`` to the ``carry`` columns (all) of ``docs``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = [name for name in (docs.columns if carry is None else carry) if name not in RESULT]
    kinds = [T.LongType()] * len(COUNTS) + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    added = [T.StructField(name, kind) for name, kind in zip(RESULT, kinds)]
    schema = T.StructType([docs.schema[name] for name in carry] + added)
    row = model.first()
    task = score_task(row.asDict() if row else None, carry, to_arrow_schema(schema))
    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(task, schema)
