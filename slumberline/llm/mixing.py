"""Mix sources to target weights by hash thresholds.

A document's place in its source is a 60-bit hash of its id and text. Taking the documents whose hash is below a
threshold takes a reproducible share, and a larger budget only adds to a smaller one: the threshold of the
second copy of a source lies inside that of the first. A threshold is found without sorting: sum the
words per source and hash bucket (1,024 rows for a source, added up before the shuffle), find the
bucket in which the budget ends, and sum that bucket alone by the next ten bits, until it holds one
document. The documents are then filtered by a comparison.

Targets: weights are dealt to the sources in code point order (null last) and share ``share`` of all
words; no target exceeds ``repeats`` times its source, and what is cut off goes to the other sources by
weight until none is above. That end state is found directly: in the order of cap per weight, a
source is capped as long as its cap is below its share of what the capped ones before it leave.

Defined results: a null text has size 0; null is a source of its own, and a null id an id like others; rows equal in id and
text are copies at one place, and where the budget ends among them, as many are taken as come nearest to it (which of them
is open, they are equal but for other columns); otherwise a document is taken where the budget covers at least half of it, so a source's
words miss its target by half a document at most, where no target is cut off; very long texts are counted by Spark's regular
expressions, whole, in linear time; an empty table gives an empty table; other columns are carried through unchanged, whatever
their names, but for columns with the names of the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slumberline.llm.arithmetic import mixed32
from slumberline.llm.columns import numbered_copies, put_back, set_aside
from slumberline.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
HASH_KEYS = (40507, 7919)
BITS, DIGIT = 60, 10
WORD = r"[^\x20\x09-\x0D]+"
# The table of thresholds has one row per source; up to this many are broadcast.
BROADCAST_SOURCES = 100_000
RESULT = ("size", "source_size", "target", "copies", "taken")
# Names that the input's columns may not have meanwhile.
INTERNAL = ("whole", "threshold", "last_place", "last_copies", "copy", "_place", "_plan", "_edge", "_file", "_row", "_part", "_n", "_within", "_first", "_of_0", "_of_part")


def n_words(text: str = "text") -> Column:
    return F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("bigint")


def place(doc_id: str = "doc_id", text: str = "text") -> Column:
    """60 bits of hash of an id and 60 bits of the text's MD5. A null id hashes like -1, a null text like an empty one."""
    low62 = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-1).cast("bigint")).bitwiseAND(F.lit((1 << 62) - 1))
    digest = F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")
    high, low = (mixed32(low62.bitwiseXOR(digest), key) for key in HASH_KEYS)
    return F.shiftleft(high, BITS - 32).bitwiseOR(F.shiftright(low, 64 - BITS))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size). All windows run over these few rows."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("bigint"))
    cap = F.col("source_size") * F.lit(repeats)
    everything = Window.partitionBy()
    by_need = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    later = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = weighed.select(
        "source",
        "source_size",
        "weight",
        cap.alias("cap"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("budget"),
        F.coalesce(F.sum(cap).over(earlier), F.lit(0)).alias("given"),
        F.sum("weight").over(later).alias("open_weight"),
    )
    rest = (F.col("budget") - F.col("given")) / F.col("open_weight")
    ranked = ranked.withColumn("rest", rest).withColumn("capped", F.col("cap") <= F.col("rest") * F.col("weight"))
    # The sources that aren't capped share what is left where the first of them stands.
    level = F.min_by("rest", F.when(~F.col("capped"), F.col("given")))
    ranked = ranked.withColumn("level", level.over(everything))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("level") * F.col("weight")).cast("double")
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(places: DataFrame, budgets: DataFrame, few: bool) -> DataFrame:
    """Per source the hash below which documents are taken so that their words come to ``budget``.

    ``places``: source, place, size (stored). ``budgets``: source, budget, at most the source's size.
    """
    none = F.lit(0).cast("bigint")
    state = budgets.select("source", "budget", none.alias("prefix"), none.alias("base"))
    for done in range(DIGIT, BITS + 1, DIGIT):
        inside = state.select(F.col("source").alias("_source"), "budget", F.col("prefix").alias("_prefix"), "base")
        same = places["source"].eqNullSafe(F.col("_source"))
        same &= F.shiftright("place", BITS - done + DIGIT) == F.col("_prefix")
        digits = F.shiftright("place", BITS - done).alias("prefix")
        sums = (
            places.join(F.broadcast(inside) if few else inside, same)
            .groupBy("source", "budget", "base", digits)
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
        )
        upto = F.col("base") + F.sum("words").over(Window.partitionBy("source").orderBy("prefix"))
        # The first bucket whose end lies beyond the budget; none where the budget is the whole source.
        over = sums.withColumn("upto", upto).filter(F.col("upto") > F.col("budget"))
        first = F.min(F.struct("prefix", (F.col("upto") - F.col("words")).alias("base"), "words", "docs"))
        state = over.groupBy("source", "budget").agg(first.alias("at")).select("source", "budget", "at.*")
        state = materialize(state, "mix")
        if not state.filter(F.col("docs") > 1).limit(1).count():
            break
    # A bucket of one document goes in if the budget covers half of it at least; of copies at one place as many
    # as come nearest.
    fits = 2 * F.col("base") + F.col("words") <= 2 * F.col("budget")
    edge = F.shiftleft(F.col("prefix") + (fits & (F.col("docs") == 1)).cast("bigint"), BITS - done)
    share = (F.col("budget") - F.col("base")) * F.col("docs") / F.col("words")
    several = F.col("docs") > 1
    return state.select(
        F.col("source").alias("_edge"),
        edge.alias("threshold"),
        F.when(several, F.col("prefix")).alias("last_place"),
        F.when(several, F.ceil(share - 0.5)).cast("bigint").alias("last_copies"),
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """Add size, source_size, target, copies (long) and taken (size times copies) to every document."""
    docs, aside = set_aside(docs.drop(*RESULT), INTERNAL)
    places = docs.select("source", place().alias("place"), n_words().alias("size"))
    places = materialize(places, "mix")
    sizes = places.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, share, repeats)
    # Whole copies of the source first, then the documents below the threshold once more.
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", F.least(whole, F.lit(repeats)).cast("bigint"))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan, "mix")
    few = plan.count() <= BROADCAST_SOURCES
    edges = thresholds(places, plan.filter(F.col("whole") < repeats).select("source", "budget"), few)
    edges = materialize(edges, "mix")
    plan = plan.join(edges, plan["source"].eqNullSafe(edges["_edge"]), "left").drop("_edge", "budget")
    plan = plan.withColumnRenamed("source", "_plan")
    sized = docs.withColumn("size", n_words()).withColumn("_place", place())
    joined = sized.join(F.broadcast(plan) if few else plan, sized["source"].eqNullSafe(plan["_plan"]))
    at_edge = F.coalesce(F.col("_place") == F.col("last_place"), F.lit(False))
    once_more = F.coalesce(F.col("_place") < F.col("threshold"), F.lit(False))
    if edges.filter("last_place IS NOT NULL").limit(1).count():
        last = numbered_copies(joined.filter(at_edge), ["source"], "copy")
        last = last.withColumn("copies", F.col("whole") + (F.col("copy") < F.col("last_copies")).cast("bigint")).drop("copy")
        others = joined.filter(~at_edge).withColumn("copies", F.col("whole") + once_more.cast("bigint"))
        joined = others.unionByName(last)
    else:
        joined = joined.withColumn("copies", F.col("whole") + once_more.cast("bigint"))
    result = joined.withColumn("taken", F.col("size") * F.col("copies"))
    return put_back(result.select(*docs.columns, *RESULT), aside)
