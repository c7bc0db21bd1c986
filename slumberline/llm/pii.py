"""Personal data, and the terms that give it away.

First the entities themselves: e-mail and IP addresses, card and phone numbers, by pattern. Then the
terms that disclose an entity without naming it: in the documents that hold an entity e, a term t tells
as much about e as its pointwise mutual information PMI(e, t) = log(n(e, t) N / (n(e) n(t))), against the
information that e itself carries, IC(e) = log(N / n(e)). A term whose PMI reaches the share
``generalise`` of IC(e) is replaced by its shape, from the share ``remove`` on it is removed. Counts are
documents of the whole corpus. An entity and a pair must be found in ``support`` different texts, or
every rare word next to an address would count as evidence.

Most entities are in one text only, so terms are counted against classes of entities as well: the kind, the domain
of an e-mail address, the first two and three parts of an IP address, the issuer's digits of a card, a phone
number without its last four and seven digits. For a class it must also be unlikely, by ``CHANCE``, that so many
different texts hold both by accident: the Chernoff bound of a Poisson tail, k log(k / m) - (k - m) for k
texts where m = n(e) n(t) / N are expected.

Terms are looked for in all documents: where one stands without its entity, it gives it away just as well.

Positions come without Python: a text split at a pattern gives what stands between the matches, so
running sums of both lengths are the offsets in code points. Where a pattern repeats a group, the
separators inside a number or address are first replaced by a mark (one code point for one), so that it
becomes a plain run of characters: the regular expression engine then neither recurses nor tries a
position twice. Running sums and maxima are taken by doubling, in log(matches) passes over the array, and parts of a text from
blocks of it, so a text takes time in proportion to its length, but for that logarithm.

Defined results: a null text is empty; a null or repeated doc_id changes nothing, as each row is looked at
by itself; a text without matches has an empty list; spans that overlap are replaced together, as the one that starts first (of
these the longest, ties by kind); very long texts are worked on whole; other columns are ignored, whatever their names;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumberline.session import materialize

GENERALISE = 0.8
REMOVE = 0.95
SUPPORT = 3
CHANCE = 1e-6
KINDS = ("email", "ip", "card", "phone")
TERM = r"\p{L}{3,}"
MARK, OTHER, DASH = "\u0001", "\u0002", "\u0003"
# Code points of a block, from which parts of a text are cut.
BLOCK = 4096
# Tables of up to this many rows are broadcast.
BROADCAST_ROWS = 50_000
LABEL = "A-Za-z0-9-"
LOCAL = "A-Za-z0-9._%+" + MARK + "-"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _no_mark(text: Column) -> Column:
    return F.translate(text, MARK + DASH, OTHER + OTHER)


def bound_to(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where ``use`` has it inside a function of array elements."""
    return F.aggregate(F.array(F.lit(0)), value, lambda bound, _: bound, use)


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of an array, by doubling the number of added elements."""
    steps = F.ceil(F.log2(F.size(values).cast("double"))).cast("int")

    def doubled(done: Column, step: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), step)
        return F.transform(done, lambda x, i: F.when(i >= reach, add(x, F.get(done, i - reach))).otherwise(x))

    return F.when(F.size(values) < 2, values).otherwise(F.aggregate(F.sequence(F.lit(0), steps - 1), values, doubled))


def _spans(found: Column, between: Column, kind: str, value: Callable[[Column], Column]) -> Column:
    """Matches with their offsets: the match ends where it and all before it, matches and gaps, are added up."""
    lengths = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, match: F.length(gap) + F.length(match))
    return F.zip_with(
        found,
        running(lengths, lambda one, other: one + other),
        lambda match, end: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(match)).alias("start"), end.alias("end"), value(match).alias("value")
        ),
    )


def _pieces(marked: Column, pattern: Column, kind: str, value: Callable[[Column], Column] = lambda match: match) -> Column:
    """All matches of ``pattern`` in ``marked``, with offsets; ``value`` undoes the marks of a match."""
    found = F.regexp_extract_all(marked, pattern, F.lit(0))
    return bound_to(found, lambda found: _spans(found, F.split(marked, pattern, -1), kind, value))


def _when(possible: Column, spans: Column) -> Column:
    return F.when(possible, spans).otherwise(F.array().cast(SPAN))


# A local part starts where no such character stands before, or where the match before ended.
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++{MARK}[{LABEL}{MARK}]++"


def _dots_marked(text: Column) -> Column:
    """A dot between two label characters becomes a mark; the host is then a run that holds one."""
    return F.regexp_replace(_no_mark(text), rf"(?<=[{LABEL}])\.(?=[{LABEL}])", MARK)


def emails(text: Column) -> Column:
    spans = _pieces(_dots_marked(text), F.lit(EMAIL), "email", lambda match: F.translate(match, MARK, "."))
    return _when(F.contains(text, F.lit("@")), spans)


def ips(text: Column) -> Column:
    pattern = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
    spans = _pieces(text, F.lit(pattern), "ip")
    parts = lambda s: F.transform(F.split(s["value"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    fits = lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255")
    return _when(F.regexp_like(text, F.lit(pattern)), F.filter(spans, lambda s: F.forall(parts(s), fits)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def cards(text: Column) -> Column:
    """A match of the pattern is a whole run of digits with single separators between them. Only runs of 13 to
    19 digits can pass, so no other run is taken up."""
    marked = F.regexp_replace(_no_mark(text), r"(?<=[0-9]) (?=[0-9])", MARK)
    marked = F.regexp_replace(marked, r"(?<=[0-9])-(?=[0-9])", DASH)
    marks = MARK + DASH
    pattern = rf"(?<![0-9{marks}])[0-9](?:[{marks}]?[0-9]){{12,18}}+(?![0-9{marks}])"
    spans = _pieces(marked, F.lit(pattern), "card", lambda match: F.translate(match, marks, " -"))
    return _when(F.regexp_like(marked, F.lit(pattern)), F.filter(spans, lambda s: luhn(digits(s["value"]))))


def phones(text: Column) -> Column:
    pattern = r"\+[0-9][ ().0-9-]+[0-9]"
    spans = _pieces(text, F.lit(pattern), "phone")
    fits = lambda s: F.length(digits(s["value"])).between(9, 15)
    return _when(F.contains(text, F.lit("+")), F.filter(spans, fits))


def entities(text: Column) -> Column:
    """All entities of a text by kind, then start."""
    return F.concat(emails(text), ips(text), cards(text), phones(text))


def without_addresses(text: Column) -> Column:
    """The text with spaces in place of its e-mail addresses, as long as before. Other entities have no letters, so no
    term overlaps them."""
    marked, pattern = _dots_marked(text), F.lit(EMAIL)
    found = F.transform(F.regexp_extract_all(marked, pattern, F.lit(0)), lambda match: F.repeat(F.lit(" "), F.length(match)))
    pieces = F.zip_with(F.split(marked, pattern, -1), found, lambda gap, blank: F.concat(gap, F.coalesce(blank, F.lit(""))))
    plain = F.translate(F.array_join(pieces, ""), MARK, ".")
    return F.when(F.contains(text, F.lit("@")), plain).otherwise(text)


def terms(text: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def names_of(span: Column) -> Column:
    """The entity of a span, ``kind:value``, and the classes it belongs to, ``kind/level:value``."""
    kind, value = span["kind"], span["value"]
    number = digits(value)
    parts = {
        "email": [("domain", F.lower(F.substring_index(value, "@", -1)))],
        "ip": [("24", F.substring_index(value, ".", 3)), ("16", F.substring_index(value, ".", 2))],
        "card": [("issuer", F.substring(number, 1, 6))],
        "phone": [("line", number.substr(F.lit(1), F.length(number) - 4)), ("area", number.substr(F.lit(1), F.length(number) - 7))],
    }
    levels = F.array().cast("array<string>")
    for name in KINDS:
        own = F.array(*[F.concat(F.lit(f"{name}/{level}:"), part) for level, part in parts[name]])
        levels = F.when(kind == name, own).otherwise(levels)
    return F.concat(F.array(F.concat(kind, F.lit(":"), value), F.concat(kind, F.lit("/kind:"))), levels)


def small(rows: DataFrame) -> DataFrame:
    """A stored table, broadcast where it has few rows."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def revealing_terms(docs: DataFrame, holders: DataFrame, generalise: float, support: int) -> DataFrame:
    """``term`` and ``share``, the largest one: the terms that disclose an entity or a class of entities.

    ``holders`` has a stored row for each of the ``docs`` (text) that has spans: row, spans, text and ``unit``, the text's name.
    """
    n = F.lit(float(docs.count()))
    entity = F.explode(F.array_distinct(F.flatten(F.transform("spans", names_of))))
    named = holders.select("row", "unit", entity.alias("entity"))
    often = (
        named.groupBy("entity", "unit").agg(F.count(F.lit(1)).alias("docs"))
        .groupBy("entity").agg(F.sum("docs").alias("n_entity"), F.count(F.lit(1)).alias("units"))
        .filter(F.col("units") >= support).drop("units")
    )
    # Every holder of an address has the class of addresses: such a name is no key to shuffle by.
    protected = named.join(small(materialize(often, "pii")), "entity")
    # Rows with equal texts hold the same pairs, so these are counted once for each text, with its number of rows.
    of_text = holders.groupBy("unit").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("docs"))
    words = holders.select("row", F.explode(terms(without_addresses(F.col("text")))).alias("term"))
    pairs = (
        protected.join(of_text.select("row", "docs"), "row").join(words, "row")
        .groupBy("entity", "term", "n_entity").agg(F.sum("docs").alias("n_both"), F.count(F.lit(1)).alias("units"))
        .filter(F.col("units") >= support)
    )
    pairs = materialize(pairs, "pii")
    every = docs.select(F.explode(terms("text")).alias("term"))
    # Counted within each task before anything moves; the join comes after.
    counts = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    pmi = F.log(F.col("n_both") * n / (F.col("n_entity") * F.col("n_term")))
    known = F.log(n / F.col("n_entity"))
    told = pairs.join(counts, "term").withColumn("share", F.when(known > 0, pmi / known).otherwise(F.lit(0.0)))
    chance = F.col("n_entity") * F.col("n_term") / n
    surprise = F.col("units") * F.log(F.col("units") / chance) - (F.col("units") - chance)
    exact = ~F.col("entity").rlike("^[a-z]+/")
    shown = exact | ((F.col("units") > chance) & (surprise >= -math.log(CHANCE)))
    told = told.filter((F.col("share") >= generalise) & shown)
    return materialize(told.groupBy("term").agg(F.max("share").alias("share")), "pii")


def with_told(rows: DataFrame, revealing: DataFrame) -> DataFrame:
    """Add ``told``, the revealing terms of each row (doc_id, text) with their shares; null without any. Rows equal in id
    and text get equal results, so the two name a row."""
    held = terms(without_addresses(F.col("text")))
    keyed = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    told = keyed.select("doc_id", "digest", F.explode(held).alias("term")).join(small(revealing), "term")
    told = told.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set(F.struct("term", "share"))).alias("told"))
    told = small(materialize(told.withColumnsRenamed({"doc_id": "told_id", "digest": "told_digest"}), "pii"))
    same = F.col("doc_id").eqNullSafe(F.col("told_id")) & (F.col("digest") == F.col("told_digest"))
    return keyed.join(told, same, "left").select("doc_id", "text", "told")


def find(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``base`` spans, ``added`` spans of terms (kind ``term`` or
    ``removed``), and ``sanitised`` text, which is null where nothing has to change."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    spans = rows.select("text", entities(text).alias("spans"))
    found = spans.filter(F.size("spans") > 0).select(
        "spans", "text", F.xxhash64("text").alias("unit"), F.monotonically_increasing_id().alias("row")
    )
    revealing = revealing_terms(rows.select("text"), materialize(found, "pii"), generalise, support)
    # Both are looked for once more, rather than kept: that moves and stores no texts.
    joined = with_told(rows, revealing).withColumn("spans", entities(F.col("text")))
    # Terms are letters only, so they can stand in a pattern as they are.
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.col("told")["term"], "|"), F.lit(r")(?!\p{L})"))
    shares = F.map_from_entries("told")
    added = F.transform(
        _pieces(without_addresses(F.col("text")), pattern, "term"),
        lambda s: F.struct(
            F.when(F.coalesce(F.element_at(shares, F.lower(s["value"])), F.lit(0.0)) >= remove, "removed").otherwise("term").alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
        ),
    )
    result = joined.select(
        "doc_id", "text", F.col("spans").alias("base"), _when(F.col("told").isNotNull(), added).alias("added")
    )
    return result.select("doc_id", "base", "added", sanitised(F.col("text"), F.concat("base", "added")).alias("sanitised"))


def blocks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` on, from the blocks that hold them."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((start + length) / BLOCK).cast("int")
    held = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.substring(held, start - first * BLOCK + 1, length)


def sanitised(text: Column, spans: Column) -> Column:
    """Replace the spans: entities by their kind, terms by their length. Spans that overlap are replaced together, by
    what stands for the one that starts first, the longer one among equals."""
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))
    ends = lambda ordered: running(F.transform(ordered, lambda s: -s["less"]), lambda one, other: F.greatest(one, other))

    def written(kind: Column, length: Column) -> Column:
        letters = F.concat(F.lit("["), length.cast("string"), F.lit(" letters]"))
        return F.when(kind == "removed", "").when(kind == "term", letters).otherwise(F.concat(F.lit("["), F.upper(kind), F.lit("]")))

    def replaced(ordered: Column, upto: Column, heads: Column, blocks: Column) -> Column:
        """``upto``: where all spans up to each end. ``heads``: those that start behind all before them."""

        def piece(head: Column, k: Column) -> Column:
            before = F.when(head == 0, 0).otherwise(F.get(upto, head - 1))
            last = F.coalesce(F.get(heads, k + 1), F.size(ordered)) - 1
            span = F.get(ordered, head)
            length = F.get(upto, last) - span["start"]
            return F.concat(part_of(blocks, before, span["start"] - before), written(span["kind"], length))

        end = F.get(upto, F.size(ordered) - 1)
        return F.concat(F.array_join(F.transform(heads, piece), ""), part_of(blocks, end, F.length(text) - end))

    def with_ends(ordered: Column) -> Column:
        def with_heads(upto: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(ordered) - 1)
            heads = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i)["start"] >= F.get(upto, i - 1)))
            return bound_to(heads, lambda heads: bound_to(blocks_of(text), lambda blocks: replaced(ordered, upto, heads, blocks)))

        return bound_to(ends(ordered), with_heads)

    return F.when(F.size(spans) > 0, bound_to(in_order, with_ends))


def span_list(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
