"""Document fingerprints by I-Match over several randomised lexicons, in built-in functions only.

The lexicon holds the terms of a band of inverse document frequency, ``MIN_IDF`` to ``MAX_IDF``, counted over all
documents. A document of T distinct terms adds T to the sum of all document frequencies, and a lexicon term takes at
least N * exp(-MAX_IDF) of it, so a lexicon has at most exp(MAX_IDF) times the mean T terms, however many documents
there are: it is a literal of the plan. Each slot of a fingerprint belongs to a random subset of the lexicon, and
holds a hash of the document's distinct terms in that subset, in sorted order. Subsets of four sizes let short and
long texts share slots after an edit.

Two fingerprints are as alike as the share of equal slots among those that are filled in either. A text without terms
of the band fills all slots from all its terms.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.llm.base import query, table

MIN_IDF, MAX_IDF = 2.3, 5.8
SHARES = (3, 5, 7, 9)  # a subset of scale i holds 2 ** -SHARES[i] of the lexicon
SLOTS_PER_SCALE = 15
ENOUGH = 10
SLOTS = len(SHARES) * SLOTS_PER_SCALE
INDEX = 16_384
GROUP_ROWS = 1024
QUANTILES = 4096
TERM_BREAK = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct runs of letters and digits in lower case; null counts as empty."""
    return F.filter(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), TERM_BREAK)), lambda t: t != "")


def subsets(term: Column) -> Column:
    """Bit s is set if the term belongs to the subset of slot s."""
    mask = F.lit(0).cast("long")
    for scale, share in enumerate(SHARES):
        part = F.lit((1 << SLOTS_PER_SCALE) - 1).cast("long")
        for i in range(share):
            part = part.bitwiseAND(F.xxhash64(term, F.lit(scale), F.lit(i)))
        mask = mask.bitwiseOR(F.shiftleft(part, scale * SLOTS_PER_SCALE))
    return mask


def lexicon(docs: DataFrame, text: str = "text") -> Column:
    """The terms of the band and their subsets, as a literal: slots of maps, found by the hash of a term."""
    n = docs.count()
    frequency = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").count()
    idf = F.log(F.lit(float(max(n, 1))) / F.col("count"))
    rows = (frequency.where((idf >= MIN_IDF) & (idf <= MAX_IDF))
            .select("term", subsets(F.col("term")).alias("mask"), F.pmod(F.xxhash64("term"), F.lit(INDEX)).alias("at")))
    index: list[dict[str, int]] = [{} for _ in range(INDEX)]
    for r in rows.where("mask <> 0").collect():
        index[r["at"]][r["term"]] = r["mask"]
    return F.from_json(F.lit(json.dumps(index, separators=(",", ":"))), "array<map<string,bigint>>")


def fingerprint(text: Column, index: Column) -> Column:
    """Slots as an array of numbers below 2^32; zero for a slot without terms."""
    def mask(t: Column) -> Column:
        return F.element_at(F.element_at(index, F.pmod(F.xxhash64(t), F.lit(INDEX)).cast("int") + 1), t)

    def short(joined: Column) -> Column:
        h = F.shiftrightunsigned(F.xxhash64(joined), 32)
        return F.when(h == 0, 1).otherwise(h)

    def with_terms(found: Column) -> Column:
        held = F.array_sort(F.filter(F.transform(found, lambda t: F.struct(t.alias("t"), mask(t).alias("m"))),
                                     lambda x: x["m"].isNotNull()))

        def slots(kept: Column) -> Column:
            some = F.flatten(F.array(*[_scale(kept, i, short) for i in range(len(SHARES))]))
            return _let(some, lambda s: F.when(F.exists(s, lambda x: x != 0), s).otherwise(
                F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)),
                            lambda k: short(F.concat_ws(" ", k.cast("string"), F.array_sort(found))))))

        return _let(held, slots)

    return _let(terms(text), with_terms)


def _scale(kept: Column, i: int, short) -> Column:
    """The slots of one scale; terms of none of its subsets are left aside first."""
    bits = ((1 << SLOTS_PER_SCALE) - 1) << (i * SLOTS_PER_SCALE)
    some = F.filter(kept, lambda x: x["m"].bitwiseAND(F.lit(bits)) != 0)
    numbers = F.sequence(F.lit(i * SLOTS_PER_SCALE), F.lit((i + 1) * SLOTS_PER_SCALE - 1))
    return _let(some, lambda part: F.transform(numbers, lambda s: _let(
        F.filter(part, lambda x: F.getbit(x["m"], s) == 1),
        lambda own: F.when(F.size(own) == 0, F.lit(0).cast("long"))
        .otherwise(short(F.array_join(F.transform(own, lambda x: x["t"]), " "))))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those filled in either, 0 to 1.

    Small subsets survive an edit best, but hold a term of long texts only: scales are taken from the smallest subsets
    on, until ``ENOUGH`` slots are filled, or all.
    """
    both = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), None).otherwise(x == y))

    def share(pairs: Column) -> Column:
        from_scale = [F.filter(F.slice(pairs, i * SLOTS_PER_SCALE + 1, SLOTS), lambda x: x.isNotNull())
                      for i in reversed(range(len(SHARES)))]
        wide = F.coalesce(*[F.when(F.size(f) >= ENOUGH, f) for f in from_scale], from_scale[-1])
        return _let(wide, lambda f: F.when(F.size(f) == 0, 1.0).otherwise(F.size(F.filter(f, lambda x: x)) / F.size(f)))

    return _let(both, share)


def as_text(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def grouped(docs: DataFrame, doc_id: str) -> DataFrame:
    """``docs`` with ``_group``: numbers that fall as ids fall, of about ``GROUP_ROWS`` rows; null ids come last.

    Quantiles of the ids part the table, equal steps between two quantiles part it further, so a table of any size has
    small groups.
    """
    n = docs.count()
    parts = max(1, min(QUANTILES, math.ceil(n / GROUP_ROWS)))
    steps = max(1, math.ceil(n / GROUP_ROWS / parts))
    points = [i / parts for i in range(parts + 1)]
    bounds = docs.agg(F.percentile_approx(doc_id, points, 10 * QUANTILES)).first()[0] or [0, 0]
    low = sorted(set(bounds))
    high = [*low[1:], low[-1] + 1]
    edges, tops = F.array(*[F.lit(x) for x in low]), F.array(*[F.lit(x) for x in high])
    part = F.greatest(F.size(F.filter(edges, lambda x: x <= F.col(doc_id))), F.lit(1))
    inside = (F.col(doc_id) - F.element_at(edges, part)) / (F.element_at(tops, part) - F.element_at(edges, part))
    step = F.least(F.greatest(F.floor(inside * steps), F.lit(0)), F.lit(steps - 1))
    of_null = -1 - F.pmod(F.xxhash64("text"), F.lit(64))
    return docs.withColumn("_group", F.when(F.col(doc_id).isNull(), of_null).otherwise(part * steps + step).cast("long"))


def with_next(docs: DataFrame, index: Column) -> DataFrame:
    """``docs`` (doc_id, text) with ``slots``, ``next_text`` and ``next_slots`` of the next row by falling id.

    After the last row comes the first; equal ids follow one another by text. The next row is looked for within a
    group; a group's last row gets the first row of the next group that has any.
    """
    order = Window.partitionBy("_group").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    placed = grouped(docs, "doc_id")
    inside = (placed.withColumn("slots", fingerprint(F.col("text"), index))
              .withColumn("_next", F.lead(F.struct("text", "slots")).over(order)))
    heads = (placed.withColumn("_n", F.row_number().over(order)).where("_n = 1")
             .select(F.col("_group").alias("_follows"), F.struct("text", fingerprint(F.col("text"), index).alias("slots")).alias("_head")))
    down = Window.orderBy(F.desc("_group"))  # over one row for each group
    follows = placed.groupBy("_group").count().select("_group", F.coalesce(
        F.lead("_group").over(down), F.first("_group").over(down)).alias("_follows"))
    across = follows.join(heads, "_follows").select("_group", "_head")
    return (inside.join(across, "_group").withColumn("_next", F.coalesce("_next", "_head"))
            .select("doc_id", "text", "slots", F.col("_next.text").alias("next_text"), F.col("_next.slots").alias("next_slots")))


def compare_edits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For each row of ``docs``: its fingerprint, that of its edited text, and how like both and the next document are.

    The edited text has its last third (rounded down, in code points) replaced by the beginning of the next document's
    text, by falling id. Null texts count as empty.
    """
    index = lexicon(docs, text)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    paired = with_next(own, index).withColumn("edited", edited)
    done = paired.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "slots",
                         "next_slots", F.explode(F.array(fingerprint(F.col("edited"), index))).alias("edited_slots"))
    return done.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("slots")).alias("fingerprint"),
                       as_text(F.col("edited_slots")).alias("edited_fingerprint"),
                       likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
                       likeness(F.col("slots"), F.col("next_slots")).alias("near_next"))


@query("op7_fingerprints")
def op7_fingerprints(spark, folder):
    return compare_edits(table(spark, folder, "documents", "doc_id", "text"))
