"""Mixing sources to target weights by a low-discrepancy schedule.

The words of a source, its documents in a hashed order, are cut into blocks of equal length (shorter ones where a source
is small). The mix is a row of slots. Slot n maps the golden-ratio point frac(n / phi) through the cumulative target
weights, counted in blocks, to a source, so every stretch of slots holds the sources in about their weights. The r-th slot of a source takes its block r modulo the
number of blocks; a source that runs out starts again. Ranks come from counts per chunk of slots, offsets from sums
per bucket of documents, so neither a large source nor the row of slots is ever ordered in one task.

Sources are the entries of a mixture: one row each of names, sizes and targets reaches the driver, never documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.llm.base import content_key, query, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST_REPEATS = 2
BLOCK_WORDS = 128
BLOCKS_OF_LEAST = 64
MOST_SLOTS = 1 << 26
BUCKET_ROWS = 4096
SLOT_CHUNK = 1 << 16
GOLDEN = (math.sqrt(5) - 1) / 2


@dataclass(frozen=True)
class Share:
    """What the mix asks of one source: its place in the order of sources, rows, words, words to take."""
    place: int
    source: str | None
    rows: int
    size: int
    target: float


def targets(sizes: list[int], weights=WEIGHTS, share=SHARE, most=MOST_REPEATS) -> list[float]:
    """Words to take of each source: ``share`` of all sizes by weight, at most ``most`` times a source's size.

    What a full source can't take goes to the others by weight, until none is above its limit.
    """
    left, open_, out = share * sum(sizes), dict(enumerate(sizes)), [Fraction(0)] * len(sizes)
    weight = [Fraction(weights[i % len(weights)]) for i in range(len(sizes))]
    while open_:
        unit = left / sum(weight[i] for i in open_)
        full = [i for i in open_ if unit * weight[i] > most * sizes[i]]
        for i in full or list(open_):
            out[i] = Fraction(most * sizes[i]) if full else unit * weight[i]
            left -= out[i]
            del open_[i]
    return [float(x) for x in out]


def block_sizes(mixture: list[Share]) -> list[int]:
    """Words of a block of each source: ``BLOCK_WORDS``, or more where the whole mix would have above ``MOST_SLOTS`` slots;
    for a source too small for that, fewer, so that it has about ``BLOCKS_OF_LEAST`` slots (or one a word) all the same."""
    most = max(BLOCK_WORDS, math.ceil(sum(m.target for m in mixture) / MOST_SLOTS))
    return [max(1, min(most, int(m.target / BLOCKS_OF_LEAST))) for m in mixture]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(sized: DataFrame, source: str) -> list[Share]:
    """The mixture: sources by code point with null last."""
    rows = sized.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n"), F.sum("_size").alias("size")).collect()
    rows.sort(key=lambda r: (r["s"] is None, r["s"] or ""))
    wanted = targets([r["size"] for r in rows])
    return [Share(i, r["s"], r["n"], r["size"], t) for i, (r, t) in enumerate(zip(rows, wanted, strict=True))]


def laid_out(sized: DataFrame, mixture: list[Share], source: str, *identity: Column) -> DataFrame:
    """``sized`` with ``_place`` of its source, its ``_source_size`` and ``_target``, and ``_start``: the words of the
    source that stand before the document in the hashed order of ``identity``."""
    spark = sized.sparkSession
    names = spark.createDataFrame([(m.place, m.source, m.size, m.target, max(1, math.ceil(m.rows / BUCKET_ROWS))) for m in mixture],
                                  "_place int, _name string, _source_size long, _target double, _buckets long")
    # one row for each source, made from a list on the driver: without the hint texts would be shuffled by their source
    hashed = sized.join(F.broadcast(names), F.col(source).eqNullSafe(F.col("_name"))).withColumn("_hash", F.xxhash64(*identity))
    # the hash's upper 31 bits choose the bucket, so buckets follow one another in the hash's unsigned order
    upper = F.shiftrightunsigned("_hash", 33)
    hashed = hashed.withColumn("_bucket", F.shiftright(upper * F.col("_buckets"), 31)).drop("_name", "_buckets")
    before = Window.partitionBy("_place").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (hashed.groupBy("_place", "_bucket").agg(F.sum("_size").alias("_sum"))
            .select("_place", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first")))
    inside = Window.partitionBy("_place", "_bucket").orderBy(upper, "_hash", "_size").rowsBetween(Window.unboundedPreceding, 0)
    return (hashed.withColumn("_start", F.sum("_size").over(inside) - F.col("_size"))
            .join(sums, ["_place", "_bucket"]).withColumn("_start", F.col("_start") + F.col("_first"))
            .drop("_first", "_bucket", "_hash"))


def slots(spark, mixture: list[Share], widths: list[int]) -> DataFrame:
    """``slot, _place, rank``: the source of every slot, and how many earlier slots have the same source.

    A source's weight is its target counted in blocks of its own length."""
    wanted = np.array([m.target / w for m, w in zip(mixture, widths, strict=True)], float)
    number = round(wanted.sum())
    ends = np.cumsum(wanted) / (wanted.sum() or 1)
    last = int(np.flatnonzero(wanted)[-1]) if wanted.any() else 0
    # frac(a + b) of parts keeps the points exact to 1e-9 up to 10^12 slots
    step = math.fmod(SLOT_CHUNK * GOLDEN, 1)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                n = np.arange(min(SLOT_CHUNK, number - chunk * SLOT_CHUNK))
                points = (chunk * step + (n + 0.5) * GOLDEN) % 1.0
                place = np.minimum(np.searchsorted(ends, points, "right"), last)
                order = np.argsort(place, kind="stable")
                counts = np.bincount(place, minlength=len(ends))
                rank = np.empty(len(n), np.int64)
                rank[order] = n - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), chunk)), pa.array(n + chunk * SLOT_CHUNK),
                     pa.array(place.astype(np.int32)), pa.array(rank)], ["chunk", "slot", "_place", "rank"])

    chunks = spark.range(0, math.ceil(number / SLOT_CHUNK), 1, max(1, min(1 << 20, math.ceil(number / SLOT_CHUNK))))
    filled = chunks.mapInArrow(fill, "chunk long, slot long, _place int, rank long")
    before = Window.partitionBy("_place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = (filled.groupBy("_place", "chunk").agg(F.count("*").alias("n"))
              .select("_place", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    # Spark takes what is made from a few chunk numbers for a few rows and would broadcast it
    return filled.hint("merge").join(counts, ["_place", "chunk"]).select("slot", "_place", (F.col("rank") + F.col("earlier")).alias("rank"))


def schedule(laid: DataFrame, mixture: list[Share], block_words: int | None = None) -> DataFrame:
    """``slot, _place, round, _start, first, last``: the pieces of documents in the order of the mix.

    A piece is the words ``first`` to ``last`` (exclusive) of the document that begins at ``_start``; ``round`` counts
    how often its source has been used up before. A slot that would use a source more than ``MOST_REPEATS`` times
    (the schedule may give a full source a slot too many) stays empty.
    """
    spark = laid.sparkSession
    widths = [block_words] * len(mixture) if block_words else block_sizes(mixture)
    blocks = spark.createDataFrame([(m.place, math.ceil(m.size / w), w) for m, w in zip(mixture, widths, strict=True)],
                                   "_place int, blocks long, width long")
    placed = (slots(spark, mixture, widths).join(F.broadcast(blocks), "_place")
              .where((F.col("blocks") > 0) & (F.col("rank") < MOST_REPEATS * F.col("blocks")))
              .select("slot", "_place", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("round")))
    width = F.col("width")
    pieces = (laid.where("_size > 0").select("_place", "_start", "_size").join(F.broadcast(blocks.select("_place", "width")), "_place")
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("_start") / width),
                                                        F.floor((F.col("_start") + F.col("_size") - 1) / width))))
              .withColumns({"first": F.greatest(F.col("block") * width - F.col("_start"), F.lit(0)),
                            "last": F.least((F.col("block") + 1) * width - F.col("_start"), F.col("_size"))}))
    # both grow with the corpus, and no estimate of Spark's knows how many rows a chunk or a document makes
    return placed.hint("merge").join(pieces, ["_place", "block"]).select("slot", "_place", "round", "_start", "first", "last")


def _prepared(docs: DataFrame, text: str, source: str, *ids: str):
    sized = docs.withColumn("_size", n_words(F.col(text)))
    mixture = shares(sized, source)
    identity = [F.col(c) for c in ids] + [content_key(F.col(text))]
    return laid_out(sized, mixture, source, *identity), mixture


def mix_counts(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, size, source_size, target, taken``: a row for each row of ``docs``.

    A null text has no words, a null source is a source of its own and comes last. Documents without words take none.
    Repeated rows are documents of their own. An empty table gives an empty result.
    """
    laid, mixture = _prepared(docs.select(doc_id, text, source), text, source, doc_id)
    laid = laid.select(F.col(doc_id).alias("doc_id"), "_size", "_place", "_start", "_source_size", "_target")
    taken = (schedule(laid, mixture).groupBy("_place", "_start")
             .agg(F.sum(F.col("last") - F.col("first")).alias("_taken")).withColumn("_some", F.lit(True)))
    return laid.withColumn("_some", F.col("_size") > 0).join(taken, ["_place", "_start", "_some"], "left").select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.coalesce("_taken", F.lit(0)).alias("taken"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it, with the columns of ``docs``.

    A document that the last round of its source takes in part keeps its first words, with the white space before
    them. Documents without words are not part of a mix counted in words.
    """
    laid, mixture = _prepared(docs, text, source, doc_id)
    rounds = (schedule(laid, mixture).groupBy("_place", "_start", "round").agg(F.max("last").alias("_last")).drop("round"))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, F.col("_last").cast("int")), "")
    kept = F.when(F.col("_last") < F.col("_size"), cut).otherwise(F.col(text))
    return (laid.where("_size > 0").join(rounds, ["_place", "_start"]).withColumn(text, kept).select(*docs.columns))


@query("op8_mix_sources")
def op8_mix_sources(spark, folder):
    return mix_counts(table(spark, folder, "documents", "doc_id", "text", "source"))
