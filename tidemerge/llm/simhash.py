"""SimHash near-duplicates, found by anchor points of a covering code.

A fingerprint has 64 bits: bit i is set if it is set in more than half of the hashes of the text's shingles. Two
fingerprints are linked if at most three bits differ, so in one of two halves at most one bit differs. In each half
the anchors are the words of the perfect Hamming code of 31 bits (its covering radius is 1: each word has an anchor
within one bit). A fingerprint goes to every anchor within the covering radius plus the threshold of a half, 1 + 1:
16 anchors at most, by the syndrome. Its nearest anchor is its home. Of two words within one bit, each lies within two
bits of the other's home, so comparing the homes of an anchor with all its visitors finds every link.

A half has 2^26 anchors, so an anchor holds few fingerprints unless they are near each other. Equal fingerprints are
one row before they go anywhere, so groups of copies cost one row, and links are between different fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemerge.llm.base import query, stored, table
from tidemerge.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
HASHES_AT_A_TIME = 1 << 16
CODE_BITS = 31


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text as a signed 64-bit number; zero if it has no words.

    Words are what stands between ASCII white space, A-Z in lower case. A text of fewer words than a shingle is one
    shingle.
    """
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    last = ends[min(words, len(tokens)) - 1:]
    first = np.concatenate(([0], ends + 1))[:len(last)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), HASHES_AT_A_TIME):
        part = slice(at, at + HASHES_AT_A_TIME)
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in
                           zip(first[part].tolist(), last[part].tolist(), strict=True)], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(last)).view(">i8")[0])


@F.pandas_udf(LongType())
def fingerprint_column(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """XOR of the positions (1 to 31) of the set bits: zero for the words of the code."""
    out = np.zeros(len(words), np.int64)
    for position in range(1, CODE_BITS + 1):
        out ^= np.where((words >> (position - 1)) & 1, position, 0)
    return out


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of 31 bits: row, anchor and whether it is the home, for every anchor within two bits."""
    s = _syndromes(words)
    flip = np.concatenate(([0], 1 << np.arange(CODE_BITS, dtype=np.int64)))  # by position; 0 flips nothing
    rows, found, home = [np.arange(len(words))], [words ^ flip[s]], [np.ones(len(words), bool)]
    for i in range(1, CODE_BITS + 1):
        other = i ^ s
        two = np.flatnonzero((s > 0) & (other > i))  # the code's words at distance two: flip i and i ^ s
        rows.append(two)
        found.append(words[two] ^ flip[i] ^ flip[other[two]])
        home.append(np.zeros(len(two), bool))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(home)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for half, words in enumerate((prints & 0x7FFFFFFF, (prints >> 32) & 0x7FFFFFFF)):
            rows, found, home = anchors(words)
            yield pa.RecordBatch.from_arrays([pa.array(found * 2 + half), pa.array(prints[rows]), pa.array(home)],
                                             ["anchor", "fp", "home"])


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: pairs of different fingerprints (column ``fp``, distinct) of which at most three bits differ."""
    spread = prints.select("fp").mapInArrow(_spread, "anchor long, fp long, home boolean")
    homes = spread.where("home").select("anchor", F.col("fp").alias("a"))
    visitors = spread.select("anchor", F.col("fp").alias("b"))
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE)
    # Spark does not know that a fingerprint makes up to 32 rows and would broadcast them for the size of the fingerprints
    return (homes.hint("merge").join(visitors.hint("merge"), (homes["anchor"] == visitors["anchor"]) & near)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _rooted(prints: DataFrame) -> DataFrame:
    """``fp, smallest, root``: for each distinct fingerprint of ``prints`` (doc_id, fp) its smallest id and its class."""
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("smallest"))
    roots = components(links(classes))
    # as in all joins here, the same plan at every size: a broadcast of many fingerprints would be built on the driver
    return classes.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, fp, component_id``: a row for each row of ``docs``.

    ``component_id`` is the smallest id that a chain of links reaches, the row's own included. A null text counts as
    empty; texts without words have fingerprint zero and are linked like any other. A null id is a row like any other
    and never the smallest; a component of null ids only has a null ``component_id``.
    """
    prints = stored(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fp")), "simhash")
    rooted = _rooted(prints)
    heads = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return prints.hint("merge").join(rooted.join(heads.hint("merge"), "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the smallest id stays, of equal ids
    the first by text, and one of rows that are equal in both."""
    marked = docs.withColumn("_fp", fingerprint_column(F.col(text)))
    rooted = stored(_rooted(stored(marked.select(F.col(doc_id).alias("doc_id"), F.col("_fp").alias("fp")), "simhash"))
                    .select(F.col("fp").alias("_fp"), F.col("root").alias("_root")), "roots")
    first = Window.partitionBy("_root").orderBy(F.col(doc_id).asc_nulls_last(), text)
    return (marked.join(rooted.hint("merge"), "_fp").withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*docs.columns))


@query("op10_simhash")
def op10_simhash(spark, folder):
    found = near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
