"""Near copies by SimHash: anchors of a covering code propose pairs, the exact Jaccard similarity confirms them.

A text is the set of its five-word shingles; two texts are linked if the sets' Jaccard similarity is 0.8 or more. The
SimHash of a set has ``BITS`` bits: the shingles' hashes vote, and a bit is set if over half of them have it set. Op10
links by three of 64 bits; at a similarity of 0.8 about 15 % of the bits differ, so no bound on 64 bits covers these
pairs and leaves unrelated ones out. Here ``TABLES`` tables take ``PIECES`` pieces of the fingerprint each. As in op10 a
piece goes to its home, the nearest word of a code: the first-order Reed-Muller code, 256 words of 128 bits, found by a
Hadamard transform. Bits count by their margin of votes, as those near half are the ones that differ between near copies.

Sets that share the homes of all pieces of a table meet: two sets of similarity 0.8 in about one table of 15, so all but
one to seven in 100,000 such pairs meet in some table, and fewer of closer ones are missed. A table also parts sets by
size (steps of ``SIZE_STEP``, shifted from table to table). Of the pairs that meet, those stay whose sizes allow the
similarity, whose fingerprints differ in at most ``MOST_DIFFERENT`` of the first 256 bits, and whose odd sketches allow it;
these are confirmed by the exact similarity of their sets. An odd sketch has a bit for each residue of the hashes, set if
an odd number of shingles has it: two sketches differ in no more bits than their sets in shingles, so this loses no pair.

Equal sets are one row before they go into buckets. In each bucket all sets are first compared with its smallest, so a
group of near copies costs about one pair for each of its sets and bucket; then, with what was linked so taken as one,
the sets of a bucket that are still apart are compared with one another. Sizes, fingerprints and sketches stand beside
the sets of a bucket then, so that the join itself leaves out pairs that are not similar.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemerge.llm.base import stored
from tidemerge.llm.components import components
from tidemerge.llm.lm import mixed
from tidemerge.operators.merge import key_filter

SHINGLE_WORDS = 5
SIMILARITY = Fraction(4, 5)
BITS, TABLES, PIECES, PIECE_BITS = 1024, 160, 3, 128
SIZE_STEP = 4
PRINT_WORDS, MOST_DIFFERENT = 4, 88
PRINT = [f"_print{i}" for i in range(PRINT_WORDS)]
ODD_WORDS = 16
ODD = [f"_odd{i}" for i in range(ODD_WORDS)]
OF_SET = ["_n", *PRINT, *ODD]
#: Rows of votes that a byte can count.
AT_A_TIME = 255
SETS_AT_A_TIME = 64
HELD_SETS = 64
_random = np.random.default_rng(10)
SEEDS = _random.integers(0, 1 << 64, BITS // 64, np.uint64) | np.uint64(1)
TAKEN = np.array([_random.permutation(BITS)[:PIECES * PIECE_BITS] for _ in range(TABLES)])
#: Signs turn the code from table to table; the unequal weights keep ties of small sets from falling to the same words.
SIGNS = (_random.choice([-1.0, 1.0], TAKEN.shape) * _random.uniform(0.8, 1.2, TAKEN.shape)).astype(np.float32)
SHIFTS = _random.random(TABLES)


def _hadamard(size: int) -> np.ndarray:
    """The words of the code of ``size`` bits as signs; their complements are words too."""
    return reduce(lambda h, _: np.block([[h, h], [h, -h]]), range(int(math.log2(size))), np.ones((1, 1), np.float32))


WORDS = _hadamard(PIECE_BITS)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a text of fewer words than a shingle is one shingle.

    Words are what stands between ASCII white space, A-Z in lower case.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    last = ends[min(SHINGLE_WORDS, len(tokens)) - 1:]
    first = np.concatenate(([0], ends + 1))[:len(last)]
    hashed = (xxhash.xxh3_64_intdigest(joined[s:e]) for s, e in zip(first.tolist(), last.tolist(), strict=True))
    return np.unique(np.fromiter(hashed, np.uint64, len(last)))


def votes(hashes: np.ndarray) -> np.ndarray:
    """Of each bit of the fingerprint, the shingles that have it set less those that have not."""
    set_ = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), AT_A_TIME):
        words = mixed((hashes[at:at + AT_A_TIME, None] ^ SEEDS) * np.uint64(0x9E3779B97F4A7C15))
        set_ += np.unpackbits(words.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return 2 * set_ - len(hashes)


def prints(voted: np.ndarray) -> np.ndarray:
    """The first bits of the fingerprints of rows of votes, in words of 64."""
    return np.packbits(voted[:, :64 * PRINT_WORDS] > 0, axis=1).view(np.int64)


def odd(hashes: np.ndarray) -> np.ndarray:
    """The odd sketch of a set, in words of 64."""
    bits = 64 * ODD_WORDS
    return np.packbits(np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).view(np.int64)


def homes(voted: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For rows of votes of sets that are not empty: in each table the homes of all pieces and the step of size, as one number."""
    out, weights = np.empty((len(voted), TABLES), np.int32), voted.astype(np.float32)
    steps = np.log(np.maximum(sizes, 1)) / math.log(SIZE_STEP)
    for t in range(TABLES):
        near = (weights[:, TAKEN[t]] * SIGNS[t]).reshape(-1, PIECE_BITS) @ WORDS
        best = np.abs(near).argmax(axis=1)
        word = (best * 2 + (near[np.arange(len(near)), best] > 0)).reshape(-1, PIECES)
        number = (steps + SHIFTS[t]).astype(np.int32)
        for piece in range(PIECES):
            number = number * (2 * PIECE_BITS) + word[:, piece]
        out[:, t] = number
    return out


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is ``SIMILARITY`` or more; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * SIMILARITY.denominator >= (len(a) + len(b) - both) * SIMILARITY.numerator


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keep = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if x not in held:
                if len(held) >= HELD_SETS:
                    held.clear()
                held[x] = shingles(batch.column(2)[i].as_py())
            keep[i] = similar(held[x], shingles(batch.column(3)[i].as_py()))
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def _side(rows: DataFrame, side: str, *keep: str | Column) -> DataFrame:
    """``rows`` with ``_node`` as ``side`` and what is known of its set under the side's names."""
    return rows.select(F.col("_node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in OF_SET], *keep)


def _allowed() -> Column:
    """Whether sizes, fingerprints and odd sketches of sides ``a`` and ``b`` allow the similarity."""
    def different(words: list[str]) -> Column:
        return reduce(add, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in words])

    x, y, total = SIMILARITY.numerator, SIMILARITY.denominator, F.col("_n_a") + F.col("_n_b")
    # similar sets differ in at most (1 - s) / (1 + s) of the shingles of both together
    return ((F.least("_n_a", "_n_b") * y >= F.greatest("_n_a", "_n_b") * x) & (different(PRINT) <= MOST_DIFFERENT)
            & (different(ODD) * (y + x) <= total * (y - x)))


def _in_order(pairs: DataFrame) -> DataFrame:
    """Each pair once, as ``a`` < ``b``."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` joined to ``wanted`` by ``_row``; most others fall out before they are shuffled."""
    held = key_filter(wanted, ["_row"], wanted.count())
    return (rows if held is None else rows.where(held(["_row"]))).join(wanted, "_row")


def marked_rows(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_row``, and of its text's set the number ``_node`` (zero for the empty one), the size ``_n``, the
    first bits of the fingerprint, the odd sketch and the homes ``_homes`` by table (none for the empty one); written once."""
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    at = rows.columns.index(text)
    names = [*rows.columns, "_node", *OF_SET, "_homes"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), SETS_AT_A_TIME):
                batch = whole.slice(start, SETS_AT_A_TIME)
                sets = [shingles(t.as_py()) for t in batch.column(at)]
                sizes = np.array([len(s) for s in sets], np.int64)
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0 for s in sets], np.uint64)
                voted = np.array([votes(s) for s in sets])
                some, at_home = sizes > 0, homes(voted, sizes)
                ends = np.concatenate(([0], np.cumsum(some) * TABLES)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at_home[some].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(nodes.view(np.int64)), pa.array(sizes), *map(pa.array, prints(voted).T.copy()),
                     *map(pa.array, np.array([odd(s) for s in sets]).T.copy()), lists], names)

    schema = StructType([*rows.schema.fields, *[StructField(c, LongType()) for c in ("_node", *OF_SET)],
                         StructField("_homes", ArrayType(IntegerType()))])
    return stored(rows.mapInArrow(mark, schema), "near-rows")


def links(marked: DataFrame, text: str) -> DataFrame:
    """``a, b``: linked pairs of the sets of ``marked``."""
    sets = stored(marked.where("_n > 0").groupBy("_node").agg(F.min("_row").alias("_row"), *[F.min(c).alias(c) for c in OF_SET]), "sets")
    # one shuffle, read by the aggregate and by the join
    spread = (marked.select("_row", "_homes").join(sets.select("_row", "_node"), "_row")
              .select(F.posexplode("_homes").alias("table", "home"), F.col("_node").alias("node"))
              .select((F.shiftleft(F.col("table").cast("long"), 32) + F.col("home")).alias("key"), "node").repartition("key"))
    heads = spread.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("sets")).where("sets > 1").select("key", "a")
    shared = stored(spread.join(heads, "key"), "buckets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("_node")).union(pairs.select("b")).distinct()
        rows = stored(sets.select("_row", "_node").join(nodes, "_node"), "nodes")
        texts = stored(_only(marked.select("_row", F.col(text).alias("text")), rows).select("_node", "text"), "texts")
        both = (pairs.join(texts.select(F.col("_node").alias("a"), F.col("text").alias("text_a")), "a")
                .join(texts.select(F.col("_node").alias("b"), F.col("text").alias("text_b")), "b"))
        return stored(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirmed, "a long, b long"), "near")

    met = _in_order(shared.where("a <> node").select("a", F.col("node").alias("b")))
    first = stored(met.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").where(_allowed()).select("a", "b"), "pairs")
    found = confirmed(first)
    roots = components(found).select(F.col("node").alias("of"), "root")
    placed = (shared.join(roots, F.col("node") == F.col("of"), "left")
              .select("key", "node", F.coalesce("root", "node").alias("root")))
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    known = sets.select("_node", *OF_SET)
    apart = stored(placed.join(several, "key").join(known, F.col("node") == F.col("_node")).drop("node"), "apart")
    x = _side(apart, "a", "key", F.col("root").alias("root_a"))
    y = _side(apart, "b", "key", F.col("root").alias("root_b"))
    more = _in_order(x.join(y, "key").where(F.expr("root_a < root_b") & _allowed())).join(first, ["a", "b"], "left_anti")
    return found.union(confirmed(stored(more, "pairs")))


def first_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of the smallest id stays, of equal ids the
    first by text, and one of rows that are equal in both.

    Null ids come last. A null text counts as empty; texts without words are copies of one another.
    """
    marked = marked_rows(docs, text)
    roots = components(links(marked, text)).select(F.col("node").alias("of"), "root")
    placed = stored(marked.select("_row", "_node", F.col(doc_id).alias("id")).join(roots, F.col("_node") == F.col("of"), "left")
                    .select("_row", "id", F.coalesce("root", "_node").alias("root")), "roots")
    lowest = placed.groupBy("root").agg(F.min("id").alias("low"))  # null only where all ids are
    firsts = placed.join(lowest, "root").where("id <=> low").select("root", "_row")
    counted = stored(firsts.groupBy("root").agg(F.count("*").alias("rows"), F.min("_row").alias("_row")), "firsts")
    tied = stored(firsts.join(counted.where("rows > 1").select("root"), "root"), "tied")
    by_text = (_only(marked.select("_row", F.col(text).alias("text")), tied).groupBy("root")
               .agg(F.min(F.struct(F.col("text").isNotNull().alias("some"), "text", "_row"))["_row"].alias("_row")))
    kept = stored(counted.where("rows = 1").select("_row").union(by_text.select("_row")), "kept")
    # the same plan at every size: a broadcast of many rows would be built on the driver
    return marked.join(kept.hint("merge"), "_row", "left_semi").select(*docs.columns)
