"""Language-model scores from a log-frequency Bloom filter.

Training counts words and word pairs of the whole corpus. A count c is kept as its level 1 + floor(log2 c), and a
n-gram of level q goes into the filter once for every level from the lowest to q: 1 for words, ``CUT_LEVEL`` for pairs.
A reader probes level after level until one is missing: that gives the level back, never too low, too high for a small
share of n-grams. Pairs below the cut are not stored: those seen once are left to the smoothing. The filter has about
``BITS_PER_ITEM`` bits for each stored level, in blocks of 128 KB: as many as the corpus needs, with the same levels at
every size. Up to ``MAX_BLOCKS`` are broadcast; more stay a table, to which each chunk of ``SCORE_TOKENS`` tokens sends its
distinct n-grams by block and gets their levels back. Meanwhile the chunk is kept as places in its list of words, so a text
is split and hashed once for it, and a block answers for all chunks at a time.

    P(w)     = (c(w) + 1) / (N + V + 1)
    P(w | u) = (c(u w) + MU * P(w)) / (c(u) + MU)

Counts are summed per shard of hash values: a task sends each distinct n-gram of about ``FLUSH_TOKENS`` tokens once,
packed, so frequent n-grams are combined before the shuffle. The base score needs exact counts: those of the most
frequent words (at most ``EXACT_WORDS``) are broadcast, tokens beyond them are joined to the whole count table.

Words are told apart by a 64-bit hash (XXH3).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.base import give_back, in_chunks, query, remainder, stored, table

FOLDS, HELD_OUT = 7, 2
FLUSH_TOKENS = 2_000_000
SCORE_TOKENS = 400_000
ANSWER_GRAMS = 1_000_000
SHARD_BYTES = 8 << 20
EXACT_WORDS = 1 << 18
BLOCK_BITS = 1 << 20
MAX_BLOCKS = 256
BITS_PER_ITEM = 9
PROBES = 6
CUT_LEVEL = 2
MU = 300.0
CACHED_WORDS = 500_000
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds white space


class _Hashes(dict):
    """Hash of a word, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = h
        return h


def tokens(text: str | None, hashes: dict) -> np.ndarray:
    """Hashes of a text's words (A-Z in lower case, between ASCII white space) and of one end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def pairs(document: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it; the first follows an end."""
    before = np.concatenate(([END], document[:-1]))
    return mixed(before * np.uint64(3) + np.uint64(1)) ^ mixed(document)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def from_level(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; zero for none."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


def counted(docs: DataFrame) -> DataFrame:
    """``gram`` (1 or 2), ``h``, ``c``: counts over all rows of ``docs`` (column text); pairs seen once are left out."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, math.ceil(size / SHARD_BYTES))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, waiting = _Hashes(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for gram, h in ((1, np.concatenate(held)), (2, np.concatenate([pairs(d) for d in held]))):
                h, c = np.unique(h, return_counts=True)
                ends = np.searchsorted(_shard(h, shards), np.arange(1, shards + 1))
                starts = np.concatenate(([0], ends[:-1]))
                some = np.flatnonzero(ends > starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(some), pa.array(np.full(len(some), gram, np.int32)),
                    pa.array([h[starts[i]:ends[i]].tobytes() for i in some], pa.binary()),
                    pa.array([c[starts[i]:ends[i]].astype(np.int32).tobytes() for i in some], pa.binary())],
                    ["shard", "gram", "h", "c"])

        for batch in batches:
            for text in batch.column(0):
                held.append(tokens(text.as_py(), hashes))
                waiting += len(held[-1])
                if waiting >= FLUSH_TOKENS:
                    yield from flush()
                    held, waiting = [], 0
        if held:
            yield from flush()

    def total(rows: pa.Table) -> pa.Table:
        gram = rows.column("gram")[0].as_py()
        h = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in rows.column("h")])
        c = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in rows.column("c")])
        h, at = np.unique(h, return_inverse=True)
        c = np.bincount(at, weights=c).astype(np.int64)
        keep = c >= gram
        return pa.table({"gram": pa.array(np.full(int(keep.sum()), gram, np.int32)), "h": pa.array(h[keep].view(np.int64)),
                         "c": pa.array(c[keep])})

    packed = docs.select("text").mapInArrow(gather, "shard long, gram int, h binary, c binary")
    return packed.groupBy("shard", "gram").applyInArrow(total, "gram int, h long, c long")


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


class Filter:
    """Bits in blocks; an n-gram has all its bits in one block."""

    def __init__(self, blocks: int, cut: int, bits: np.ndarray | None = None):
        self.blocks, self.cut = blocks, cut
        self.bits = np.zeros(blocks * BLOCK_BITS // 8, np.uint8) if bits is None else bits

    def steps(self, h: np.ndarray, lev: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """First bit place and the step to the next ones, before they are taken modulo the block."""
        g = mixed(h + np.asarray(lev, np.uint64) * np.uint64(0xD1342543DE82EF95))
        return g >> np.uint64(40), (g & np.uint64(0xFFFFF)) | np.uint64(1)

    def places(self, h: np.ndarray, lev: np.ndarray | int, probe: int) -> np.ndarray:
        """Bit places within the n-gram's block."""
        first, step = self.steps(h, lev)
        return (first + np.uint64(probe) * step) % np.uint64(BLOCK_BITS)

    def has(self, h: np.ndarray, lev: int, block: np.ndarray) -> np.ndarray:
        """Which of ``h`` have all bits of a level; ``block`` says in which block each stands."""
        out, base = np.arange(len(h)), block * np.uint64(BLOCK_BITS)
        place, step = self.steps(h, lev)
        for _ in range(PROBES):
            at = base + place % np.uint64(BLOCK_BITS)
            set_ = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            out, base, step, place = out[set_], base[set_], step[set_], place[set_]
            place = place + step
        found = np.zeros(len(h), bool)
        found[out] = True
        return found

    def levels(self, h: np.ndarray, lowest: int | None = None) -> np.ndarray:
        """Levels by probing one after the other, from the cut or ``lowest`` on, until one is missing."""
        found, lev, active = np.zeros(len(h), np.int64), lowest or self.cut, np.arange(len(h))
        block = _shard(mixed(h), self.blocks)
        while len(active) and lev < 64:
            active = active[self.has(h[active], lev, block[active])]
            found[active] = lev
            lev += 1
        return found

    def counts(self, h: np.ndarray, lowest: int | None = None) -> np.ndarray:
        """Quantised counts."""
        return from_level(self.levels(h, lowest))


def n_blocks(counts: DataFrame) -> int:
    """Blocks for all n-grams of a count table (gram, h, c) at their levels."""
    spread = counts.groupBy("gram", F.floor(F.log2("c")).cast("int").alias("q")).count().collect()
    items = sum(r["count"] * max(0, r["q"] + 2 - _lowest(r["gram"])) for r in spread)
    return max(1, math.ceil(items * BITS_PER_ITEM / BLOCK_BITS))


def _lowest(gram: int) -> int:
    return 1 if gram == 1 else CUT_LEVEL


def filled_blocks(counts: DataFrame, blocks: int) -> DataFrame:
    """``block, bits``: the blocks that hold anything."""
    empty = Filter(1, CUT_LEVEL)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_shard(mixed(h), blocks).astype(np.int64)), *b.columns],
                                             ["block", "h", "c", "lowest"])

    def fill(rows: pa.Table) -> pa.Table:
        h = rows.column("h").to_numpy().view(np.uint64)
        top, lowest = level(rows.column("c").to_numpy()), rows.column("lowest").to_numpy()
        bits = np.zeros(BLOCK_BITS, bool)
        for lev in range(1, int(top.max(initial=0)) + 1):
            some = h[(top >= lev) & (lowest <= lev)]
            for probe in range(PROBES):
                bits[empty.places(some, lev, probe)] = True
        return pa.table({"block": rows.column("block").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    of_word = F.col("gram") == 1
    kept = (counts.where(of_word | (F.col("c") >= 2 ** (CUT_LEVEL - 1)))
            .select("h", "c", F.when(of_word, 1).otherwise(CUT_LEVEL).cast("long").alias("lowest")))
    return (kept.mapInArrow(place, "block long, h long, c long, lowest long").groupBy("block")
            .applyInArrow(fill, "block long, bits binary"))


def build_filter(counts: DataFrame) -> Filter:
    """The whole filter of a count table (gram, h, c), collected block by block."""
    blocks = n_blocks(counts)
    made, filled = Filter(blocks, CUT_LEVEL), filled_blocks(counts, blocks)
    width = BLOCK_BITS // 8
    for r in filled.toLocalIterator():
        made.bits[r["block"] * width:(r["block"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return made


def frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent words: at most ``EXACT_WORDS``, all above one count."""
    steps = {r["q"]: r["count"] for r in words.groupBy(F.floor(F.log2("c") * 8).cast("int").alias("q")).count().collect()}
    held, lowest = 0, None
    for q in sorted(steps, reverse=True):
        held += steps[q]
        if held > EXACT_WORDS:
            break
        lowest = q
    if lowest is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = words.where(F.floor(F.log2("c") * 8) >= lowest).select("h", "c").toArrow()
    h, c = found["h"].to_numpy().view(np.uint64), found["c"].to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def scored(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs`` (doc_id, text).

    A null text counts as empty: it has the end alone. Repeated rows stay. With an empty training set every count is
    zero.
    """
    spark = docs.sparkSession
    words = counts.where("gram = 1").select("h", "c")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    known_h, known_c = frequent(words)
    blocks = n_blocks(counts)
    whole = build_filter(counts).bits if blocks <= MAX_BLOCKS else None
    sent = spark.sparkContext.broadcast((whole, known_h, known_c))

    def lookup(h: np.ndarray, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[at] == h
        return hit, np.where(hit, values[at], 0)

    def words_of(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
        """Distinct words of some documents, each token's place among them, where documents begin, and their columns
        that need no filter."""
        _, keys, values = sent.value
        h = np.concatenate(held)
        starts = np.cumsum([0] + [len(x) for x in held[:-1]])
        distinct, at = np.unique(h, return_inverse=True)
        hit, exact = lookup(distinct, keys, values)
        ends, rare = np.append(starts[1:], len(h)), ~hit[at]
        return distinct, at, starts, [
            pa.array(ends - starts), pa.array(np.add.reduceat((hit & (exact > 0)).astype(np.int64)[at], starts)),
            pa.array(np.add.reduceat(np.log10(exact + 1.0)[at], starts)),
            pa.array([h[s:e][rare[s:e]].view(np.int64) for s, e in zip(starts, ends, strict=True)], pa.list_(pa.int64()))]

    def lefts(distinct: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of the words before: a document ends with an end, which the first word of the next one follows."""
        return np.concatenate(([np.searchsorted(distinct, END)], at[:-1]))

    def pairs_of(distinct: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, and each token's place among them; as ``pairs`` makes them."""
        before, own = mixed(distinct * np.uint64(3) + np.uint64(1)), mixed(distinct)
        return np.unique(before[lefts(distinct, at)] ^ own[at], return_inverse=True)

    def score_sums(distinct: np.ndarray, at: np.ndarray, starts: np.ndarray, back: np.ndarray, one: np.ndarray, two: np.ndarray) -> pa.Array:
        """Scores of documents; ``one`` and ``two`` are the levels of distinct words and of distinct pairs."""
        one, seen = from_level(one), from_level(two)[back]
        p1, context = (one + 1) / (n + v + 1), one[lefts(distinct, at)]
        return pa.array(np.add.reduceat(np.log10((np.minimum(seen, context) + MU * p1[at]) / (context + MU)), starts))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Hashes, ids and number of the first row, of about ``SCORE_TOKENS`` tokens at a time."""
        hashes, row = _Hashes(), TaskContext.get().partitionId() << 40
        kind, held, ids, waiting = None, [], [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                held.append(tokens(text.as_py(), hashes))
                ids.append(i)
                waiting += len(held[-1])
                if waiting >= SCORE_TOKENS:
                    yield held, pa.array(ids, kind), row
                    row += len(held)
                    held, ids, waiting = [], [], 0
        if held:
            yield held, pa.array(ids, kind), row

    own = ["n_tokens", "known", "log_sum", "rare"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Filter(blocks, CUT_LEVEL, sent.value[0])
        for held, ids, row in chunks(batches):
            distinct, at, starts, columns = words_of(held)
            two, back = pairs_of(distinct, at)
            sums = score_sums(distinct, at, starts, back, model.levels(distinct, 1), model.levels(two))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(held))), ids, *columns, sums], ["row", "doc_id", *own, "score"])

    def by_block(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = _shard(mixed(h), blocks).astype(np.uint16 if blocks <= 1 << 16 else np.int64)  # 16 bits are sorted in linear time
        order = np.argsort(block, kind="stable")
        return order, block[order]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of each document, its tokens as places; a row of each chunk (block -1), its words; its n-grams by block."""
        names = ["chunk", "block", "one", "two", "row", "doc_id", *own, "places"]

        def without_document(block: np.ndarray, one: list, two: list, row: int, kinds: list) -> pa.RecordBatch:
            k = len(block)
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, row)), pa.array(block.astype(np.int64)), pa.array(one, pa.binary()),
                                               pa.array(two, pa.binary()), *[pa.nulls(k, kind) for kind in kinds]], names)

        for held, ids, row in chunks(batches):
            distinct, at, starts, columns = words_of(held)
            k, ends, narrow = len(held), np.append(starts[1:], len(at)), at.astype(np.uint16 if len(distinct) <= 1 << 16 else np.uint32)
            documents = [pa.array(np.arange(row, row + k)), ids, *columns,
                         pa.array([narrow[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, row)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                                              pa.nulls(k, pa.binary()), *documents], names)
            kinds, parts = [x.type for x in documents], []
            yield without_document(np.array([-1]), [distinct.tobytes()], [None], row, kinds)
            for h in (distinct, pairs_of(distinct, at)[0]):
                order, block = by_block(h)
                parts.append((h[order], block))
            asked = np.union1d(parts[0][1], parts[1][1])
            one, two = ([h[s:e].tobytes() for s, e in zip(np.searchsorted(block, asked), np.searchsorted(block, asked, "right"), strict=True)]
                        for h, block in parts)
            yield without_document(asked, one, two, row, kinds)

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        bits = np.frombuffer(held.column("bits")[0].as_py(), np.uint8) if held.num_rows else None
        model, found = Filter(1, CUT_LEVEL, bits), []
        for name, low in (("one", 1), ("two", CUT_LEVEL)):
            sets, levels = asked.column(name).to_pylist(), []
            for first, last in in_chunks([len(x) // 8 for x in sets], ANSWER_GRAMS):
                whole = model.levels(np.frombuffer(b"".join(sets[first:last]), np.uint64), low).astype(np.uint8).tobytes()
                at = 0
                for x in sets[first:last]:
                    levels.append(whole[at:at + len(x) // 8])
                    at += len(x) // 8
            found.append(pa.array(levels, pa.binary()))
        return pa.table([asked.column("chunk"), asked.column("block"), *found], ["chunk", "block", "one", "two"])

    def score_answered(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers, of_chunk = answers.sort_by("block"), rows.filter(pc.is_valid(rows.column("block")))
        rows = rows.filter(pc.is_null(rows.column("block"))).sort_by("row")
        distinct = np.frombuffer(of_chunk.column("one")[0].as_py(), np.uint64)
        places = rows.column("places").to_pylist()
        at = np.frombuffer(b"".join(places), np.uint16 if len(distinct) <= 1 << 16 else np.uint32).astype(np.int64)
        lengths = rows.column("n_tokens").to_numpy()
        two, back = pairs_of(distinct, at)
        levels = []
        for h, name in ((distinct, "one"), (two, "two")):
            found = np.empty(len(h), np.int64)
            found[by_block(h)[0]] = np.frombuffer(b"".join(answers.column(name).to_pylist()), np.uint8)
            levels.append(found)
        return rows.select(["row", "doc_id", *own]).append_column("score", score_sums(distinct, at, np.cumsum(lengths) - lengths, back, *levels))

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"row long, doc_id {id_kind}, n_tokens long, known long, log_sum double, rare array<long>"
    schema = f"{kinds}, score double"
    given = docs.select("doc_id", "text")
    if whole is not None:
        first = stored(given.mapInArrow(score, schema), "lm")
    else:
        asked = stored(given.mapInArrow(ask, f"chunk long, block long, one binary, two binary, {kinds}, places binary"), "asked")
        table_of_blocks = stored(filled_blocks(counts, blocks), "blocks")
        answers = stored(asked.where("block >= 0").select("chunk", "block", "one", "two").groupBy("block")
                         .cogroup(table_of_blocks.groupBy("block")).applyInArrow(answer, "chunk long, block long, one binary, two binary"), "answers")
        give_back(spark)  # the n-grams that were sent go before the documents are
        first = stored(asked.where("block is null or block < 0").drop("two").groupBy("chunk")
                       .cogroup(answers.groupBy("chunk")).applyInArrow(score_answered, schema), "lm")
    more = (first.select("row", F.explode("rare").alias("h")).join(words, "h")
            .groupBy("row").agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("c") + 1.0)).alias("more_sum")))
    log_sum = F.col("log_sum") + F.coalesce("more_sum", F.lit(0.0))
    return first.drop("rare").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (log_sum - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "score")


@query("op6_lm_score")
def op6_lm_score(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    out = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    counts = stored(counted(docs.where(~out)), "counts")
    return scored(docs, counts).withColumn("held_out", out)
