"""Exact removal of repeated passages, by suffix arrays built one bucket at a time with a difference cover.

A byte goes if it lies in a string of ``DEPTH`` bytes that also starts elsewhere, so every start of such a string is a
suffix to compare to that depth. Suffixes are parted into buckets by the smallest hash of the ``GRAM``-byte strings in
their first ``DEPTH`` bytes: equal strings have equal smallest hashes. Neighbouring suffixes mostly share it, so they
travel as one stretch of text, at about a fiftieth of the positions.

1. Count the buckets. A bucket of one stretch holds no repeated string, unless its text repeats within itself. The rest go into a bit map of fixed size, which the
   next pass reads; a bit set by chance only lets a harmless bucket through.
2. Equal stretches become one row with a count. All suffixes of a stretch met twice are repeated.
3. The other buckets are sorted, a few at a time: suffixes by their first ``PERIOD`` bytes, and where these tie by the
   ranks of a sample of positions, ranked once for the block. The sample is periodic with offsets of a difference cover,
   so any two suffixes reach sampled positions at one common offset, whatever the length of the tie.
4. A bucket of more than ``BUCKET_STRETCHES`` stretches (a passage in very many surroundings) is parted on by longer
   grams, in the same way: what lies inside the passage becomes equal stretches, what reaches far out of it goes
   elsewhere. The little that is left after the last length goes by a hash of the whole depth.
5. Repeated starts become spans of bytes and are joined to the texts by a hash of the whole text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.base import content_key, query, stored, table

DEPTH = 200
GRAMS = (100, 150, 180, 195)
STRETCH = 128
BUCKET_STRETCHES = 200
BLOCK_BYTES = 1 << 20
CHUNK = 1 << 20
SCREEN_BITS = 27
PAGE_BITS = 17

PERIOD = 32
COVER = (1, 2, 3, 4, 8, 12, 20)
RADIX = 0x9E3779B97F4A7C15


def _offsets() -> np.ndarray:
    """For each pair of places modulo ``PERIOD``, the least step that takes both into the cover."""
    inside = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    out = np.full((PERIOD, PERIOD), -1)
    for i in range(PERIOD):
        for j in range(PERIOD):
            out[i, j] = np.flatnonzero(inside[i:i + PERIOD] & inside[j:j + PERIOD])[0]
    return out


STEP = _offsets()


def bucket_hashes(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of ``DEPTH`` bytes in ``data`` the smallest hash of its grams of ``size`` bytes, and all grams' hashes."""
    value, power, length, places, factors = data.astype(np.uint64) + np.uint64(1), RADIX, 1, {}, {}
    while length <= size:  # hashes of 1, 2, 4 ... bytes
        places[length], factors[length] = value, np.uint64(power)
        value = value[:-length] * factors[length] + value[length:]
        power = power * power % (1 << 64)
        length *= 2
    n, at, gram = len(data) - size + 1, 0, np.zeros(len(data) - size + 1, np.uint64)
    for length in sorted(places, reverse=True):
        if size - at >= length:
            gram = gram * factors[length] + places[length][at:at + n]
            at += length
    gram = (gram ^ (gram >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    gram = gram ^ (gram >> np.uint64(32))
    least, width, window = gram, 1, DEPTH - size + 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    count = len(data) - DEPTH + 1
    return np.minimum(least[:count], least[window - width:window - width + count]), gram


def stretches(data: bytes, size: int = GRAMS[0]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bucket, first and last start of each stretch of a text, and whether it can repeat a string within itself.

    A stretch that repeats a string has the period of the two starts' distance. Then its smallest gram begins one of its
    strings at an earlier place than it ends another. Arrays come for a part of the text at a time.
    """
    far = 1 << 62
    for at in range(0, len(data) - DEPTH + 1, CHUNK):
        least, gram = bucket_hashes(np.frombuffer(data, np.uint8, min(CHUNK + DEPTH - 1, len(data) - at), at), size)
        new = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        long = np.diff(np.append(new, len(least)))
        pieces = -(-long // STRETCH)
        first = np.repeat(new, pieces) + STRETCH * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        last = np.append(first[1:], len(least)) - 1
        begins = np.flatnonzero(gram[:len(least)] == least)
        ends = np.flatnonzero(gram[DEPTH - size:] == least)
        begin = np.append(begins, far)[np.searchsorted(begins, first)]
        end = np.append(-far, ends)[np.searchsorted(ends, last, "right")]
        yield least[first], first + at, last + at, (begin <= last) & (end >= first) & (begin < end + DEPTH - size)


def _bytes(text) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # a stretch that may repeat a string within itself counts twice
        found = [x for text in batch.column(0) for g, _, _, folds in stretches(_bytes(text)) for x in (g, g[folds])]
        if found:
            g, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n)], ["g", "n"])


def screen(docs: DataFrame) -> np.ndarray:
    """Bits of the buckets met more than once, by the low bits of their hash: 2 ** ``SCREEN_BITS`` bits at any size."""
    low = F.col("g").bitwiseAND(F.lit((1 << SCREEN_BITS) - 1))
    met = docs.select("text").mapInArrow(_buckets, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n > 1")
    places = met.select(F.shiftright(low, PAGE_BITS).alias("page"), low.bitwiseAND(F.lit((1 << PAGE_BITS) - 1)).alias("at")).distinct()
    out = np.zeros(1 << (SCREEN_BITS - 3), np.uint8)
    size = 1 << (PAGE_BITS - 3)
    for r in places.groupBy("page").applyInArrow(_page, "page long, bits binary").toLocalIterator():
        out[r["page"] * size:(r["page"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out.view(np.uint64)


def _page(rows: pa.Table) -> pa.Table:
    bits = np.zeros(1 << PAGE_BITS, bool)
    bits[rows.column("at").to_numpy()] = True
    return pa.table({"page": rows.column("page").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def _candidates(data: bytes, bits: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    for g, first, last, folds in stretches(data):
        low = g & np.uint64((1 << SCREEN_BITS) - 1)
        hit = np.flatnonzero((bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1))
        yield from zip(g[hit].view(np.int64).tolist(), first[hit].tolist(), last[hit].tolist(), folds[hit].tolist(), strict=True)


def repeated(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the ``DEPTH`` bytes at each start are also those at another start."""
    padded = np.concatenate([text, np.zeros(2 * DEPTH, np.uint8)])

    def words(at: np.ndarray) -> list[np.ndarray]:
        """``PERIOD`` bytes from each place as numbers that sort as the bytes do."""
        rows = np.lib.stride_tricks.sliding_window_view(padded, PERIOD)[at]
        return list(np.ascontiguousarray(rows).view(">u8").astype(np.uint64).T)

    def ranked(keys: list[np.ndarray]) -> np.ndarray:
        order = np.lexsort(keys[::-1])
        changed = np.zeros(len(order), bool)
        for k in keys:
            k = k[order]
            changed[1:] |= k[1:] != k[:-1]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(changed)
        return out

    # ranks of the sample: PERIOD bytes, then twice as many from the ranks of both halves, up to 4 * PERIOD
    places = np.arange(len(text) + DEPTH)
    sample = places[np.isin(places % PERIOD, COVER)]
    number = np.full(len(text) + 2 * DEPTH, len(sample), np.int64)
    number[sample] = np.arange(len(sample))
    rank = ranked(words(sample))
    for length in (PERIOD, 2 * PERIOD):
        half = np.append(rank, -1)
        rank = ranked([rank, half[number[sample + length]]])
    rank = np.append(rank, -1)

    out = np.zeros(len(starts), bool)
    group = ranked(words(starts))
    rows = np.argsort(group, kind="stable")
    group = group[rows]
    ends = words(starts + DEPTH - PERIOD)
    while len(rows):
        # keep groups of two and more, compare each member with the middle one
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        size = np.diff(np.append(first, len(rows)))
        keep = np.repeat(size > 1, size)
        rows, size = rows[keep], size[size > 1]
        first = np.cumsum(size) - size
        number_of = np.repeat(np.arange(len(size)), size)
        pivot = rows[first + size // 2][number_of]
        a, b, order = starts[rows], starts[pivot], np.zeros(len(rows), np.int64)
        for at in (0, DEPTH - 5 * PERIOD):  # two sampled pieces of 4 * PERIOD bytes reach all but the last PERIOD
            step = at + STEP[(a + at) % PERIOD, (b + at) % PERIOD]
            order = np.where(order == 0, np.sign(rank[number[a + step]] - rank[number[b + step]]), order)
        for w in ends:
            order = np.where(order == 0, (w[rows] > w[pivot]).astype(np.int64) - (w[rows] < w[pivot]), order)
        same = np.bincount(number_of, weights=order == 0, minlength=len(size))
        out[rows[(order == 0) & (same[number_of] > 1)]] = True
        group = number_of * 3 + order + 1
        left = order != 0
        rows, group = rows[left], group[left]
        by = np.argsort(group, kind="stable")
        rows, group = rows[by], group[by]
    return out


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by bucket: whole buckets are sorted together until a block is full."""
    held: list[tuple[int, bytes, bytes, int]] = []
    size = 0

    def block() -> pa.RecordBatch:
        texts = [r[2] for r in held]
        begins = np.cumsum([0] + [len(t) for t in texts])
        counts = np.array([len(t) - DEPTH + 1 for t in texts])
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        flags = repeated(np.frombuffer(b"".join(texts), np.uint8), inside + np.repeat(begins[:-1], counts))
        return _runs([r[1] for r in held], counts, flags, np.array([r[3] == 1 for r in held]))

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("g", "uid", "u", "n")), strict=True):
            if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                yield block()
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield block()


def _runs(uids: list[bytes], counts: np.ndarray, flags: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated starts within each wanted stretch."""
    owner = np.repeat(np.arange(len(uids)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    hit = np.flatnonzero(flags & wanted[owner])
    new = np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(owner[hit]) > 0))) if len(hit) else np.zeros(0, bool)
    first, last = hit[new], hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)] if len(hit) else hit
    return pa.RecordBatch.from_arrays([pa.array([uids[i] for i in owner[first]], pa.binary()), pa.array(inside[first]),
                                       pa.array(inside[last])], ["uid", "lo", "hi"])


def _whole_depth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uid, u, n in zip(*(batch.column(c).to_pylist() for c in ("uid", "u", "n")), strict=True):
            count = len(u) - DEPTH + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([xxhash.xxh3_128_digest(u[i:i + DEPTH]) for i in range(count)], pa.binary()),
                pa.array([uid] * count, pa.binary()), pa.array(np.arange(count)), pa.array(np.full(count, n))], ["w", "uid", "at", "n"])


def _parted(size: int):
    """Splits stretches by grams of ``size`` bytes; the parts know their stretch and where in it they begin."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(parent, int(at), n == 1, int(g), u[at:to + DEPTH], bool(folds), n)
                    for parent, u, n in zip(*(batch.column(c).to_pylist() for c in ("uid", "u", "n")), strict=True)
                    for arrays in stretches(u, size)
                    for g, at, to, folds in zip(arrays[0].view(np.int64), *arrays[1:], strict=True)]
            parent, at, lone, g, u, folds, n = zip(*rows, strict=True) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([
                pa.array(parent, pa.binary()), pa.array(at, pa.int64()), pa.array(lone, pa.bool_()),
                pa.array([xxhash.xxh3_128_digest(x) for x in u], pa.binary()), pa.array(g, pa.int64()), pa.array(u, pa.binary()),
                pa.array(folds, pa.bool_()), pa.array(n, pa.int64())], ["parent", "at", "lone", "uid", "g", "u", "folds", "n"])

    return part


def _resolved(distinct: DataFrame, level: int = 0) -> DataFrame:
    """``uid, lo, hi``: runs of repeated starts in distinct stretches (uid, g, u, folds, n) by grams of a length."""
    sizes = distinct.groupBy("g").agg(F.count("*").alias("m"), F.max("folds").alias("f")).where("m > 1 or f").drop("f")
    shared = distinct.join(sizes, "g")
    runs = "uid binary, lo long, hi long"
    twice = distinct.where("n > 1").select("uid", F.lit(0).cast("long").alias("lo"), (F.length("u") - DEPTH).cast("long").alias("hi"))
    in_block = (shared.where(F.col("m") <= BUCKET_STRETCHES).select("g", "uid", "u", "n").repartition("g")
                .sortWithinPartitions("g").mapInArrow(_sorted_buckets, runs))
    found = twice.union(in_block)
    large = F.col("m") > BUCKET_STRETCHES
    if sizes.where(large).isEmpty():
        return found
    rest = shared.where(large).select("uid", "u", "n")
    if level + 1 < len(GRAMS):
        parts = stored(rest.mapInArrow(_parted(GRAMS[level + 1]), "parent binary, at long, lone boolean, uid binary, g long, "
                                                                  "u binary, folds boolean, n long"), "parts")
        inner = _resolved(stored(parts.groupBy("uid", "g", "u", "folds").agg(F.sum("n").alias("n")), "stretches"), level + 1)
        deeper = parts.where("lone").join(inner, "uid").select(
            F.col("parent").alias("uid"), (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))
    else:
        whole = rest.mapInArrow(_whole_depth, "w binary, uid binary, at long, n long")
        again = whole.groupBy("w").agg(F.sum("n").alias("met")).where("met > 1").select("w")
        deeper = whole.where("n = 1").join(again, "w", "left_semi").select("uid", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return found.union(deeper)


def repeated_starts(docs: DataFrame) -> DataFrame:
    """``key, lo, hi``: runs of starts of repeated strings, by ``content_key`` of the text; runs may touch or repeat.

    ``docs`` has a column text; a text that is there twice repeats all its strings.
    """
    bits = docs.sparkSession.sparkContext.broadcast(screen(docs))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: Counter = Counter()
            for text in batch.column(0):
                data = _bytes(text)
                met.update((g, data[lo:hi + DEPTH], folds) for g, lo, hi, folds in _candidates(data, bits.value))
            yield pa.RecordBatch.from_arrays([
                pa.array([xxhash.xxh3_128_digest(u) for _, u, _ in met], pa.binary()), pa.array([g for g, _, _ in met], pa.int64()),
                pa.array([u for _, u, _ in met], pa.binary()), pa.array([f for _, _, f in met], pa.bool_()),
                pa.array(list(met.values()), pa.int64())], ["uid", "g", "u", "folds", "n"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                data = _bytes(text)
                found = [(xxhash.xxh3_128_digest(data[lo:hi + DEPTH]), lo) for _, lo, hi, _ in _candidates(data, bits.value)]
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key.as_py()] * len(found), pa.binary()), pa.array([u for u, _ in found], pa.binary()),
                        pa.array([at for _, at in found], pa.int64())], ["key", "uid", "start"])

    distinct = stored(docs.select("text").mapInArrow(gathered, "uid binary, g long, u binary, folds boolean, n long")
                      .groupBy("uid", "g", "u", "folds").agg(F.sum("n").alias("n")), "stretches")
    found = _resolved(distinct).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("runs"))
    where = docs.select(content_key(F.col("text")), "text").mapInArrow(placed, "key binary, uid binary, start long")
    return (where.join(found, "uid").select("key", "start", F.explode("runs").alias("r"))
            .select("key", (F.col("start") + F.col("r.lo")).alias("lo"), (F.col("start") + F.col("r.hi")).alias("hi")))


def merged_spans(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans of bytes covered by strings whose starts are in ``runs``."""
    out: list[list[int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + DEPTH)
        else:
            out.append([lo, hi + DEPTH])
    return [(a, b) for a, b in out]


def _with_runs(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_runs`` of repeated starts; null where a text has none."""
    runs = repeated_starts(docs.select(F.col(text).alias("text")))
    spans = runs.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("_runs")).withColumnRenamed("key", "_key")
    return docs.withColumn("_key", content_key(F.col(text))).join(spans, "_key", "left").drop("_key")


def _cut(data: bytes, runs: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    spans = merged_spans([(r["lo"], r["hi"]) for r in runs or ()])
    edges = [0, *(x for s in spans for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), spans


def measure(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For each row of ``docs``: its bytes, how many are removed, in how many spans, and the digest of the rest.

    Null and empty texts have no bytes. Rows that repeat a text of ``DEPTH`` bytes or more lose it all.
    """
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, runs in zip(batch.column("text"), batch.column("_runs").to_pylist(), strict=True):
                data = _bytes(value)
                kept, spans = _cut(data, runs)
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    marked = _with_runs(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(measured, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters that they cut in two."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text; a character that a span cuts in two stays whole.

    Every occurrence goes. Rows stay, also those whose text is empty afterwards; a null text stays null.
    """
    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = []
            for value, runs in zip(batch.column(at), batch.column("_runs").to_pylist(), strict=True):
                if runs:
                    data = _bytes(value)
                    edges = [0, *(x for s in whole_characters(data, _cut(data, runs)[1]) for x in s), len(data)]
                    texts.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode("utf-8", "surrogatepass"))
                else:
                    texts.append(value.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns], columns)

    return _with_runs(docs, text).mapInArrow(cut, docs.schema)


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark, folder):
    return measure(table(spark, folder, "documents", "doc_id", "text"))
