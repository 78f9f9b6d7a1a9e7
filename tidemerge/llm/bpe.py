"""Byte-level BPE: encoding by ranked merges, decoding by concatenation.

The words of the whole corpus (matches of the split pattern) are counted, and the most frequent ones, at most
``VOCABULARY``, are encoded once each in Spark: a higher-order function folds over the word's bytes and joins, step by
step, the adjacent pair of lowest rank, found in a map of ranks that is one broadcast row. Their ids are broadcast. A task
encodes a document by looking its words up. Words beyond the broadcast table, and those longer than ``FOLD_BYTES``, are merged in
the task by the same rule, so every word has its exact ids whatever its frequency.

A word that is itself in the rank table is one token. Ties of rank go to the leftmost pair.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from tidemerge.llm.base import in_chunks, query, stored, table

VOCABULARY = 1 << 16
FOLD_BYTES = 24
FOLD_GROUPS, FOLD_TASKS = 256, 32
CACHED_WORDS = 60_000
CHUNK_BYTES = 4 << 20
INDEX = 1 << 15
SLOTS = "array<map<string,int>>"
#: Spark's xxhash64 of a string.
HASH_SEED = 42

# --- fixed values: the split pattern's classes below U+0250, and white space
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
SPACE = "\t-\r \x85\xa0"
MORE_SPACE = SPACE + "  -     　"


def _pattern(letters: str, numbers: str, space: str) -> str:
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+")


_near = re.compile(_pattern(LETTERS, NUMBERS, SPACE))
_far = regex.compile(_pattern(r"\p{L}", r"\p{N}", MORE_SPACE))
_beyond = re.compile("[^\x00-ɏ]")
SPLIT = _pattern(r"\p{L}", r"\p{N}", r"\s")


def split(text: str) -> list[str]:
    """The matches of the pattern; texts of Latin letters take the faster of two equal expressions."""
    return (_far if _beyond.search(text) else _near).findall(text)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by byte sequence, from a file of lines with a base64 sequence and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 4 * FOLD_BYTES:
        return _merge_long(word, ranks)
    parts, none = [word[i:i + 1] for i in range(len(word))], len(ranks)
    pairs = [ranks.get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) < none:
        at = pairs.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs: no quadratic time for a word of any length."""
    end = len(word)
    until = list(range(1, end + 1))  # a part is word[i:until[i]]
    before = list(range(-1, end))
    alive = [True] * end

    def pair(i: int) -> tuple[int, int, int] | None:
        j = until[i]
        rank = ranks.get(word[i:until[j]]) if j < end else None
        return None if rank is None else (rank, i, until[j])

    heap = [p for p in map(pair, range(end - 1)) if p]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or until[i] >= end or until[until[i]] != stop:
            continue
        alive[until[i]], until[i] = False, stop
        if stop < end:
            before[stop] = i
        for k in (before[i], i):
            if k >= 0 and (p := pair(k)):
                heapq.heappush(heap, p)
    return [ranks[word[i:until[i]]] for i in range(end) if alive[i]]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Words(dict):
    """Ids of words as bytes: a table of known ones, and a bounded number of others that a worker has merged."""

    def __init__(self, known: dict[str, bytes], ranks: dict[bytes, int]):
        super().__init__(known)
        self.ranks, self.most = ranks, len(known) + CACHED_WORDS

    def __reduce__(self):
        return Words, (dict(self), self.ranks)

    def __missing__(self, word: str) -> bytes:
        found = _packed(merge(word.encode("utf-8", "surrogatepass"), self.ranks))
        if len(self) < self.most and len(word) <= 4 * FOLD_BYTES:
            self[word] = found
        return found


def _slots(ranks: dict[bytes, int]) -> str:
    """Ranks by upper-case hex, as JSON of slots of maps."""
    index: list[dict[str, int]] = [{} for _ in range(INDEX)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        index[xxhash.xxh64_intdigest(key, HASH_SEED) % INDEX][key] = rank
    return json.dumps(index, separators=(",", ":"))


def rank_map(ranks: dict[bytes, int]) -> Column:
    """Ranks by upper-case hex, as a literal of slots of maps; it stands in the plan wherever it is used."""
    return F.from_json(F.lit(_slots(ranks)), SLOTS)


def folded(word: Column, ranks: Column) -> Column:
    """Ids of a word, by a fold of ranked merges over its bytes."""
    def rank(piece: Column) -> Column:
        # the hash as an unsigned number modulo a power of two is its low bits
        return F.element_at(F.element_at(ranks, F.xxhash64(piece).bitwiseAND(F.lit(INDEX - 1)).cast("int") + 1), piece)

    def joined(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p, i: F.struct(
            rank(F.concat(p, F.element_at(parts, i + 2))).alias("rank"), (i + 1).alias("at")))
        best = F.array_min(F.filter(pairs, lambda p: p["rank"].isNotNull()))
        return F.element_at(F.transform(F.array(best), lambda b: F.when(b.isNull(), parts).otherwise(F.concat(
            F.slice(parts, 1, b["at"] - 1),
            F.array(F.concat(F.element_at(parts, b["at"]), F.element_at(parts, b["at"] + 1))),
            F.slice(parts, b["at"] + 2, F.size(parts))))), 1)

    text = F.hex(F.encode(word, "UTF-8"))
    size = F.octet_length(word)
    parts = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(text, i * 2 - 1, F.lit(2)))
    merged = F.aggregate(F.sequence(F.lit(1), size), parts, joined)
    return F.when(rank(text).isNotNull(), F.array(rank(text))).otherwise(F.transform(merged, rank))


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``word, ids`` of the column ``word``.

    The ranks are a row that is joined to groups of words. As a literal they would stand in the plan once for each lookup:
    on the driver as objects, in each task, and as text in what Spark keeps of every query.
    """
    slots = words.sparkSession.createDataFrame([(_slots(ranks),)], "slots string")
    groups = (words.select("word", F.pmod(F.xxhash64("word"), F.lit(FOLD_GROUPS)).alias("g")).repartition(FOLD_TASKS, "g")
              .groupBy("g").agg(F.collect_list("word").alias("words")))
    ids = F.transform("words", lambda w: F.struct(w.alias("word"), folded(w, F.col("ranks")).alias("ids")))
    return groups.crossJoin(F.broadcast(slots.select(F.from_json("slots", SLOTS).alias("ranks")))).select(F.inline(ids))


def frequent_words(docs: DataFrame, text: str) -> DataFrame:
    """The most frequent words of all rows: at most ``VOCABULARY``, all above one count."""
    # only which words are in the table depends on this split, never their ids
    words = stored(docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit("(?U)" + SPLIT), F.lit(0))).alias("word"))
             .groupBy("word").count().where(F.octet_length("word") <= FOLD_BYTES), "words")
    step = F.floor(F.log2("count") * 8).cast("int")
    held, lowest = 0, None
    for r in sorted(words.groupBy(step.alias("q")).count().collect(), key=lambda r: -r["q"]):
        held += r["count"]
        if held > VOCABULARY:
            break
        lowest = r["q"]
    return words.where(step >= lowest if lowest is not None else F.lit(False)).select("word")


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids", keep: list[str] | None = None,
           decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with the ids of each whole text as an array.

    Null and empty texts have none. ``decoded`` names a column for the bytes that the ids decode to, made in the same
    pass. Columns of these names are replaced. ``path`` is the rank file, read by the driver.
    """
    ranks = read_ranks(path)
    found = fold_words(frequent_words(docs, text), ranks).toArrow()
    lists = found["ids"].combine_chunks()
    ids, ends = lists.values.to_numpy().astype(np.int32), lists.offsets.to_numpy()
    known = {w: ids[a:b].tobytes() for w, a, b in zip(found["word"].to_pylist(), ends[:-1], ends[1:], strict=True)}
    sent = docs.sparkSession.sparkContext.broadcast(Words(known, ranks))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (into, decoded)]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        pieces = pa.array(sorted(words.ranks, key=words.ranks.get), pa.large_binary()) if decoded else None
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(text)), 0).to_pylist()
            for start, end in in_chunks(sizes, CHUNK_BYTES):
                batch = whole.slice(start, end - start)
                ids = [b"".join(map(words.__getitem__, split(t.as_py() or ""))) for t in batch.column(text)]
                ends = np.cumsum([0] + [len(x) // 4 for x in ids])
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                out = [*(batch.column(c) for c in kept), lists]
                if decoded:
                    out.append(joined(values, ends, pieces))
                yield pa.RecordBatch.from_arrays(out, names)

    made = [StructField(into, ArrayType(IntegerType())), *([StructField(decoded, BinaryType())] if decoded else [])]
    schema = StructType([*docs.select(*kept).schema.fields, *made])
    names = schema.fieldNames()
    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(encoded, schema)


def joined(ids: pa.Array, ends: np.ndarray, pieces: pa.Array) -> pa.Array:
    """The bytes of lists of ids: the pieces of all ids, one after the other, parted at the ends of the lists."""
    taken = pieces.take(ids)
    at = np.frombuffer(taken.buffers()[1], np.int64)[ends] if len(ids) else np.zeros(len(ends), np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(at.tobytes()), taken.buffers()[2]]).cast(pa.binary())


def decode(ids: Column, path: str) -> Column:
    """The bytes of a column of ids: their pieces, one after the other; null for null."""
    pieces = [b.hex() for b, _ in sorted(read_ranks(path).items(), key=lambda x: x[1])]
    table_ = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table_, i + 1)), ""))


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens`` and digests of the columns ``ids`` and ``decoded``, in their place."""
    return (encoded.withColumn("n_tokens", F.size("ids").cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256))
            .withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("ids", "decoded"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op5_bpe")
def op5_bpe(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return digests(encode(docs, vocabulary_path(), keep=["doc_id"], decoded="decoded"))
