"""Repair of the turn structure of conversations, by Viterbi decoding with coalescing survivors.

Edits of least cost make the roles of a conversation follow ``(s?(ua)+)?``: keep a row, give it another role, delete it
or insert an empty one. A row with a fault (blank, duplicate, truncated) costs more to keep or must go. The states are
the role that stands last (none, system, user, assistant); each holds one survivor, its cheapest edits so far.

Survivors share a tree of backpointers whose nodes count the nodes and survivors that stand on them. A node left by all
is taken out, a node left with one child becomes one with it, and what the root holds is common to all survivors: those
edits are final and are emitted at once. Survivors that cost more than another one could ever need to do the same are
dropped, so states that only look possible do not keep the tree from coalescing. What stays unresolved takes a byte an
edit. Ties go to the smallest edit string: inserts stand before the row they precede, so of two unresolved strings none
begins the other, and the order of the whole strings lives on as a rank of the survivors that each step extends.

In Spark, equal rows of a turn become one with a count, first appearances are found by an aggregate, and only keys,
roles and fault marks (no texts) go to the decoder, sorted by conversation and turn and read as a stream: a task
holds one batch and the unresolved edits. Texts meet the emitted edits in a join, which AQE splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.base import query, stored, table

SPACE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NONE, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
OK, BLANK, DUPLICATE, CUT = range(4)

#: ``[i][j]``: what state i pays at most, beyond state j, to do whatever j can do next.
_EXTRA = [
    [0, 0, INSERT, 2 * INSERT],
    [2 * INSERT, 0, INSERT, 2 * INSERT],
    [INSERT + DELETE, INSERT, 0, INSERT],
    [DELETE, 0, INSERT, 0],
]


def _moves(initial: str, truncated: bool) -> list[tuple[int, int, bytes, int]]:
    """``(from, to, edits, cost)`` for a row. ``L`` is the keeping of a system row and sorts like K."""
    more = TRUNCATED if truncated else 0
    out = [(i, i, b"D", DELETE) for i in range(4)]
    if initial == "s":
        out.append((NONE, SYSTEM, b"L", more))
    for to, name in ((USER, "u"), (ASSISTANT, "a")):
        edit, cost = (b"K", more) if initial == name else (b"R", REROLE + more)
        for i in range(4):
            inserts = int((i == USER) == (to == USER))
            out.append((i, to, b"I" * inserts + edit, INSERT * inserts + cost))
    return out


MOVES = {(c, t): _moves(c, t) for c in ("s", "u", "a", "") for t in (False, True)}
ENDS = [(NONE, b"", 0), (ASSISTANT, b"", 0), (USER, b"I", INSERT), (SYSTEM, b"II", 2 * INSERT)]


class _Node:
    """Edits that all survivors above it share; ``refs`` counts child nodes and survivors on it."""
    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent: _Node | None, edits: bytes):
        self.parent, self.edits, self.refs = parent, bytearray(edits), 1


class Decoder:
    """Edits of one conversation, row by row. ``ready`` takes the edits that are final and empties itself on reading."""

    def __init__(self):
        self.nodes, self.costs, self.ranks = {NONE: _Node(None, b"")}, {NONE: 0}, {NONE: 0}
        self.ready = bytearray()

    def delete(self, count: int) -> None:
        """Rows that must go: every survivor takes the same step."""
        for state, node in self.nodes.items():
            self.costs[state] += DELETE * count
            node.edits += b"D" * count
        self._emit()

    def row(self, initial: str, truncated: bool) -> None:
        self._take(MOVES[initial if initial in ("s", "u", "a") else "", truncated])

    def end(self) -> int:
        """The last inserts; all edits are final then. Returns the cost."""
        self._take([(i, NONE, edits, cost) for i, edits, cost in ENDS], last=True)
        return self.costs[NONE]

    def _take(self, moves, last: bool = False) -> None:
        best: dict[int, tuple] = {}
        for i, to, edits, cost in moves:
            if i in self.costs:
                new = (self.costs[i] + cost, self.ranks[i], edits, i)
                if to not in best or new < best[to]:
                    best[to] = new
        if not last:
            least = {j: min(best[i][0] + _EXTRA[i][j] for i in best) for j in best}
            best = {j: b for j, b in best.items() if b[0] <= least[j]}
        heirs: dict[int, int] = {}
        for b in best.values():
            heirs[b[3]] = heirs.get(b[3], 0) + 1
        gone = [node for i, node in self.nodes.items() if i not in heirs]
        nodes = {}
        for to, (_, _, edits, i) in best.items():
            node = self.nodes[i]
            if heirs[i] == 1:
                node.edits += edits
                nodes[to] = node
            else:
                nodes[to] = _Node(node, edits)
                node.refs = heirs[i]
        order = sorted(best, key=lambda to: best[to][1:3])
        self.nodes, self.costs = nodes, {to: b[0] for to, b in best.items()}
        self.ranks = {to: r for r, to in enumerate(order)}
        lone = {id(p) for p in map(self._release, gone) if p is not None}
        if lone:
            self._join(lone)
        self._emit()

    def _release(self, node: _Node) -> _Node | None:
        """Takes a node out, and those below it that nothing else stands on; the node below these."""
        while node.parent is not None:
            node = node.parent
            node.refs -= 1
            if node.refs:
                return node
        return None

    def _join(self, lone: set[int]) -> None:
        """Nodes of which one child is left become one with it."""
        for node in list(self.nodes.values()):
            while (below := node.parent) is not None:
                if id(below) in lone and below.refs == 1:
                    below.edits += node.edits
                    node.edits, node.parent = below.edits, below.parent
                else:
                    node = below

    def _live(self) -> Iterator[_Node]:
        for node in self.nodes.values():
            while node is not None:
                yield node
                node = node.parent

    def _emit(self) -> None:
        root = next(iter(self.nodes.values()))
        while root.parent is not None:
            root = root.parent
        if root.edits:
            self.ready += root.edits
            root.edits = bytearray()

    def taken(self) -> bytes:
        out, self.ready = bytes(self.ready), bytearray()
        return out


class _Conversation:
    """Counts of one conversation and its emitted edits; ``out`` is where edits of rows that stay are put."""

    def __init__(self, key, out: list):
        self.key, self.out, self.decoder, self.audit = key, out, Decoder(), bytearray()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.before, self.low, self.high, self.state, self.at, self.inserts = None, None, None, NONE, 0, 0

    def add(self, turn: int | None, role: str, fault: int, copies: int) -> int:
        """One distinct row with its copies; returns the number of its first copy."""
        number, initial = self.rows, role[:1]
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.illegal += (copies - 1) + (self.before is not None and self.before + initial not in ("su", "ua", "au"))
        self.rows, self.before = self.rows + copies, initial
        if fault in (BLANK, DUPLICATE):
            self.blank += copies * (fault == BLANK)
            self.duplicate += copies * (fault == DUPLICATE)
            self.decoder.delete(copies)
        else:
            self.truncated += fault == CUT
            self.decoder.row(initial, fault == CUT)
            if copies > 1:
                self.duplicate += copies - 1
                self.decoder.delete(copies - 1)
        self._emit()
        return number

    def _emit(self) -> None:
        """Emitted edits become rows: conversation, number of the row, place before it, edit, role (None: its own)."""
        done = self.decoder.taken()
        for edit in done:
            if edit == 68:  # D
                self.at, self.inserts = self.at + 1, 0
                continue
            self.state = SYSTEM if edit == 76 else ASSISTANT if self.state == USER else USER
            keeps = edit in (75, 76)  # K, L
            self.out.append((self.key, self.at, self.inserts, "K" if keeps else chr(edit), None if keeps else NAMES[self.state]))
            if edit == 73:  # I
                self.inserts += 1
            else:
                self.at, self.inserts = self.at + 1, 0
        self.audit += done

    def end(self) -> tuple:
        cost = self.decoder.end()
        self._emit()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.audit.decode().replace("L", "K"))


_ROW, _EDIT, _END = range(3)
_FIELDS = [("kind", pa.int8()), ("conv_id", pa.int64()), ("number", pa.int64()), ("place", pa.int32()), ("edit", pa.string()),
           ("new_role", pa.string()), ("uid", pa.binary()), ("gaps", pa.int64()), ("blank", pa.int64()),
           ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
_SCHEMA = ("kind byte, conv_id long, number long, place int, edit string, new_role string, uid binary, gaps long, blank long, "
           "duplicate long, truncated long, illegal long, cost long, audit string")


def _records(kind: int, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = dict(zip(names, zip(*rows))) if rows else {}
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(rows) if name == "kind" else columns.get(name, [None] * len(rows)), kind_of) for name, kind_of in _FIELDS],
        [name for name, _ in _FIELDS])


_END_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, fault, copies, uid) in order: their numbers, the edits, and one end a conversation."""
    now: _Conversation | None = None
    for batch in batches:
        rows, edits, ends = [], [], []
        if now is not None:
            now.out = edits
        for key, turn, role, fault, copies, uid in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.key != key:
                if now is not None:
                    ends.append(now.end())
                now = _Conversation(key, edits)
            rows.append((key, now.add(turn, role, fault, copies), uid))
        yield _records(_ROW, rows, ["conv_id", "number", "uid"])
        yield _records(_EDIT, edits, ["conv_id", "number", "place", "edit", "new_role"])
        yield _records(_END, ends, _END_NAMES)
    if now is not None:
        now.out = edits = []
        ends = [now.end()]
        yield _records(_EDIT, edits, ["conv_id", "number", "place", "edit", "new_role"])
        yield _records(_END, ends, _END_NAMES)


def _fault(text: Column) -> Column:
    shown = F.rtrim(text, F.lit(SPACE))
    return F.when(shown == "", BLANK).when(F.right(shown, F.lit(1)).isin(".", "!", "?"), OK).otherwise(CUT)


class Repaired:
    """``report``: gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation. ``rows``: what stands
    in each after its edits, as conv_id, number and place (their order), edit (K, R or I), turn, role, text."""

    def __init__(self, report: DataFrame, rows: DataFrame):
        self.report, self.rows = report, rows


def repair(rows: DataFrame) -> Repaired:
    """Edits conversations (``conv_id, turn, role, text``) into legal turn order at least cost.

    Rows stand by turn, null turns first; rows of one turn by role, then text. A null role or text is one space. A null
    conv_id is a conversation like any other. Repeated rows are duplicates; texts of white space are blank. Other
    columns are left out, whatever they are called. An empty table gives empty results.
    """
    seen = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    counted = seen.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    uid = F.unhex(F.sha2(F.to_json(F.struct("conv_id", "turn", "role", F.sha2("text", 256))), 256))
    texts = stored(counted.select("*", uid.alias("uid"), F.unhex(F.md5("text")).alias("key"), _fault(F.col("text")).alias("fault")), "dialogue-rows")
    light = texts.select("conv_id", "turn", "role", "fault", "copies", "uid", "key", F.left("text", F.lit(40)).alias("begin"))
    first = light.groupBy("conv_id", "role", "key").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first")).select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "first")
    earlier = F.struct(F.col("turn").isNotNull(), "turn") > F.col("first")
    marked = light.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))).select(
        "conv_id", "turn", "role", F.when((F.col("fault") != BLANK) & earlier, DUPLICATE).otherwise(F.col("fault")).alias("fault"),
        "copies", "uid", "begin", "key")
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "begin", "key")
    done = stored(ordered.select("conv_id", "turn", "role", "fault", "copies", "uid").mapInArrow(_decode, _SCHEMA), "dialogue-edits")
    # the numbers of rows that stay lead to their texts; inserted rows have none
    edits = done.where(F.col("kind") == _EDIT).select("conv_id", "number", "place", "edit", "new_role")
    numbers = done.where(F.col("kind") == _ROW).select(F.col("conv_id").alias("c"), F.col("number").alias("m"), "uid")
    held = edits.where("edit <> 'I'").join(
        numbers, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("number") == F.col("m"))).select("number", "place", "edit", "new_role", "uid")
    kept = held.join(texts.select("uid", "conv_id", "turn", "role", "text"), "uid").select(
        "conv_id", "number", "place", "edit", "turn", F.coalesce("new_role", "role").alias("role"), "text")
    put = edits.where("edit = 'I'").select("conv_id", "number", "place", "edit", F.lit(None).cast("long").alias("turn"),
                                           F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(done.where(F.col("kind") == _END).select(*_END_NAMES), kept.unionByName(put))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` lines in order. A digest reads its conversation as one stream of
    batches; nothing but the hash is held."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed, done = None, None, []
        for batch in batches:
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if hashed is not None and conv == key:
                    hashed.update(b"\n")
                else:
                    if hashed is not None:
                        done.append((key, hashed.hexdigest()))
                    key, hashed = conv, hashlib.sha256()
                hashed.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.int64()), pa.array([h for _, h in done])], ["conv_id", "repaired_sha256"])
                done = []
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([hashed.hexdigest()])], ["conv_id", "repaired_sha256"])

    ordered = rows.select("conv_id", "number", "place", F.concat("role", F.lit(":"), "text").alias("line")).repartition(
        "conv_id").sortWithinPartitions("conv_id", "number", "place")
    return ordered.select("conv_id", "line").mapInArrow(lines, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of ``conv_id:turn``: dropped, emptied, cut, repeated, made user's."""
    part = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    out = rows.select("conv_id", "turn", F.when(part == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                      F.when(part == 1, "").when(part == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), part.alias("part"))
    return out.where("part <> 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("part") == 3, 2).otherwise(1)))).drop("part", "copy")


@query("op12_repair")
def op12_repair(spark, folder):
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    done = repair(damaged(rows))
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    report = done.report.select(F.col("conv_id").alias("rc"), *figures, "audit")
    hashes = digests(done.rows).select(F.col("conv_id").alias("hc"), "repaired_sha256")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("rc")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("hc")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in figures], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
