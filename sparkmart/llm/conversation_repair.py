"""Repair of conversations: edits of least cost, ties by prefix-doubled ranks.

A conversation's rows are edited until the first letters of its roles read
``(s?(ua)+)?``. A row is kept (K), given the other role (R) or deleted (D); turns without
text are inserted (I). What has been written so far is one of four states (nothing, ``s``,
ends in ``u``, ends in ``a``), so a dynamic program over (row, state) from the last row to
the first gives the least cost to the end, and the arcs on cheapest ways.

Among these arcs the audit (the edits' letters in order) that is least in ASCII is wanted.
The nodes are ranked by the first 1, 2, 4, ... letters of their least audits: a node's rank
for twice as many letters is that of the pair (own rank, rank of the node so many letters
on), and its pointer there is the pointer's pointer. A node's arcs have distinct letters,
so its least arc is known from the first round; the rounds order the audits of different
nodes, and the way is read off the doubled pointers, half a stride at a time.

Rows reach a task twice in one sorted stream: first as one small code per distinct row, from
which the audit is made block by block, then as texts, which are edited and digested one by
one and never held. A conversation passes through one task, as its audit and digest are
single values; the task holds a byte a row of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the contract.
RULES = 20
DROP, EMPTY, UNSTOP, REPEAT, AS_USER = range(5)
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
STOPS, BLANKS = ".!?", " \t\n\u000b\f\r"

#: Codes of a row: its role's letter (s, u, a, another), and what is wrong with it.
LETTERS = "sua"
OTHER = 3
MUST_GO, TRUNCATED = 4, 8
#: States: nothing written, s, ends in u, ends in a. What each letter leads to (-1: nothing).
_KEEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
_NEXT = np.array([2, 2, 3, 2])
_END = (0, 3)
_FAR = np.int64(1) << 60
#: Rows whose nodes are ranked at a time.
BLOCK = 4096


def _steps(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least costs to the end from each state before each row, and behind the last.

    ``after``: the costs behind the last row.
    """
    costs = np.empty((len(codes) + 1, 4), np.int64)
    costs[-1] = after
    below = after.tolist()
    for i in range(len(codes) - 1, -1, -1):
        code = int(codes[i])
        extra = TRUNCATED_COST if code & TRUNCATED else 0
        here = [c + DELETE_COST for c in below]
        if not code & MUST_GO:
            for s in range(4):
                kept = _KEEP_LIST[s][code & 3]
                if kept >= 0 and below[kept] + extra < here[s]:
                    here[s] = below[kept] + extra
                if below[_NEXT_LIST[s]] + REROLE_COST + extra < here[s]:
                    here[s] = below[_NEXT_LIST[s]] + REROLE_COST + extra
        below = costs[i] = _with_inserts(here)
    return costs


_KEEP_LIST, _NEXT_LIST = _KEEP.tolist(), _NEXT.tolist()


def _with_inserts(costs: list[int]) -> list[int]:
    """Two inserted turns lead back to the same state, so more are never cheaper."""
    once = [min(c, costs[n] + INSERT_COST) for c, n in zip(costs, _NEXT_LIST, strict=True)]
    return [min(c, once[n] + INSERT_COST) for c, n in zip(costs, _NEXT_LIST, strict=True)]


def _arcs(codes: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node (row, state): the letter of its least cheapest arc, and where it leads.

    Nodes are numbered row by row; those behind the last row may still insert, and a node
    that ends there leads to itself with letter 0.
    """
    n = len(codes)
    at = np.arange(n + 1)[:, None] * 4
    letter = np.zeros((n + 1, 4), np.int64)
    leads = at + np.arange(4)
    extra = np.where(codes & TRUNCATED, TRUNCATED_COST, 0)[:, None]
    stays = (codes & MUST_GO == 0)[:, None]
    kept = _KEEP[:, codes & 3].T
    reroled = np.broadcast_to(_NEXT, (n, 4))

    def arc(name: str, where: np.ndarray, to: np.ndarray) -> None:
        rows = slice(0, len(where))
        letter[rows] = np.where(where, ord(name), letter[rows])
        leads[rows] = np.where(where, to, leads[rows])

    # From the greatest letter to the least, so that the least one is left.
    below = np.take_along_axis(costs[1:], reroled, 1) + REROLE_COST + extra
    arc("R", stays & (below == costs[:-1]), at[1:] + reroled)
    below = np.take_along_axis(costs[1:], np.maximum(kept, 0), 1) + extra
    arc("K", stays & (kept >= 0) & (below == costs[:-1]), at[1:] + kept)
    arc("I", costs[:, _NEXT] + INSERT_COST == costs, at + _NEXT)
    arc("D", costs[1:] + DELETE_COST == costs[:-1], at[1:] + np.arange(4))
    return letter.ravel(), leads.ravel()


def ranks(letter: np.ndarray, leads: np.ndarray) -> tuple[list, list]:
    """Ranks and pointers of all nodes for 1, 2, 4, ... letters, to the longest audit."""
    _, rank = np.unique(letter, return_inverse=True)
    all_ranks, pointers = [rank], [leads]
    ends = letter == 0
    while not ends[pointers[-1]].all():
        rank, pointer = all_ranks[-1], pointers[-1]
        pair = rank * (int(rank.max()) + 1) + rank[pointer]
        all_ranks.append(np.unique(pair, return_inverse=True)[1])
        pointers.append(pointer[pointer])
    return all_ranks, pointers


def _way(letter: np.ndarray, pointers: list, start: int) -> np.ndarray:
    """The nodes of the least audit from ``start``, its last node included."""
    nodes = np.array([start])
    for pointer in reversed(pointers):
        nodes = np.stack([nodes, pointer[nodes]], 1).ravel()
    return nodes[: int(np.argmax(letter[nodes] == 0)) + 1]


def least_audit(codes: np.ndarray) -> tuple[int, list[bytes]]:
    """The least cost, and the ASCII-least audit of that cost, in parts of some rows."""
    end = [0 if s in _END else int(_FAR) for s in range(4)]
    bounds = [*range(0, len(codes), BLOCK), len(codes)] if len(codes) else [0, 0]
    after = [np.array(_with_inserts(end), np.int64)]
    for low, high in zip(bounds[-2::-1], bounds[:0:-1], strict=True):
        after.append(_steps(codes[low:high], after[-1])[0])
    cost = int(after[-1][0])
    state, parts = 0, []
    for k, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        last = high == len(codes)
        costs = _steps(codes[low:high], after[len(bounds) - 2 - k])
        letter, leads = _arcs(codes[low:high], costs)
        # Behind the block's last row its way ends, and the next block's begins.
        behind = slice(len(letter) - 4, len(letter))
        if last:
            for s in _END:
                done = len(letter) - 4 + s
                if costs[-1][s] == 0:
                    letter[done], leads[done] = 0, done
        else:
            letter[behind], leads[behind] = 0, np.arange(len(letter) - 4, len(letter))
        _, pointers = ranks(letter, leads)
        nodes = _way(letter, pointers, state)
        parts.append(letter[nodes[:-1]].astype(np.uint8).tobytes())
        state = int(nodes[-1]) % 4
    return cost, parts


class _Repair:
    """One conversation: first its codes, then its texts, both in order."""

    def __init__(self):
        self.codes = bytearray()
        self.n = {MUST_GO: 0, MUST_GO | 16: 0, TRUNCATED: 0}
        self.low = self.high = self.turn = None
        self.distinct = 0
        self.edits: Iterator[int] | None = None

    def add_code(self, turn: int | None, code: int, copies: int, again: bool) -> None:
        """``copies`` equal rows; all but the first, or with ``again`` all, are duplicates."""
        if not copies:
            return
        if turn is not None and (self.turn is None or turn != self.turn):
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.distinct += 1
        letter = code & 3
        if code & MUST_GO:
            self.n[MUST_GO] += copies
            self.codes += bytes([code]) * copies
            return
        if not again:
            self.n[TRUNCATED] += bool(code & TRUNCATED)
            self.codes.append(code)
            copies -= 1
        self.n[MUST_GO | 16] += copies
        self.codes += bytes([letter | MUST_GO]) * copies

    def plan(self) -> None:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        letters = codes & 3
        pairs = letters[:-1].astype(int) * 4 + letters[1:]
        s, u, a = (LETTERS.index(x) for x in LETTERS)
        legal = np.isin(pairs, [s * 4 + u, u * 4 + a, a * 4 + u])
        self.illegal = int(len(pairs) - legal.sum())
        self.cost, parts = least_audit(codes)
        self.audit = b"".join(parts)
        self.codes = None
        self.edits = iter(self.audit)
        self.digest = hashlib.sha256()
        self.state, self.written = 0, False

    def _write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written = True

    def add_text(self, role: str | None, text: str) -> None:
        """Apply the edits up to that of the next row; ``None`` for those behind the last."""
        for edit in map(chr, self.edits):
            wanted = "assistant" if self.state == 2 else "user"
            if edit == "I":
                self._write(wanted, "")
            elif edit == "R":
                self._write(wanted, text)
            elif edit == "K":
                self._write(role, text)
                if role[:1] == "s":
                    self.state = 1
                    return
            if edit != "D":
                self.state = int(_NEXT[self.state])
            if edit != "I":
                return

    def row(self) -> tuple:
        if self.edits is None:
            self.plan()
        self.add_text(None, "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (
            gaps,
            self.n[MUST_GO],
            self.n[MUST_GO | 16],
            self.n[TRUNCATED],
            self.illegal,
            self.cost,
            self.audit.decode(),
            self.digest.hexdigest(),
        )


RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _repairer(id_type: pa.DataType):
    names = ["conv_id", *(part.split()[0] for part in RESULT.split(", "))]
    kinds = [pa.string() if "string" in part else pa.int64() for part in RESULT.split(", ")]

    def result(ids: list, done: list[tuple]) -> pa.RecordBatch:
        columns = zip(kinds, zip(*done, strict=True), strict=True)
        arrays = [pa.array(ids, id_type), *(pa.array(c, k) for k, c in columns)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        for batch in batches:
            ids, done = [], []
            for conv, phase, turn, code, copies, again, role, text in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if held is None or conv != own:
                    if held is not None:
                        ids.append(own)
                        done.append(held.row())
                    held, own = _Repair(), conv
                if phase == 0:
                    held.add_code(turn, code, copies, again)
                else:
                    if held.edits is None:
                        held.plan()
                    held.add_text(role, text)
            if done:
                yield result(ids, done)
        if held is not None:
            yield result([own], [held.row()])

    return run


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) after the damage, with ``copies`` of each row.

    Nulls of role and text become one space. A row that is dropped has no copies.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rule = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % RULES
    text = (
        F.when(rule == EMPTY, "")
        .when(rule == UNSTOP, F.translate(shown("text"), STOPS, ""))
        .otherwise(shown("text"))
    )
    return turns.select(
        "conv_id",
        "turn",
        F.when(rule == AS_USER, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.when(rule == DROP, 0).when(rule == REPEAT, 2).otherwise(1).alias("copies"),
    )


def _codes(rows: DataFrame) -> DataFrame:
    """One row for each distinct row, with its code and whether it was seen before."""
    letter = F.substring("role", 1, 1)
    initial = F.lit(OTHER)
    for k, name in enumerate(LETTERS):
        initial = F.when(letter == name, k).otherwise(initial)
    trimmed = F.rtrim("text", F.lit(BLANKS))
    wrong = (
        F.when(trimmed == "", MUST_GO)
        .when(~F.substring(trimmed, -1, 1).isin(*STOPS), TRUNCATED)
        .otherwise(0)
    )
    there = F.col("copies") > 0
    slim = rows.select(
        "conv_id",
        *(
            F.when(there, column).alias(name)
            for name, column in (
                ("turn", F.col("turn")),
                ("role", F.col("role")),
                ("digest", F.sha2("text", 256)),
                ("code", initial + wrong),
            )
        ),
        "copies",
    )
    distinct = slim.groupBy("conv_id", "turn", "role", "digest", "code").agg(
        F.sum("copies").alias("copies")
    )
    # Said in more than one turn: few, so the turns themselves need no window.
    first = (
        distinct.groupBy("conv_id", "role", "digest")
        .agg(
            F.count("*").alias("n"),
            F.count("turn").alias("n_turns"),
            F.min("turn").alias("first"),
        )
        .where("n > 1")
        .select(
            F.col("conv_id").alias("c"),
            F.col("role").alias("r"),
            F.col("digest").alias("d"),
            F.when(F.col("n") == F.col("n_turns"), F.col("first")).alias("first"),
            F.lit(True).alias("several"),
        )
    )
    same = (
        distinct["conv_id"].eqNullSafe(first["c"])
        & distinct["role"].eqNullSafe(first["r"])
        & distinct["digest"].eqNullSafe(first["d"])
    )
    again = F.col("several").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    return distinct.join(first, same, "left").select(
        "conv_id",
        F.lit(0).alias("phase"),
        "turn",
        "role",
        "digest",
        "code",
        "copies",
        again.alias("again"),
        F.lit(None).cast("string").alias("text"),
    )


def repair(turns: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of each conversation of ``turns`` after the damage.

    One row per conv_id, also where all rows are dropped (zeros, an empty audit, the digest
    of nothing); turns with a null conv_id are one conversation. Rows go by turn, nulls
    first; rows of the same turn by role and then by a digest of their text. A null role or
    text is one space, so the text is blank, and the role none of s, u and a; nor is an
    empty role. Repeated rows are duplicates of the first. An empty table gives no rows;
    other columns are not read. A text of any length is handled as one value.
    """
    id_field = turns.schema["conv_id"]
    rows = damage(turns.select("conv_id", "turn", "role", "text"))
    texts = rows.where("copies > 0").select(
        "conv_id",
        F.lit(1).alias("phase"),
        "turn",
        "role",
        F.sha2("text", 256).alias("digest"),
        F.lit(0).alias("code"),
        F.lit(0).cast("long").alias("copies"),
        F.lit(False).alias("again"),
        F.explode(F.array_repeat("text", F.col("copies"))).alias("text"),
    )
    return (
        _codes(rows)
        .unionByName(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "phase", "turn", "role", "digest")
        .select("conv_id", "phase", "turn", "code", "copies", "again", "role", "text")
        .mapInArrow(
            _repairer(_arrow_type(id_field.dataType)),
            f"conv_id {id_field.dataType.simpleString()}, {RESULT}",
        )
    )


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
