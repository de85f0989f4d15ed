"""Conversation structure repair by depth-first branch-and-bound.

Rows of a conversation are put in order of turn, get their faults, and are edited until the roles read
``(system? (user assistant)+)?`` at the least cost. Edits: keep (K, free), reroll the role to user or assistant (R, 3),
delete (D, 4; blank and repeated rows must go), insert an empty user or assistant row (I, 3); a truncated row that is not
deleted costs 3 more. Among the cheapest edits the ASCII-least string of initials (the *audit*) wins.

**Search.** A node is (rows decided, role state); its prefix is (cost, audit). An explicit stack is followed depth first,
the branch with the least bound first. A node is dropped when its cost and the *suffix lower bound* exceed the incumbent,
when they tie with the incumbent and its audit is already larger, or when its *dominance table* entry (the best prefix that
reached the same node) is not worse. The search ends with an empty stack: the incumbent is then optimal. Two prefixes of one
node with equal cost are never a beginning of one another (they decide the same rows, and an insert more would cost more),
so the smaller one stays smaller whatever follows. The bounds hold the role rules but no audit; looser ones (costs that no
edit avoids, pairs of neighbours with one role) left equal costs open and took exponential time on some 300 rows.

**Long conversations** are read as a stream: the search runs over blocks of rows, once for each role state at the block's
end, and the next block starts from all of these prefixes. What these prefixes have in common is final: it is written to the
digest and forgotten. A task holds a block of rows and the undecided tails, however long the conversation is; the digest of
the repaired rows (one hash over them in order) and the audit are by contract one value of the whole conversation.

**Plan.** Damage and faults are native expressions, rows are dealt once by conversation; a repeated row is found by its
rank among equal (role, text) in that same distribution, so no task gathers a conversation's texts in a set.

Nulls count as one space in the damage key, as role and as text (a null role can be neither kept nor told from a space);
null turns come first and are left out of ``gaps``; a null conversation id is a conversation of its own. Rows of one turn
are ordered by role, then text; repeated rows are kept apart and repeats after the first are duplicates. Empty and very
long texts need no care. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
BLOCK = 64  # rows that one search decides
SLACK = 12  # a state that is dearer than the best one by more can be reached from that one for less, whatever follows
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FAR = 1 << 40  # no way to the goal
SOUND, MUST_GO, TRUNCATED = 0, 1, 2
#: Role states: nothing yet, a system row, a user row, an assistant row came last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ASKS_USER = (True, True, False, True)  # which role each state lets in by insert or rerole
AFTER = (USER, USER, ASSISTANT, USER)


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, alive) after the contract's damage; dropped rows stay with ``alive`` false, so that
    a conversation without rows is still known."""
    key = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), key.alias("hit")).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") != 0, text).otherwise(F.lit("")).alias("text"), (F.col("hit") != 0).alias("alive"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("time")).drop("time")


def _fault(earlier: Column) -> Column:
    """0 none, 1 blank, 2 duplicate, 3 truncated; the first one counts."""
    ended = F.rtrim("text", F.lit(WHITE))
    return F.when(F.length(ended) == 0, 1).when(earlier, 2).when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)


def _edges(code: str, fault: int, state: int) -> tuple:
    """Edits of a row in a state as (initial, cost, next state)."""
    more = CUT if fault == TRUNCATED else 0
    out = [("D", DELETE, state)]
    if fault != MUST_GO:
        out.append(("R", REROLE + more, AFTER[state]))
        fits = {"s": (EMPTY,), "u": (EMPTY, SYSTEM, ASSISTANT), "a": (USER,)}.get(code, ())
        if state in fits:
            out.append(("K", more, SYSTEM if code == "s" else AFTER[state]))
    return tuple(out)


_EDGES = {(c, f): tuple(_edges(c, f, s) for s in range(4)) for c in "suax" for f in (SOUND, MUST_GO, TRUNCATED)}


def suffix_bounds(rows: Sequence[tuple[str, int]], goal: int | None) -> list[list[int]]:
    """Least cost of the rows from i on, for each role state before them, whatever their audit: the end is ``goal``, or any
    allowed sequence. Filled from the last row backwards; the cost of a suffix does not depend on its prefix."""
    ends = (EMPTY, ASSISTANT) if goal is None else (goal,)
    table = [[0 if q in ends else FAR for q in range(4)]]
    for n in range(len(rows) + 1):
        now = table[-1]
        if n:
            now = [min(c + table[-1][to] for _, c, to in edges) for edges in _EDGES[rows[-n]]]
            table.append(now)
        for _ in range(2):  # up to two inserts before the row: user, assistant
            for q in range(4):
                now[q] = min(now[q], INSERT + now[AFTER[q]])
    return table[::-1]


def search(rows: Sequence[tuple[str, int]], starts: Sequence[tuple[int, str, int]], goal: int | None = None) -> tuple[int, str] | None:
    """The best (cost, audit) over all ``rows`` from any of ``starts`` (cost, audit, state) that ends in the state ``goal`` or,
    without one, in an allowed role sequence; None where the goal cannot be reached."""
    n = len(rows)
    bounds = suffix_bounds(rows, goal)
    ends = (EMPTY, ASSISTANT) if goal is None else (goal,)
    tables: dict[tuple[int, int], tuple[int, str]] = {}  # dominance: the best prefix that reached each node
    best: tuple[int, str] | None = None  # the incumbent
    stack = sorted(((c, a, 0, q) for c, a, q in starts), key=lambda e: (e[0] + bounds[0][e[3]], e[1]), reverse=True)
    while stack:
        cost, audit, i, state = stack.pop()
        bound = cost + bounds[i][state]
        if bound >= FAR or (best is not None and (bound > best[0] or (bound == best[0] and audit > best[1][:len(audit)]))):
            continue
        node, mine = (i, state), (cost, audit)
        if node in tables and tables[node] <= mine:
            continue
        tables[node] = mine
        if i == n and state in ends and (best is None or mine < best):
            best = mine
        branches = [(cost + INSERT, audit + "I", i, AFTER[state])]
        if i < n:
            branches.extend((cost + c, audit + letter, i + 1, to) for letter, c, to in _EDGES[rows[i]][state])
        branches.sort(key=lambda e: (e[0] + bounds[e[2]][e[3]], e[1]), reverse=True)
        stack.extend(branches)
    return best


@lru_cache(maxsize=50_000)
def _short(rows: tuple) -> tuple[int, str]:
    return search(rows, [(0, "", EMPTY)])


class Repair:
    """One conversation as a stream of rows: faults are counted, blocks are searched, what is decided is hashed."""

    def __init__(self):
        self.counts = [0, 0, 0, 0]  # rows without a fault, blank, duplicate, truncated
        self.illegal = self.turns = self.cost = 0
        self.before = self.low = self.high = self.turn = None
        self.rows: list[tuple[str, int]] = []  # rows that no search has decided yet
        self.held: list[tuple[str, str]] = []  # (role, text) of rows whose edit is open
        self.ends = [(0, "", EMPTY)]
        self.audit: list[str] = []
        self.state, self.lines, self.hash = EMPTY, 0, hashlib.sha256()

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high, self.turns, self.turn = turn, self.turns + (turn != self.turn), turn
        self.held.append((role, text))
        self.rows.append((initial if initial in ("s", "u", "a") else "x", (SOUND, MUST_GO, MUST_GO, TRUNCATED)[fault]))
        if len(self.rows) > BLOCK:
            self._decide(BLOCK)

    def _decide(self, count: int) -> None:
        found = [(search(self.rows[:count], self.ends, goal), goal) for goal in range(4)]
        least = min(e[0] for e, _ in found if e is not None)
        self.ends = [(*e, goal) for e, goal in found if e is not None and e[0] <= least + SLACK]
        del self.rows[:count]
        sure = os.path.commonprefix([e[1] for e in self.ends])
        if sure:
            self._apply(sure)
            self.ends = [(c, a[len(sure):], s) for c, a, s in self.ends]

    def _apply(self, edits: str) -> None:
        at = 0
        for letter in edits:
            role, text = ("", "") if letter == "I" else self.held[at]
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = "user" if ASKS_USER[self.state] else "assistant"
            self.state = SYSTEM if role[:1] == "s" else AFTER[self.state]
            self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            self.lines += 1
        del self.held[:at]
        self.audit.append(edits)

    def finish(self) -> tuple:
        if self.ends == [(0, "", EMPTY)] and not self.audit:
            cost, rest = _short(tuple(self.rows))
        else:
            cost, rest = search(self.rows, self.ends)
        self._apply(rest)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.counts[1:], self.illegal, cost, "".join(self.audit), self.hash.hexdigest()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_conversations(rows: DataFrame, alive: str | None = None) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. ``alive`` names a boolean column that is false for rows that are gone already; their conversation is
    returned all the same."""
    here = F.col(alive) if alive else F.lit(True)
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    same = Window.partitionBy("conv_id", "alive", "role", F.md5(F.col("text").cast("binary")), "text").orderBy(*order)
    dealt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"),
                        here.alias("alive")).repartition("conv_id")
    marked = dealt.select("*", _fault(F.row_number().over(same) > 1).alias("fault"))
    source = marked.sortWithinPartitions("conv_id", *order, F.col("fault") == 2)  # the first of equal rows, then its repeats
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, done, type_ = None, None, [], None

        def out() -> pa.RecordBatch:
            cols = [pa.array([d[0] for d in done], type_), *[pa.array([d[n] for d in done], pa.int64()) for n in range(1, 7)],
                    *[pa.array([d[n] for d in done], pa.string()) for n in (7, 8)]]
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            type_ = batch.schema.field("conv_id").type
            cells = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "alive", "fault")]
            for conv, turn, role, text, alive, fault in zip(*cells, strict=True):
                if now is None or conv != at:
                    if now is not None:
                        done.append((at, *now.finish()))
                    now, at = Repair(), conv
                if alive:
                    now.add(turn, role, text, fault)
            if len(done) >= 2_000:
                yield out()
                done = []
        if now is not None:
            done.append((at, *now.finish()))
            yield out()

    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return source.mapInArrow(run, schema)
