"""Repair of conversation structure by the cheapest edits.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``.  Its edits form a lattice:
a node is a number of rows done and the role that was last given out, an edge keeps, re-roles or
deletes the next row or inserts an empty one.  Dijkstra's search runs over it from both ends, each with
its own heap; when no cheaper or equal meeting is left, the least audit among all meetings is taken.

Every conversation reaches its task twice, first as small facts, then as texts.  So the search
runs over a few bytes per row, and the texts of a long conversation pass by without being held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dinerlake.llm.common import BATCH_ROWS, configure

# Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # the fault of a row
START, SYSTEM, USER, ASSISTANT = range(4)  # the role last given out
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL_PAIRS = {"su", "ua", "au"}
SPACE = " \t\n\x0b\f\r"
FLUSH_BYTES = 1 << 22

TURN = "kind string, conv_id {conv}, seq long, role string, text string, edit string"
REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


class Lattice:
    """Edges between nodes; node ``4 * i + state`` has ``i`` rows done."""

    def __init__(self, roles: str, faults: bytes):
        self.roles, self.faults, self.rows = roles, faults, len(faults)

    def keep_state(self, i: int, state: int) -> int | None:
        """The state after keeping row ``i``, if its role may stand there."""
        role = INITIALS.get(self.roles[i])
        if role == NEXT[state] or (role == SYSTEM and state == START):
            return role
        return None

    def out(self, node: int) -> Iterator[tuple[str, int, int]]:
        """``letter, cost, target`` of the edges that leave a node."""
        i, state = divmod(node, 4)
        yield "I", INSERT, 4 * i + NEXT[state]
        if i == self.rows:
            return
        fault = self.faults[i]
        yield "D", DELETE, node + 4
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            kept = self.keep_state(i, state)
            if kept is not None:
                yield "K", KEEP + more, 4 * i + 4 + kept
            if kept != NEXT[state]:
                yield "R", REROLE + more, 4 * i + 4 + NEXT[state]

    def into(self, node: int) -> Iterator[tuple[str, int, int]]:
        """``letter, cost, origin`` of the edges that enter a node."""
        i, state = divmod(node, 4)
        for origin in (4 * i + s for s in range(4) if NEXT[s] == state):
            yield "I", INSERT, origin
        for origin in range(4 * i - 4, 4 * i) if i else ():
            for letter, cost, target in self.out(origin):
                if target == node and letter != "I":
                    yield letter, cost, origin


class Search:
    """The two searches; per node and side: cost, neighbour on the best path and its letter."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.cost: tuple[dict, dict] = ({START: 0}, {4 * lattice.rows + e: 0 for e in ENDS})
        self.link: tuple[dict, dict] = ({START: (None, "")}, {4 * lattice.rows + e: (None, "") for e in ENDS})
        self.done: tuple[set, set] = (set(), set())
        # Edges without cost only go forward in the rows, so that order settles equal costs.
        self.heap: tuple[list, list] = ([(0, 0, START)], [(0, 0, n) for n in self.cost[1]])
        self.best = self._meeting(START) if lattice.rows == 0 else None

    def _meeting(self, node: int) -> int | None:
        a, b = self.cost[0].get(node), self.cost[1].get(node)
        return None if a is None or b is None else a + b

    def _earlier(self, first: tuple[int, str], second: tuple[int, str]) -> bool:
        """Whether the path through ``first`` spells less than that through ``second``; both lead to
        one node.  They are followed back to where they part."""
        (a, x), (b, y) = first, second
        left, right = [x], [y]
        while a != b:
            if (a // 4, self.cost[0][a]) >= (b // 4, self.cost[0][b]):
                a, letter = self.link[0][a]
                left.append(letter)
            else:
                b, letter = self.link[0][b]
                right.append(letter)
        return left[::-1] < right[::-1]

    def _step(self, side: int) -> None:
        cost, _, node = heappop(self.heap[side])
        if node in self.done[side] or cost > self.cost[side][node]:
            return
        self.done[side].add(node)
        edges = self.lattice.into(node) if side else self.lattice.out(node)
        for letter, extra, other in edges:
            new, old = cost + extra, self.cost[side].get(other)
            if old is None or new < old:
                self.cost[side][other] = new
                self.link[side][other] = (node, letter)
                i = other // 4
                heappush(self.heap[side], (new, self.lattice.rows - i if side else i, other))
                met = self._meeting(other)
                if met is not None and (self.best is None or met < self.best):
                    self.best = met
            elif new == old:
                # Behind a node paths differ in their first letter; before it anywhere.
                less = letter < self.link[1][other][1] if side else self._earlier(
                    (node, letter), self.link[0][other])
                if less:
                    self.link[side][other] = (node, letter)

    def _settle(self, side: int) -> None:
        heap = self.heap[side]
        while heap and heap[0][2] in self.done[side]:
            heappop(heap)

    def run(self) -> tuple[int, str]:
        """Least cost, and the least audit of that cost."""
        while True:
            self._settle(0)
            self._settle(1)
            if not self.heap[0] or not self.heap[1]:
                break
            low = self.heap[0][0][0], self.heap[1][0][0]
            # Beyond this, every path of the least cost has an edge from one side's nodes to the other's.
            if self.best is not None and low[0] + low[1] > self.best:
                break
            self._step(0 if (low[0], len(self.done[0])) <= (low[1], len(self.done[1])) else 1)
        return self.best, min(self._audits())

    def _audits(self) -> Iterator[str]:
        """The audits through all meetings; nodes that lie on one path give it once."""
        meetings = {n for n in self.cost[0] if self._meeting(n) == self.best}
        for node in meetings:
            before = self.link[0][node][0]
            if before in meetings and self.link[1][before][0] == node:
                continue
            letters, at = [], node
            while at is not None:
                at, letter = self.link[0][at]
                letters.append(letter)
            letters.reverse()
            at = node
            while at is not None:
                at, letter = self.link[1][at]
                letters.append(letter)
            yield "".join(letters)


def cheapest(roles: str, faults: bytes) -> tuple[int, str]:
    """Least cost and least audit for rows with these role initials and faults."""
    return Search(Lattice(roles, faults)).run()


def edits(audit: str, roles: str) -> Iterator[tuple[str, int | None, str | None]]:
    """``letter, row, new role`` per edit; the new role is None for kept rows."""
    state, row = START, 0
    for letter in audit:
        if letter == "D":
            yield letter, row, None
            row += 1
            continue
        state = SYSTEM if letter == "K" and state == START and roles[row] == "s" else NEXT[state]
        if letter == "I":
            yield letter, None, NAMES[state]
        else:
            yield letter, row, None if letter == "K" else NAMES[state]
            row += 1


class Conversation:
    """What a task holds of one conversation: facts, then the way through the texts."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.roles, self.faults, self.known = [], bytearray(), set()
        self.low = self.high = self.last = None
        self.turns, self.seq = 0, 0
        self.plan, self.hash = None, hashlib.sha256()

    def fact(self, turn, role: str, fault: int, digest: bytes) -> None:
        if turn is not None:
            if turn != self.last:
                self.turns, self.last = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        if fault != BLANK:
            fault = DUPLICATE if digest in self.known else fault
            self.known.add(digest)
        self.roles.append(role[:1] or " ")
        self.faults.append(fault)

    def solve(self) -> None:
        self.known = set()
        self.roles = "".join(self.roles)
        pairs = (self.roles[i:i + 2] for i in range(len(self.roles) - 1))
        cost, audit = cheapest(self.roles, bytes(self.faults))
        self.report = [
            self.high - self.low + 1 - self.turns if self.turns else 0,
            *(self.faults.count(f) for f in (BLANK, DUPLICATE, CUT)),
            sum(p not in LEGAL_PAIRS for p in pairs), cost, audit,
        ]
        self.plan = edits(audit, self.roles)

    def _given(self, role: str, text: str, edit: str) -> tuple:
        self.hash.update(f"{chr(10) if self.seq else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.seq += 1
        return "turn", self.conv_id, self.seq - 1, role, text, edit, None

    def text(self, role: str, text: str) -> Iterator[tuple]:
        """The rows given out up to and with the next row of the conversation."""
        if self.plan is None:
            self.solve()
        for letter, row, name in self.plan:
            if letter != "D":
                yield self._given(name or role, "" if row is None else text, letter)
            if row is not None:
                return

    def end(self) -> Iterator[tuple]:
        if self.plan is None:
            self.solve()
        for letter, _, name in self.plan:
            yield self._given(name, "", letter)
        yield "report", self.conv_id, None, None, None, None, (*self.report, self.hash.hexdigest())


def facts(rows: DataFrame) -> DataFrame:
    """Every row twice: with its fault and digest (phase 0), and with its text (phase 1)."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    fault = (
        F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(SOUND)
    )
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    first = F.col("phase") == 0
    return (
        rows.withColumns({"fault": fault.cast("int"), "digest": digest})
        .withColumn("phase", F.explode(F.when(F.col("dropped"), F.array(F.lit(0))).otherwise(
            F.array(F.lit(0), F.lit(1)))))
        .withColumn("text", F.when(~first, F.col("text")))
        .select("conv_id", "phase", "turn", "role", "digest", "fault", "dropped", "text")
    )


def mended(rows: DataFrame, dropped: Column | None = None) -> DataFrame:
    """``kind, conv_id, seq, role, text, edit, report``: the repaired turns of every conversation
    (kind ``turn``) and one report on it (kind ``report``); see ``turns`` and ``reports``.

    ``rows`` has conv_id, turn, role and text; other columns are not read.  A NULL role or text is one
    space, an empty role too.  Rows are taken by turn (NULL first), equal turns by role and then by a digest of
    role and text, so that repeated rows lie side by side.  A NULL conv_id is a conversation of its own.
    Rows flagged ``dropped`` only name their conversation, which is reported even if nothing else is
    left: zeros, an empty audit and the hash of the empty string.  An empty table gives no rows.

    A conversation is one sequence and is repaired in one task, however many rows it has; that holds
    some hundred bytes per row of it, never its texts, which the sort may spill.
    """
    spark = configure(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType
    clean = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(F.coalesce("role", F.lit("")) == "", " ").otherwise(F.col("role")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce(F.lit(False) if dropped is None else dropped, F.lit(False)).alias("dropped"),
    )
    in_order = facts(clean).repartition("conv_id").sortWithinPartitions(
        "conv_id", "phase", F.col("turn").asc_nulls_first(), "role", "digest")
    schema = TURN.format(conv=conv.simpleString()) + f", report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>"
    report = pa.struct([(n, pa.string() if k == "string" else pa.int64())
                        for n, k in (c.split() for c in REPORT.split(", "))])
    names = [f.name for f in report]
    kinds = [pa.string(), to_arrow_type(conv), pa.int64(), pa.string(), pa.string(), pa.string(), report]

    def repair(batches):
        found, size = [], 0

        def batch():
            columns = list(zip(*found))
            columns[6] = [None if r is None else dict(zip(names, r)) for r in columns[6]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["kind", "conv_id", "seq", "role", "text", "edit", "report"])

        now = None
        for part in batches:
            for conv_id, phase, turn, role, digest, fault, gone, text in zip(*(c.to_pylist() for c in part.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        found += now.end()
                    now = Conversation(conv_id)
                if phase == 0:
                    if not gone:
                        now.fact(turn, role, fault, digest)
                    continue
                for row in now.text(role, text):
                    found.append(row)
                    size += len(row[4])
                if len(found) >= BATCH_ROWS or size >= FLUSH_BYTES:
                    yield batch()
                    found, size = [], 0
        if now is not None:
            found += now.end()
        if found:
            yield batch()

    return in_order.mapInArrow(repair, schema)


def turns(found: DataFrame) -> DataFrame:
    """``conv_id, seq, role, text, edit``: the repaired conversations, row by row."""
    return found.where(F.col("kind") == "turn").select("conv_id", "seq", "role", "text", "edit")


def reports(found: DataFrame) -> DataFrame:
    """Faults, cost, audit and checksum of every conversation."""
    return found.where(F.col("kind") == "report").select("conv_id", "report.*")
