"""Repair of conversations by a persistent dynamic program over edits.

Rows of a conversation run through a small automaton of the legal role order. For each of its
states the cheapest edits so far are one node of a tree: a node is a letter and its parent, so
all candidates share their prefixes. Nodes hold their ancestors at distances 1, 2, 4, ... and a
rolling hash of all letters up to them. Candidates of equal cost are compared at the first place
where they differ, which is found by lifting both while their hashes differ; that the parts
before it are the same is then verified. (Of two candidates for the same rows and state none is
a beginning of the other: it would differ by insertions only, which cost. So the lesser one
stays the lesser whatever follows.)

A conversation may be of any length. Rows are sorted by ranges of conversation and turn, and a
task works on slices of bounded size. A slice that is a whole conversation is decided where it
is. Of the others each slice gives its cheapest edits from every state to every state; these
tables are then joined by the same dynamic program, one node per slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import slices, stored

# A slice ends after so many rows or so many characters.
SLICE_ROWS = 4096
SLICE_CHARS = 4 << 20
# A task remembers the edits of so many patterns of at most so many rows: most repeat.
PATTERNS = 1 << 16
PATTERN_ROWS = 24
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}

# States: nothing yet, a system row only, after a user row, after an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (NOTHING, ASSISTANT)
INSERTS = ((NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT))
KEEPS = {
    "s": {NOTHING: SYSTEM},
    "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
REROLES = {**KEEPS["u"], **KEEPS["a"]}
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


class Trail:
    """Strings that share their beginnings: node 0 is the empty one."""

    def __init__(self):
        self.parts, self.depths, self.hashes, self.ups = [""], [0], [0], [()]

    def add(self, node: int, part: str) -> int:
        """The node of ``node``'s string followed by ``part``."""
        up, k = [node], 0
        while k < len(self.ups[up[k]]):
            up.append(self.ups[up[k]][k])
            k += 1
        digest = self.hashes[node]
        for c in part:
            digest = (digest * _BASE + ord(c) + 1) % _MODULUS
        self.parts.append(part)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append(digest)
        self.ups.append(tuple(up))
        return len(self.parts) - 1

    def _at(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` that is ``depth`` parts long."""
        left = self.depths[node] - depth
        while left:
            k = left.bit_length() - 1
            node = self.ups[node][k]
            left -= 1 << k
        return node

    def list(self, node: int) -> list[str]:
        found = []
        while node:
            found.append(self.parts[node])
            node = self.ups[node][0]
        return found[::-1]

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depths[a], self.depths[b])
        x, y = self._at(a, depth), self._at(b, depth)
        if x == y or self.hashes[x] == self.hashes[y]:
            if x == y or self.list(x) == self.list(y):
                return self.depths[a] < self.depths[b]
            return self.list(a) < self.list(b)
        for k in reversed(range(len(self.ups[x]))):
            if k < len(self.ups[x]):
                p, q = self.ups[x][k], self.ups[y][k]
                if p != q and self.hashes[p] != self.hashes[q]:
                    x, y = p, q
        p, q = self.ups[x][0], self.ups[y][0]
        # Equal hashes of what lies before are verified; they may be another's by chance.
        if p != q and self.list(p) != self.list(q):
            return self.list(a) < self.list(b)
        return self.parts[x] < self.parts[y]


Cells = dict[int, tuple[int, int]]


def _put(cells: Cells, state: int, cost: int, node: int, part: str, trail: Trail) -> None:
    """Offer ``node`` and ``part`` for ``state``; the cheaper and then the lesser one stays."""
    held = cells.get(state)
    if held is None or cost < held[0]:
        cells[state] = (cost, trail.add(node, part))
    elif cost == held[0]:
        new = trail.add(node, part)
        if trail.less(new, held[1]):
            cells[state] = (cost, new)


def _with_inserts(cells: Cells, trail: Trail) -> Cells:
    # In this order one pass is enough, as a second insertion can only follow a user row.
    cells = dict(cells)
    for state, after in INSERTS:
        if state in cells:
            cost, node = cells[state]
            _put(cells, after, cost + INSERT_COST, node, "I", trail)
    return cells


def _after_rows(pattern: str, entry: int, trail: Trail) -> Cells:
    """Cheapest edits of rows from one state, for every state after the last row.

    A row is the initial of its role, in upper case if its text is truncated (``-`` and ``+``
    for initials that no rule keeps), or ``x`` if it has to go.
    """
    cells: Cells = {entry: (0, 0)}
    for row in pattern:
        now: Cells = {}
        extra = TRUNCATED_COST if row.isupper() or row == "+" else 0
        kept = KEEPS.get(row.lower(), {})
        for state, (cost, node) in _with_inserts(cells, trail).items():
            _put(now, state, cost + DELETE_COST, node, "D", trail)
            if row == "x":
                continue
            if state in kept:
                _put(now, kept[state], cost + extra, node, "K", trail)
            if state in REROLES:
                _put(now, REROLES[state], cost + extra + REROLE_COST, node, "R", trail)
        cells = now
    return cells


def _closed(cells: Cells, trail: Trail) -> tuple[int, int]:
    """Cost and node of the cheapest way to a state that may end a conversation."""
    cells = _with_inserts(cells, trail)
    best = None
    for state in FINAL:
        if state in cells and (
            best is None
            or cells[state][0] < best[0]
            or cells[state][0] == best[0]
            and trail.less(cells[state][1], best[1])
        ):
            best = cells[state]
    return best


def cheapest(pattern: str) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation."""
    trail = Trail()
    cost, node = _closed(_after_rows(pattern, NOTHING, trail), trail)
    return cost, "".join(trail.list(node))


def replay(
    lines: list[tuple[str, str]], letters: str, state: int = NOTHING
) -> tuple[list[tuple[str, str]], int]:
    """Role and text of the rows that the edits leave, and the state after them."""
    out, at = [], 0
    for letter in letters:
        if letter == "I":
            state = dict(INSERTS)[state]
            out.append((NAMES[state], ""))
            continue
        role, text = lines[at]
        at += 1
        if letter == "K":
            state = KEEPS[role[:1]][state]
            out.append((role, text))
        elif letter == "R":
            state = REROLES[state]
            out.append((NAMES[state], text))
    return out, state


def _joined(messages: Iterable[tuple[str, str]]) -> bytes:
    return "\n".join(f"{r}:{t}" for r, t in messages).encode("utf-8", "surrogatepass")


@dataclass
class _Slice:
    """Rows of one conversation in a row, and what was counted on them."""

    conv: int | None
    last: tuple | None = None
    lines: list | None = None
    pattern: list | None = None
    chars: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None

    def __post_init__(self):
        self.lines, self.pattern = [], []

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        row = (turn, role, text)
        again = again or row == self.last
        self.last = row
        body = text.rstrip(SPACES)
        initial = role[:1]
        if not body:
            self.blank += 1
            self.pattern.append("x")
        elif again:
            self.duplicate += 1
            self.pattern.append("x")
        elif body.endswith(ENDS):
            self.pattern.append(initial if initial in KEEPS else "-")
        else:
            self.truncated += 1
            self.pattern.append(initial.upper() if initial in KEEPS else "+")
        if self.lines and self.lines[-1][0][:1] + initial not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.lines.append((role, text))
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.lines) >= SLICE_ROWS or self.chars >= SLICE_CHARS


_LINES = "array<struct<role:string,text:string>>"
_LINES_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "turns"]
_SLICE_SCHEMA = (
    "conv_id long, part int, slice int, whole boolean, n long, blank long, duplicate long,"
    " truncated long, illegal long, turns long, first_turn long, last_turn long,"
    " first_role string, last_role string, costs array<long>, letters array<string>,"
    f" sha256 string, lines {_LINES}"
)
_SLICE_NAMES = [
    "conv_id", "part", "slice", "whole", *_COUNTS, "first_turn", "last_turn", "first_role",
    "last_role", "costs", "letters", "sha256", "lines",
]
_SLICE_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 8, pa.string(), pa.string(),
    pa.list_(pa.int64()), pa.list_(pa.string()), pa.string(), _LINES_TYPE,
]


def _slice_row(
    s: _Slice, part: int, number: int, whole: bool, with_lines: bool, known: dict
) -> tuple:
    pattern, digest, lines = "".join(s.pattern), None, s.lines
    if whole:
        if pattern not in known:
            if len(known) >= PATTERNS:
                known.clear()
            known[pattern] = cheapest(pattern)
        cost, audit = known[pattern]
        if len(pattern) > PATTERN_ROWS:
            del known[pattern]
        repaired, _ = replay(s.lines, audit)
        costs, letters = [cost], [audit]
        digest = hashlib.sha256(_joined(repaired)).hexdigest()
        lines = repaired if with_lines else None
    else:
        costs, letters = [], []
        for entry in range(4):
            trail = Trail()
            cells = _after_rows(pattern, entry, trail)
            for state in range(4):
                cost, node = cells.get(state, (None, None))
                costs.append(cost)
                letters.append(None if cost is None else "".join(trail.list(node)))
    return (
        s.conv, part, number, whole, len(s.lines), s.blank, s.duplicate, s.truncated, s.illegal,
        s.turns, s.first_turn, s.last_turn, s.lines[0][0][:1] if s.lines else None,
        s.lines[-1][0][:1] if s.lines else None, costs, letters, digest,
        lines and [{"role": r, "text": t} for r, t in lines],
    )


def _table(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
    )


def _sliced(rows: DataFrame, absent: Column | None, with_lines: bool) -> DataFrame:
    """Stored slices of all conversations; a conversation without a present row has an empty one."""
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))).alias("gone"),
    ).withColumns(
        {
            # Two hashes name a row's conversation, role and text; a null has a place of its own.
            "h": F.xxhash64(F.col("conv_id").isNull(), "conv_id", "role", "text"),
            "g": F.xxhash64("text", F.lit(1), "role", F.lit(2), "conv_id"),
            "when": F.struct(F.col("turn").isNotNull().alias("known"), "turn"),
        }
    )
    # Copies are counted before the shuffle; only what repeats is looked up.
    firsts = (
        given.filter("NOT gone")
        .groupBy("h", "g")
        .agg(F.min("when").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("h", "g", "first")
    )
    marked = given.join(firsts, ["h", "g"], "left").select(
        "conv_id", "turn", "role", "text", "gone",
        F.coalesce(F.col("when") > F.col("first"), F.lit(False)).alias("again"),
    )
    ranges = ["conv_id", "turn", "role"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        known: dict[str, tuple[int, str]] = {}
        held, number, first, open_ = None, 0, True, False

        def emit(whole: bool) -> None:
            nonlocal number
            out.append(_slice_row(held, part, number, whole, with_lines, known))
            number += 1

        for batch in slices(batches, "text"):
            columns = ("conv_id", "turn", "role", "text", "gone", "again")
            for conv, turn, role, text, gone, again in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True
            ):
                if held is None or held.conv != conv:
                    if held is not None:
                        # The first conversation may have begun in the part before.
                        emit(whole=not first and not open_)
                        first = False
                    held, open_ = _Slice(conv), False
                elif held.full and not gone:
                    emit(whole=False)
                    held, open_ = _Slice(conv, held.last), True
                if not gone:
                    held.add(turn, role, text, again)
            if out:
                yield _table(out, _SLICE_TYPES, _SLICE_NAMES)
                out.clear()
        if held is not None:
            emit(whole=False)
            yield _table(out, _SLICE_TYPES, _SLICE_NAMES)

    return stored(
        marked.repartitionByRange(*ranges, F.substring("text", 1, 32))
        .sortWithinPartitions(*ranges, "text")
        .mapInArrow(cut, _SLICE_SCHEMA),
        "conversation-slices",
    )


_DECIDED = (
    "conv_id long, n long, blank long, duplicate long, truncated long, illegal long, turns long,"
    " first_turn long, last_turn long, cost long, audit string,"
    " pieces array<struct<part:int,slice:int,letters:string>>"
)


def _decided(parts: DataFrame) -> DataFrame:
    """One row for each conversation of several slices: counts, cost, audit and its slices' edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 10 + [
            pa.string(),
            pa.list_(
                pa.struct(
                    [("part", pa.int32()), ("slice", pa.int32()), ("letters", pa.string())]
                )
            ),
        ]
        names = ["conv_id", *_COUNTS, "first_turn", "last_turn", "cost", "audit", "pieces"]
        held = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held is None or held.conv != row["conv_id"]:
                    if held is not None:
                        out.append(held.row())
                    held = _Joined(row["conv_id"])
                held.add(row)
            if out:
                yield _table(out, types, names)
        if held is not None:
            yield _table([held.row()], types, names)

    return (
        parts.drop("lines", "sha256", "whole")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "slice")
        .mapInArrow(run, _DECIDED)
    )


class _Joined:
    """The slices of one conversation, joined in order."""

    def __init__(self, conv: int | None):
        self.conv = conv
        self.trail = Trail()
        self.cells: Cells = {NOTHING: (0, 0)}
        self.slices: list[tuple[int, int]] = []
        self.totals = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = self.last_role = None

    def add(self, row: dict) -> None:
        self.slices.append((row["part"], row["slice"]))
        now: Cells = {}
        for entry, (cost, node) in self.cells.items():
            for state in range(4):
                more = row["costs"][entry * 4 + state]
                if more is not None:
                    letters = row["letters"][entry * 4 + state]
                    _put(now, state, cost + more, node, letters, self.trail)
        self.cells = now
        for c in _COUNTS:
            self.totals[c] += row[c]
        if self.last_role is not None and row["first_role"] is not None:
            self.totals["illegal"] += self.last_role + row["first_role"] not in LEGAL
        self.last_role = self.last_role if row["last_role"] is None else row["last_role"]
        if row["first_turn"] is not None:
            self.totals["turns"] -= self.last_turn == row["first_turn"]
            self.first_turn = row["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = row["last_turn"]

    def row(self) -> tuple:
        cost, node = _closed(self.cells, self.trail)
        parts = self.trail.list(node)
        # Insertions at the end go with the last slice.
        count = len(self.slices)
        parts = [*parts[: count - 1], "".join(parts[count - 1 :])]
        pieces = [
            {"part": part, "slice": number, "letters": letters}
            for (part, number), letters in zip(self.slices, parts, strict=True)
        ]
        return (
            self.conv, *(self.totals[c] for c in _COUNTS), self.first_turn, self.last_turn, cost,
            "".join(parts), pieces,
        )


def _replayed(parts: DataFrame, decided: DataFrame) -> DataFrame:
    """conv_id, part, slice and the repaired lines of conversations of several slices."""
    pieces = decided.select(F.explode("pieces").alias("p")).select("p.*")
    kind = f"conv_id long, part int, slice int, lines {_LINES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, begun = None, NOTHING, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv:
                    conv, state, begun = row["conv_id"], NOTHING, True
                lines = [(x["role"], x["text"]) for x in row["lines"] or []]
                repaired, state = replay(lines, row["letters"], state)
                out.append(
                    (conv, row["part"], row["slice"], [{"role": r, "text": t} for r, t in repaired])
                )
            if out:
                yield _table(
                    out,
                    [pa.int64(), pa.int32(), pa.int32(), _LINES_TYPE],
                    ["conv_id", "part", "slice", "lines"],
                )

    return (
        parts.select("conv_id", "part", "slice", "lines")
        .join(pieces, ["part", "slice"])
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "slice")
        .select("conv_id", "part", "slice", "letters", "lines")
        .mapInArrow(run, kind)
    )


def _digests(lines: DataFrame) -> DataFrame:
    """conv_id and sha256 of the lines of each conversation; a hash has to see them in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, empty, begun = None, None, True, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv:
                    if begun:
                        out.append((conv, digest.hexdigest()))
                    conv, digest, empty, begun = row["conv_id"], hashlib.sha256(), True, True
                if row["lines"]:
                    digest.update(b"" if empty else b"\n")
                    digest.update(_joined((x["role"], x["text"]) for x in row["lines"]))
                    empty = False
            if out:
                yield _table(out, [pa.int64(), pa.string()], ["conv_id", "sha256"])
        if begun:
            yield _table([(conv, digest.hexdigest())], [pa.int64(), pa.string()], ["conv_id", "sha256"])

    # _replayed leaves the slices of a conversation in order in one partition.
    return lines.mapInArrow(run, "conv_id long, sha256 string")


def repair(rows: DataFrame, absent: Column | None = None) -> DataFrame:
    """What is wrong with each conversation of ``rows`` (conv_id, turn, role, text) and its repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (K, R, D, I for
    keep, rerole, delete, insert) and repaired_sha256. Rows for which ``absent`` is true do not
    count, but their conversation is listed; with no other row it has zeros, an empty audit and
    the hash of nothing. Null roles and texts are one space, a null conv_id is a conversation
    like any other, a null turn comes first. Rows of one turn are taken in order of role and
    text; rows that repeat are duplicates. Very long texts are read whole; a single row must
    fit in a Python worker, and the audit in a column. Other columns are not read. An empty
    table has no conversation.
    """
    found = _sliced(rows, absent, with_lines=False)
    parts = found.filter("NOT whole")
    decided = stored(_decided(parts), "conversation-edits")
    digests = _digests(_replayed(parts, decided))
    joined = decided.join(
        digests, decided["conv_id"].eqNullSafe(digests["conv_id"])
    ).select(decided["*"], digests["sha256"])
    columns = ["conv_id", *_COUNTS, "first_turn", "last_turn", "cost", "audit", "sha256"]
    whole = found.filter("whole").withColumns(
        {"cost": F.col("costs")[0], "audit": F.col("letters")[0]}
    )
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    return (
        whole.select(columns)
        .union(joined.select(columns))
        .select(
            "conv_id",
            gaps.cast("long").alias("gaps"),
            "blank",
            "duplicate",
            "truncated",
            "illegal",
            "cost",
            "audit",
            F.col("sha256").alias("repaired_sha256"),
        )
    )


def messages(rows: DataFrame, absent: Column | None = None) -> DataFrame:
    """The repaired conversations of ``rows``: conv_id, part, slice, place, role and text.

    A conversation's messages are in order of part, slice and place. All else as in ``repair``.
    """
    found = _sliced(rows, absent, with_lines=True)
    parts = found.filter("NOT whole")
    decided = stored(_decided(parts), "conversation-edits")
    columns = ["conv_id", "part", "slice", "lines"]
    return (
        found.filter("whole")
        .select(columns)
        .union(_replayed(parts, decided).select(columns))
        .select("conv_id", "part", "slice", F.posexplode("lines").alias("place", "line"))
        .select("conv_id", "part", "slice", "place", "line.role", "line.text")
    )
