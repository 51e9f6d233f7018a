"""Conversation structure repair by Wagner-Fischer target alignment.

A repaired conversation's role initials are ``(s?(ua)+)?``: perhaps a system turn,
then user and assistant in turn. Every turn is kept (cost 0), reroled to user or
assistant (3) or deleted (4); empty user and assistant turns may be inserted
anywhere (3). Blank and repeated turns must be deleted; a truncated turn that is
not deleted costs 3 more. Of the cheapest repairs the one whose audit (the edits'
initials K, R, D, I in order) is least in ASCII is taken.

Because the grammar alternates, a length fixes its target string. The turns are
aligned to the target of each feasible length, from the nearest length outwards,
until the length alone costs more than the incumbent. An alignment is a
Wagner-Fischer table in an Ukkonen band: only cells whose offset can be reached
and left within the incumbent's cost are filled. The table holds the costs of the
rest of the turns, so the least audit is traced forward; equal costs of other
lengths are decided by comparing these audits.

Long conversations are cut into runs of ``RUN_TURNS`` turns that may be kept. A
run is aligned to the strings by which the grammar leads from one phase (nothing
yet, after s, after u, after a) to another; runs are joined phase by phase on cost
and audit. (Two audits of one run between the same phases with equal costs are
never a prefix of one another, as what one has more are inserts, so the order of
audits survives joining.) Turns are dealt by ranges of (conversation, turn), so a
conversation of any share of all rows is spread over tasks, each of which reports
costs and audits for every phase it may be entered in. Equal rows are one row with
a count, and only lengths of digests of texts travel until the audits are known.
Writing a repaired conversation needs its texts in order: that last pass streams
them through one task per conversation, one row at a time.

Faults, first match: blank (nothing but space and \\t\\n\\v\\f\\r), duplicate (role and
text seen earlier in the conversation), truncated (the last other character is not
``.!?``).

Defined cases: a null role or text is one space. Turns are taken by number, null
first, of equal numbers by role, then by SHA-256 of the text. Repeated rows are
duplicates of each other. A null conversation id is one conversation. Roles count
by their first character (an empty role has none). Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, scratch_folder

RUN_TURNS = 16
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
#: Phases of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: (phase before, phase after): strings between them as (first letter, odd length?, least length).
ROUTES = {
    (START, START): (("", False, 0),), (START, SYSTEM): (("s", True, 1),),
    (START, USER): (("u", True, 1), ("s", False, 2)), (START, ASSISTANT): (("u", False, 2), ("s", True, 3)),
    (SYSTEM, SYSTEM): (("", False, 0),), (SYSTEM, USER): (("u", True, 1),), (SYSTEM, ASSISTANT): (("u", False, 2),),
    (USER, USER): (("a", False, 0),), (USER, ASSISTANT): (("a", True, 1),),
    (ASSISTANT, ASSISTANT): (("u", False, 0),), (ASSISTANT, USER): (("u", True, 1),),
}


def target(first: str, length: int) -> str:
    """The alternating string of a length that begins with a letter."""
    if first == "s":
        return "s" + target("u", length - 1)
    return (("ua" if first == "u" else "au") * (length // 2 + 1))[:length]


def least_cost(n: int, m: int) -> int:
    """What the lengths alone cost: inserts or deletions for their difference."""
    return INSERT * (m - n) if m > n else DELETE * (n - m)


def align(turns: tuple, want: str, limit: int) -> tuple[int, str] | None:
    """(cost, least audit) of the cheapest edits from ``turns`` ((initial, cost of staying), ...) to
    ``want``, or None above ``limit``."""
    n, m = len(turns), len(want)
    slack = (limit - least_cost(n, m)) // (INSERT + DELETE)
    if slack < 0:
        return None
    low, high, far = min(0, m - n) - slack, max(0, m - n) + slack, limit + 1
    table = [[far] * (m + 2) for _ in range(n + 1)]       # costs of the rest; cells out of the band stay far
    for i in range(n, -1, -1):
        row, below = table[i], table[i + 1] if i < n else None
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            cost = 0 if i == n and j == m else far
            if below is not None:
                cost = below[j] + DELETE
            if j < m:
                due = want[j]
                if due != "s":
                    cost = min(cost, row[j + 1] + INSERT)
                if below is not None and (turns[i][0] == due or due != "s"):
                    cost = min(cost, below[j + 1] + turns[i][1] + (0 if turns[i][0] == due else REROLE))
            row[j] = min(cost, far)
    if table[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        cost = table[i][j]
        if i < n and cost == table[i + 1][j] + DELETE:
            audit.append("D")
            i += 1
        elif j < m and want[j] != "s" and cost == table[i][j + 1] + INSERT:
            audit.append("I")
            j += 1
        else:                                             # a letter's kind is fixed by the turn: no choice between K and R
            audit.append("K" if turns[i][0] == want[j] else "R")
            i, j = i + 1, j + 1
    return table[0][0], "".join(audit)


def cheapest(turns: tuple, routes: tuple) -> tuple[int, str] | None:
    """(cost, audit) over all lengths of the strings of ``routes``."""
    best, n = None, len(turns)
    for first, odd, least in routes:
        if first == "s" and all(initial != "s" for initial, _ in turns):
            continue                                      # a system turn can only be kept
        lengths = [0] if not first else sorted(
            range(least + (least % 2 != odd), 2 * n + least + 3, 2), key=lambda m: (least_cost(n, m), m))
        for m in lengths:
            if best is not None and least_cost(n, m) > best[0]:
                break
            found = align(turns, target(first, m), best[0] if best else DELETE * n + INSERT * m)
            if found is not None and (best is None or found < best):
                best = found
    return best


@lru_cache(maxsize=1 << 15)
def run_costs(turns: tuple, before: int) -> tuple:
    """((phase after, cost, audit), ...) of a run that is entered in a phase."""
    return tuple((after, *found) for (b, after), routes in ROUTES.items()
                 if b == before and (found := cheapest(turns, routes)) is not None)


def with_deletions(audit: str, layout: str) -> str:
    """The audit with a D for every turn that must go; ``layout`` has L or D for every turn. The
    inserts before a turn follow the deletions before it."""
    if "D" not in layout:
        return audit
    out, at = [], 0
    for kind in layout:
        if kind == "D":
            out.append("D")
            continue
        end = at
        while audit[end] == "I":
            end += 1
        out.append(audit[at:end + 1])
        at = end + 1
    return "".join([*out, audit[at:]])


def joined(states: dict, turns: tuple, layout: str) -> dict:
    """{phase: (cost, audit)} after a run, from those before it."""
    out: dict = {}
    for before, (cost, audit) in states.items():
        for after, more, edits in run_costs(turns, before):
            one = (cost + more, audit + with_deletions(edits, layout))
            if after not in out or one < out[after]:
                out[after] = one
    return out


class Piece:
    """The turns of one conversation in one task, taken in order."""

    def __init__(self, conv, entries) -> None:
        self.conv, self.states = conv, {e: {e: (0, "")} for e in entries}
        self.turns, self.layout = [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, blank: bool, again: bool, cut: bool, copies: int) -> None:
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.illegal += copies - 1                        # copies of a turn never follow each other legally
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.numbers += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not again)
            self.truncated += cut and not again
        goes = copies - (not blank and not again)
        if not blank and not again:
            if len(self.turns) == RUN_TURNS:
                self.close()
            self.turns.append((initial, TRUNCATED * cut))
            self.layout.append("L")
        self.layout.append("D" * goes)

    def close(self) -> None:
        turns, layout = tuple(self.turns), "".join(self.layout)
        self.states = {e: joined(s, turns, layout) for e, s in self.states.items()}
        self.turns, self.layout = [], []

    def row(self, part: int) -> tuple:
        self.close()
        found = [(e, after, *x) for e, s in self.states.items() for after, x in sorted(s.items())]
        return (self.conv, part, self.blank, self.duplicate, self.truncated, self.illegal, self.numbers, self.low, self.high,
                self.first, self.last, *([f[k] for f in found] for k in range(4)))


LEGAL = frozenset(("su", "ua", "au"))
_PIECE = ("conv bigint, part int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, numbers bigint, low bigint, "
          "high bigint, first string, last string, entries array<int>, exits array<int>, costs array<bigint>, audits array<string>")
_RESULT = ("conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
_LINE = "conv bigint, place bigint, edit string, role string, text string"
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
          "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list, ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _TYPES[t]) for k, (_, t) in enumerate(fields)],
                                      [n for n, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, len(batch), SLICE_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(lo, SLICE_ROWS).columns), strict=True)


def _written(rows: Iterator[tuple], ddl: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most SLICE_ROWS rows, or of about ``most`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= SLICE_ROWS or size >= most:
            yield _batch(held, ddl)
            held, size = [], 0
    yield _batch(held, ddl)


def read_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """conv, turn, role, text and ``digest``, null roles and texts read as one space."""
    text = F.coalesce(turns[text_col].cast("string"), F.lit(" "))
    return turns.select(turns[conv_col].cast("bigint").alias("conv"), turns[turn_col].cast("bigint").alias("turn"),
                        F.coalesce(turns[role_col].cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                        F.unhex(F.sha2(text, 256)).alias("digest"))


def _order(*more: str) -> list:
    return [F.col(c).asc_nulls_first() for c in ("conv", *more, "turn", "role", "digest")]


def judged_turns(turns: DataFrame) -> DataFrame:
    """A row for equal rows of ``read_turns``, without the text: ``n`` of them, ``initial``, ``blank``,
    ``cut`` (truncated) and ``again`` (role and text are those of an earlier turn)."""
    bare = F.rtrim("text", F.lit(SPACES))
    narrow = (turns.select("conv", "turn", "role", "digest", (bare == "").alias("blank"),
                           (~F.substring(bare, -1, 1).isin(*".!?")).alias("cut"))
              .groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("n")))
    folder = scratch_folder(turns.sparkSession, "repair_turns")
    narrow.write.parquet(folder)
    narrow = turns.sparkSession.read.parquet(folder)
    firsts = (narrow.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
              .agg(F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("lowest")))
    both = narrow.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    again = F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("lowest")))
    return both.select("conv", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", again.alias("again"),
                       "cut", "n")


def audit(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """A row per conversation: its id, ``gaps`` (missing turn numbers), the faults (``blank``,
    ``duplicate``, ``truncated``), ``illegal`` (neighbours that the grammar does not allow), and the
    ``cost`` and ``audit`` of the cheapest repair."""
    read = judged_turns(read_turns(turns, conv_col, turn_col, role_col, text_col))
    ranges = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = read.repartitionByRange(ranges, *_order()).sortWithinPartitions(*_order())
    dealt = dealt.select("conv", "turn", "initial", "blank", "again", "cut", "n")

    def pieces(batches):
        def run():
            part, piece = TaskContext.get().partitionId(), None
            for conv, *turn in _rows(batches):
                if piece is None or conv != piece.conv:
                    if piece is not None:
                        yield piece.row(part)
                    # the first conversation of a range may have begun in the one before
                    piece = Piece(conv, range(4) if piece is None else (START,))
                piece.add(*turn)
            if piece is not None:
                yield piece.row(part)
        return _written(run(), _PIECE)

    found = dealt.mapInArrow(pieces, _PIECE).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part")

    def whole(batches):
        def run():
            held: list = []
            for row in _rows(batches):                    # a conversation has as many rows as ranges that it lies in
                if held and held[0][0] != row[0]:
                    yield repaired(held)
                    held = []
                held.append(row)
            if held:
                yield repaired(held)
        return _written(run(), _RESULT)
    return found.mapInArrow(whole, _RESULT).withColumnRenamed("conv", conv_col)


def repaired(pieces: list) -> tuple:
    """The result of a conversation from its pieces in order."""
    states, blank, duplicate, truncated, illegal, numbers = {START: (0, "")}, 0, 0, 0, 0, 0
    low = high = last = None
    for _, _, b, d, t, bad, own, lo, hi, first, end, entries, exits, costs, audits in pieces:
        blank, duplicate, truncated, illegal = blank + b, duplicate + d, truncated + t, illegal + bad
        illegal += last is not None and last + first not in LEGAL
        numbers += own - (lo is not None and lo == high)
        low, high, last = lo if low is None else low, hi if hi is not None else high, end
        out: dict = {}
        for entry, after, cost, edits in zip(entries, exits, costs, audits, strict=True):
            if entry in states:
                one = (states[entry][0] + cost, states[entry][1] + edits)
                if after not in out or one < out[after]:
                    out[after] = one
        states = out
    cost, edits = min(states[p] for p in (START, ASSISTANT) if p in states)
    return (pieces[0][0], 0 if low is None else high - low + 1 - numbers, blank, duplicate, truncated, illegal,
            cost + DELETE * (blank + duplicate), edits)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, place, edit, role, text) of every repaired turn, and (conv, None, ...) behind each
    conversation; the rows are a conversation's audit and then its turns."""
    conv, audit_, at, place, odd = None, None, 0, 0, 0

    def due() -> str:
        return ("assistant", "user")[(place + 1 + odd) % 2]

    def inserts():
        nonlocal at, place
        while at < len(audit_) and audit_[at] == "I":
            yield conv, place, "I", due(), ""
            at, place = at + 1, place + 1

    for c, edits, role, text in _rows(batches):
        if edits is not None:
            if audit_ is not None:
                yield from inserts()
                yield conv, None, None, None, None
            conv, audit_, at, place, odd = c, edits, 0, 0, (len(edits) - edits.count("D")) % 2
            continue
        if audit_[at] != "D":
            yield from inserts()
        edit = audit_[at]
        at += 1
        if edit != "D":
            yield conv, place, edit, role if edit == "K" else due(), text
            place += 1
    if audit_ is not None:
        yield from inserts()
        yield conv, None, None, None, None


def _in_order(turns: DataFrame, audits: DataFrame, conv_col: str) -> DataFrame:
    """Every conversation's audit, then its turns, together in one task and in order."""
    read = turns.select("conv", F.lit(1).alias("tag"), "turn", "role", "digest", F.lit(None).cast("string").alias("audit"), "text")
    heads = audits.select(F.col(conv_col).alias("conv"), F.lit(0).alias("tag"), F.lit(None).cast("bigint").alias("turn"),
                          F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), "audit",
                          F.lit(None).cast("string").alias("text"))
    return (heads.unionByName(read).repartition("conv").sortWithinPartitions(*_order("tag"))
            .select("conv", "audit", "role", "text"))


def repair(turns: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The repaired turns by the audits of ``audit``: the conversation, ``place`` (from 0), ``edit`` (K, R
    or I), ``role`` and ``text``."""
    rows = _in_order(read_turns(turns, conv_col, turn_col, role_col, text_col), audits, conv_col)
    return (rows.mapInArrow(lambda batches: _written((r for r in _replayed(batches) if r[1] is not None), _LINE), _LINE)
            .withColumnRenamed("conv", conv_col))


def repaired_digests(turns: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``sha256`` of every repaired conversation: ``role:text`` of its turns, newline-joined."""
    ddl = "conv bigint, sha256 string"

    def digest(batches):
        def run():
            sha, glue = hashlib.sha256(), ""
            for conv, place, _, role, text in _replayed(batches):
                if place is None:
                    yield conv, sha.hexdigest()
                    sha, glue = hashlib.sha256(), ""
                    continue
                sha.update(f"{glue}{role}:{text}".encode("utf-8", "surrogatepass"))
                glue = "\n"
        return _written(run(), ddl)
    rows = _in_order(read_turns(turns, conv_col, turn_col, role_col, text_col), audits, conv_col)
    return rows.mapInArrow(digest, ddl).withColumnRenamed("conv", conv_col)
