"""Repair of the structure of conversations: the cheapest edits that leave ``(s?(ua)+)?``.

The roles kept so far put a conversation into one of four states: nothing yet, after a system turn, after
a user turn, after an assistant turn. A Viterbi pass over the rows, in order of turn, keeps the cheapest
edits into each state; equal costs are settled by comparing the whole strings of edits back to where
they part. Edits are nodes of a tree of back pointers that count who refers to them: what no surviving
state refers to is dropped, and as soon as all survivors share an ancestor its edits are final and leave
the tree. A state that another one undercuts whatever follows does not survive. A survivor also carries
the running hash of its repaired text, so no text is held back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moonstride.session import stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
NEW_ROLE, GONE, ADDED, TRUNCATED = 2, 3, 2, 1  # costs of edits and of a truncated row that stays
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# state after the initial of a turn, by state before it
NEXT = {
    NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
ENDS = (NOTHING, ASSISTANT)
LEGAL_PAIRS = {"su", "ua", "au"}
SPEAKER = {"u": "user", "a": "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
_BLANKS = " \t\n\x0b\x0c\r"

# what a state may cost more than another and still be worth keeping: [other][state], the price at which the
# other one can follow whatever edits come after the state
_CATCH_UP = (
    (0, 0, 2, 0),
    (4, 0, 2, 4),
    (5, 2, 0, 2),
    (3, 0, 2, 0),
)


def _paths(state: int) -> Iterator[tuple[int, str]]:
    """States that insertions alone reach, and the initials inserted."""
    seen, added = [state], ""
    while True:
        yield seen[-1], added
        step = [(i, s) for i, s in NEXT[seen[-1]].items() if i != "s" and s not in seen]
        if not step:
            return
        added += step[0][0]
        seen.append(step[0][1])


def _moves(initial: str) -> list[list[tuple[int, int, str, str, str]]]:
    """By state reached over a row that stays: (state before, cost, edits, initials inserted, initial of the row).

    Insertions stand before a row that stays: put before a deleted one they could as well follow it, which is
    the smaller string.
    """
    found: list[dict[int, tuple]] = [{} for _ in NEXT]
    for state in NEXT:
        for between, added in _paths(state):
            for new, target in NEXT[between].items():
                edits = [KEEP] * (new == initial) + [REROLE] * (new != "s")
                for edit in edits:
                    cost = ADDED * len(added) + NEW_ROLE * (edit == REROLE)
                    move = (cost, INSERT * len(added) + edit, added, new)
                    if state not in found[target] or move < found[target][state]:
                        found[target][state] = move
    return [[(state, *move) for state, move in into.items()] for into in found]


_MOVES = {initial: _moves(initial) for initial in ("s", "u", "a", "")}


class _Node:
    __slots__ = ("edits", "parent", "refs", "times")

    def __init__(self, parent: _Node | None, edits: str) -> None:
        self.parent, self.edits, self.times, self.refs = parent, edits, 1, 1


class _Survivor:
    __slots__ = ("cost", "digest", "node")

    def __init__(self, cost: int, node: _Node, digest) -> None:
        self.cost, self.node, self.digest = cost, node, digest


def _before(a: _Node, a_edits: str, b: _Node, b_edits: str) -> bool:
    """Whether the edits up to ``a`` and on with ``a_edits`` are ASCII-less than those by way of ``b``."""
    one, two = [a_edits], [b_edits]
    while a is not b:  # survivors are equally deep; repeated nodes have the same length on both sides
        one.append(a.edits)
        two.append(b.edits)
        a, b = a.parent, b.parent
    return "".join(reversed(one)) < "".join(reversed(two))


class Repair:
    """One conversation, row by row: ``add`` in order of turn, then ``finish``."""

    def __init__(self) -> None:
        self.root = _Node(None, "")
        self.states: dict[int, _Survivor] = {NOTHING: _Survivor(0, self.root, hashlib.sha256())}
        self.audit: list[str] = []
        self.in_run = False

    def add(self, role: str, text: str, fault: str | None) -> None:
        if fault in FAULTS[:2]:
            self._delete_for_all()
            return
        before, states = self.states, {}
        extra = TRUNCATED if fault == FAULTS[2] else 0
        initial = role[:1]
        for target, moves in enumerate(_MOVES.get(initial, _MOVES[""])):
            best = None
            if target in before:
                best = (before[target].cost + GONE, target, DELETE, "", None)
            for state, cost, edits, added, new in moves:
                old = before.get(state)
                if old is None:
                    continue
                cost += old.cost + extra
                if best is None or cost < best[0] or (cost == best[0] and _before(old.node, edits, before[best[1]].node, best[2])):
                    best = (cost, state, edits, added, new)
            if best is not None:
                states[target] = best
        for state in list(states):
            if any(states[other][0] + _CATCH_UP[other][state] < states[state][0] for other in states if other != state):
                del states[state]
        uses: dict[int, int] = {}
        for _, state, _, _, _ in states.values():
            uses[state] = uses.get(state, 0) + 1
        self.states = {}
        for target, (cost, state, edits, added, new) in states.items():
            old = before[state]
            uses[state] -= 1
            digest = old.digest if uses[state] == 0 else old.digest.copy()
            self._hash(digest, state, added, None if edits == DELETE else role if edits.endswith(KEEP) else SPEAKER[new], text)
            old.node.refs += 1
            self.states[target] = _Survivor(cost, _Node(old.node, edits), digest)
        for old in before.values():
            self._release(old.node)
        self.in_run = False
        self._emit()

    @staticmethod
    def _hash(digest, state: int, added: str, role: str | None, text: str) -> None:
        lines = [SPEAKER[i] + ":" for i in added] + ([] if role is None else [f"{role}:{text}"])
        if lines:
            digest.update((("" if state == NOTHING else "\n") + "\n".join(lines)).encode("utf-8", "surrogatepass"))

    def _delete_for_all(self) -> None:
        """A row that must go: every survivor deletes it, and a run of such rows is one node each."""
        for survivor in self.states.values():
            survivor.cost += GONE
            if self.in_run:
                survivor.node.times += 1
            else:  # the survivor's reference passes on to the new node
                survivor.node = _Node(survivor.node, DELETE)
        self.in_run = True

    @staticmethod
    def _release(node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.parent

    def _emit(self) -> None:
        """Hand out the edits that all survivors share."""
        if self.root.refs > 1:
            return
        chain, node = [], next(iter(self.states.values())).node
        while node is not self.root:
            chain.append(node)
            node = node.parent
        while self.root.refs == 1 and chain:
            self.root = chain.pop()
            self.audit.append(self.root.edits * self.root.times)
            self.root.parent = None

    def finish(self) -> tuple[int, str, str]:
        """Cost, edits and the repaired text's sha256."""
        best = None
        for state, survivor in self.states.items():
            for end, added in _paths(state):
                if end not in ENDS:
                    continue
                cost, edits = survivor.cost + ADDED * len(added), INSERT * len(added)
                if best is None or cost < best[0] or (cost == best[0] and _before(survivor.node, edits, best[1].node, best[2])):
                    best = (cost, survivor, edits, state, added)
                break
        cost, survivor, edits, state, added = best
        self._hash(survivor.digest, state, added, None, "")
        chain, node = [], survivor.node
        while node is not self.root:
            chain.append(node.edits * node.times)
            node = node.parent
        return cost, "".join([*self.audit, *reversed(chain), edits]), survivor.digest.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``dropped``: rows damaged by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (it stays as a mark, so that its conversation is known), 1 empties its text, 2 takes its
    ``.``, ``!`` and ``?``, 3 repeats it, 4 makes the user its speaker. A null counts as one blank, in the
    hashed text as in role and text; ``turn`` itself stays null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"), kind.alias("_kind"),
    )
    kind = F.col("_kind")
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    role = F.when(kind == 4, "user").otherwise(F.col("role")).alias("role")
    return rows.select("conv_id", "turn", role, text.alias("text"), (kind == 0).alias("dropped"), copies).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by conversation, with each row's first ``fault`` or null, ``place`` among its like and ``digest``.

    A duplicate is found by a window that the exchange by ``conv_id`` already serves; it sorts, and so
    spills, and holds no row back.
    """
    digest = F.sha2(F.concat_ws("\x00", F.char_length("role").cast("string"), "role", "text").cast("binary"), 256)
    rows = rows.withColumn("digest", F.when(~F.col("dropped"), digest)).repartition(F.col("conv_id"))
    like = Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())
    seen: Column = F.row_number().over(like)
    stripped = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(F.col("dropped"), None)
        .when(stripped == "", FAULTS[0])
        .when(F.col("place") > 1, FAULTS[1])
        .when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), FAULTS[2])
    )
    return rows.withColumn("place", seen).withColumn("fault", fault)


def repair(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """Per ``conv_id``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``; with ``damaged`` also ``dropped``, as
    ``damage`` gives them. Nulls in role and text are read as one blank. Rows follow one another by turn, null turns first, those of one
    turn by speaker and text hash. A null ``conv_id`` is a conversation of its own. An empty role is read as
    one blank, which no legal turn begins with. Repeated rows are duplicates; a table without rows gives
    none; other columns are not read. Texts of any length are hashed in one go each.

    The hash runs over a whole conversation, so its rows pass through one task, as a sorted stream: what is
    held is one row, four states and the edits not yet settled, never the rows of a conversation.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "place"]
    ready = with_faults(_rows(conversations, damaged)).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "dropped", "fault")
    return ready.mapInArrow(_repair_stream, ", ".join(f"{n} {k}" for n, k in _FIELDS))


_FIELDS = [
    ("conv_id", "long"), ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
    ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"),
]


class _Conversation:
    """Counts and repair of the conversation whose rows are passing."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.faults = dict.fromkeys(FAULTS, 0)
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.initial: str | None = None
        self.repair = Repair()

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL_PAIRS
        self.initial = initial
        if fault is not None:
            self.faults[fault] += 1
        self.repair.add(role, text, fault)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, *self.repair.finish())


def _repair_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in _FIELDS])
    current: _Conversation | None = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[] for _ in schema]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

    for batch in batches:
        done = []
        narrow = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "dropped", "fault")]
        for conv_id, turn, role, dropped, fault, text in zip(*narrow, batch.column("text")):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Conversation(conv_id)
            if not dropped:
                current.add(turn, role, text.as_py(), fault)
        yield batch_of(done)
    if current is not None:
        yield batch_of([current.row()])


def _rows(conversations: DataFrame, damaged: bool) -> DataFrame:
    """Rows in the shape of ``damage``: nulls in role and text, and an empty role, count as one blank."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dropped = F.col("dropped") if damaged else F.lit(False)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(plain("role") == "", " ").otherwise(plain("role")).alias("role"), plain("text").alias("text"), dropped.alias("dropped"),
    )


def repaired_rows(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``edit``, ``turn`` (null if inserted), ``role``, ``text``.

    The edits are worked out by ``repair``, written, and replayed over the rows, which are a second sorted
    stream with each conversation's edits ahead of it. Rows are taken as ``repair`` takes them.
    """
    audits = stage(repair(conversations, damaged).select("conv_id", "audit"), "audits")
    rows = with_faults(_rows(conversations, damaged).where(~F.col("dropped"))).select("conv_id", "turn", "role", "text", "digest", "place")
    ahead = audits.select(
        "conv_id", *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[1:]), "audit",
    )
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(ahead).repartition(F.col("conv_id"))
    order = ["conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest", "place"]
    kinds = "conv_id long, place long, edit string, turn long, role string, text string"
    ready = both.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "audit")
    return ready.mapInArrow(_replay, kinds)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    schema, conv_id, audit, at, state, place = pa.schema(kinds), None, "", 0, NOTHING, 0
    out: list[tuple] = []

    def put(edit: str, turn, role: str, text: str) -> None:
        nonlocal state, place
        out.append((conv_id, place, edit, turn, role, text))
        state, place = NEXT[state][role[0]], place + 1

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == INSERT:
            put(INSERT, None, SPEAKER["a" if state == USER else "u"], "")
            at += 1

    for batch in batches:
        columns = [batch.column(c) for c in ("conv_id", "turn", "role", "text", "audit")]
        for values in zip(*columns):
            owner, turn, role, text, edits = (v.as_py() for v in values)
            if edits is not None:
                conv_id, audit, at, state, place = owner, edits, 0, NOTHING, 0
                insert()
                continue
            edit, at = audit[at], at + 1
            if edit != DELETE:
                put(edit, turn, role if edit == KEEP else SPEAKER["a" if state == USER else "u"], text)
            insert()
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema)
            out.clear()
