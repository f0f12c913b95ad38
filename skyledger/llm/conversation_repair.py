"""Repair of conversations: the cheapest edits that make the roles alternate.

A conversation is right if its role initials read `(s?(ua)+)?`. The edits are those of `COSTS`;
the cheapest ones come from a Viterbi search over the four states that a right beginning can
be in, one survivor for each state. Survivors are ends of a tree of edits. A node counts the
nodes and survivors that refer to it, so branches that no survivor needs go at once, and edits
that all survivors share are emitted and forgotten. Survivors of equal cost are told apart by
all their edits that are not yet emitted. A task therefore reads a conversation as a stream,
whatever its length, and holds the texts of the undecided edits only. (Where each of many rows
has to be reroled, the number of rows behind decides the first edit, and all of them wait.)

Which rows repeat an earlier one is found by an aggregate over hashes of role and text, so no
task keeps the texts that it has seen. The text of a conversation passes through one task, in
order, because its SHA-256 can be taken in no other way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.llm.common import materialize

# What the edits cost, and an undeleted row whose last sentence is cut off.
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
BLANKS = " \t\n\x0b\f\r"

# States: nothing yet, after system, after user, after assistant. The last one may be the end.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
# The one turn that may be added or made out of another in a state.
_DUE = {START: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
_LEGAL = {"su", "ua", "au"}

REPORT = ("gaps:bigint, blank:bigint, duplicate:bigint, truncated:bigint, illegal:bigint, "
          "cost:bigint, audit:string, repaired_sha256:string")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies: rows damaged by a hash of their place.

    Of every twenty values of crc32 of `conv_id:turn`, 0 drops the row (no copies), 1 empties its
    text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes its
    role user. Nulls count as one space, but a null turn stays null.
    """
    def known(name: str) -> Column:
        return F.coalesce(conversations[name].cast("string"), F.lit(" "))

    place = F.concat(known("conv_id"), F.lit(":"), known("turn"))
    hit = F.crc32(place.cast("binary")) % 20
    return conversations.select(
        conversations["conv_id"], conversations["turn"].cast("bigint").alias("turn"),
        F.when(hit == 4, "user").otherwise(known("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(known("text"), ".!?", ""))
        .otherwise(known("text")).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


class _Node:
    """An edit and what it adds to the conversation; kids and holders are those that refer to it."""

    __slots__ = ("edit", "holders", "kids", "parent", "turn")

    def __init__(self, edit: str, turn: tuple[str, str] | None, parent: _Node | None) -> None:
        self.edit, self.turn, self.parent = edit, turn, parent
        self.kids: list[_Node] = []
        self.holders = 0
        if parent is not None:
            parent.kids.append(self)


class Survivors:
    """The cheapest edits so far for each state; settled edits are handed to `emit`.

    A survivor is its cost, a rank, a tail and a node. Survivors that end with an edit of the
    last row differ before one of them ends, so their order as texts is a rank among them; what
    insertions add behind is the tail. (rank, tail) therefore compares all undecided edits.
    """

    def __init__(self, emit) -> None:
        self._emit = emit
        self._root = _Node("", None, None)
        self._root.holders = 1
        self._alive = {START: (0, 0, "", self._root)}
        self._insert()

    @property
    def undecided(self) -> int:
        """The number of edits in the tree."""
        count, nodes = 0, [self._root]
        while nodes:
            kids = nodes.pop().kids
            count += len(kids)
            nodes += kids
        return count

    def _offer(self, best: dict, state: int, cost: int, after: tuple, edit: str, turn) -> None:
        """Let `after` and one more edit survive in `state`, if that is cheaper or less as text."""
        _, rank, tail, parent = after
        known, tail = best.get(state), tail + edit
        if known is not None and known[:3] <= (cost, rank, tail):
            return
        node = _Node(edit, turn, parent)
        node.holders = 1
        best[state] = (cost, rank, tail, node)
        if known is not None:
            self._release(known[3])

    def _release(self, node: _Node) -> None:
        node.holders -= 1
        while not node.holders and not node.kids and node.parent is not None:
            gone, node = node, node.parent
            gone.parent = None
            node.kids.remove(gone)

    def _insert(self) -> None:
        """Add insertions and drop states that others beat for good."""
        best = self._alive
        for state in (START, SYSTEM, ASSISTANT, USER):
            if state in best:
                role = _DUE[state]
                self._offer(best, _NEXT[state, role[0]], best[state][0] + COSTS["I"], best[state],
                            "I", (role, ""))
        # What may follow SYSTEM may follow a path of the cost `reach` too, and what may follow
        # START if one system row is deleted besides.
        reach = min(best[state][0] + extra for state, extra in (
            (ASSISTANT, 0), (USER, COSTS["I"])) if state in best)
        for state, extra in ((SYSTEM, 0), (START, COSTS["D"])):
            if state in best and best[state][0] > reach + extra:
                self._release(best.pop(state)[3])

    def add(self, role: str, text: str, doomed: bool, truncated: bool) -> None:
        """Take one more row; a doomed one can only be deleted."""
        best: dict[int, tuple] = {}
        extra = TRUNCATED if truncated else 0
        for state, survivor in self._alive.items():
            cost = survivor[0]
            self._offer(best, state, cost + COSTS["D"], survivor, "D", None)
            if doomed:
                continue
            after = _NEXT.get((state, role[:1]))
            if after is not None:
                self._offer(best, after, cost + extra + COSTS["K"], survivor, "K", (role, text))
            due = _DUE[state]
            self._offer(best, _NEXT[state, due[0]], cost + extra + COSTS["R"], survivor, "R",
                        (due, text))
        for survivor in self._alive.values():
            self._release(survivor[3])
        ranked = sorted(best, key=lambda state: best[state][1:3])
        self._alive = {state: (best[state][0], rank, "", best[state][3])
                       for rank, state in enumerate(ranked)}
        self._insert()
        while not self._root.holders and len(self._root.kids) == 1:
            self._settle(self._root.kids[0])

    def _settle(self, node: _Node) -> None:
        self._emit(node.edit, node.turn)
        self._root, node.parent, node.turn = node, None, None

    def end(self) -> int:
        """Emit the rest of the cheapest edits that end rightly and return their cost."""
        ends = [self._alive[state] for state in (START, ASSISTANT) if state in self._alive]
        cost, _, _, node = min(ends, key=lambda end: end[:3])
        chain = []
        while node is not self._root:
            chain.append(node)
            node = node.parent
        for node in reversed(chain):
            self._settle(node)
        return cost


class _Conversation:
    """Counts, edits and digest of the rows of one conversation, which come in order."""

    def __init__(self, conv_id, with_edits: bool) -> None:
        self.conv_id = conv_id
        self.edits: list[dict] = []
        self._with_edits, self._seq = with_edits, 0
        self._count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self._turns, self._first, self._last, self._role = 0, None, None, None
        self._audit: list[str] = []
        self._sha, self._any = hashlib.sha256(), False
        self._survivors: Survivors | None = None

    def _emit(self, edit: str, turn: tuple[str, str] | None) -> None:
        self._audit.append(edit)
        if self._with_edits:
            role, text = turn or (None, None)
            self.edits.append({"conv_id": self.conv_id, "seq": self._seq, "edit": edit,
                               "role": role, "text": text})
        self._seq += 1
        if turn is not None:
            self._sha.update((b"\n" if self._any else b"") + f"{turn[0]}:{turn[1]}".encode())
            self._any = True

    def add(self, turn: int | None, role: str, text: str, copies: int, fresh: bool) -> None:
        """`copies` equal rows of one turn; fresh: none of an earlier turn is equal."""
        if not copies:
            return
        if self._survivors is None:
            self._survivors = Survivors(self._emit)
        if turn is not None and (self._last is None or turn != self._last):
            self._turns += 1
            self._first, self._last = turn if self._first is None else self._first, turn
        bare = text.rstrip(BLANKS)
        truncated = bool(bare) and bare[-1] not in ".!?"
        for copy in range(copies):
            if self._role is not None and self._role + role[:1] not in _LEGAL:
                self._count["illegal"] += 1
            self._role = role[:1]
            again = bool(bare) and (copy > 0 or not fresh)
            self._count["blank"] += not bare
            self._count["duplicate"] += again
            self._count["truncated"] += truncated and not again
            self._survivors.add(role, text, again or not bare, truncated and not again)

    def report(self) -> dict:
        cost = self._survivors.end() if self._survivors else 0
        gaps = self._last - self._first + 1 - self._turns if self._turns else 0
        return {"gaps": gaps, **self._count, "cost": cost, "audit": "".join(self._audit),
                "repaired_sha256": self._sha.hexdigest()}


def _repaired(with_edits: bool, conv_type: pa.DataType):
    report = pa.struct([
        *((name, pa.int64()) for name in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    schema = pa.schema([("conv_id", conv_type), ("seq", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string()), ("report", report)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk: _Conversation | None = None
        # rows of one turn, role and text, which wait for their last copy
        place, copies, fresh, role, text = None, 0, True, "", ""

        def ended() -> list[dict]:
            talk.add(place[1], role, text, copies, fresh)
            report = talk.report()
            return [*talk.edits, {"conv_id": talk.conv_id, "report": report}]

        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                here = (row["conv_id"], row["turn"], row["key"])
                if place is None or here[0] != place[0]:
                    out += ended() if talk else []
                    talk = _Conversation(row["conv_id"], with_edits)
                elif here != place:
                    talk.add(place[1], role, text, copies, fresh)
                if here != place:
                    place, copies, fresh = here, 0, True
                if row["again"]:
                    fresh = False
                else:
                    copies += row["copies"]
                    role, text = row["role"], row["text"]
            if talk:
                out += talk.edits
                talk.edits = []
            yield pa.RecordBatch.from_pylist(out, schema)
        if talk:
            yield pa.RecordBatch.from_pylist(ended(), schema)
    return run


def _moment(turn: str) -> Column:
    """A turn that can be compared; null comes first."""
    return F.struct(F.col(turn).isNotNull(), F.coalesce(turn, F.lit(0)))


def repair(rows: DataFrame, with_edits: bool = True) -> DataFrame:
    """conv_id, seq, edit, role, text, report: the edits of each conversation, then its report.

    `rows` has conv_id, turn, role, text and copies (how often the row stands there, 0: not at
    all), as `damage` gives them; other columns are not read. A conversation is taken by
    turn, null first; different rows of one turn stand in the order of a hash of role and text,
    equal ones side by side. `edit` is the initial of keep, rerole, delete or insert; role and
    text are those of the repaired row, null for a deletion. The row of the report has no edit:
    gaps (turns missing between the least and the greatest), blank, duplicate and truncated
    (rows by their first fault: no character but white space, role and text of an earlier row,
    last character no full stop, exclamation or question mark), illegal (neighbours whose
    role initials are none of su, ua, au), cost and audit (the cheapest edits; of several the
    one that is least as text), repaired_sha256 (`role:text` lines of the repaired rows).

    Null roles and texts are empty. A null conv_id is a conversation of its own. A conversation
    without a copy of any row has zeros, an empty audit and the hash of the empty text. A very
    long conversation is read as a stream by one task, with few edits undecided; its audit has a
    character for each edit. An empty table gives an empty result.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role), F.lit(":"), role, text)))
    rows = materialize(rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        text.alias("text"), key.alias("key"), F.col("copies").cast("bigint").alias("copies"),
    ), "conversation-rows")
    places = rows.where("copies > 0").select("conv_id", "key", "turn")
    first, last = F.min(_moment("turn")), F.max(_moment("turn"))
    # written, so that the join deals its rows out anew and can split a text of many turns
    repeats = materialize(
        places.groupBy("conv_id", "key").agg(first.alias("first"), last.alias("last"))
        .where("first <> last").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first"),
        "repeated-rows")
    marks = places.join(
        repeats, places["conv_id"].eqNullSafe(repeats["c"]) & (places["key"] == repeats["k"])
    ).where(_moment("turn") > F.col("first")).select(
        "conv_id", "turn", F.lit("").alias("role"), F.lit("").alias("text"), "key",
        F.lit(0).cast("bigint").alias("copies"), F.lit(True).alias("again"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("key")]
    stream = (rows.withColumn("again", F.lit(False)).unionAll(marks)
              .repartition("conv_id").sortWithinPartitions(*order))
    kind = rows.schema["conv_id"].dataType
    return stream.mapInArrow(
        _repaired(with_edits, to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, seq bigint, edit string, role string, text string, "
        f"report struct<{REPORT}>")


def reports(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id and the columns of its report."""
    done = repair(rows, with_edits=False).where("report is not null")
    return done.select("conv_id", "report.*")
