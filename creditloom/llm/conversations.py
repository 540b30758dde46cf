"""Repair of conversations by a run-length dynamic program over their message structure.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Messages may be kept, given
the role that is due, deleted, or an empty message of the role that is due may be inserted; the
cheapest edits are sought. Four states say what may come next, so a message is a 4 x 4 matrix in
min-plus algebra, the insertions ahead of it included. It depends on the message's symbol alone:
role initial and fault. Equal consecutive symbols are one run; a run is advanced from its end to its
start by binary powers of its matrix, which every task keeps. The edits are then unrolled from the
start: in a run in blocks, so that costs are kept for one block of messages only.

Which messages repeat an earlier one is found by Spark: messages are reduced to a digest of role and
text, grouped, and joined to the first turn of their digest. Copies of a message at one turn are one
row with a count. The symbols of a conversation then reach its task ahead of its texts, and both are
streams sorted by Spark, on disk if need be: in memory are one conversation's runs and its
audit, one letter a message, which is one value of the result. Texts are hashed as they pass. The
digest of a conversation is one SHA-256 over all its texts, so they pass one task in order.

Faults, the first that holds: ``blank`` (nothing but white space), ``duplicate`` (role and text
came earlier in the conversation), ``truncated`` (the last character that is no white space is
none of ``.!?``). Blank and duplicate messages are deleted; a truncated one that stays costs 1.

Defined results: a null role or text is one blank; turns are ordered with nulls first, messages of
equal turns by digest; rows with a null id are one conversation; repeated rows are duplicates; a
conversation without messages has zeros, an empty audit and the digest of nothing; an empty table
gives no rows. Roles other than the three known ones cannot be kept. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import BLANKS, map_batches
from creditloom.operators.relational import group_table

# --- states, symbols and costs --------------------------------------------------------------

#: What has been given out so far: nothing, s, an open pair, complete pairs.
START, SYSTEM, OPEN, CLOSED = range(4)
STATES = (START, SYSTEM, OPEN, CLOSED)

#: State after the message that is due (user, or assistant in an open pair).
DUE = (OPEN, OPEN, CLOSED, OPEN)
ROLE = ("user", "user", "assistant", "user")

#: State after keeping a message with this initial; a state that is missing does not allow it.
KEPT = {
    "s": {START: SYSTEM},
    "u": {START: OPEN, SYSTEM: OPEN, CLOSED: OPEN},
    "a": {OPEN: CLOSED},
}
LEGAL = {"su", "ua", "au"}

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = float("inf")

#: Fault of a message as part of its symbol; a message to delete has no other part.
FINE, CUT, GONE = 0, 1, 2

Costs = tuple[float, float, float, float]
Matrix = tuple[Costs, Costs, Costs, Costs]
Symbol = tuple[str, int]

#: Costs from every state after the last message: an open pair is closed, s alone gets a pair.
END: Costs = (0, 2 * INSERT, INSERT, 0)


def times(left: Matrix, right: Matrix) -> Matrix:
    """The product in min-plus algebra."""
    return tuple(
        tuple(min(left[i][k] + right[k][j] for k in STATES) for j in STATES) for i in STATES
    )


def advance(matrix: Matrix, costs: Costs) -> Costs:
    """Costs before the messages of a matrix, from the costs after them."""
    a, b, c, d = costs
    return tuple(min(row[0] + a, row[1] + b, row[2] + c, row[3] + d) for row in matrix)


def choices(symbol: Symbol, state: int) -> Iterator[tuple[str, float, int]]:
    """The edits of one message: initial, cost, state after it; in order of their initials."""
    yield "D", DELETE, state
    initial, fault = symbol
    if fault != GONE:
        extra = TRUNCATED if fault == CUT else 0
        after = KEPT.get(initial, {}).get(state)
        if after is not None:
            yield "K", extra, after
        yield "R", REROLE + extra, DUE[state]


BLOCK = 1024

Runs = tuple[tuple[Symbol, int], ...]


class Repairs:
    """Cheapest edits of conversations; every task has one, which keeps the powers of matrices."""

    def __init__(self, remembered: int = 1 << 16) -> None:
        self.powers: dict[tuple[Symbol, int], Matrix] = {}
        self.known: dict[Runs, tuple[int, str]] = {}
        self.remembered = remembered

    def power(self, symbol: Symbol, exponent: int) -> Matrix:
        """The matrix of ``2 ** exponent`` equal messages."""
        found = self.powers.get((symbol, exponent))
        if found is None:
            if exponent:
                half = self.power(symbol, exponent - 1)
                found = times(half, half)
            else:
                found = single(symbol)
            self.powers[symbol, exponent] = found
        return found

    def before_run(self, symbol: Symbol, length: int, costs: Costs) -> Costs:
        """Costs before a run of equal messages, from those after it."""
        exponent = 0
        while length:
            if length & 1:
                costs = advance(self.power(symbol, exponent), costs)
            length, exponent = length >> 1, exponent + 1
        return costs

    def unrolled(self, runs: Runs) -> tuple[int, str]:
        """Cost and initials of the cheapest edits, the least in ASCII order among equals."""
        after = [END]
        for symbol, length in reversed(runs):
            after.append(self.before_run(symbol, length, after[-1]))
        total, parts, state = after[-1][START], [], START
        for number, (symbol, length) in enumerate(runs):
            behind = after[-2 - number]
            for start in range(0, length, BLOCK):
                size = min(BLOCK, length - start)
                costs = [self.before_run(symbol, length - start - size, behind)]
                for _ in range(size):
                    costs.append(advance(self.power(symbol, 0), costs[-1]))
                costs.reverse()
                state = walk(symbol, costs, state, parts)
        while END[state]:
            parts.append("I")
            state = DUE[state]
        return int(total), "".join(parts)

    def cheapest(self, runs: Runs) -> tuple[int, str]:
        """:meth:`unrolled`, remembered for short conversations, which repeat."""
        if len(runs) > 32:
            return self.unrolled(runs)
        if runs not in self.known:
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[runs] = self.unrolled(runs)
        return self.known[runs]


def single(symbol: Symbol) -> Matrix:
    """The matrix of one message, with the insertions ahead of it."""
    rows = []
    for start in STATES:
        costs = [NEVER] * 4
        state, paid = start, 0
        for _ in range(3):  # no insertion, one, two; a third is never of use
            for _, cost, after in choices(symbol, state):
                costs[after] = min(costs[after], paid + cost)
            state, paid = DUE[state], paid + INSERT
        rows.append(tuple(costs))
    return tuple(rows)


def walk(symbol: Symbol, costs: list[Costs], state: int, parts: list[str]) -> int:
    """Take the least initial that keeps to the cheapest cost, message by message."""
    for before, after in zip(costs, costs[1:]):
        while True:
            wanted = before[state]
            found = [(i, s) for i, c, s in choices(symbol, state) if c + after[s] == wanted]
            if (not found or found[0][0] != "D") and INSERT + before[DUE[state]] == wanted:
                parts.append("I")
                state = DUE[state]
                continue
            initial, state = found[0]
            parts.append(initial)
            break
    return state


# --- messages -------------------------------------------------------------------------------


def with_faults(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``key``, ``turn``, ``mark``, ``initial``, ``fault``, ``copies``: text left behind.

    ``messages`` has ``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` (0 for a row that only
    names its conversation). Equal messages of a turn become one row; ``first`` says whether its
    first copy is the first in the conversation. Blanks are marked as to be deleted already.
    """
    counted = (
        messages.groupBy("conv_id", "key", "turn", "mark", "initial", "fault")
        .agg(F.sum("copies").alias("copies"))
    )
    firsts = group_table(
        counted.where("copies > 0"),
        ["key", "mark"],
        {"least": F.min("turn"), "unnumbered": F.bool_or(F.col("turn").isNull())},
    )
    at_first = F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(
        F.col("turn") == F.col("least")
    )
    return (
        counted.join(firsts, ["key", "mark"], "left")
        .withColumn("first", F.coalesce(at_first, F.lit(True)))
        .drop("least", "unnumbered")
    )


def marked(messages: DataFrame) -> DataFrame:
    """Add what is known of a message by itself: ``key`` of its conversation, ``mark``, ``initial``,
    ``fault`` (from null-free ``role`` and ``text``)."""
    length = F.octet_length("role").cast("string")
    shown = F.rtrim("text", F.lit(BLANKS.decode()))
    return messages.withColumns(
        {
            "key": F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")),
            "mark": F.unhex(F.sha2(F.concat(length, F.lit(":"), "role", "text"), 256)),
            "initial": F.substring("role", 1, 1),
            "fault": F.when(shown == "", GONE)
            .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), CUT)
            .otherwise(FINE),
        }
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of id and turn; ``copies`` is 0, 1 or 2."""
    as_text = {
        c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        for c in ("conv_id", "turn", "role", "text")
    }
    checksum = F.crc32(F.concat(as_text["conv_id"], F.lit(":"), as_text["turn"]).cast("binary"))
    rows = conversations.select(
        "conv_id",
        "turn",
        as_text["role"].alias("role"),
        as_text["text"].alias("text"),
        (checksum % 20).alias("damage"),
    )
    damage = F.col("damage")
    return rows.select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "")
        .when(damage == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1).alias("copies"),
    )


# --- conversations as streams ---------------------------------------------------------------


class Conversation:
    """What is known of a conversation from the symbols of its messages, which come in order."""

    def __init__(self, key: str, conv_id: object) -> None:
        self.key, self.conv_id = key, conv_id
        self.runs: list[list] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def run(self, symbol: Symbol, length: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += length
        elif length:
            self.runs.append([symbol, length])

    def add(self, turn: int | None, initial: str, fault: int, first: bool, copies: int) -> None:
        if not copies:
            return
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        self.last = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        gone: Symbol = ("", GONE)
        if fault == GONE:
            self.faults["blank"] += copies
            self.run(gone, copies)
            return
        fresh = int(first)
        self.faults["duplicate"] += copies - fresh
        if fresh:
            self.faults["truncated"] += fault == CUT
            self.run((initial if initial in KEPT else "", fault), 1)
        self.run(gone, copies - fresh)

    def report(self, repairs: Repairs) -> dict:
        self.cost, self.audit = repairs.cheapest(tuple((s, n) for s, n in self.runs))
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return {
            "conv_id": self.conv_id,
            "gaps": gaps,
            **self.faults,
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": self.audit,
        }


class Edits:
    """The audit of a conversation, applied to its messages as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield "I", ROLE[self.state], ""
            self.at, self.state = self.at + 1, DUE[self.state]

    def apply(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what becomes of a message's copies and stands ahead of them."""
        for _ in range(copies):
            yield from self._inserted()
            edit, self.at = self.audit[self.at], self.at + 1
            if edit == "K":
                yield edit, role, text
                self.state = KEPT[role[0]][self.state]
            elif edit == "R":
                yield edit, ROLE[self.state], text
                self.state = DUE[self.state]

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


#: Rows of the stream: a symbol, or a message with its text.
_STREAM = "key conv_id sort turn mark initial fault first copies role text".split()


def _stream(messages: DataFrame) -> DataFrame:
    """Symbols and texts of every conversation, in order, in one partition each."""
    known = marked(messages)
    symbols = with_faults(known).withColumns(
        {"sort": F.lit(0), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}
    )
    # a blank message is deleted whatever comes before it, its text is not needed
    texts = known.where("copies > 0").withColumns(
        {
            "sort": F.lit(1),
            "first": F.lit(None).cast("boolean"),
            "text": F.when(F.col("fault") != GONE, F.col("text")).otherwise(""),
        }
    )
    both = symbols.select(*_STREAM).unionByName(texts.select(*_STREAM))
    return both.repartition("key").sortWithinPartitions("key", "sort", "turn", "mark")


def _conversations(
    batches: Iterable[pa.RecordBatch],
) -> Iterator[tuple[Conversation, dict, Iterator[tuple[str, str, str]]]]:
    """Each conversation with its report and the stream of its repaired messages.

    That stream has to be read to its end before the next conversation is asked for.
    """

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in _STREAM))

    stream, repairs = rows(), Repairs()
    row = next(stream, None)

    def repaired(conversation: Conversation) -> Iterator[tuple[str, str, str]]:
        nonlocal row
        edits = Edits(conversation.audit)
        while row is not None and row[0] == conversation.key:
            yield from edits.apply(row[9], row[10], row[8])
            row = next(stream, None)
        yield from edits.rest()

    while row is not None:
        conversation = Conversation(row[0], row[1])
        while row is not None and row[0] == conversation.key and row[2] == 0:
            conversation.add(row[3], row[5], row[6], row[7], row[8])
            row = next(stream, None)
        yield conversation, conversation.report(repairs), repaired(conversation)


ROWS = 2048
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _kind(messages: DataFrame) -> str:
    return messages.schema["conv_id"].dataType.simpleString()


def _columns(rows: Iterable[dict], names: Iterable[str], size: int = ROWS) -> Iterator[dict]:
    """Rows as columns, ``size`` rows at a time."""
    names, out = list(names), []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield {n: [r[n] for r in out] for n in names}
            out = []
    yield {n: [r[n] for r in out] for n in names}


def repair_report(messages: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit, ``repaired_sha256`` of the repaired messages.

    The digest is that of their ``role:text`` with line feeds between them. ``messages`` has
    ``conv_id``, ``turn``, ``role``, ``text`` and ``copies``, see :func:`damaged`.
    """
    schema = f"conv_id {_kind(messages)}, {REPORT}, repaired_sha256 string"
    names = T._parse_datatype_string(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def rows() -> Iterator[dict]:
            for _, report, repaired in _conversations(batches):
                digest, between = hashlib.sha256(), b""
                for _, role, text in repaired:
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
                yield report | {"repaired_sha256": digest.hexdigest()}

        yield from _columns(rows(), names)

    return map_batches(_stream(messages), run, schema)


def repaired_messages(messages: DataFrame) -> DataFrame:
    """The messages of the repaired conversations: ``conv_id``, ``place`` from 0, ``edit`` (initial),
    ``role``, ``text``."""
    schema = f"conv_id {_kind(messages)}, place long, edit string, role string, text string"
    names = T._parse_datatype_string(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def rows() -> Iterator[dict]:
            for conversation, _, repaired in _conversations(batches):
                for place, message in enumerate(repaired):
                    yield dict(zip(names, (conversation.conv_id, place, *message)))

        yield from _columns(rows(), names, size=256)

    return map_batches(_stream(messages), run, schema)
