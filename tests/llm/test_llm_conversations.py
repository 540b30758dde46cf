"""Conversation repair against a search over whole edit strings, and on rows of all kinds."""

import hashlib
import random
import zlib
from functools import lru_cache

import edge
import pytest
from conftest import SMALL

from creditloom.llm import conversations
from creditloom.llm.queries import op11_conversation_repair

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def sort_key(row):
    turn, role, text = row
    data = f"{len(role.encode())}:{role}{text}".encode()
    return (turn is not None, turn or 0, hashlib.sha256(data).digest())


def messages_of(rows):
    """Messages of each conversation after the damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        name = " " if conv is None else conv
        fault = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return {conv: sorted(kept, key=sort_key) for conv, kept in out.items()}


def searched(faulty):
    """Cheapest (cost, audit) over all edit strings, tried one message at a time."""

    @lru_cache(maxsize=None)
    def best(i, said, inserts):
        found = []
        if i == len(faulty):
            rest = said[1:] if said[:1] == "s" else said
            if rest == "" and said == "" or rest and set(rest[i : i + 2] for i in range(0, len(rest), 2)) == {"ua"}:
                found.append((0, ""))
        short = said[-2:] if len(said) > 3 else said
        due = "a" if short[-1:] == "u" else "u"
        if inserts < 2:
            cost, audit = best(i, keep(said + due), inserts + 1)
            found.append((cost + 2, "I" + audit))
        if i < len(faulty):
            role, fault = faulty[i]
            cost, audit = best(i + 1, said, 0)
            found.append((cost + 3, "D" + audit))
            if fault in (None, "truncated"):
                extra = fault == "truncated"
                if role[:1] and role[:1] == due or role[:1] == "s" and said == "":
                    cost, audit = best(i + 1, keep(said + role[:1]), 0)
                    found.append((cost + extra, "K" + audit))
                cost, audit = best(i + 1, keep(said + due), 0)
                found.append((cost + 2 + extra, "R" + audit))
        return min(found, default=(10**9, ""))

    def keep(said):  # complete pairs add nothing to what may follow
        return said.replace("uaua", "ua")

    return best(0, "", 0)


def brute(rows):
    for conv, kept in messages_of(rows).items():
        faulty, seen = [], set()
        for _, role, text in kept:
            shown = text.rstrip(BLANKS)
            fault = "truncated" if shown and shown[-1] not in ".!?" else None
            fault = "duplicate" if (role, text) in seen else fault
            fault = fault if shown else "blank"
            seen.add((role, text))
            faulty.append((role, fault))
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit = searched(tuple(faulty))
        repaired, state, left = [], "", iter(kept)
        for edit in audit:
            due = "assistant" if state[-1:] == "u" else "user"
            if edit == "I":
                repaired.append(f"{due}:")
                state = due[0]
                continue
            _, role, text = next(left)
            if edit != "D":
                role = role if edit == "K" else due
                repaired.append(f"{role}:{text}")
                state = role[0]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        yield (
            conv,
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == name for _, f in faulty) for name in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )


def compare(frame, rows):
    got = conversations.repair_report(conversations.damaged(frame)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = op11_conversation_repair(spark, SMALL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle"]
    texts = ["a.", "b!", "c?", "a", "b ", "c.\n", "d ", " ", "", None, "é.", "x\x85", ".", "d.\t"]
    rows = [
        (
            rng.choice([None, *range(120)]),
            rng.choice([None, *range(-2, 9)]),
            rng.choice(roles),
            rng.choice(texts),
        )
        for _ in range(900)
    ]
    rows += rng.sample(rows, 60)  # repeated rows
    compare(edge.with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(5)), rows)


def test_long_runs(spark):
    """Runs longer than a block, and a conversation that changes all the time."""
    rows = [(1, t, "user", f"text {t}.") for t in range(3000)]
    rows += [(2, t, "user" if t % 2 else "assistant", f"text {t}") for t in range(2500)]
    rows += [(3, t, "system", "same.") for t in range(2100)]
    got = conversations.repair_report(conversations.damaged(spark.createDataFrame(rows, SCHEMA)))
    kept = messages_of(rows)
    for row in got.collect():
        assert len(row.audit.replace("I", "")) == len(kept[row.conv_id])
        edits = 3 * row.audit.count("D") + 2 * (row.audit.count("I") + row.audit.count("R"))
        assert 0 <= row.cost - edits <= row.truncated
        assert row.blank + row.duplicate <= row.audit.count("D")


@pytest.mark.parametrize("seed", range(40))
def test_runs_and_powers(seed, monkeypatch):
    """Runs, cut into blocks, give what message by message gives, and that is the cheapest."""
    monkeypatch.setattr(conversations, "BLOCK", 3)
    rng = random.Random(seed)
    symbols = [(i, f) for i in ("s", "u", "a", "") for f in (0, 1)] + [("", 2)]
    runs = [(rng.choice(symbols), rng.randint(1, 9)) for _ in range(rng.randint(0, 6))]
    names = {0: None, 1: "truncated", 2: "blank"}
    flat = tuple((s[0] or "tool", names[s[1]]) for s, n in runs for _ in range(n))
    repairs = conversations.Repairs()
    assert repairs.unrolled(tuple(runs)) == repairs.cheapest(tuple(runs)) == searched(flat)
    for symbol, _ in runs:
        costs = conversations.END
        for n in range(1, 40):
            costs = conversations.advance(repairs.power(symbol, 0), costs)
            assert repairs.before_run(symbol, n, conversations.END) == costs


def test_messages(spark):
    rows = [(5, 0, "user", "Hi."), (5, 2, "user", "Still there?"), (5, 3, "assistant", "Yes."), (5, 4, "user", "Good."), (6, 0, "assistant", "x")]
    found = conversations.repaired_messages(
        spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", copies int")
    )
    got = sorted(map(tuple, found.collect()))
    assert got == [
        (5, 0, "K", "user", "Hi."),
        (5, 1, "I", "assistant", ""),
        (5, 2, "K", "user", "Still there?"),
        (5, 3, "K", "assistant", "Yes."),
        (5, 4, "K", "user", "Good."),
        (5, 5, "I", "assistant", ""),
    ]


def test_no_rows(spark):
    compare(spark.createDataFrame([], SCHEMA), [])
