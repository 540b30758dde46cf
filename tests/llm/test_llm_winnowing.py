"""Winnowing against its definition, and the report against a plain loop over sorted rows."""

import hashlib
import random

import edge
import pytest
import xxhash
from conftest import SMALL

from creditloom.llm import winnowing
from creditloom.llm.queries import op13_document_fingerprints

MASK = (1 << 64) - 1


def plain_mix(v):
    v = ((v ^ v >> 31) * 0x7FB5D329728EA185) & MASK
    v = ((v ^ v >> 27) * 0x81DADEF4BC2DD44D) & MASK
    return v ^ v >> 33


def plain(text, gram, window):
    """Hash and position of the rightmost smallest hash of every window."""
    if not text:
        return []
    gram = min(gram, len(text))
    hashes = []
    for i in range(len(text) - gram + 1):
        value = 0
        for c in text[i : i + gram]:
            value = (value * winnowing.BASE + ord(c) + 1) & MASK
        hashes.append(plain_mix(value))
    window = min(window, len(hashes))
    chosen = set()
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        chosen.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return [(hashes[p], p) for p in sorted(chosen)]


def pairs(found):
    return list(zip(found[0].tolist(), found[1].tolist()))


@pytest.mark.parametrize("gram, window", [(1, 1), (3, 4), (5, 1), (4, 9), (16, 85)])
def test_fingerprint(gram, window, monkeypatch):
    monkeypatch.setattr(winnowing, "PIECE", 64)
    rng = random.Random(gram * 100 + window)
    winnow = winnowing.Winnowing(gram, window)
    texts = ["", "a", "ab", "aaaa" * 60, "é𝄞\x00 x" * 50]
    texts += ["".join(rng.choices("abc", k=rng.randint(0, 400))) for _ in range(30)]
    for text in texts:
        assert pairs(winnow.fingerprint(text)) == plain(text, gram, window)


def test_shared_passages_are_found():
    """Any passage of window + gram - 1 code points leaves a hash in both texts."""
    rng = random.Random(3)
    winnow = winnowing.Winnowing(8, 20)
    letters = "abcdefgh ijkl"
    for _ in range(100):
        passage, *rest = ("".join(rng.choices(letters, k=k)) for k in (27, 90, 50, 3, 200))
        one, two = rest[0] + passage + rest[1], rest[2] + passage + rest[3]
        assert winnowing.likeness(winnow.fingerprint(one), winnow.fingerprint(two)) > 0


def brute(rows, gram=winnowing.GRAM, window=winnowing.WINDOW):
    def order(row):
        text = row[1] or ""
        low = xxhash.xxh64_intdigest(text.encode(), 42)
        return (row[0] is not None, row[0] or 0, low - (low >> 63 << 64))

    rows = sorted(rows, key=order)
    found = [plain(r[1] or "", gram, window) for r in rows]
    shown = lambda f: " ".join(f"{h:016x}@{p}" for h, p in f)

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, row in enumerate(rows):
        text, following = row[1] or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + following[:cut]
        again = plain(changed, gram, window)
        yield (
            row[0],
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            shown(found[i]),
            shown(again),
            near(found[i], again),
            near(found[i], found[(i + 1) % len(rows)]),
        )


def compare(frame, rows, **options):
    got = winnowing.edit_report(frame, **options).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows, **options), key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r) for r in op13_document_fingerprints(spark, SMALL).collect()}
    rows.sort()
    sample = rows[:60]  # neighbours in order; the last one's neighbour is outside
    want = list(brute(sample))[:-1]
    assert len(got) == len(rows)
    assert [got[row[0]] for row in want] == want
    assert got[rows[-1][0]][:3] == list(brute([rows[-1], rows[0]]))[1 if rows[0][0] < rows[-1][0] else 0][:3]


@pytest.mark.parametrize("repeated", [False, True])
def test_edges(spark, repeated):
    short = [(r[0], (r[1] or "")[:700] if r[1] is not None else None, *r[2:]) for r in edge.texts()]
    rows = short + [(i, edge.prose(i, 3 + i % 40), None, None) for i in range(20, 90)]
    if repeated:
        rows += [(30, edge.prose(30, 33), None, None)] * 7 + [(None, None, None, None)] * 3
    else:
        rows = list({(r[0], r[1] or ""): r for r in rows}.values())
    frame = edge.with_clashes(edge.documents(spark, rows, partitions=7))
    compare(frame, rows, gram=5, window=9)


@pytest.mark.parametrize("rows", [[], [(1, "only one text", "en", "a")], [(None, None, None, None)]])
def test_few_rows(spark, rows):
    compare(edge.documents(spark, rows, partitions=2), rows)


def test_very_long_text(spark):
    rows = [(1, edge.prose(1, 900_000, 9000), None, None), (2, "x" * 3_000_000, None, None)]
    by = {r.doc_id: r for r in winnowing.edit_report(edge.documents(spark, rows, 2)).collect()}
    assert by[1].n_chars == len(rows[0][1]) and 0.5 < by[1].near_edited < 0.8
    assert by[2].fingerprint.split("@")[0] == by[2].edited_fingerprint.split("@")[0]


def test_arrays(spark):
    rows = [(1, "some text of words", None, None), (2, None, None, None)]
    got = {r.doc_id: r for r in winnowing.fingerprints(edge.documents(spark, rows, 1), 4, 3).collect()}
    want = plain(rows[0][1], 4, 3)
    assert [h & MASK for h in got[1].hashes] == [h for h, _ in want]
    assert got[1].positions == [p for _, p in want]
    assert got[2].hashes == got[2].positions == []
