import zlib
from collections import Counter

import edge
import numpy as np
import pytest
from tokenizers import Tokenizer

from creditloom.llm import packing
from creditloom.llm.queries import byte_bpe


def one_by_one(lengths, capacities, rule, weights):
    """Number of sequences when each piece is placed by itself, longest first."""
    limits = capacities.limits()
    scale, open_ = np.array(weights) / limits, []
    for length in sorted(lengths, reverse=True):
        need, best = packing.demand(length), None
        for left in open_:
            if (left >= need).all():
                after = np.square((left - need) * scale).sum()
                worth = -(left * scale) @ (need * scale) if rule == "dot" else after
                if best is None or worth < best[0]:
                    best = (worth, left)
        if best is None:
            open_.append(limits - need)
        else:
            best[1][:] -= need
    return len(open_)


@pytest.mark.parametrize("rule", ["dot", "norm"])
@pytest.mark.parametrize("weights", [(1, 0, 0), (1, 0.5, 0.3)])
@pytest.mark.parametrize("limits", [(64, None, None), (64, 3, None), (64, 5, 1500)])
def test_plan(rule, weights, limits):
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 39, 400).tolist()
    capacities = packing.Capacities(*limits)
    fillings = packing.plan(Counter(lengths), capacities, rule, weights)
    placed = Counter()
    for filling, times in fillings:
        assert (sum(map(packing.demand, filling)) <= capacities.limits()).all()
        for length in filling:
            placed[length] += times
    assert placed == Counter(lengths)
    assert sum(n for _, n in fillings) == one_by_one(lengths, capacities, rule, weights)


def test_a_piece_must_fit():
    with pytest.raises(ValueError, match="exceeds"):
        packing.plan({65: 1}, packing.Capacities(64))


def check(spark, frame, rows, max_tokens=1024):
    tokenizer = Tokenizer.from_file(byte_bpe()["tokenizer"])
    pieces = packing.tokenised(frame, **byte_bpe(), max_tokens=max_tokens)
    got = packing.pack(pieces, packing.Capacities(max_tokens)).collect()
    want, total = Counter(), 0
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        first = len(ids) % max_tokens or max_tokens
        edges = [0, *range(first, len(ids) + 1, max_tokens)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            want[(r[0], k, a, b - a, crc)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_tokens
    return len(sequences), -(-total // max_tokens)


def test_edges(spark):
    rows = edge.texts() + [(100, "x", None, None)] * 5
    used, least = check(spark, edge.with_clashes(edge.documents(spark, rows)), rows)
    assert used <= least + 1


def test_few_sequences(spark):
    rows = [(i, edge.prose(i, 1 + i * 7 % 200), None, None) for i in range(600)]
    used, least = check(spark, edge.documents(spark, rows), rows)
    assert used <= 1.02 * least + 1


def test_empty(spark):
    pieces = packing.tokenised(edge.documents(spark, []), **byte_bpe())
    assert packing.pack(pieces).count() == 0


def test_ranks_are_gapless_in_a_hot_length(spark):
    pieces = spark.range(5000).selectExpr(
        "id AS doc_id", "0 AS piece", "0L AS start", "IF(id % 3 = 0, 7L, id % 5) AS length", "0L AS ids_crc32"
    )
    rows = packing.ranked(pieces, rows_per_bucket=100).collect()
    by = {}
    for r in rows:
        by.setdefault(r.length, []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_both_libraries_agree():
    fast, slow = packing.Encoder(**{**{"path": byte_bpe()["tokenizer"]}, "ranks": byte_bpe()["ranks"], "pattern": byte_bpe()["pattern"]}), packing.Encoder(byte_bpe()["tokenizer"])
    samples = [r[1] or "" for r in edge.texts()]
    samples += ["a  b\t\tc \n\n d'll 12a ÄÖ ÿŁ x\r\ny", "<|endoftext|>", " \n", " a b c", "日本 語"]
    for text in samples:
        assert fast.ids(text).tolist() == slow.ids(text).tolist()


def test_equal_pieces_fill_a_bin_before_the_next():
    lengths = {600: 10, 200: 10, 141: 15}
    everything = [n for n, times in lengths.items() for _ in range(times)]
    fillings = packing.plan(lengths, packing.Capacities())
    used = sum(n for _, n in fillings)
    assert used == one_by_one(everything, packing.Capacities(), "norm", (1, 0, 0)) == 10


def test_special_tokens_and_long_runs(spark):
    """Ids are those of a plain call, whatever stands in the text, and however long its runs are."""
    rows = [(1, "a <|endoftext|> b", None, None), (2, "<|endoftext|>" * 3, None, None)]
    rows += [(3, " " * 2_000_000, None, None), (4, "x" + "\n" * 2_000_000 + "y", None, None)]
    rows += [(5, "\t \r\n" * 300_000 + "z", None, None), (6, "ab" * 1_000_000, None, None)]
    rows += [(7, (" " * 4095 + "w") * 30 + " " * 4097, None, None), (8, "1" * 500_000, None, None)]
    check(spark, edge.documents(spark, rows), rows)
    by = packing.tokenised(edge.documents(spark, rows[:1]), **byte_bpe(), with_ids=True).first()
    assert by["ids"] == [64, 220, 50256, 275, 2]
