import hashlib

import edge
import numpy as np
import pytest

from creditloom.llm import line_dedup


def key(line):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in line.encode().strip(b" \t\n\x0b\x0c\r"))


def brute(rows, min_docs, keep):
    seen, first = {}, {}
    for r in rows:
        for k in {key(line) for line in (r[1] or "").split("\n")}:
            seen[k] = seen.get(k, 0) + 1
            if r[0] is not None:
                first[k] = min(first.get(k, r[0]), r[0])
    out = []
    for r in rows:
        lines, kept, had = (r[1] or "").split("\n"), [], set()
        for line in lines:
            k = key(line)
            if k and seen[k] >= min_docs:
                if keep == "none" or first.get(k) != r[0] or k in had:
                    continue
                had.add(k)
            kept.append(line)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((r[0], len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


def corpus():
    shared = ["Shared line", " shared LINE\t", "Other", "ÉA", "Éa"]
    rows = edge.texts()
    for i in range(20, 60):
        lines = [edge.prose(i, 6), shared[i % 5], shared[i % 3], edge.prose(i % 7, 4)]
        rows.append((i, "\n".join(lines), "en", "a"))
    return rows + rows[-3:]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("filter_bytes", [64 << 20, 16])
def test_equals_brute_force(spark, keep, limit, filter_bytes):
    rows = corpus()
    applied = line_dedup.drop_common_lines(
        edge.with_clashes(edge.documents(spark, rows)),
        min_docs=5,
        keep=keep,
        max_broadcast_keys=limit,
        max_filter_bytes=filter_bytes,
    )
    got = sorted(map(tuple, line_dedup.line_report(applied).collect()), key=repr)
    assert got == brute(rows, 5, keep)


def test_rows_keep_their_columns(spark):
    docs = edge.with_clashes(edge.documents(spark, corpus()))
    out = line_dedup.deduplicated(line_dedup.drop_common_lines(docs, min_docs=5), docs)
    assert out.dtypes == docs.dtypes
    assert out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert out.count() == docs.count()


def test_empty(spark):
    assert line_dedup.drop_common_lines(edge.documents(spark, [])).count() == 0


def test_merged_filters_hold_every_repeat():
    rng = np.random.default_rng(3)
    shape = line_dedup.Shape(3000, 16, 1 << 20, 1 << 12)
    parts = [rng.integers(0, 1 << 63, 500, dtype=np.uint64) for _ in range(6)]
    parts[1][:50], parts[4][:20] = parts[0][:50], parts[0][:20]
    repeats = np.concatenate([parts[0][:50], parts[2][:5]])
    parts[2] = np.concatenate([parts[2], parts[2][:5]])
    once, twice = shape.empty(), shape.empty()
    for part in parts:
        own = shape.empty(), shape.empty()
        for half in np.array_split(part, 2):
            line_dedup.see(*own, half, shape)
        line_dedup.merge(once, twice, *own)
    assert line_dedup.contained(twice, shape.places(repeats)).all()
    singles = parts[5]
    assert line_dedup.contained(once, shape.places(singles)).all()
    assert line_dedup.contained(twice, shape.places(singles)).mean() < 0.05
