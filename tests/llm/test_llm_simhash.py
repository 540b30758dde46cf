import random

import edge
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from creditloom.llm import simhash
from creditloom.llm.components import components


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    grams = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams] if parts else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(count, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = edge.prose(i % 12, 60 + i % 7 * 100).split()
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("block_rows", [4096, 5])
def test_components_equal_brute_force(spark, block_rows):
    rows = edge.texts() + [(i + 100, *r[1:]) for i, r in enumerate(near_copies(150))]
    frame = edge.with_clashes(edge.documents(spark, rows))
    got = simhash.near_duplicates(frame, block_rows=block_rows).collect()
    prints = [fingerprint(r[1]) for r in rows]
    union = Union()
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                union.join(b, a)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            root = union.find(i)
            least[root] = min(least.get(root, r[0]), r[0])
    want = [(r[0], f"{prints[i]:016x}", least.get(union.find(i))) for i, r in enumerate(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert len({w[2] for w in want}) < len({w[1] for w in want})


def sets_of(text, words=5):
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    return frozenset(b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1)))


@pytest.mark.parametrize("block_rows", [2048, 6])
def test_one_document_of_each_group_stays(spark, block_rows):
    rows = edge.texts() + [(i + 100, *r[1:]) for i, r in enumerate(near_copies(150, 1))]
    docs = edge.with_clashes(edge.documents(spark, rows))
    out = simhash.one_of_each(docs, block_rows=block_rows)
    assert out.dtypes == docs.dtypes
    grams, union = [sets_of(r[1]) for r in rows], Union()
    for a in range(len(rows)):
        for b in range(a):
            both = len(grams[a] | grams[b])
            if both == 0 or len(grams[a] & grams[b]) / both >= 0.8:
                union.join(b, a)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(union.find(i), []).append(r[0])
    want = [min((x for x in g if x is not None), default=None) for g in groups.values()]
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_sets_of_bits():
    for bits, radius, blocks in ((64, 2, 4), (64, 3, 5), (10, 1, 2)):
        sets = simhash.pigeonhole_sets(bits, radius, blocks)
        rng = random.Random(1)
        for _ in range(200):
            changed = set(rng.sample(range(bits), radius))
            assert any(changed.isdisjoint(s) for s in sets)
    with pytest.raises(ValueError):
        simhash.pigeonhole_sets(64, 4, 4)


@pytest.mark.parametrize("size", [8, 32])
def test_bit_sliced_distances(size):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, (9, size), dtype=np.uint8)
    prints = base[rng.integers(0, 9, 200)].copy()
    for row in prints:
        for bit in rng.integers(0, size * 8, rng.integers(0, 7)):
            row[bit // 8] ^= np.uint8(128 >> (bit % 8))
    distance = np.unpackbits(prints[:, None] ^ prints[None], axis=2).sum(2)
    group = np.digitize(np.arange(200), [70, 100, 150, 151])
    blocks = [
        (prints[:70], None),
        (prints[70:100], prints[100:150]),
        (prints[150:151], None),
        (prints[151:], None),
    ]
    for radius in (0, 1, 2, 7, 20, 59):
        planes = simhash.planes_of(prints)
        for i in range(0, 200, 17):
            near = simhash.within(prints[i], planes, radius)
            assert near[near < 200].tolist() == np.flatnonzero(distance[i] <= radius).tolist()
        i, j = simhash.close_pairs(blocks, radius)
        want = {
            (a, b)
            for a, b in zip(*np.nonzero(distance <= radius))
            if a < b
            and ((group[a] == group[b] and group[a] in (0, 3, 4)) or (group[a], group[b]) == (1, 2))
        }
        assert set(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(60)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)],
        "none": [],
    }[shape]
    links += [(7, 7), (None, 3)] if links else []
    union = Union()
    for a, b in links:
        if a is not None and a != b:
            union.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: union.find(n) for n in list(union)}


def test_few_links_stay_in_few_files(spark, monkeypatch):
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in held}
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        few = components(links)
        assert len(few.inputFiles()) == 1
        monkeypatch.setattr("creditloom.session.FILE_ROWS", 20)
        more = components(links, 60)
        assert len(more.inputFiles()) == 3
        for found in (few, more):
            assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(61)}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_empty(spark):
    docs = edge.documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_large_buckets_are_cut_into_blocks(spark):
    frame = spark.range(1000).select(
        F.unhex(F.lpad(F.hex("id"), 16, "0")).alias("fingerprint"), F.lit(b"k").alias("bucket")
    )
    rows = simhash.bucket_blocks(frame, 100).collect()
    assert len(rows) == 55
    assert sum(len(r.left) for r in rows if r.right is None) == 1000
    assert max(len(r.left) + len(r.right or []) for r in rows) < 400


def edited_copies(seed, count=40, words=304, edits=7):
    """Variants of one text whose five-word shingle sets have similarities around 0.8."""
    rng = random.Random(seed)
    base = [f"s{seed}w{k}" for k in range(words)]
    out = []
    for v in range(count):
        copy = list(base)
        for at in rng.sample(range(words), rng.choice([edits - 4, edits - 2, edits])):
            copy[at] = f"v{v}x{at}"
        out.append(" ".join(copy))
    return out


def test_pairs_behind_a_failed_link_are_checked_too(spark):
    """A forest of the candidates loses groups here: links of it fail that other pairs stand in for."""
    copies = [text for seed in range(12) for text in edited_copies(seed)]
    rows = [(i, text, "en", "a") for i, text in enumerate(copies)]
    grams, union = [sets_of(r[1]) for r in rows], Union()
    for family in range(0, len(rows), 40):
        for a in range(family, family + 40):
            for b in range(family, a):
                if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.8:
                    union.join(b, a)
    out = simhash.one_of_each(edge.documents(spark, rows))
    assert {r.doc_id for r in out.collect()} == {union.find(i) for i in range(len(rows))}


def test_exact_links_join_all_roots_with_a_similar_candidate():
    """Against all pairs: inside a block and across two, with roots that several pairs join."""
    rng = random.Random(6)
    measures, families = (30, 100, 4), []
    for seed in range(5):
        families += edited_copies(seed, count=30, words=120, edits=5)
    rng.shuffle(families)
    members = []
    for at, text in enumerate(families):
        hashes = np.unique(simhash.shingle_hashes(text, 5)).tobytes()
        members.append((simhash.set_fingerprint(text, 5, 4), bytes([at % 40]), hashes))
    texts = {m[0]: t for m, t in zip(members, families)}
    for left, right in ((members, []), (members[:70], members[70:])):
        union = Union()
        for a in left:
            for b in right or left:
                close = simhash.jaccard(texts[a[0]], texts[b[0]], 5) >= 0.8
                apart = np.unpackbits(np.frombuffer(a[0], np.uint8) ^ np.frombuffer(b[0], np.uint8))
                if close and a[1] != b[1] and apart[:64].sum() <= 30 and apart[:256].sum() <= 100:
                    union.join(a[1], b[1])
        links = simhash.exact_links(left, right, measures, 0.8)
        got, root = Union(), {m[0]: m[1] for m in members}
        for a, b in links:
            assert simhash.jaccard(texts[a], texts[b], 5) >= 0.8 and root[a] != root[b]
            got.join(root[a], root[b])
        assert len(links) < 40
        assert {k: got.find(k) for k in set(got) | set(union)} == {k: union.find(k) for k in set(got) | set(union)}


def test_places_are_bounded_in_rows_and_bytes(spark):
    frame = spark.range(300).select(
        F.unhex(F.lpad(F.hex("id"), 16, "0")).alias("fingerprint"),
        F.lit(b"k").alias("bucket"),
        F.lit(10).alias("size"),
    )
    blocks = F.ceil(F.greatest(F.col("n") / 200, F.col("total") / 600))
    places = simhash.block_places(frame, blocks).groupBy("i", "j").count().collect()
    assert len(places) == 15 and sum(r["count"] for r in places) == 300 * 5


def planted_pairs(count, low=0.80, high=0.85):
    """Pairs of texts whose shingle sets have a similarity in that range."""
    rng, pairs = random.Random(11), []
    while len(pairs) < count:
        words = edge.prose(rng.random(), rng.randint(50, 600), 3000).split()
        other = list(words)
        for _ in range(rng.randint(1, 1 + len(words) // 30)):
            at = rng.randrange(len(other))
            if rng.random() < 0.5:
                other[at] = f"x{rng.randrange(99)}"
            else:  # a passage goes, or is put in
                other[at : at + rng.choice([0, 1, 3])] = [f"y{rng.randrange(99)}"] * rng.choice([0, 1, 2])
        one, two = " ".join(words), " ".join(other)
        if low <= simhash.jaccard(one, two, 5) < high:
            pairs.append((one, two))
    return pairs


@pytest.mark.parametrize("rows", [1000, 200_000, 10**9])
def test_recall_of_candidates(rows):
    """Share of 1,500 pairs at 0.80 to 0.85 that meet in a bucket and pass both radii."""
    sketch = simhash.Sketch()
    sets = [np.array(chosen) for chosen in sketch.sets(rows)]
    found = 0
    pairs = planted_pairs(1500)
    for pair in pairs:
        bits = [
            np.unpackbits(np.frombuffer(simhash.set_fingerprint(t, 5, 4), np.uint8)[:32]) for t in pair
        ]
        apart = bits[0] != bits[1]
        meet = any(not apart[chosen].any() for chosen in sets)
        found += meet and apart[:64].sum() <= sketch.radius(64) and apart.sum() <= sketch.radius(256)
    print(f"{rows} rows: {len(sets)} sets of {len(sets[0])} bits, recall {found / len(pairs):.4f}")
    assert found / len(pairs) >= 0.97


def test_a_hot_bucket_in_bounded_memory():
    """Blocks of near copies: what they hold at once does not follow the pairs that pass."""
    import tracemalloc

    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, 48, dtype=np.uint8)
    rows = np.repeat(base[None], 2048, axis=0)
    flips = rng.integers(0, 256, (2048, 6))
    for k in range(6):
        rows[np.arange(2048), flips[:, k] // 8] ^= (128 >> (flips[:, k] % 8)).astype(np.uint8)
    blocks = [(rows[:1024], rows[1024:])]
    tracemalloc.start()
    links = list(simhash.nearest_links(blocks, 20, 59, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(links[0]) == 2047
    assert peak < 160e6


def test_repeats_count_once_and_equal_bits_are_no_proof(spark):
    once = [f"p{k}" for k in range(204)]
    repeated = once[:100] + once[80:100] * 19 + once[100:]
    # one shingle in the majority gives all bits of the fingerprint by repeats; the rest differs
    loops = [" ".join(["x"] * 100 + [f"{name}{k}" for k in range(20)]) for name in "ab"]
    rows = [(i, t, "en", "a") for i, t in enumerate([" ".join(once), " ".join(repeated), *loops])]
    assert simhash.jaccard(rows[0][1], rows[1][1], 5) >= 0.8 > simhash.jaccard(*loops, 5)
    out = simhash.one_of_each(edge.documents(spark, rows))
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3]
