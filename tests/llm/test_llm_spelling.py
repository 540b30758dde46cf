"""Spelling variants against brute force over all pairs of words, and on rows of all kinds."""

import random
import re
import zlib
from collections import Counter

import edge
import numpy as np
import pytest
from conftest import SMALL

from creditloom.llm import spelling
from creditloom.llm.queries import op12_spelling_variants


def counted(rows, min_chars=5, min_count=3):
    total = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            checksum = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            if checksum % 97 == 0:
                run = "".join(c for i, c in enumerate(run) if i != checksum % len(run))
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars and n >= min_count}


def apart(a, b):
    """Edit distance is exactly one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    """By wildcards: near words agree once a letter is left out of both or of the longer one."""
    holes, near = {}, {w: set() for w in words}
    for word in words:
        for i in range(len(word)):
            holes.setdefault((i, word[:i] + word[i + 1 :]), set()).add(word)
    for (_, rest), group in holes.items():
        group = group | ({rest} & set(words))
        for word in group:
            near[word] |= group - {word}
    near = {w: {o for o in others if apart(w, o)} for w, others in near.items()}
    forms = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 2 * words[word]:
                forms[word] = best

    def root(word):
        return root(forms[word]) if word in forms else word

    return {
        (w, forms.get(w), root(w), n, len(near[w]), words[forms[w]] if w in forms else None)
        for w, n in words.items()
    }


def variants(rows, seed, size):
    """Words and many edits of them."""
    rng = random.Random(seed)
    letters = "abcdeéÿ×"
    words = {}
    for _ in range(size):
        word = "".join(rng.choices(letters, k=rng.randint(5, 9)))
        words[word] = rng.randint(3, 400)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(word))
            other = word[:at] + rng.choice(["", *letters]) + word[at + rng.randint(0, 1) :]
            if len(other) >= 5:
                words[other] = rng.randint(3, 400)
                word = rng.choice([word, other])
    return words | rows


@pytest.mark.parametrize("limit", [3, 40, 100_000])
def test_small_limits(spark, limit):
    """Nodes that are opened to the bottom, dealt out, or not at all."""
    extra = {"q" * k: 3 * k for k in range(5, 300, 7)} | {"q" * k: 3 * k for k in range(295, 305)}
    extra |= {"abcde" * 20: 9, "abcde" * 20 + "f": 20, "abcde" * 19 + "abcd": 50}
    words = variants(extra, 5, 250)
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = spelling.spelling_variants(frame, limit=limit).collect()
    assert len(got) == len(words) and set(map(tuple, got)) == brute(words)


@pytest.mark.parametrize("seed", range(4))
def test_search(seed):
    """Both sides of the search, below a leaf's size and above it."""
    words = list(variants({}, seed, 300))
    members = spelling.Words(words, [3] * len(words))
    sought = spelling.Words(words[::2], [3] * len(words[::2]))
    found = set()
    for a, b in spelling.search(members, sought, cells=500):
        pairs = list(zip(sought.words[a], members.words[b]))
        assert not found & set(pairs) and len(set(pairs)) == len(pairs)
        found |= set(pairs)
    assert found == {(a, b) for a in words[::2] for b in words if apart(a, b)}


def test_short_words(spark):
    words = {w: n for n, w in enumerate(("a", "b", "ab", "abc", "bc", "xyz", "xz", "yx"), 3)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.near_words(frame, min_chars=1).collect()
    assert {r.word: r.n_near for r in got} == {
        w: k for w in words if (k := sum(apart(w, o) for o in words))
    }


def test_vectors_are_cut_alike():
    some = spelling.vectors(["a" * 254, "a" * 255, "a" * 256, "ab"])
    assert some.shape == (4, spelling.GROUPS) and some.max() == 255
    assert np.abs(np.diff(some[:3].astype(int), axis=0)).sum() == 1


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op12_spelling_variants(spark, SMALL).collect()
    want = brute(counted(rows))
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert {r.word: r.n for r in got} == counted(rows)


def test_words_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_RUNS", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 70)
    rows = edge.texts() + [(i, "Wörter wörter WöRTER Straße straße×÷ lang" * 9, None, None) for i in range(300, 420)]
    frame = edge.with_clashes(edge.documents(spark, rows))
    assert {r.word: r.n for r in spelling.word_counts(frame).collect()} == counted(rows)


def test_chains_end_at_the_last_form(spark):
    """Forms of forms, each twice as frequent, and a form that many words share."""
    words = {"abcdefgh"[:5] + "x" * k: 3 * 2**k for k in range(30)}
    words |= {f"{a}bcde{b}": 3 for a in "qrst" for b in "xyzw"}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.spelling_variants(frame).collect()
    assert set(map(tuple, got)) == brute(words)


def test_no_rows(spark):
    words = spelling.word_counts(edge.documents(spark, []))
    assert spelling.spelling_variants(words).count() == 0
