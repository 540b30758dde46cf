"""Spelling variants: words that differ in one letter, found in a trie of letter-group counts.

Letters fall into groups. A word's vector says how many of its letters are in each group; an
insertion adds 1 to one count, a deletion takes 1 from one, a replacement may do both. So the vector
of a near word exceeds a word's by 1 in all at most (surplus) and falls short by 1 in all at most
(deficit). The words stand in a trie, one level for each group, by the counts in turn. A depth-first
search goes down it with a budget of one surplus and one deficit; what it finds at the bottom is
verified letter by letter. All words that are sought go down the trie together, as arrays.

Spark holds the trie by its upper nodes. Every word has its home below one node, and visits the other
nodes that its budget reaches and that do not come before its own: so each pair of words meets once.
Nodes with more than ``limit`` words are opened: their words and visitors go on to the nodes some levels
below. What meets at a node is one sorted stream: its words first, which are kept, then the visitors,
in batches. Many visitors are dealt out, each share with a copy of the words; words that are too many
at the lowest level are dealt out too, each share with all visitors.

Words come from counts that every task adds up ahead of the shuffle. A word's form is its near word
with the largest count (the least in code-point order among equals) if that is at least twice its
own. Counts at least double from form to form, so roots are reached by doubling steps in few joins.

Defined results: a null text has no words, a null id is an empty text in the checksum; repeated rows
count each; a table without words gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import map_batches
from creditloom.operators.relational import group_table
from creditloom.session import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")

# --- words ----------------------------------------------------------------------------------

#: Different words that a task adds up before it passes their counts on.
HELD_WORDS = 200_000

#: Runs of a text that are held at a time.
HELD_RUNS = 1 << 18


def runs_of(text: str) -> Iterator[Counter]:
    """Letter runs of a text, A-Z in lower case, with their counts, some at a time."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if len(text) <= HELD_RUNS:
        yield Counter(RUN.findall(text))
        return
    found: Counter = Counter()
    for number, run in enumerate(RUN.finditer(text)):
        found[run.group()] += 1
        if number % HELD_RUNS == HELD_RUNS - 1:
            yield found
            found = Counter()
    yield found


def misspelt(run: str, checksum: int, modulus: int) -> str:
    """The run, or without one of its letters if its checksum says so."""
    if checksum % modulus:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame,
    min_chars: int = 5,
    min_count: int = 3,
    modulus: int = 97,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``word``, ``n``: the words of all texts with a letter left out here and there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total: Counter = Counter()

        def columns() -> dict:
            return {"word": list(total), "n": list(total.values())}

        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            for name, value in rows:
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for found in runs_of(value or ""):
                    for word, times in found.items():
                        if len(word) < min_chars:
                            continue  # and shorter without a letter
                        checksum = zlib.crc32(word.encode(), start)
                        if checksum % modulus == 0:
                            word = misspelt(word, checksum, modulus)
                            if len(word) < min_chars:
                                continue
                        total[word] += times
                    if len(total) >= HELD_WORDS:
                        yield columns()
                        total.clear()
        yield columns()

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = map_batches(narrow, run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- vectors and nodes ----------------------------------------------------------------------

GROUPS = 12

#: Levels at which the trie is cut into nodes, and at which large nodes are opened again.
DEPTHS = (3, 6, GROUPS)


def vectors(words: list[str]) -> np.ndarray:
    """Letters in each group (code point modulo their number); counts end at 255.

    Cut counts differ by no more than whole ones, so no near word is lost by that.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    places = np.repeat(np.arange(len(words)) * GROUPS, lengths) + codes % GROUPS
    counts = np.bincount(places, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
    return np.minimum(counts, 255).astype(np.uint8)


def steps(width: int) -> np.ndarray:
    """Differences of a vector of that width within the budget, the zero difference first."""
    plus = np.eye(width, dtype=np.int16)
    both = (plus[:, None] - plus[None, :]).reshape(-1, width)
    return np.concatenate([np.zeros((1, width), np.int16), plus, -plus, both[both.any(axis=1)]])


def nodes(words: DataFrame, depth: int, above: int) -> DataFrame:
    """Rows ``word``, ``n``, ``node``, ``home`` at a level.

    From words (``above`` is 0) or from such rows at the level ``above``, which go on to the nodes
    below theirs.
    """
    moves = steps(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.slice(start, 4096)
                own = vectors(part.column("word").to_pylist())[:, :depth]
                reached = own[:, None, :].astype(np.int16) + moves[None]
                allowed = ((reached >= 0) & (reached <= 255)).all(axis=2)
                # the first place where they differ says which node comes first
                first = np.argmax(moves != 0, axis=1)
                allowed &= (moves[np.arange(len(moves)), first] >= 0)[None]
                if above:
                    known = np.frombuffer(b"".join(part.column("node").to_pylist()), np.uint8)
                    known = known.reshape(-1, above).astype(np.int16)
                    allowed &= (reached[:, :, :above] == known[:, None]).all(axis=2)
                rows, move = np.nonzero(allowed)
                keys = reached[rows, move].astype(np.uint8).tobytes()
                yield {
                    "word": part.column("word").take(pa.array(rows)),
                    "n": part.column("n").take(pa.array(rows)),
                    "node": [keys[i : i + depth] for i in range(0, len(keys), depth)],
                    "home": move == 0,
                }

    return map_batches(words, run, "word string, n long, node binary, home boolean")


def placed(words: DataFrame, limit: int) -> DataFrame:
    """Every word at its home and at the nodes it visits, dealt out where they are many.

    ``share`` and ``part`` tell apart the copies of a node; a home word that is sought there has
    ``sought``.
    """
    done, rows, above = None, words, 0
    for depth in DEPTHS:
        rows = written(nodes(rows, depth, above))
        sizes = group_table(
            rows,
            ["node"],
            {"members": F.count_if("home"), "everything": F.count(F.lit(1))},
        )
        sized = rows.join(sizes.where("members > 0"), "node")
        large = F.col("members") > limit
        settled = sized if depth == DEPTHS[-1] else sized.where(~large)
        done = settled if done is None else done.unionByName(settled)
        if depth == DEPTHS[-1] or sizes.where(large).isEmpty():
            break
        rows, above = sized.where(large).select("word", "n", "node", "home"), depth
    shares = F.ceil(F.col("everything") / F.lit(limit)).cast("int")
    parts = F.ceil(F.col("members") / F.lit(limit)).cast("int")
    hashed = F.xxhash64("word")
    dealt = done.withColumns(
        {
            "shares": shares,
            "parts": parts,
            "own_share": F.pmod(hashed, shares).cast("int"),
            "own_part": F.pmod(F.shiftright(hashed, 20), parts).cast("int"),
        }
    )

    def every(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    kept = (
        dealt.where("home").withColumn("part", F.col("own_part")).withColumn("share", every("shares"))
    )
    sought = dealt.withColumn("share", F.col("own_share")).withColumn("part", every("parts"))
    columns = ["node", "share", "part", "word", "n"]
    return kept.select(*columns, F.lit(0).alias("kind")).unionByName(
        sought.select(*columns, F.when(F.col("home"), 1).otherwise(2).alias("kind"))
    )


# --- the search below a node ----------------------------------------------------------------

#: Nodes with no more words than this are compared with their visitors at once.
LEAF = 64

#: Letters of words that are compared as arrays; longer ones are compared as texts.
WIDTH = 32


class Words:
    """Words as arrays: vectors, first and last two letters, letters."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        vector = vectors(words)
        order = np.lexsort(vector.T[::-1])
        self.vectors = vector[order]
        self.words = np.array(words, dtype=object)[order]
        self.counts = np.array(counts, dtype=np.int64)[order]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(words))
        cut = [w[:WIDTH] for w in self.words]
        self.letters = (
            np.array(cut, dtype=f"<U{WIDTH}").view("<u4").reshape(len(words), WIDTH)
            if words
            else np.zeros((0, WIDTH), "<u4")
        )
        ends = np.array([w[-2:] for w in self.words], dtype="<U2").view("<u8") if words else []
        self.head = self.letters[:, :2].copy().view("<u8").reshape(-1)
        self.tail = np.asarray(ends, dtype="<u8").reshape(-1)

    def __len__(self) -> int:
        return len(self.words)


def one_apart(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) <= 1 and a != b and a[at + (len(a) == len(b)) :] == b[at + 1 :]


def verified(one: Words, left: np.ndarray, other: Words, right: np.ndarray) -> np.ndarray:
    """Which pairs (places in both) are one letter apart."""
    gap = other.lengths[right] - one.lengths[left]
    short, long = one.letters[left], other.letters[right]
    turned = (gap < 0)[:, None]
    short, long = np.where(turned, long, short), np.where(turned, short, long)
    differs = short != long
    first = np.argmax(differs, axis=1)
    behind = np.arange(WIDTH - 1) >= first[:, None]
    shifted = ((short[:, : WIDTH - 1] != long[:, 1:]) & behind).any(axis=1)
    found = np.where(gap == 0, differs.sum(axis=1) == 1, (np.abs(gap) == 1) & ~shifted)
    wide = np.maximum(one.lengths[left], other.lengths[right]) > WIDTH
    for i in np.flatnonzero(wide):
        found[i] = one_apart(one.words[left[i]], other.words[right[i]])
    return found


def search(
    members: Words, sought: Words, min_chars: int = 5, cells: int = 1 << 20
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all near words, in ``sought`` and in ``members``, by depth-first search.

    Between words of four letters and more one edit leaves the first or the last two letters alone.
    """
    ends_tell = min_chars >= 4

    def leaf(low: int, high: int, seekers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(cells // max(high - low, 1), 1)
        for start in range(0, len(seekers), step):
            part = seekers[start : start + step]
            if ends_tell:
                same = sought.head[part][:, None] == members.head[None, low:high]
                same |= sought.tail[part][:, None] == members.tail[None, low:high]
                left, right = np.nonzero(same)
                left, right = part[left], right + low
            else:
                left = np.repeat(part, high - low)
                right = np.tile(np.arange(low, high), len(part))
            for at in range(0, len(left), 1 << 16):
                a, b = left[at : at + (1 << 16)], right[at : at + (1 << 16)]
                change = members.vectors[b].astype(np.int16) - sought.vectors[a]
                within = (np.maximum(change, 0).sum(axis=1) <= 1) & (
                    np.maximum(-change, 0).sum(axis=1) <= 1
                )
                a, b = a[within], b[within]
                near = verified(sought, a, members, b)
                yield a[near], b[near]

    everyone = np.arange(len(sought))
    budget = np.ones(len(sought), np.int16)
    stack = [(0, len(members), 0, everyone, budget, budget)] if len(members) and len(sought) else []
    while stack:
        low, high, level, seekers, surplus, deficit = stack.pop()
        if high - low <= LEAF or level == GROUPS:
            yield from leaf(low, high, seekers)
            continue
        column = members.vectors[low:high, level]
        edges = np.flatnonzero(np.diff(column)) + 1
        wanted = sought.vectors[seekers, level].astype(np.int16)
        for a, b in zip([0, *edges], [*edges, high - low]):
            change = int(column[a]) - wanted
            more, less = surplus - np.maximum(change, 0), deficit - np.maximum(-change, 0)
            going = np.flatnonzero((more >= 0) & (less >= 0))
            if len(going):
                stack.append((low + a, low + b, level + 1, seekers[going], more[going], less[going]))


class Best:
    """For words of a task: how many near words were met, the largest count, the least of those."""

    def __init__(self) -> None:
        self.found: dict[str, tuple[int, int, str]] = {}

    def add(self, words: Iterable[str], near: Iterable[str], counts: Iterable[int]) -> None:
        found = self.found
        for word, other, n in zip(words, near, counts):
            seen = found.get(word)
            if seen is None:
                found[word] = (1, n, other)
            elif (-n, other) < (-seen[1], seen[2]):
                found[word] = (seen[0] + 1, n, other)
            else:
                found[word] = (seen[0] + 1, seen[1], seen[2])

    def columns(self) -> dict:
        met, n, near = zip(*self.found.values()) if self.found else ((), (), ())
        return {"word": list(self.found), "met": list(met), "near_n": list(n), "near": list(near)}


def near_words(words: DataFrame, limit: int = 20_000, min_chars: int = 5) -> DataFrame:
    """``word``, ``n_near``, ``near``, ``near_n`` for words (``word``, ``n``) that have near words.

    ``near`` is the near word with the largest count, the least of them in code-point order.
    """
    batch_rows = max(min(limit, 50_000), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place, kept, seekers, members, best = None, [], [], None, Best()
        names = ("node", "share", "part", "kind", "word", "n")

        def sought() -> None:
            """Search what has been gathered of one kind."""
            nonlocal members
            if not seekers:
                return
            if members is None:
                members = Words([r[4] for r in kept], [r[5] for r in kept])
            visitors = Words([r[4] for r in seekers], [r[5] for r in seekers])
            mutual = seekers[0][3] == 2
            for a, b in search(members, visitors, min_chars):
                mine, theirs = visitors.words[a].tolist(), members.words[b].tolist()
                best.add(mine, theirs, members.counts[b].tolist())
                if mutual:
                    best.add(theirs, mine, visitors.counts[a].tolist())
            seekers.clear()

        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in names)):
                if row[:3] != place:
                    sought()
                    place, members = row[:3], None
                    kept.clear()
                if row[3] == 0:
                    kept.append(row)
                    continue
                if seekers and (seekers[0][3] != row[3] or len(seekers) >= batch_rows):
                    sought()
                seekers.append(row)
                if len(best.found) >= HELD_WORDS:
                    yield best.columns()
                    best = Best()
        sought()
        yield best.columns()

    met = map_batches(
        placed(words, limit)
        .repartition("node", "share", "part")
        .sortWithinPartitions("node", "share", "part", "kind", "word"),
        run,
        "word string, met long, near_n long, near string",
    )
    first = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    return (
        met.groupBy("word")
        .agg(F.sum("met").alias("n_near"), first.alias("first"))
        .select("word", "n_near", "first.near", (-F.col("first.order")).alias("near_n"))
    )


# --- forms and roots ------------------------------------------------------------------------


def roots_of(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for every word of ``forms(word, form)``: the last form that is reached."""
    links = written(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(links.join(onward, "root", "left").select("word", "root", "next"))
        links = stepped.select("word", F.coalesce("next", "root").alias("root"))
        if stepped.where("next IS NOT NULL").isEmpty():
            return links


def spelling_variants(
    words: DataFrame, ratio: int = 2, limit: int = 20_000, min_chars: int = 5
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for all words (``word``, ``n``)."""
    words = written(words.select("word", "n"))
    near = written(near_words(words, limit, min_chars))
    chosen = F.col("near_n") >= ratio * F.col("n")
    judged = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(chosen, F.col("near")).alias("form"),
            F.when(chosen, F.col("near_n")).alias("form_n"),
        )
    )
    roots = roots_of(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
