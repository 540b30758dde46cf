"""Quality rules: statistics of a document, fixed base rules, and boosted trees over the rest.

The statistics of every whole text are computed in one pass. Gradient-boosted trees are fitted on a
bounded sample of labelled rows: histogram splits, logistic loss, and for chosen statistics a
monotonic constraint (more symbols never raise the score). The trees are flattened into arrays of
nodes, on which all rows of a batch go down together.

Defined results: a null, empty or blank text has no words and fails the base rules; ties and
repeated rows are scored each; without labelled rows of both kinds there are no trees, and the base
rules decide alone; labels that are null are not learned from. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import record_batch, texts_of
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SYMBOLS = re.compile(r"[#*$%&|<>]")
BLANK_TRANSLATION = str.maketrans("\t\n\x0b\x0c\r", "     ")

#: Statistics that are returned, and those the trees look at with the direction in which the
#: score may move when they grow (0: either).
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbols_per_char": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "lone_symbol_words": -1,
    "exclamation_words": -1,
    "distinct_share": 1,
    "stop_end_lines": 0,
    "words_per_line": 0,
    "longest_run": -1,
}


def words_of(text: str) -> list[str]:
    return [w for w in text.translate(BLANK_TRANSLATION).split(" ") if w]


def repeated_words(words: list[str], window: int = 3) -> int:
    """Words in windows that occur twice or more in the text, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter(
        (number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words)
    )
    codes = ids[:n]
    for k in range(1, window):
        # numbering the windows so far keeps the products small
        _, codes = np.unique(codes * len(number) + ids[k : n + k], return_inverse=True)
    often = np.bincount(codes)[codes] > 1
    inside = np.zeros(len(words), dtype=bool)
    for k in range(window):
        inside[k : n + k] |= often
    return int(inside.sum())


def statistics_of(text: str) -> tuple[list[int], list[float]]:
    """``COUNTS`` and ``FEATURES`` of a whole text."""
    words = words_of(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = len(SYMBOLS.findall(text))
    seen: set[str] = set()
    duplicates = lines = ended = 0
    for line in text.split("\n"):
        bare = line.strip(" \t\n\x0b\x0c\r")
        if bare:
            lines += 1
            ended += bare[-1] in ".!?"
            duplicates += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    digits = sum(1 for w in words if w[0].isdigit())
    lone = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    marked = sum(1 for w in words if w.endswith("!!"))
    same = sum(1 for a, b in zip(words, words[1:]) if a == b)
    per_word = 1.0 / max(n, 1)
    features = [
        float(np.log1p(n)),
        chars * per_word,
        symbols / max(len(text), 1),
        duplicates / max(lines, 1),
        repeats * per_word,
        upper * per_word,
        digits * per_word,
        lone * per_word,
        marked * per_word,
        len(set(words)) * per_word,
        ended / max(lines, 1),
        n / max(lines, 1),
        same * per_word,
    ]
    return [n, chars, symbols, duplicates, repeats], features


def with_statistics(
    docs: DataFrame, keys: list[str], text: str = "text", trees: Trees | None = None
) -> DataFrame:
    """``keys`` of every row with ``COUNTS`` as longs and ``features`` as an array.

    Given trees, their ``score`` comes in place of the features. It is found in the same Python call:
    a second one in a row would hold another worker for each task.
    """
    narrow = docs.select(*keys, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics_of(value) for value in texts_of(batch.column("__text"))]
            columns = {name: batch.column(name) for name in keys}
            for k, name in enumerate(COUNTS):
                columns[name] = [counts[k] for counts, _ in found]
            features = [features for _, features in found]
            if trees is None:
                columns["features"] = features
            else:
                columns["score"] = score(trees, np.array(features).reshape(-1, len(FEATURES)))
            yield record_batch(columns, arrow)

    last = (
        T.StructField("features", T.ArrayType(T.DoubleType()))
        if trees is None
        else T.StructField("score", T.DoubleType())
    )
    schema = T.StructType(
        [narrow.schema[name] for name in keys]
        + [T.StructField(name, T.LongType()) for name in COUNTS]
        + [last]
    )
    arrow = to_arrow_schema(schema)
    return narrow.mapInArrow(run, schema)


# --- boosted trees --------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in arrays; a leaf is its own child and adds its value."""

    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float


def score(trees: Trees, features: np.ndarray) -> np.ndarray:
    """Probability of the label 1 for each row."""
    rows = np.arange(len(features))[:, None]
    at = np.broadcast_to(trees.roots, (len(features), len(trees.roots))).copy()
    for _ in range(trees.depth):
        under = features[rows, trees.feature[at]] <= trees.threshold[at]
        at = np.where(under, trees.below[at], trees.above[at])
    return 1.0 / (1.0 + np.exp(-(trees.base + trees.value[at].sum(axis=1))))


def fit(
    features: np.ndarray,
    labels: np.ndarray,
    directions: np.ndarray,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    min_rows: int = 5,
    penalty: float = 1.0,
) -> Trees:
    """Boosted trees for 0/1 labels; ``directions`` has the monotonic constraint of each feature.

    A constrained split is only taken if its sides' values are in the right order, and the middle
    between them bounds what lies below either side.
    """
    n, width = features.shape
    cuts = [
        np.unique(np.quantile(features[:, j], np.linspace(0, 1, bins + 1)[1:-1]))
        for j in range(width)
    ]
    binned = np.stack([np.searchsorted(c, features[:, j]) for j, c in enumerate(cuts)], axis=1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    raw = np.full(n, base)
    nodes: list[list[float]] = []  # feature, threshold, below, above, value
    roots = []

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows], weight[rows]
        worth = lambda a, b: np.clip(-a / (b + penalty), low, high)
        total_g, total_h = g.sum(), h.sum()
        own = float(worth(total_g, total_h))
        me = len(nodes)
        nodes.append([0, np.inf, me, me, own * rate])
        best = None
        if level < depth and len(rows) >= 2 * min_rows:
            for j in range(width):
                size = len(cuts[j]) + 1
                if size < 2:
                    continue
                left_g = np.cumsum(np.bincount(binned[rows, j], g, size))[:-1]
                left_h = np.cumsum(np.bincount(binned[rows, j], h, size))[:-1]
                left_n = np.cumsum(np.bincount(binned[rows, j], minlength=size))[:-1]
                right_g, right_h = total_g - left_g, total_h - left_h
                a, b = worth(left_g, left_h), worth(right_g, right_h)
                gain = -(left_g * a + (left_h + penalty) * a * a / 2) - (
                    right_g * b + (right_h + penalty) * b * b / 2
                )
                allowed = (left_n >= min_rows) & (len(rows) - left_n >= min_rows)
                if directions[j]:
                    allowed &= (b - a) * directions[j] >= 0
                gain = np.where(allowed, gain, -np.inf)
                k = int(np.argmax(gain))
                if best is None or gain[k] > best[0]:
                    best = (gain[k], j, k, a[k], b[k])
        floor = -(total_g * own + (total_h + penalty) * own * own / 2)
        if best is None or best[0] <= floor + 1e-6:
            raw[rows] += own * rate
            return me
        _, j, k, a, b = best
        bounds = [(low, high), (low, high)]
        if directions[j]:
            middle = (a + b) / 2
            bounds = [(low, middle), (middle, high)]
            if directions[j] < 0:
                bounds = [(middle, high), (low, middle)]
        under = binned[rows, j] <= k
        below = grow(rows[under], level + 1, *bounds[0])
        above = grow(rows[~under], level + 1, *bounds[1])
        nodes[me] = [j, cuts[j][k], below, above, 0.0]
        return me

    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-raw))
        gradient, weight = p - labels, np.maximum(p * (1 - p), 1e-6)
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    table = np.array(nodes, dtype=np.float64).reshape(-1, 5)
    whole = table[:, [0, 2, 3]].astype(np.int64)
    return Trees(
        whole[:, 0],
        table[:, 1],
        whole[:, 1],
        whole[:, 2],
        table[:, 4],
        np.array(roots, dtype=np.int64),
        depth,
        base,
    )


def no_trees() -> Trees:
    """A model that accepts everything."""
    return Trees(
        np.zeros(1, dtype=np.int64),
        np.full(1, np.inf),
        np.zeros(1, dtype=np.int64),
        np.zeros(1, dtype=np.int64),
        np.zeros(1),
        np.zeros(1, dtype=np.int64),
        0,
        20.0,
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, doc_id: str, text: str
) -> DataFrame:
    """Up to ``max_rows`` labelled rows, ``text`` and ``label``; the same ones on each run.

    Rows come in the order of a hash of id and text. Only ids and hashes are sorted; the texts of the
    chosen ids are fetched afterwards.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").alias("__id")).agg(
        F.max(label).cast("int").alias("label")
    )
    chosen = known.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(max_rows)
    named = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("text"))
    return named.join(F.broadcast(chosen), "__id")


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 8000,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    **parameters,
) -> Trees:
    """Trees fitted on a bounded sample of at most ``max_rows`` labelled ids."""
    sample = labelled_sample(docs, labels, label, max_rows, doc_id, text)
    rows = (
        with_statistics(sample, ["__id", "label"], "text")
        .select("__id", "label", "features")
        .orderBy("__id", F.xxhash64("features"))
        .limit(2 * max_rows)
        .collect()
    )
    truth = np.array([r.label for r in rows], dtype=np.float64)
    if len(np.unique(truth)) < 2:
        return no_trees()
    features = np.array([r.features for r in rows], dtype=np.float64)
    return fit(features, truth, np.array(list(FEATURES.values())), **parameters)


def judged(
    docs: DataFrame,
    trees: Trees,
    threshold: float = 0.5,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """``keys`` of every row, ``COUNTS``, ``base_failed``, ``score`` and ``kept``."""
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return (
        with_statistics(docs, list(keys), text, trees)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )
