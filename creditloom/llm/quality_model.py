"""A quality classifier on bytes: a small convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters run over
byte embeddings inside each chunk; each filter's largest response is the chunk's feature. Largest,
mean and smallest feature over the chunks go through one hidden layer to one probability.

The network is fitted here, with Adam, on a bounded sample of labelled rows. Gradients only pass
through the windows that gave the maxima.

Defined results: a null or empty text is one chunk of padding and gets a score, too; repeated rows
score alike; without labelled rows of both kinds every score is the share of label 1 (or 0.5
without any); null labels are not learned from. Only the text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.common import record_batch
from creditloom.llm.quality_rules import labelled_sample

CHUNK, OVERLAP, WINDOW, STRIDE = 1024, 64, 8, 2
SPOTS = (CHUNK - WINDOW) // STRIDE + 1
Weights = dict[str, np.ndarray]


def chunks_of(data: bytes) -> np.ndarray:
    """The chunks of a text as rows of bytes; the last one is padded with zeros."""
    step = CHUNK - OVERLAP
    number = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.zeros((number - 1) * step + CHUNK, dtype=np.uint8)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def initial(seed: int, filters: int, width: int, hidden: int) -> Weights:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    return {
        "embed": draw(256, width) * 0.5,
        "filter": draw(WINDOW * width, filters) / np.float32(np.sqrt(WINDOW * width)),
        "shift": np.zeros(filters, dtype=np.float32),
        "inner": draw(3 * filters, hidden) / np.float32(np.sqrt(3 * filters)),
        "inner_shift": np.zeros(hidden, dtype=np.float32),
        "outer": draw(hidden) / np.float32(np.sqrt(hidden)),
        "outer_shift": np.zeros(1, dtype=np.float32),
    }


def windows(weights: Weights, chunks: np.ndarray) -> np.ndarray:
    """Embedded windows of chunks as rows of one matrix."""
    embedded = weights["embed"][chunks].reshape(len(chunks), -1)
    width = weights["embed"].shape[1]
    slid = np.lib.stride_tricks.sliding_window_view(embedded, WINDOW * width, axis=1)
    return np.ascontiguousarray(slid[:, :: STRIDE * width]).reshape(-1, WINDOW * width)


def chunk_features(weights: Weights, chunks: np.ndarray, at_once: int = 128) -> np.ndarray:
    """The largest response of each filter in each chunk (the ReLU comes after the maximum)."""
    parts = []
    for at in range(0, len(chunks), at_once):
        part = chunks[at : at + at_once]
        response = windows(weights, part) @ weights["filter"]
        parts.append(response.reshape(len(part), SPOTS, -1).max(axis=1))
    return np.maximum(np.concatenate(parts) + weights["shift"], 0)


def combined(weights: Weights, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Probability for each text, given the features of its chunks from ``starts`` on."""
    return 1 / (1 + np.exp(-_forward(weights, features, starts)[-1].astype(np.float64)))


def _forward(weights: Weights, features: np.ndarray, starts: np.ndarray) -> tuple:
    sizes = np.diff(np.append(starts, len(features)))
    pooled = np.concatenate(
        [
            np.maximum.reduceat(features, starts, axis=0),
            np.add.reduceat(features, starts, axis=0) / sizes[:, None].astype(np.float32),
            np.minimum.reduceat(features, starts, axis=0),
        ],
        axis=1,
    )
    hidden = np.maximum(pooled @ weights["inner"] + weights["inner_shift"], 0)
    return sizes, pooled, hidden, hidden @ weights["outer"] + weights["outer_shift"]


def gradients(weights: Weights, texts: list[np.ndarray], truth: np.ndarray) -> Weights:
    """Gradients of the mean logistic loss over a few texts, given as chunks."""
    chunks = np.concatenate(texts)
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
    view = windows(weights, chunks)
    response = (view @ weights["filter"]).reshape(len(chunks), SPOTS, -1)
    peak = response.argmax(axis=1)
    top = np.take_along_axis(response, peak[:, None, :], axis=1)[:, 0, :] + weights["shift"]
    features = np.maximum(top, 0)
    sizes, pooled, hidden, logit = _forward(weights, features, starts)
    error = ((1 / (1 + np.exp(-logit)) - truth) / len(truth)).astype(np.float32)
    back_hidden = np.outer(error, weights["outer"]) * (hidden > 0)
    back_pooled = back_hidden @ weights["inner"].T
    filters = features.shape[1]
    owner = np.repeat(np.arange(len(texts)), sizes)
    most, mean, least = (back_pooled[:, k * filters : (k + 1) * filters] for k in range(3))
    back = (mean / sizes[:, None])[owner]
    back += (features == pooled[owner, :filters]) * most[owner]
    back += (features == pooled[owner, 2 * filters :]) * least[owner]
    back = (back * (top > 0)).astype(np.float32)
    # only the window of the maximum passes a gradient on
    rows = np.arange(len(chunks))[:, None] * SPOTS + peak
    seen = view[rows]  # chunk, filter, window * width
    back_filter = np.einsum("cf,cfk->kf", back, seen)
    width = weights["embed"].shape[1]
    back_window = (back[:, :, None] * weights["filter"].T[None]).reshape(-1, width)
    places = (peak * STRIDE)[:, :, None] + np.arange(WINDOW)
    letters = chunks[np.arange(len(chunks))[:, None, None], places].ravel()
    back_embed = np.stack(
        [np.bincount(letters, back_window[:, j], 256) for j in range(width)], axis=1
    )
    return {
        "embed": back_embed.astype(np.float32),
        "filter": back_filter,
        "shift": back.sum(axis=0),
        "inner": pooled.T @ back_hidden,
        "inner_shift": back_hidden.sum(axis=0),
        "outer": hidden.T @ error,
        "outer_shift": error.sum(keepdims=True),
    }


def fit(
    texts: list[str],
    labels: list[int],
    steps: int = 1500,
    batch: int = 32,
    filters: int = 32,
    width: int = 4,
    hidden: int = 16,
    rate: float = 0.01,
    decay: float = 1e-4,
    seed: int = 7,
) -> Weights:
    """Weights after a fixed number of Adam steps; each batch has both labels in equal parts.

    The shift of the last layer is then moved so that the mean probability over the sample is the
    share of label 1.
    """
    rng = np.random.default_rng(seed)
    truth = np.array(labels, dtype=np.float32)
    weights = initial(seed, filters, width, hidden)
    kinds = [np.flatnonzero(truth == k) for k in (0, 1)]
    if not all(map(len, kinds)):
        share = float(truth.mean()) if len(truth) else 0.5
        weights["outer"][:] = 0
        weights["outer_shift"][:] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return weights
    data = [chunks_of(text.encode()) for text in texts]
    first = {k: np.zeros_like(w) for k, w in weights.items()}
    second = {k: np.zeros_like(w) for k, w in weights.items()}
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(kind, batch // 2) for kind in kinds])
        found = gradients(weights, [data[i] for i in chosen], truth[chosen])
        slower = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
        for k, g in found.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            weights[k] = weights[k] - (slower * (move + decay * weights[k])).astype(np.float32)
    _calibrate(weights, data, truth)
    return weights


def _calibrate(weights: Weights, data: list[np.ndarray], truth: np.ndarray) -> None:
    starts = np.cumsum([0] + [len(d) for d in data[:-1]])
    logits = _forward(weights, chunk_features(weights, np.concatenate(data)), starts)[-1]
    low, high = -20.0, 20.0
    for _ in range(40):
        middle = (low + high) / 2
        mean = float((1 / (1 + np.exp(-(logits.astype(np.float64) + middle)))).mean())
        low, high = (middle, high) if mean < truth.mean() else (low, middle)
    weights["outer_shift"] = weights["outer_shift"] + np.float32((low + high) / 2)


def probabilities(weights: Weights, texts: list[str], at_once: int = 256) -> np.ndarray:
    """Probability of label 1 for whole texts; a bounded number of chunks is worked on at a time."""
    answers, waiting, starts, number = [], [], [], 0
    for k, text in enumerate(texts):
        chunks = chunks_of(text.encode())
        waiting.append(chunks)
        starts.append(number)
        number += len(chunks)
        if number >= at_once or k + 1 == len(texts):
            features = np.concatenate([chunk_features(weights, w) for w in _joined(waiting)])
            answers.append(combined(weights, features, np.array(starts)))
            waiting, starts, number = [], [], 0
    return np.concatenate(answers) if answers else np.empty(0)


def _joined(parts: list[np.ndarray], at_once: int = 128) -> Iterator[np.ndarray]:
    """Chunks of several texts together, some at a time."""
    held: list[np.ndarray] = []
    size = 0
    for part in parts:
        for at in range(0, len(part), at_once):
            piece = part[at : at + at_once]
            held.append(piece)
            size += len(piece)
            if size >= at_once:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 3000,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    **parameters,
) -> Weights:
    """Weights fitted on a bounded sample of at most ``max_rows`` labelled ids."""
    sample = labelled_sample(docs, labels, label, max_rows, doc_id, text)
    rows = sample.orderBy("__id", F.xxhash64("text")).limit(2 * max_rows).collect()
    return fit([r.text or "" for r in rows], [r.label for r in rows], **parameters)


def scored(docs: DataFrame, weights: Weights, doc_id: str = "doc_id", text: str = "text"):
    """``doc_id`` and ``score`` of every row."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = probabilities(weights, texts)
            yield record_batch({"doc_id": batch.column("doc_id"), "score": found}, arrow)

    return narrow.mapInArrow(run, schema)
