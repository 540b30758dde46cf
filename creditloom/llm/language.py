"""Language identification by compression.

For each language a zstandard dictionary of raw content is made from lower-cased texts of it. A
lower-cased text is compressed with each dictionary, in chunks that cover all of it, and the language
that gives the fewest bytes is predicted. The margin to the next decides whether it is accepted.
A short text alone does not compress, so it is compressed behind a context of the language, whose
own size is subtracted.

Fitting is bounded: ``documents`` texts of each language, ``piece_chars`` characters of each, from a
place in the text that its hash chooses. The number of languages is that of the labels.

Defined results: a null text and one without a letter is ``und`` with score 0; equal sizes go to the
language that comes first by code point; with one language every text with a letter is that language,
with none it is ``und``; repeated rows agree. Only the text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.common import record_batch

UNDETERMINED = "und"


def dictionaries(
    docs: DataFrame,
    documents: int = 100,
    piece_chars: int = 1200,
    lang: str = "lang",
    text: str = "text",
) -> dict[str, bytes]:
    """Raw dictionary content of each non-null language in ``docs``, in lower case."""
    content = F.col(text).cast("string")
    order = F.xxhash64(content)
    slack = F.greatest(F.length(content) - piece_chars, F.lit(0)) + 1
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"),
        order.alias("order"),
        F.substring(content, F.pmod(order, slack).cast("int") + 1, F.lit(piece_chars)).alias("piece"),
    )
    first = Window.partitionBy("lang").orderBy("order", "piece")
    # copies of a text would use up the places of other texts
    rows = (
        labelled.distinct()
        .withColumn("k", F.row_number().over(first))
        .where(F.col("k") <= documents)
        .collect()
    )
    pieces: dict[str, set[str]] = {}
    for row in rows:
        pieces.setdefault(row.lang, set()).add(row.piece)
    return {name: "\n".join(sorted(found)).lower().encode() for name, found in sorted(pieces.items())}


class Compressors:
    """Compressed sizes of texts with the dictionary of each language."""

    def __init__(
        self, contents: dict[str, bytes], level: int, chunk_bytes: int, context_bytes: int
    ) -> None:
        self.names, self.chunk_bytes, self.context_bytes = list(contents), chunk_bytes, context_bytes
        settings = zstandard.ZstdCompressionParameters.from_level(
            level, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        self.compressors, self.contexts, self.bases = [], [], []
        for content in contents.values():
            # the context is no part of the dictionary, or it would cost nothing as a whole
            context, rest = content[:context_bytes], content[context_bytes:] or content
            raw = zstandard.ZstdCompressionDict(rest, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level)
            compressor = zstandard.ZstdCompressor(dict_data=raw, compression_params=settings)
            self.compressors.append(compressor)
            self.contexts.append(context + b"\n")
            self.bases.append(len(compressor.compress(context + b"\n")))

    def sizes(self, text: str) -> list[int]:
        data, step = text.lower().encode(), self.chunk_bytes
        if len(data) < self.context_bytes:
            return [
                max(len(c.compress(context + data)) - base, 0)
                for c, context, base in zip(self.compressors, self.contexts, self.bases)
            ]
        chunks = [data[at : at + step] for at in range(0, len(data), step)]
        return [sum(len(c.compress(chunk)) for chunk in chunks) for c in self.compressors]


def verdict(names: list[str], sizes: list[int], softness: float) -> tuple[str, float, float]:
    """Best language, score from 0 to 1, and margin to the next as a share of the next's size.

    The score is the weight of the best among all when each byte more divides a language's weight
    by ``exp(1 / softness)``.
    """
    order = np.argsort(np.array(sizes), kind="stable")
    best = sizes[order[0]]
    score = 1.0 / np.exp(-(np.array(sizes, dtype=np.float64) - best) / softness).sum()
    margin = 1.0 if len(sizes) == 1 else 1.0 - best / max(sizes[order[1]], 1)
    return names[order[0]], float(score), float(margin)


def predicted(
    docs: DataFrame,
    contents: dict[str, bytes],
    min_margin: float = 0.02,
    level: int = 6,
    chunk_bytes: int = 4096,
    context_bytes: int = 1024,
    softness: float = 4.0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score``, ``margin``, ``accepted``.

    ``accepted`` is false where the margin is below ``min_margin``: the prediction is then a guess.
    """
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            narrow.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("margin", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Compressors(shared.value, level, chunk_bytes, context_bytes)
        for batch in batches:
            found = []
            for value in batch.column("text").to_pylist():
                if value and tools.names and any(map(str.isalpha, value)):
                    found.append(verdict(tools.names, tools.sizes(value), softness))
                else:
                    found.append((UNDETERMINED, 0.0, 0.0))
            names, scores, margins = zip(*found) if found else ((), (), ())
            yield record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": list(names),
                    "score": list(scores),
                    "margin": list(margins),
                    "accepted": [m >= min_margin for m in margins],
                },
                arrow,
            )

    return narrow.mapInArrow(run, schema)
