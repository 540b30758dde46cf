"""Connected components of a graph given as links, by repeated joins with checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.relational import group_table
from creditloom.session import written


def components(links: DataFrame, most_links: int | None = None) -> DataFrame:
    """``node``, ``root`` for every node of ``links(a, b)``; the root is the smallest node reachable.

    Each round hangs the larger neighbours of every node on its smallest neighbour, then the node and
    its smaller neighbours on the smallest of those; both keep components and shorten paths, and
    when nothing changes the links form stars. Rounds grow with the logarithm of path lengths. A
    round's links are written to the shared folder, so a lost executor costs one round at most.
    Null ends and loops are ignored; nodes without links do not appear. No round has more links than
    the one before, so few links stay in few files; ``most_links`` bounds those of the first, if known.
    """
    edges = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct(),
        most_links,
    )
    state = _state(edges)
    while state is not None and state[0]:
        edges = written(_small_star(_large_star(edges)), state[0])
        known, state = state, _state(edges)
        if known == state:
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number and content sums of the links: equal once a round changes nothing."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("u", "v")),
            F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    least = group_table(both, ["u"], {"m": F.least(F.min("v"), F.col("u"))})
    return (
        both.join(least, "u")
        .where("v > u")
        .select("v", F.col("m").alias("u"))
        .where("v <> u")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have the larger node in ``v``."""
    least = group_table(edges, ["v"], {"m": F.min("u")})
    moved = edges.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    kept = least.select("v", F.col("m").alias("u"))
    return moved.unionByName(kept).distinct()
