"""Connected components of a link table, distributed.

Each partition first contracts its links by union-find, which leaves a forest of at most one
link per node.  Alternating large-star and small-star rounds (groups by minimum, joined back,
so that a node with very many links is never gathered in one task) then turn the forests
into stars, whose centres are the smallest nodes.  Every round is a written table.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import discard, ship, written


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's links (a, b): each node but the roots, with its root as b."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, top)
        return top

    def flushed() -> pa.RecordBatch:
        pairs = [(x, root(x)) for x in list(parent)]
        pairs = [(x, r) for x, r in pairs if x != r]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((root(a), root(b)))
            if low != high:
                parent[high] = low
        if len(parent) > 500_000:  # bounded memory: the links so far go out as stars
            yield flushed()
            parent.clear()
    yield flushed()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star round over links (a > b)."""
    if large:
        sides = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # neighbours above a node go to the least of its neighbourhood
        above = links.select(F.col("b").alias("a"), F.col("a").alias("v"))
        out = above.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        out = (links.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of every node of ``links`` (a, b: long) that isn't the smallest of its component.

    Null ends and links of a node to itself are left out; an empty table gives an empty one.
    """
    ship(links.sparkSession)
    pairs = links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(pairs.mapInArrow(contracted, "a long, b long").distinct())
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        after = written(_star(_star(now, True), False))
        discard(now)
        now = after
