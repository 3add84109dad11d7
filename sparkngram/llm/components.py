"""Connected components by union-find inside tasks and star contraction across them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import cut


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each node with its root
    (the least node); holds one entry per node of the partition's links."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                up[max(u, v)] = min(u, v)
    nodes = [x for x in up if root(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i:i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([up[x] for x in part], pa.int64())], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns):
    the least node reachable.  Links between a node and itself or a null add
    nothing.  Each round contracts stars; the number of rounds is logarithmic
    in practice, each round reads and writes links only."""
    a, b = links.columns[:2]
    pair = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    # links to the greater end first, so that a task sees whole stars
    edges = cut(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
                .mapInArrow(_forest, "u long, v long").distinct())
    while True:
        # every node's neighbours beyond it go to its least neighbour ...
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # ... and those before it, itself included, to the least of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        after = cut(small)
        # done once every node has one link, to a node that has none
        several = after.groupBy("u").count().where("count > 1").limit(1).count()
        chained = after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count() if not several else 1
        edges = after
        if not several and not chained:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
