"""Connected components of links, by union-find in tasks and star rounds between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.scratch import Scratch
from folium.llm.tasks import frugal

#: Links that one union-find takes at most.
FOREST = 500_000


class UnionFind:
    """Sets of hashable nodes; the least node of a set is its root."""

    def __init__(self):
        self.above: dict = {}

    def find(self, x):
        above = self.above
        root = x
        while (up := above.get(root, root)) != root:
            root = up
        while (up := above.get(x, x)) != root:
            above[x] = root
            x = up
        return root

    def union(self, a, b) -> bool:
        """Whether the two were in different sets until now."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars around roots: one link a node at most."""

    def stars(sets: UnionFind) -> pa.RecordBatch:
        nodes = [x for x in sets.above if sets.find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(list(map(sets.find, nodes)), pa.binary())], ["u", "v"])

    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.union(a, b)
        if len(sets.above) > FOREST:
            yield stars(sets)
            sets = UnionFind()
    yield stars(sets)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes that links (two binary columns) touch; the root is the component's least node.

    In each round a union-find joins what the links of the same nodes hang on; then, unless all components are
    stars by now, every node's larger neighbours are hung on its least one. Null nodes and links of a node with
    itself count for nothing. Each round hangs nodes on smaller ones, so it ends.
    """
    u, v = links.columns
    kind = "u binary, v binary"
    own = Scratch(links.sparkSession)
    edges, before = links.filter(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).mapInArrow(frugal(_forest), kind), None
    least = None
    while True:
        edges = own.stored(edges.repartition("u").sortWithinPartitions("u").mapInArrow(frugal(_forest), kind))
        if before is not None:
            own.drop(before)
        before = edges
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(edges.select("v", F.lit(0), F.lit(1)))
        open_ends = ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high")).filter("low > 1 or low = 1 and high = 1")
        if not open_ends.limit(1).count():
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if least is not None:
            own.drop(least)
        # a table of its own, so that Spark can split the links of a hub
        least = own.stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        edges = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).mapInArrow(frugal(_forest), kind)
    roots = edges.select(F.col("v").alias("node")).distinct()
    with own:
        return own.keep(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root"))))
