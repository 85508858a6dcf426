"""Connected components by alternating large and small stars; every step is a join and an aggregate."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.llm.common import gathered, ship, store

# Edges that a task ties together before it hands its stars on.
FLUSH_EDGES = 250_000


class Forest:
    """Which nodes are tied together by the edges that a task has seen; the root is the smallest of them."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        up = self.up
        while (above := up.get(node, node)) != node:
            up[node] = node = up.get(above, above)
        return node

    def tie(self, a: int, b: int) -> bool:
        """Whether this ties what was apart."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that tie the same nodes: stars around the smallest node that a node is tied to by the task's edges."""

    def stars() -> pa.RecordBatch:
        nodes = list(forest.up)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([forest.root(node) for node in nodes], pa.int64())], ["u", "v"]
        )

    forest, waiting = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.tie(a, b)
        waiting += batch.num_rows
        if waiting >= FLUSH_EDGES:
            yield stars()
            forest, waiting = Forest(), 0
    yield stars()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them: a row for each row of ``edges``, the
    node's own in place of that of its smallest neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u"))
    return down.join(least, "u").select(moved.alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for every node that has an edge to another.

    ``edges`` has two long columns u and v. The number of rounds grows with the logarithm of the number of
    nodes; each star is written to the shared folder, so that lineage and the plans that the driver holds stay short.
    What meets in a task is tied together there, before the first round and at the end of each.
    """
    ship(edges.sparkSession)

    def tied(found: DataFrame) -> DataFrame:
        return store(gathered(found.select("u", "v")).mapInArrow(_tied, "u long, v long"), "components")

    current = tied(edges.where("u <> v"))
    while True:
        # Done when all are stars around their smallest node: no node points to two, and no centre points on.
        ends = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.lit(None).cast("long")))
        told = ends.groupBy("u").agg(
            F.min("v").alias("least"), F.max("v").alias("most"), F.count_if(F.col("v").isNull()).alias("centre")
        )
        if not told.where("least <> most or (least is not null and centre > 0)").limit(1).count():
            break
        current = tied(_small_star(store(gathered(_large_star(current)), "components")))
    # Several tasks may have told the same edge.
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
