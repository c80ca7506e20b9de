"""Connected components of a graph of links, in rounds that each end in a checkpoint."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.durable import durable
from tidemark.session import ship


#: Links of forests that one task may join: some tens of megabytes.
ONE_TASK = 500_000


def _forest(batches):
    """The links of a task as links from each node to the smallest of its piece."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    for at in range(0, len(nodes), 100_000):
        part = nodes[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(map(find, part), pa.int64(), size=len(part))], names=["u", "v"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, one_task: int = ONE_TASK) -> DataFrame:
    """node and component (the smallest node that it reaches) of every node of a link; numbers that no link holds are absent.

    Tasks first shrink their own links to forests. Then large-star and small-star steps alternate (each node's larger
    neighbours, then its smaller ones, are linked to the smallest) until nothing changes, in a number of rounds that grows
    with the logarithm of the longest path. A node's neighbours are never gathered: every step is a minimum for each
    node and a join, and the minimum is combined before it moves. Null ends and links of a node to itself say nothing.
    """
    ship(links.sparkSession)
    ends = links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v")
    now = durable(ends.mapInArrow(_forest, "u long, v long").where("u <> v").distinct())
    state = None
    if now.limit(one_task + 1).count() <= one_task:
        now, rounds = durable(now.coalesce(1).mapInArrow(_forest, "u long, v long")), 0
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = durable(small.distinct())
        old, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == old or not state[0]:
            break
    else:
        if rounds:
            raise RuntimeError("the components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
