"""Connected components of an edge table, without collecting anything to the driver.

Rounds of large-star and small-star (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014) over a DataFrame.  Before the rounds every partition replaces its edges with the
forest of its own union-find, which bounds the edge count by the node count of the partition and
shortens long chains.  Each round ends in a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

EDGE = "u long, v long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    pairs = [(find(x), x) for x in parent]
    pairs = [p for p in pairs if p[0] != p[1]]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["u", "v"]
    )


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star; edges are (u, v) with u < v before and after."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = (
        both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
    )
    low2 = large.groupBy("v").agg(F.min("u").alias("m"))
    joined = large.join(low2, "v")
    small = joined.select(F.col("m").alias("u"), "v").unionByName(
        joined.select(F.col("m").alias("u"), F.col("u").alias("v"))
    )
    return small.where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge; ``component`` is the smallest node id.

    Self-loops and repeated edges are allowed, edges with a null end are ignored.  Nodes without
    an edge do not appear.  An empty edge table gives an empty result.
    """
    pairs = edges.select(
        F.least(src, dst).cast("long").alias("u"), F.greatest(src, dst).cast("long").alias("v")
    ).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    loops = pairs.where("u = v").select(F.col("u").alias("node"))
    current = checkpoint(pairs.where("u <> v").mapInArrow(_forest, EDGE).distinct())
    state = _fingerprint(current)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        following = checkpoint(_round(current))
        after = _fingerprint(following)
        if after == state:
            break
        current, state = following, after
    else:
        raise RuntimeError("components did not settle")
    members = current.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = current.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    found = members.unionByName(roots)
    lone = loops.distinct().join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.unionByName(lone)


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("h"),
    ).first()
    return int(row["n"]), int(row["h"])
