"""Connected components of a link table.

Up to ``local_links`` links (a counted bound of 16 bytes each) are joined by union-find in one task.
Larger tables are contracted by alternating large-star and small-star steps (each two shuffles, no
neighbour lists), which shrink every component to a star around its smallest node; the number of
steps grows with the logarithm of the component size. Both give the same labels.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.session import ensure_checkpoint_dir


def _union_find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    above: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while (up := above.setdefault(root, root)) != root:
            root = up
        while above[x] != root:
            above[x], x = root, above[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = top(u), top(v)
            if u != v:
                above[max(u, v)] = min(u, v)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], names=["node", "label"])


def connected_components(links: DataFrame, max_steps: int = 60, local_links: int = 1_000_000) -> DataFrame:
    """node, label (the smallest node of its component) for all nodes of ``links`` (a, b: long).
    Lineage is cut by checkpoint()."""
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    if edges.count() <= local_links:
        return edges.coalesce(1).mapInArrow(_union_find, "node long, label long").checkpoint()
    state = None
    for _ in range(max_steps):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionAll(down.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not converge in {max_steps} steps")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        edges.select(F.col("v"), F.col("v")).distinct())
