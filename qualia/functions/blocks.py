"""Packing of aggregate expressions into blocks that stay whole-stage code-generated.

Spark turns whole-stage code generation off for a plan wider than
``spark.sql.codegen.maxFields`` (output columns plus aggregation buffer slots); one wide
aggregation over that limit runs interpreted, several times slower. Operators pack their
per-column or per-rule aggregate expressions into consecutive blocks whose summed field
cost stays within the session's limit; on columnar sources each block reads only its own
columns, so the blocks do not multiply I/O.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")

# Fields every block carries besides its items (the row count and its buffer slot).
BLOCK_OVERHEAD = 2


def codegen_field_limit(spark: SparkSession) -> int:
    """``spark.sql.codegen.maxFields`` (at least 20; 100 when unreadable)."""
    try:
        return max(20, int(spark.conf.get("spark.sql.codegen.maxFields", "100")))
    except (TypeError, ValueError):
        return 100


def pack(items: Sequence[T], cost: Callable[[T], int], limit: int) -> list[list[T]]:
    """Greedy consecutive blocks whose summed ``cost`` (plus the block overhead) stays within
    ``limit``; an item costlier than the limit gets a block of its own."""
    blocks: list[list[T]] = []
    used = BLOCK_OVERHEAD
    for item in items:
        c = cost(item)
        if blocks and blocks[-1] and used + c <= limit:
            blocks[-1].append(item)
            used += c
        else:
            blocks.append([item])
            used = BLOCK_OVERHEAD + c
    return blocks
