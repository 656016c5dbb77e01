"""Historical runs: raw responses of a range to tables, batch by batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockweave.operators import decode, metrics, sinks

#: Raw rows of all blocks, or a function that gives those of the blocks from first to last.
Source = DataFrame | Callable[[int, int], DataFrame]


def run(
    spark: SparkSession, raw: Source, root: str, first: int, last: int, batch_blocks: int | None = None, reserve: Source | None = None, chunk_size: int = 1000, remap_mod: int = 0, report: bool = True
) -> int:
    """Writes the blocks of a range and moves the cursor to its end; returns the number of batches.

    Rows are of a response or of a block each; a function is asked once a batch, for that batch's blocks.  The cursor moves past
    blocks that stay failed: they have no marker, so that the verifier lists them.  With ``report`` the run's figures are
    stored as JSON.
    """
    size = batch_blocks or last - first + 1
    batches = []
    for low in range(first, last + 1, size):
        high = min(low + size - 1, last)
        began = time.perf_counter()
        rows = _rows(raw, low, high)
        if reserve is not None:
            rows = decode.retry(rows, _rows(reserve, low, high))
        took = sinks.write_batch(decode.decode(decode.assemble(rows)), root, low, high, chunk_size, remap_mod)
        sinks.write_cursor(spark, root, high)
        batches.append({"from_block": low, "to_block": high, **took, "total_ms": 1000 * (time.perf_counter() - began)})
    if report:
        metrics.write_report(spark, root, batches, first, last)
    return len(batches)


def _rows(source: Source, low: int, high: int) -> DataFrame:
    return source(low, high) if callable(source) else source.where(F.col("block_num").between(low, high))


def from_rpc(spark: SparkSession, root: str, rpc_url: str, first: int, last: int, reserve_url: str | None = None, fetch_mode: int = 0, **options) -> int:
    """A historical run against a node: every block is fetched once, with its three responses in one row."""
    from blockweave.sources import rpc

    cursor = sinks.read_cursor(spark, root)
    first = max(first, cursor + 1) if cursor is not None else first
    return run(spark, lambda low, high: rpc.read(spark, rpc_url, low, high, fetch_mode, reserve_url, wide=True), root, first, last, **options) if first <= last else 0
