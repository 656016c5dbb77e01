"""Completion markers and the cursor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockweave.operators import transform


def markers(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    """One marker a block with its numbers of rows, counted inside the block's row: no shuffle and no join."""
    pairs = transform._paired(decoded)
    logs = F.aggregate(pairs, F.lit(0), lambda n, p: n + F.greatest(F.coalesce(F.size(p["r"]["logs"]), F.lit(0)), F.lit(0)))
    head = transform.with_matches(decoded, chunk_size, remap_mod, F.size(pairs).alias("tx_count"), logs.alias("log_count"))
    itx = F.size(F.filter("found", lambda x: (F.coalesce(x["action"]["from"], F.lit("")) != "") & x["action"]["value"].isNotNull()))
    created = F.size(F.filter("found", lambda x: x["result"]["address"].isNotNull()))
    return head.select("chunk", "block_number", "tx_count", "log_count", itx.alias("itx_count"), created.alias("contract_count"))


def from_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Markers from the tables: blocks left-outer each table's counts, zero where there are none."""
    result = tables["blocks"].select("chunk", F.col("number").alias("block_number"))
    for name, column in (("transactions", "tx_count"), ("logs", "log_count"), ("internal_transactions", "itx_count"), ("contracts", "contract_count")):
        result = result.join(tables[name].groupBy("block_number").agg(F.count("*").alias(column)), "block_number", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("tx_count", "log_count", "itx_count", "contract_count")]
    return result.select("chunk", "block_number", *zero)


def cursor(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.max("number").alias("cursor"))


def start(state: DataFrame, from_block: int) -> DataFrame:
    """Where a run starts: after the cursor, or at the range's first block."""
    return state.agg(F.coalesce(F.max("cursor") + 1, F.lit(from_block).cast("long")).alias("start_block"))


def completed_only(table: DataFrame, markers: DataFrame, number: str = "block_number") -> DataFrame:
    """Rows of complete blocks: what readers see."""
    return table.join(markers.select(F.col("block_number").alias("__done")), F.col(number) == F.col("__done"), "left_semi")
