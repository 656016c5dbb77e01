"""Verification of stored tables: counts by chunk, gaps, and rows against markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blockweave.operators import sinks, verify


def run(spark: SparkSession, root: str, first: int, last: int, chunk_size: int = 1000, remap_mod: int = 0) -> dict[str, DataFrame]:
    markers = sinks.read_table(spark, root, "block_completions", first, last)
    missing = verify.gaps(spark, markers, first, last, chunk_size, remap_mod)
    tables = {name: sinks.read_table(spark, root, name, first, last) for name in ("blocks", "transactions", "logs", "internal_transactions", "contracts")}
    return {"chunks": verify.chunk_counts(spark, markers, first, last, chunk_size, remap_mod), "gaps": missing, "report": verify.report(missing), "data": verify.data_counts(markers, tables)}
