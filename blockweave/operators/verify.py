"""Completeness of a range of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockweave.functions import hexnum as H

LISTED = 30


def in_range(markers: DataFrame, first: int, last: int, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    """Markers of a range; in linear mode also by the chunk's own range.

    Markers that are read for the range (``sinks.read_table`` with first and last) come from the range's folders alone.
    """
    rows = markers.where(F.col("block_number").between(first, last))
    return rows if remap_mod else rows.where(F.col("chunk").between(first // chunk_size, last // chunk_size))


def expected_blocks(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).withColumnRenamed("id", "block_number")


def gaps(spark: SparkSession, markers: DataFrame, first: int, last: int, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    """chunk and block_number of the blocks without a marker."""
    missing = expected_blocks(spark, first, last).join(in_range(markers, first, last, chunk_size, remap_mod).select("block_number"), "block_number", "left_anti")
    return missing.select(H.chunk("block_number", chunk_size, remap_mod).alias("chunk"), "block_number")


def _expected(chunk: Column, first: int, last: int, chunk_size: int, remap_mod: int) -> Column:
    return H.expected_remap(chunk, remap_mod, first, last) if remap_mod else H.expected_linear(chunk, chunk_size, first, last)


def chunks(spark: SparkSession, first: int, last: int, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    """chunk and expected blocks of each chunk of a range."""
    keys = spark.range(remap_mod) if remap_mod else spark.range(first // chunk_size, last // chunk_size + 1)
    keys = keys.select(F.col("id").cast("int").alias("chunk"))
    return keys.withColumn("expected", _expected(F.col("chunk").cast("long"), first, last, chunk_size, remap_mod))


def chunk_counts(spark: SparkSession, markers: DataFrame, first: int, last: int, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    """chunk, expected, found, complete: all chunks in one job."""
    found = in_range(markers, first, last, chunk_size, remap_mod).groupBy("chunk").agg(F.count("*").alias("found"))
    joined = chunks(spark, first, last, chunk_size, remap_mod).join(found, "chunk", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return joined.withColumn("complete", F.col("expected") == F.col("found"))


def report(missing: DataFrame, listed: int = LISTED) -> DataFrame:
    """The first missing blocks, each with the number of all."""
    total = missing.agg(F.count("*").alias("missing_total"))
    return missing.select("block_number").orderBy("block_number").limit(listed).crossJoin(F.broadcast(total))


def data_counts(markers: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Markers whose numbers disagree with the tables' rows: the third level, beyond markers alone."""
    from blockweave.operators.completions import from_tables

    names = ("tx_count", "log_count", "itx_count", "contract_count")
    actual = from_tables(tables).select("block_number", *[F.col(c).alias(f"actual_{c}") for c in names])
    differs = F.lit(False)
    for c in names:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"actual_{c}"))
    return markers.join(actual, "block_number", "left").where(differs)
