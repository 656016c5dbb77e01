"""Sinks: the six tables, then the completion markers.

Tables are stored by ranges of ``BUCKET_BLOCKS`` block numbers (the column ``bucket``), whatever batches or streams they come
from, and writing a block replaces all rows that any earlier run stored for it.  Where none of a batch's blocks is stored yet,
its rows are appended; else the ranges they stand in are written anew from the other blocks' rows and the new ones.  Markers go
last: a reader that joins them sees complete blocks only.  A range of blocks has one writer at a time.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockweave.operators import completions, store, transform
from blockweave.schemas import TABLES

#: Blocks of a stored range; readers and writers of a store must agree on it.
BUCKET_BLOCKS = 1000
DEAD_LETTERS = "block_num LONG, methods STRING"
_NUMBER = {"blocks": "number", "dead_letters": "block_num"}


def number_of(name: str) -> str:
    """The column of a table that holds the block's number."""
    return _NUMBER.get(name, "block_number")


def bucket(number: Column | str) -> Column:
    return F.floor((F.col(number) if isinstance(number, str) else number) / F.lit(BUCKET_BLOCKS))


def _schema(name: str) -> str:
    return f"{DEAD_LETTERS if name == 'dead_letters' else TABLES[name]}, bucket LONG"


def read_table(spark: SparkSession, root: str, name: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """A stored table, or its rows of a range of blocks: only the range's folders are read."""
    rows = spark.read.schema(_schema(name)).parquet(f"{root}/{name}")
    if first is not None:
        rows = rows.where(F.col("bucket").between(first // BUCKET_BLOCKS, last // BUCKET_BLOCKS) & F.col(number_of(name)).between(first, last))
    return rows.drop("bucket")


def _stored_buckets(spark: SparkSession, path: str, first: int, last: int) -> list[int]:
    """Stored ranges among those that the blocks from first to last fall in."""
    low, high = first // BUCKET_BLOCKS, last // BUCKET_BLOCKS
    found = [n.split("=")[1] for n in store.names(spark, path) if n.startswith("bucket=")]
    return sorted(b for b in map(int, (f for f in found if f.lstrip("-").isdigit())) if low <= b <= high)


def replace_blocks(rows: DataFrame, root: str, name: str, done: DataFrame, first: int, last: int, order: str | None = None, max_records: int = 0) -> None:
    """Stores rows in place of all stored rows of the blocks ``done`` (column block_num), which lie between first and last.

    ``max_records`` bounds the rows of a file (frames); 0 leaves them unbounded.
    """
    spark, path, number = rows.sparkSession, f"{root}/{name}", number_of(name)
    fresh = rows.withColumn("bucket", bucket(number).cast("long"))
    buckets = _stored_buckets(spark, path, first, last)
    kept, stale = None, []
    if buckets:
        stored = spark.read.schema(_schema(name)).parquet(path).where(F.col("bucket").isin(buckets))
        ours = done.select(F.col("block_num").alias("__done"))
        again = stored.join(ours, F.col(number) == F.col("__done"), "left_semi")
        stale = [r["bucket"] for r in again.select("bucket").distinct().collect()]
        kept = stored.where(F.col("bucket").isin(stale)).join(ours, F.col(number) == F.col("__done"), "left_anti")

    def write(df: DataFrame, mode: str) -> None:
        if order:
            df = df.sortWithinPartitions("bucket", *(["chunk"] if "chunk" in df.columns else []), order)
        writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket")
        (writer.option("maxRecordsPerFile", max_records) if max_records else writer).parquet(path)

    if not stale:
        write(fresh, "append")
        return
    result = kept.unionByName(fresh)
    left = {r["bucket"] for r in result.select("bucket").distinct().collect()}
    write(fresh.where(~F.col("bucket").isin(stale)), "append")
    write(result.where(F.col("bucket").isin(stale)), "overwrite")
    for b in stale:
        if b not in left:
            store.delete(spark, f"{path}/bucket={b}")


def write_tables(tables: dict[str, DataFrame], markers: DataFrame, root: str, done: DataFrame, first: int, last: int, max_records: int = 0) -> None:
    """The tables side by side, then the markers; any failure leaves the markers unwritten."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        jobs = [pool.submit(replace_blocks, df, root, name, done, first, last, None if name == "contracts_by_addresses" else number_of(name), max_records) for name, df in tables.items()]
        for job in jobs:
            job.result()
    replace_blocks(markers, root, "block_completions", done, first, last, "block_number")


def write_batch(decoded: DataFrame, root: str, first: int, last: int, chunk_size: int = 1000, remap_mod: int = 0, max_records: int = 0) -> dict[str, float]:
    """All tables of a batch of blocks from one fetch and parse, then its markers; returns milliseconds of both steps and of fetches."""
    decoded = transform.prepare(decoded).persist()
    try:
        began = time.perf_counter()
        waited = F.col("fetch_ms") if "fetch_ms" in decoded.columns else F.lit(None).cast("double")
        seen = decoded.agg(F.count("*").alias("n"), F.avg(waited).alias("avg"), F.max(waited).alias("max")).first()
        ready = time.perf_counter()
        done = decoded.where(~F.col("err")).select("block_num")
        write_tables(transform.entities(decoded, chunk_size, remap_mod), completions.markers(decoded, chunk_size, remap_mod), root, done, first, last, max_records)
        return {"fbdr_avg": seen["avg"], "fbdr_max": seen["max"], "tpt_ms": 1000 * (ready - began), "save_ms": 1000 * (time.perf_counter() - ready)}
    finally:
        decoded.unpersist()


def compact(spark: SparkSession, root: str, name: str, first: int, last: int, files: int = 1) -> None:
    """Writes the stored ranges between first and last anew, in ``files`` files each: for tables fed by many small batches."""
    buckets = _stored_buckets(spark, f"{root}/{name}", first, last)
    rows = spark.read.schema(_schema(name)).parquet(f"{root}/{name}").where(F.col("bucket").isin(buckets))
    split = rows.repartition(max(1, len(buckets) * files), "bucket", F.pmod(F.col(number_of(name)), F.lit(files)))
    split.sortWithinPartitions("bucket", number_of(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{root}/{name}")


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    counts = [read_table(spark, root, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name in TABLES]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def write_cursor(spark: SparkSession, root: str, cursor: int) -> None:
    """Moves the cursor, after the markers are written.

    The number is the name of a file: it exists or doesn't, so that a crash leaves the old cursor or the new one.
    """
    have = read_cursor(spark, root)
    if have is not None and have >= cursor:
        return
    store.write_text(spark, f"{root}/cursor/{cursor:020d}", "")
    for name in store.names(spark, f"{root}/cursor"):
        if name.isdigit() and int(name) < cursor:
            store.delete(spark, f"{root}/cursor/{name}")


def read_cursor(spark: SparkSession, root: str) -> int | None:
    return max((int(n) for n in store.names(spark, f"{root}/cursor") if n.isdigit()), default=None)


def truncate(spark: SparkSession, root: str) -> None:
    """Empties all tables."""
    for name in TABLES:
        store.delete(spark, f"{root}/{name}")
        spark.createDataFrame([], _schema(name)).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{name}")
