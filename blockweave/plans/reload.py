"""Reload of dumps: the six tables, then the markers, through the sinks, which replace blocks by number: loading again changes nothing."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockweave.operators import completions, sinks
from blockweave.schemas import DUMP_TABLES, TABLES
from blockweave.sources import dump


def tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The six tables of dump rows."""
    out = {}
    for name in DUMP_TABLES:
        columns = [c.split()[0] for c in TABLES[name].split(", ")]
        out[name] = dump.from_values(rows, name, columns).select(*columns)
    return out


def _write(rows: DataFrame, root: str) -> None:
    found = tables(rows)
    done = found["blocks"].select(F.col("number").alias("block_num")).persist()
    try:
        ends = done.agg(F.min("block_num"), F.max("block_num")).first()
        if ends[0] is not None:
            sinks.write_tables(found, completions.from_tables(found), root, done, *ends)
    finally:
        done.unpersist()


def _ids(rows: DataFrame) -> list[int]:
    return sorted(r["batch_id"] for r in rows.select("batch_id").distinct().collect())


def load(rows: DataFrame, root: str, per_step: int | None = None) -> None:
    """Writes dump rows into tables: all batches at once, or ``per_step`` of them before the next ones begin."""
    held = rows.persist()
    try:
        if per_step is None:
            _write(held, root)
        else:
            ids = _ids(held)
            for at in range(0, len(ids), per_step):
                _write(held.where(F.col("batch_id").between(ids[at], ids[min(at + per_step, len(ids)) - 1])), root)
    finally:
        held.unpersist()


def by_block(rows: DataFrame) -> DataFrame:
    """Dump rows with a batch for each block, named by its number."""
    number: Column = F.get("vals", F.when(F.col("table_id") == DUMP_TABLES.index("contracts_by_addresses"), 3).otherwise(1))
    return rows.withColumn("batch_id", dump._number(number, 8))


def paced(rows: DataFrame, root: str, interval: str = "500 milliseconds") -> None:
    """Writes one batch an interval, in order, as a stream whose checkpoint lets a broken load go on; ``by_block`` makes that a block."""
    held, done = rows.persist(), threading.Event()
    ids = _ids(held)

    def step(ticks: DataFrame, _: int) -> None:
        for at in sorted(r["value"] for r in ticks.collect()):
            if at < len(ids):
                _write(held.where(F.col("batch_id") == ids[at]), root)
            if at >= len(ids) - 1:
                done.set()

    ticks = rows.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    try:
        if ids:
            query = ticks.writeStream.option("checkpointLocation", f"{root}/_checkpoint").foreachBatch(step).trigger(processingTime=interval).start()
            while not done.wait(0.05) and query.isActive:
                pass
            if query.exception() is not None:
                raise query.exception()
            query.stop()
    finally:
        held.unpersist()


def counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows and blocks of each stored table that has any."""
    result = None
    for i, name in enumerate(DUMP_TABLES):
        stored = sinks.read_table(spark, root, name).select(F.lit(i).alias("table_id"), F.col(sinks.number_of(name)).alias("block_num"))
        result = stored if result is None else result.unionByName(stored)
    return result.groupBy("table_id").agg(F.count("*").alias("n_rows"), F.countDistinct("block_num").alias("n_blocks"))
