"""Streaming runs: the same transform in ``foreachBatch``.

Catch-up and live are one stream: it starts after the cursor, which historical runs and the stream's own batches move, the
checkpoint holds the offset, and the sink replaces blocks by their number, so that a batch made again, a stream begun anew or a
historical run over the same blocks changes nothing.  A live block that isn't complete yet is asked for again and holds its batch,
and so the committed offset; blocks that can't be had within the stream's patience become dead letters and stay gaps, until
a later run has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blockweave.operators import decode, sinks
from blockweave.schemas import RAW, WIDE

#: Seconds for which a live block that isn't complete is asked for again.
PATIENCE_S = 15.0
#: Most blocks of a micro-batch while a polling stream catches up.
CATCH_UP_BLOCKS = 10_000


def heads_to_process(heads: DataFrame, cursor: int, to_block: int) -> DataFrame:
    """Block numbers after the cursor, up to the end, each once."""
    return heads.where((F.col("block_num") > cursor) & (F.col("block_num") <= to_block)).dropDuplicates(["block_num"])


def fill_heads(heads: DataFrame, cursor: int, to_block: int) -> DataFrame:
    """All blocks from the cursor to the highest head: jumps are filled."""
    top = heads.agg(F.least(F.max("block_num"), F.lit(to_block).cast("long")).alias("top"))
    return top.where(F.col("top") > cursor).select(F.explode(F.sequence(F.lit(cursor + 1).cast("long"), "top")).alias("block_num"))


def unavailable(raw: DataFrame) -> DataFrame:
    """Dead-letter rows: blocks of which a response failed, with the methods."""
    if "block_body" in raw.columns:
        missing = [F.when(F.col(f"{decode.FIELDS[m]}_body").isNull(), F.lit(m)) for m in sorted(decode.FIELDS)]
        return raw.where("any_failed").select("block_num", F.array_join(F.array_compact(F.array(*missing)), ",").alias("methods"))
    return raw.where("failed").groupBy("block_num").agg(F.array_join(F.array_sort(F.collect_set("method")), ",").alias("methods"))


def process(rows: DataFrame, batch_id: int, root: str, reserve: DataFrame | None = None, chunk_size: int = 1000, remap_mod: int = 0, cursor: bool = True) -> None:
    """One micro-batch of raw rows, of a response or of a block each: retry, decode, tables, markers, dead letters, cursor."""
    held = rows.persist()
    try:
        ends = held.agg(F.min("block_num"), F.max("block_num")).first()
        if ends[0] is None:
            return
        rows = decode.retry(held, reserve) if reserve is not None else held
        sinks.write_batch(decode.decode(decode.assemble(rows)), root, *ends, chunk_size, remap_mod)
        sinks.replace_blocks(unavailable(rows), root, "dead_letters", held.select("block_num").distinct(), *ends, "block_num")
        if cursor:
            sinks.write_cursor(held.sparkSession, root, ends[1])
    finally:
        held.unpersist()


def from_files(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Raw rows that arrive as Parquet files."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run(raw: DataFrame, root: str, available_now: bool = True, interval: str = "500 milliseconds", **options) -> StreamingQuery:
    """Starts a stream of raw rows; ``available_now`` catches up and stops, otherwise it polls."""
    writer = raw.writeStream.option("checkpointLocation", f"{root}/_checkpoint").foreachBatch(lambda rows, batch: process(rows, batch, root, **options))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def from_node(spark: SparkSession, url: str, first: int, last: int | None = None, ws_url: str | None = None, reserve_url: str | None = None, patience: float = PATIENCE_S, timeout: float = 30.0, max_blocks: int | None = None) -> DataFrame:
    """Rows of a live node, a block each: heads advance the offset, executors fetch the blocks and wait ``patience`` seconds for incomplete ones.

    With a patience of ``math.inf`` no block is passed that isn't complete.  A stream taken up again must give the block after the
    last one stored as ``first``, as ``live`` does.
    """
    from blockweave.sources import heads, rpc

    spark.dataSource.register(heads.HeadsDataSource)
    source = spark.readStream.format("block_heads").option("url", url).option("fromBlock", first)
    if ws_url:
        source = source.option("wsUrl", ws_url)
    if last is not None:
        source = source.option("toBlock", last)
    if max_blocks:
        source = source.option("maxBlocks", max_blocks)

    def fetch(batches):
        import time

        import pyarrow as pa

        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.float64())
        for batch in batches:
            numbers = batch.column("block_num").to_pylist()
            for at in range(0, len(numbers), 10):
                began = time.perf_counter()
                rows = rpc.fetch_with_reserve(url, reserve_url, numbers[at : at + 10], 0, timeout, patience)
                columns = zip(*rpc.wide(rows, 1000 * (time.perf_counter() - began)), strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in WIDE.split(", ")])

    return source.load().mapInArrow(fetch, WIDE)


def live(spark: SparkSession, root: str, url: str, first: int, last: int | None = None, available_now: bool = False, interval: str = "500 milliseconds", ws_url: str | None = None, reserve_url: str | None = None, patience: float = PATIENCE_S, timeout: float = 30.0, **options) -> StreamingQuery:
    """Follows a node from the block after the store's cursor on, or from ``first`` where there is none; a restart goes on where it stopped."""
    cursor = sinks.read_cursor(spark, root)
    begin = first if cursor is None else max(first, cursor + 1)
    rows = from_node(spark, url, begin, last, ws_url, reserve_url, patience, timeout, None if available_now else CATCH_UP_BLOCKS)
    return run(rows, root, available_now, interval, **options)
