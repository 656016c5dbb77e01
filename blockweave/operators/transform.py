"""The six tables from decoded blocks.

All joins are inside a block, so they run inside its row: receipts meet transactions by position, traces meet transactions
by hash.  Nothing shuffles between decoding and writing.

Arrays are exploded by the outer generators, with empty ones filtered after: the inner ones make Catalyst infer a filter on
the array, which it then computes a second time, JSON and all, below the projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockweave.functions import hexnum as H
from blockweave.functions.uint256 import decimal
from blockweave.operators.decode import valid


def _head(decoded: DataFrame, chunk_size: int, remap_mod: int, *more: Column | str) -> DataFrame:
    """Complete blocks with their key and times."""
    number, seconds = H.hex_to_i64("block.number"), H.hex_to_i64("block.timestamp")
    return valid(decoded).select(
        H.chunk(number, chunk_size, remap_mod).alias("chunk"), number.alias("block_number"), seconds.alias("block_timestamp_s"), H.milliseconds("block.milliTimestamp", seconds).alias("block_timestamp_ms"), *more
    )


def paired(transactions: Column, receipts: Column) -> Column:
    """Transactions with receipts by position, as many as the shorter list has."""
    n = F.least(F.size(transactions), F.size(receipts))
    return F.zip_with(F.slice(transactions, F.lit(1), n), F.slice(receipts, F.lit(1), n), lambda t, r: F.struct(t.alias("t"), r.alias("r")))


def _paired(decoded: DataFrame) -> Column:
    return F.col("pairs") if "pairs" in decoded.columns else paired(F.col("block.transactions"), F.col("receipts"))


def prepare(decoded: DataFrame) -> DataFrame:
    """Decoded blocks with receipts and traces already joined to their transactions (``pairs``, ``found``), for runs that derive several tables."""
    more = [c for c in ("fetch_ms",) if c in decoded.columns]
    head = F.struct("block.number", "block.timestamp", "block.milliTimestamp", "block.miner").alias("block")
    paired_up = decoded.withColumn("pairs", paired(F.col("block.transactions"), F.col("receipts")))
    return _matched(paired_up).select("block_num", "err", head, "pairs", "found", *more)


def blocks(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    head = _head(decoded, chunk_size, remap_mod, F.lower("block.miner").alias("miner"))
    return head.select("chunk", F.col("block_number").alias("number"), F.col("block_timestamp_s").alias("timestamp_s"), F.col("block_timestamp_ms").alias("timestamp_ms"), "miner")


def _pairs(decoded: DataFrame, chunk_size: int, remap_mod: int) -> DataFrame:
    head = _head(decoded, chunk_size, remap_mod, _paired(decoded).alias("pairs"))
    rows = head.select("chunk", "block_number", "block_timestamp_s", "block_timestamp_ms", F.inline_outer("pairs"))
    return rows.where("t is not null")


def transactions(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0, value: Callable[[str], Column] = decimal) -> DataFrame:
    data = F.lower("t.input")
    return _pairs(decoded, chunk_size, remap_mod).select(
        "chunk",
        "block_number",
        H.hex_to_i32("t.transactionIndex").alias("transaction_index"),
        F.lower("t.hash").alias("hash"),
        "block_timestamp_s",
        "block_timestamp_ms",
        H.empty_to_null(H.method_id(data)).alias("method_id"),
        H.empty_to_null(data).alias("input"),
        F.lower("t.from").alias("from_address"),
        H.empty_to_null(H.null_to_empty("t.to")).alias("to_address"),
        value("t.value").alias("value"),
        H.hex_to_i64("t.gas").alias("gas_limit"),
        H.hex_to_i64("t.gasPrice").alias("gas_price"),
        H.hex_to_i64("r.gasUsed").alias("gas_used"),
        H.hex_to_i64("t.maxPriorityFeePerGas").alias("max_priority_fee_per_gas"),
        H.hex_to_i64("t.maxFeePerGas").alias("max_fee_per_gas"),
        H.hex_to_i64("r.cumulativeGasUsed").alias("cumulative_gas_used"),
        H.hex_to_i64("r.effectiveGasPrice").alias("effective_gas_price"),
        H.empty_to_null(H.null_to_empty("r.contractAddress")).alias("contract_address"),
        H.hex_to_i8("r.status").alias("status"),
        H.hex_to_i8("t.type").alias("type"),
    )


def logs(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    topics = F.col("topics")
    placed = _pairs(decoded, chunk_size, remap_mod).select("chunk", "block_number", "block_timestamp_s", "block_timestamp_ms", F.posexplode_outer("r.logs").alias("at", "log"))
    exploded = placed.where("at is not null").select("chunk", "block_number", "block_timestamp_s", "block_timestamp_ms", "log.*")
    names = ("topic_zeroth", "topic_first", "topic_second", "topic_third")
    return exploded.select(
        "chunk",
        "block_number",
        H.hex_to_i32("transactionIndex").alias("transaction_index"),
        H.hex_to_i32("logIndex").alias("log_index"),
        "block_timestamp_s",
        "block_timestamp_ms",
        F.lower("address").alias("address"),
        F.lower("data").alias("data"),
        *[H.empty_to_null(H.topic(topics, i)).alias(name) for i, name in enumerate(names)],
        H.rest_topics(topics).alias("rest_topics"),
        F.lower("transactionHash").alias("transaction_hash"),
        F.coalesce("removed", F.lit(False)).alias("removed"),
    )


def with_matches(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0, *more: Column) -> DataFrame:
    """Complete blocks with an array ``found`` of the traces that belong to a transaction of the block.

    The hash decides, the last of equal hashes winning; the position counts only where there is no hash.  The lookup is an
    array search inside the row, so that neither side shuffles, and happens before the traces are exploded.
    """
    if "found" in decoded.columns:
        return _head(decoded, chunk_size, remap_mod, "found", *more)
    return _matched(_head(decoded, chunk_size, remap_mod, _paired(decoded).alias("pairs"), "traces", *more)).drop("pairs")


def _matched(rows: DataFrame) -> DataFrame:
    """Adds ``found`` to rows with ``pairs`` and ``traces``."""
    keys = F.transform("pairs", lambda p: F.struct(H.hex_to_i32(p["t"]["transactionIndex"]).alias("transaction_index"), F.lower(p["t"]["hash"]).alias("hash"), F.lower(p["t"]["from"]).alias("creator")))
    head = rows.withColumn("txs", keys).withColumn("hashes", F.transform("txs", lambda t: t["hash"]))
    backwards = F.reverse("hashes")

    def place(t: Column) -> Column:
        by_hash = F.array_position(backwards, F.lower(t["transactionHash"]))
        given = t["transactionPosition"]
        by_place = F.when(given.rlike("^0[xX]"), H.hex_to_i64_or_null(given)).when(given.rlike("^[0-9]{1,9}$"), given.cast("int"))
        hashed = F.coalesce(t["transactionHash"], F.lit("")) != ""
        return F.when(hashed, F.when(by_hash > 0, F.size("hashes") - by_hash)).otherwise(by_place)

    found = F.transform("traces", lambda t, i: F.struct(i.alias("trace_index"), t["action"].alias("action"), t["result"].alias("result"), place(t).cast("int").alias("at")))
    kept = F.filter(found, lambda x: (x["at"] >= 0) & (x["at"] < F.size("txs")))
    full = F.transform(kept, lambda x: F.struct(x["trace_index"], x["action"], x["result"], F.get("txs", x["at"]).alias("tx")))
    return head.withColumn("found", full).drop("txs", "hashes", "traces")


def matched_traces(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    """Traces that belong to a transaction of their block, with their place among all of the block's traces."""
    head = with_matches(decoded, chunk_size, remap_mod)
    rows = head.select("chunk", "block_number", "block_timestamp_s", "block_timestamp_ms", F.inline_outer("found")).where("trace_index is not null")
    return rows.select("*", F.coalesce(F.lower("action.from"), F.lit("")).alias("from_address"))


def internal_transactions(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0, value: Callable[[str], Column] = decimal) -> DataFrame:
    found = matched_traces(decoded, chunk_size, remap_mod).where("from_address <> '' and action.value is not null")
    return found.select(
        "chunk",
        "block_number",
        "block_timestamp_s",
        "block_timestamp_ms",
        F.col("tx.transaction_index").alias("transaction_index"),
        F.col("tx.hash").alias("transaction_hash"),
        "trace_index",
        "from_address",
        H.null_to_empty("action.to").alias("to_address"),
        value("action.value").alias("value"),
    )


def contracts(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0) -> DataFrame:
    found = matched_traces(decoded, chunk_size, remap_mod).where("result.address is not null")
    return found.select(
        "chunk",
        "block_number",
        F.col("tx.transaction_index").alias("transaction_index"),
        F.col("tx.hash").alias("transaction_hash"),
        "trace_index",
        "block_timestamp_s",
        "block_timestamp_ms",
        F.lower("result.address").alias("address"),
        H.creation_method("action.creationMethod").alias("creation_method"),
        F.col("tx.creator").alias("creator_address"),
        H.empty_to_null(H.contract_factory(F.col("from_address"), F.col("tx.creator"))).alias("contract_factory"),
        H.creation_bytecode(F.col("action.init"), F.col("action.input")).alias("creation_bytecode"),
        H.deployed_bytecode(F.col("result.code")).alias("deployed_bytecode"),
    )


def contracts_by_addresses(created: DataFrame) -> DataFrame:
    """The address table's rows, from rows of ``contracts``."""
    return created.select(
        "address",
        F.col("creator_address").alias("creator"),
        F.col("transaction_hash").alias("tx_hash"),
        "block_number",
        F.col("block_timestamp_s").alias("timestamp"),
        "contract_factory",
        "creation_bytecode",
        "deployed_bytecode",
    )


def latest_by_address(created: DataFrame) -> DataFrame:
    """The address table after upserts: the latest (block, transaction, trace) of an address wins.  An aggregate, combined before the shuffle."""
    order = F.struct("block_number", "transaction_index", "trace_index")
    best = created.groupBy("address").agg(F.max_by(F.struct(*created.columns), order).alias("row"))
    return contracts_by_addresses(best.select("row.*"))


def entities(decoded: DataFrame, chunk_size: int = 1000, remap_mod: int = 0, value: Callable[[str], Column] = decimal) -> dict[str, DataFrame]:
    """All six tables; the caller persists ``decoded`` if it uses several."""
    created = contracts(decoded, chunk_size, remap_mod)
    return {
        "blocks": blocks(decoded, chunk_size, remap_mod),
        "transactions": transactions(decoded, chunk_size, remap_mod, value),
        "logs": logs(decoded, chunk_size, remap_mod),
        "internal_transactions": internal_transactions(decoded, chunk_size, remap_mod, value),
        "contracts": created,
        "contracts_by_addresses": contracts_by_addresses(created),
    }


def quarantine(decoded: DataFrame) -> DataFrame:
    """Quantities that the reader can't take as hex or that don't fit decimal(38, 0): table, block, place, text."""
    tx = _pairs(decoded, 1000, 0).select(F.lit("transactions").alias("table"), "block_number", H.hex_to_i32("t.transactionIndex").alias("place"), F.col("t.value").alias("value"))
    itx = matched_traces(decoded).where("from_address <> '' and action.value is not null").select(F.lit("internal_transactions").alias("table"), "block_number", F.col("trace_index").alias("place"), F.col("action.value").alias("value"))
    return tx.unionByName(itx).where(decimal("value").isNull())
