"""Queries of the engine over the bridged test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockweave.functions import hexnum as H
from blockweave.functions import uint256 as U
from blockweave.operators import completions, decode, metrics, sinks, store, transform, verify
from blockweave.plans import historical, reload
from blockweave.plans.workspace import shared_dir
from blockweave.schemas import BLOCK_METHOD, DUMP_TABLES, RECEIPTS_METHOD, TABLES, TRACES_METHOD
from blockweave.sources import bridge, dump
from blockweave.streaming import realtime

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The star-schema tables as chain tables, for the SQL side.
BASE = """
o AS (SELECT o_orderkey AS k, 25078000 + o_orderkey // 10 AS block, (o_orderkey % 10)::INT AS idx, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS prio,
  round(o_totalprice * 100)::BIGINT AS cents FROM orders),
allb AS (SELECT DISTINCT block, block % 97 = 0 AS failed, 1700000000 + 12 * (block - 25078000) AS ts FROM o),
bk AS (SELECT (block // 1000)::INT AS chunk, block AS number, ts AS timestamp_s, ts * 1000 + CASE WHEN block % 2 = 0 THEN 250 ELSE 0 END AS timestamp_ms,
  '0x' || substr(sha256('miner:' || (block % 25)), 1, 40) AS miner FROM allb WHERE NOT failed),
tx0 AS (SELECT o.*, b.chunk, b.timestamp_s AS ts, b.timestamp_ms AS tms FROM o JOIN bk b ON b.number = o.block WHERE NOT (o.idx = 9 AND o.block % 50 = 7)),
tx AS (SELECT chunk, block AS block_number, idx AS transaction_index, '0x' || sha256('tx:' || k) AS hash, ts AS block_timestamp_s, tms AS block_timestamp_ms,
  CASE st WHEN 'O' THEN '0x' WHEN 'F' THEN '0x' || substr(md5(k::VARCHAR), 1, 8) ELSE '0xa9059cbb' || sha256('in:' || k) END AS input,
  '0x' || substr(sha256('cust:' || cust), 1, 40) AS from_address, CASE WHEN prio <> '1-URGENT' THEN '0x' || substr(sha256('seg:' || (cust % 7)), 1, 40) END AS to_address,
  (cents::HUGEINT * 18446744073709551616)::VARCHAR AS value, 21000 + k % 1000 AS gas_limit, 1000000000 + cust AS gas_price, 21000 + k % 500 AS gas_used,
  CASE WHEN k % 5 >= 2 THEN 1000 + k % 7 ELSE 0 END AS max_priority_fee_per_gas, CASE WHEN k % 5 >= 2 THEN 2000000000 + k % 11 ELSE 0 END AS max_fee_per_gas,
  (21000 + k % 500) * (idx + 1) AS cumulative_gas_used, CASE WHEN k % 11 <> 0 THEN 1000000000 + cust ELSE 0 END AS effective_gas_price,
  CASE WHEN prio = '1-URGENT' THEN '0x' || substr(sha256('new:' || k), 1, 40) END AS contract_address, CASE st WHEN 'F' THEN 0 ELSE 1 END AS status, (k % 5)::INT AS type, k, cust FROM tx0),
li AS (SELECT l.*, o.block, o.idx, row_number() OVER (PARTITION BY o.block ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS li
  FROM lineitem l JOIN o ON l.l_orderkey = o.k),
lg AS (SELECT t.chunk, t.block_number, t.transaction_index, li::INT AS log_index, t.block_timestamp_s, t.block_timestamp_ms, '0x' || substr(sha256('part:' || l_partkey), 1, 40) AS address,
  '0x' || lower(hex(l_quantity::BIGINT)) AS data, l_linenumber - 1 AS n_topics, l_partkey, t.hash AS transaction_hash, l_returnflag = 'R' AS removed FROM li JOIN tx t ON t.k = li.l_orderkey),
ev AS (SELECT e.event_id, e.user_id, e.event_type AS kind, round(e.value * 100)::BIGINT AS cents, e.value, o.k, o.block, o.idx, o.cust, (row_number() OVER (PARTITION BY o.block ORDER BY event_id) - 1)::INT AS trace_index
  FROM events e JOIN o ON o.k = e.event_id - e.event_id % 3),
tr AS (SELECT ev.event_id, ev.user_id, ev.kind, ev.cents, ev.trace_index, t.chunk, t.block_number, t.block_timestamp_s, t.block_timestamp_ms, t.transaction_index, t.hash AS transaction_hash, t.from_address AS creator,
  CASE WHEN event_id % 2 = 0 THEN t.from_address ELSE '0x' || substr(sha256('factory:' || user_id), 1, 40) END AS from_address FROM ev JOIN tx t ON t.k = ev.k WHERE ev.kind IN ('view', 'click', 'purchase', 'signup')),
itx AS (SELECT chunk, block_number, block_timestamp_s, block_timestamp_ms, transaction_index, transaction_hash, trace_index, from_address,
  CASE WHEN kind = 'view' THEN '0x' || substr(sha256('seg:' || (user_id % 7)), 1, 40) ELSE '' END AS to_address, CASE WHEN kind = 'view' THEN cents ELSE 0 END::VARCHAR AS value FROM tr WHERE kind <> 'click'),
ct AS (SELECT chunk, block_number, transaction_index, transaction_hash, trace_index, block_timestamp_s, block_timestamp_ms, '0x' || substr(sha256('contract:' || (event_id % 1500)), 1, 40) AS address,
  CASE kind WHEN 'purchase' THEN 0 ELSE 1 END AS creation_method, creator AS creator_address, CASE WHEN from_address = creator THEN NULL ELSE from_address END AS contract_factory,
  CASE kind WHEN 'purchase' THEN '0x60' || sha256('init:' || event_id) ELSE '0x' END AS creation_bytecode, CASE kind WHEN 'purchase' THEN '0x61' || sha256('code:' || event_id) ELSE '0x' END AS deployed_bytecode
  FROM tr WHERE kind IN ('purchase', 'signup')),
cba AS (SELECT address, creator_address AS creator, transaction_hash AS tx_hash, block_number, block_timestamp_s AS timestamp, contract_factory, creation_bytecode, deployed_bytecode FROM ct),
mk AS (SELECT b.chunk, b.number AS block_number, coalesce(t.n, 0)::INT AS tx_count, coalesce(l.n, 0)::INT AS log_count, coalesce(i.n, 0)::INT AS itx_count, coalesce(c.n, 0)::INT AS contract_count FROM bk b
  LEFT JOIN (SELECT block_number, count(*) AS n FROM tx GROUP BY 1) t ON t.block_number = b.number LEFT JOIN (SELECT block_number, count(*) AS n FROM lg GROUP BY 1) l ON l.block_number = b.number
  LEFT JOIN (SELECT block_number, count(*) AS n FROM itx GROUP BY 1) i ON i.block_number = b.number LEFT JOIN (SELECT block_number, count(*) AS n FROM ct GROUP BY 1) c ON c.block_number = b.number),
rng AS (SELECT min(block) AS first, max(block) AS last FROM o)
"""


def query(name: str, sql: str | None = None):
    """Registers a query; its SQL sees the chain tables."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = f"WITH {BASE}\n{sql}"
        return f

    return add


def _triples(spark, d) -> DataFrame:
    return decode.assemble(bridge.raw(spark, d))


def _decoded(spark, d) -> DataFrame:
    return decode.decode(decode.assemble(bridge.wide(spark, d)))


def _bodies(spark, d, method) -> DataFrame:
    return bridge.raw(spark, d, methods=(method,)).where(~F.col("failed"))


def _tables(spark, d, **options) -> dict[str, DataFrame]:
    return transform.entities(_decoded(spark, d), **options)


def _range(spark, d) -> tuple[int, int]:
    r = bridge.orders(spark, d).agg(F.min("block"), F.max("block")).first()
    return r[0], r[1]


def _plain(df: DataFrame) -> DataFrame:
    """Types that both sides print alike."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        out.append((c.cast("string") if kind.startswith("decimal") else c.cast("int") if kind == "tinyint" else F.array_join(c, ",") if kind.startswith("array") else c).alias(name))
    return df.select(*out)


# Sources

_RAW_SQL = """, raws AS (SELECT block AS block_num, m.method, failed FROM allb, (VALUES ('eth_getBlockByNumber'), ('eth_getBlockReceipts'), ('trace_block')) m(method)),
items AS (SELECT block, 'eth_getBlockByNumber' AS method, count(*) AS n FROM o GROUP BY 1 UNION ALL SELECT block, 'eth_getBlockReceipts', count(*) FROM o WHERE NOT (idx = 9 AND block % 50 = 7) GROUP BY 1
  UNION ALL SELECT block, 'trace_block', count(*) FROM ev GROUP BY 1)
SELECT block_num, raws.method, raws.failed, CASE WHEN raws.failed THEN NULL ELSE coalesce(n, 0) END AS n_items FROM raws LEFT JOIN items ON block = block_num AND items.method = raws.method"""


def _sized(raw: DataFrame) -> DataFrame:
    n = F.when(F.col("method") == BLOCK_METHOD, F.size(decode.result("body", BLOCK_METHOD)["transactions"]))
    n = n.when(F.col("method") == RECEIPTS_METHOD, F.size(decode.result("body", RECEIPTS_METHOD))).otherwise(F.size(decode.result("body", TRACES_METHOD)))
    return raw.select("block_num", "method", "failed", F.when(~F.col("failed"), n.cast("long")).alias("n_items"))


@query("src_raw_triples", _RAW_SQL)
def src_raw_triples(spark, d):
    whole = _triples(spark, d)
    rows = whole.select("block_num", "any_failed", F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"{c}_body").alias("body")) for m, c in decode.FIELDS.items()])).alias("x"))
    return _sized(rows.select("block_num", "x.method", "x.body", F.col("any_failed").alias("failed")))


@query("src_method_batch", _RAW_SQL)
def src_method_batch(spark, d):
    return _sized(decode.method_batch(bridge.method_batches(spark, d)))


@query("src_block_batch", _RAW_SQL)
def src_block_batch(spark, d):
    return _sized(decode.block_batch(bridge.block_batches(spark, d)))


query("json_batch_by_id", "SELECT block AS block_num, CASE WHEN failed THEN NULL ELSE 10 END AS n_txs FROM (SELECT a.*, c.n FROM allb a JOIN (SELECT block, count(*) AS n FROM o GROUP BY 1) c USING (block))")(
    lambda spark, d: decode.method_batch(bridge.method_batches(spark, d, methods=(BLOCK_METHOD,))).select("block_num", F.when(~F.col("failed"), F.size(decode.result("body", BLOCK_METHOD)["transactions"])).alias("n_txs"))
)
query("json_block_batch", "SELECT number AS block_num, number, timestamp_s, miner FROM bk")(
    lambda spark, d: transform.blocks(decode.decode(decode.assemble(decode.block_batch(bridge.block_batches(spark, d), wide=True)))).select(F.col("number").alias("block_num"), "number", "timestamp_s", "miner")
)


@query("retry_coalesce", "SELECT block AS block_num, failed AND block % 2 <> 0 AS failed, failed AND block % 2 = 0 AS from_reserve FROM allb")
def retry_coalesce(spark, d):
    primary, reserve = bridge.raw(spark, d), bridge.raw(spark, d, reserve=True)
    merged = decode.retry(primary, reserve)
    before = primary.groupBy("block_num").agg(F.max("failed").alias("was"))
    return merged.groupBy("block_num").agg(F.max("failed").alias("failed")).join(before, "block_num").select("block_num", "failed", (F.col("was") & ~F.col("failed")).alias("from_reserve"))


@query("cursor_start", "SELECT max(number) + 1 AS start_block FROM bk")
def cursor_start(spark, d):
    return completions.start(completions.cursor(transform.blocks(_decoded(spark, d))), _range(spark, d)[0])


@query("completions_range_scan", "SELECT mk.* FROM mk, rng WHERE block_number BETWEEN first + (last - first) // 4 AND last - (last - first) // 4")
def completions_range_scan(spark, d):
    first, last = _range(spark, d)
    first, last = first + (last - first) // 4, last - (last - first) // 4
    within = _decoded(spark, d).where(F.col("block_num").between(first, last))  # the key is known before the answers, so that only the range's rows shuffle
    return verify.in_range(completions.markers(within), first, last)


query("completions_ordered", "SELECT * FROM mk")(lambda spark, d: completions.markers(_decoded(spark, d)).repartition("chunk").sortWithinPartitions("chunk", "block_number"))

# Decoding


@query("json_envelope", "SELECT block AS block_num, failed AS is_null FROM allb")
def json_envelope(spark, d):
    return bridge.raw(spark, d, methods=(BLOCK_METHOD,)).select("block_num", decode.result("body", BLOCK_METHOD).isNull().alias("is_null"))


@query("json_block", "SELECT number AS block_num, '0x' || hex(number) AS number, '0x' || hex(timestamp_s) AS timestamp, CASE WHEN number % 2 = 0 THEN '0x' || hex(timestamp_ms) END AS milli, '0x' || upper(substr(miner, 3)) AS miner, 10 AS n_txs FROM bk")
def json_block(spark, d):
    b = _bodies(spark, d, BLOCK_METHOD).select("block_num", decode.result("body", BLOCK_METHOD).alias("b"))
    return b.select("block_num", "b.number", "b.timestamp", F.col("b.milliTimestamp").alias("milli"), "b.miner", F.size("b.transactions").alias("n_txs"))


@query(
    "json_tx",
    """SELECT block AS block_num, '0x' || hex(idx) AS tx_index, '0X' || upper(sha256('tx:' || k)) AS hash, '0x' || upper(substr(sha256('cust:' || cust), 1, 40)) AS from_raw,
  CASE WHEN prio <> '1-URGENT' THEN '0x' || substr(sha256('seg:' || (cust % 7)), 1, 40) END AS to_raw, '0x' || hex(cents) || repeat('0', 16) AS value, '0x' || lower(hex(21000 + k % 1000)) AS gas, '0x' || hex(1000000000 + cust) AS gas_price,
  '0x' || (k % 5) AS type, CASE WHEN k % 5 >= 2 THEN '0x' || hex(1000 + k % 7) END AS priority, CASE WHEN k % 5 >= 2 THEN '0x' || hex(2000000000 + k % 11) END AS max_fee FROM o WHERE block % 97 <> 0""",
)
def json_tx(spark, d):
    t = _bodies(spark, d, BLOCK_METHOD).select("block_num", F.inline(decode.result("body", BLOCK_METHOD)["transactions"]))
    return t.select("block_num", F.col("transactionIndex").alias("tx_index"), "hash", F.col("from").alias("from_raw"), F.col("to").alias("to_raw"), "value", "gas", F.col("gasPrice").alias("gas_price"), "type", F.col("maxPriorityFeePerGas").alias("priority"), F.col("maxFeePerGas").alias("max_fee"))


@query(
    "json_receipt",
    """SELECT block AS block_num, '0x' || hex(idx) AS tx_index, '0X' || upper(sha256('tx:' || k)) AS hash, '0x' || hex(21000 + k % 500) AS gas_used, '0x' || hex((21000 + k % 500) * (idx + 1)) AS cumulative,
  CASE WHEN k % 11 <> 0 THEN '0x' || hex(1000000000 + cust) END AS price, CASE WHEN prio = '1-URGENT' THEN '0x' || upper(substr(sha256('new:' || k), 1, 40)) END AS contract, CASE st WHEN 'F' THEN '0x0' ELSE '0x1' END AS status, coalesce(n, 0) AS n_logs
  FROM o LEFT JOIN (SELECT l_orderkey, count(*)::INT AS n FROM lineitem GROUP BY 1) ON l_orderkey = k WHERE block % 97 <> 0 AND NOT (idx = 9 AND block % 50 = 7)""",
)
def json_receipt(spark, d):
    r = _bodies(spark, d, RECEIPTS_METHOD).select("block_num", F.inline(decode.result("body", RECEIPTS_METHOD)))
    return r.select("block_num", F.col("transactionIndex").alias("tx_index"), F.col("transactionHash").alias("hash"), F.col("gasUsed").alias("gas_used"), F.col("cumulativeGasUsed").alias("cumulative"), F.col("effectiveGasPrice").alias("price"), F.col("contractAddress").alias("contract"), "status", F.size("logs").alias("n_logs"))


@query(
    "json_log",
    "SELECT block AS block_num, '0x' || hex(li) AS log_index, '0x' || hex(idx) AS tx_index, '0x' || substr(sha256('part:' || l_partkey), 1, 40) AS address, '0x' || hex(l_quantity::BIGINT) AS data, l_linenumber - 1 AS n_topics, l_returnflag = 'R' AS removed FROM li WHERE block % 97 <> 0 AND NOT (idx = 9 AND block % 50 = 7)",
)
def json_log(spark, d):
    r = _bodies(spark, d, RECEIPTS_METHOD).select("block_num", F.inline(decode.result("body", RECEIPTS_METHOD)))
    logs = r.select("block_num", F.inline("logs"))
    return logs.select("block_num", F.col("logIndex").alias("log_index"), F.col("transactionIndex").alias("tx_index"), "address", "data", F.size("topics").alias("n_topics"), "removed")


@query(
    "json_trace",
    """SELECT block AS block_num, trace_index, CASE WHEN kind <> 'error' THEN '0X' || upper(sha256('tx:' || k)) END AS hash, CASE WHEN kind <> 'error' THEN idx::VARCHAR END AS position, CASE WHEN kind = 'view' THEN '0x' || hex(cents) WHEN kind IN ('purchase', 'signup') THEN '0x0' END AS value,
  CASE kind WHEN 'purchase' THEN 'create' WHEN 'signup' THEN 'create2' END AS method, CASE WHEN kind IN ('purchase', 'signup') THEN '0x' || upper(substr(sha256('contract:' || (event_id % 1500)), 1, 40)) END AS address,
  CASE kind WHEN 'purchase' THEN '0x61' || sha256('code:' || event_id) END AS code FROM ev WHERE block % 97 <> 0""",
)
def json_trace(spark, d):
    t = _bodies(spark, d, TRACES_METHOD).select("block_num", F.posexplode(decode.result("body", TRACES_METHOD)).alias("trace_index", "t"))
    return t.select("block_num", "trace_index", F.col("t.transactionHash").alias("hash"), F.col("t.transactionPosition").alias("position"), F.col("t.action.value").alias("value"), F.col("t.action.creationMethod").alias("method"), F.col("t.result.address").alias("address"), F.col("t.result.code").alias("code"))


def _heads(spark, d) -> DataFrame:
    """Head events from ``events``: one block each, some without a number, some unreadable."""
    e = spark.read.parquet(f"{d}/events.parquet")
    number = F.lit(25078000).cast("long") + F.floor(F.col("event_id") / 2)
    text = F.when(F.col("event_id") % 13 == 0, F.lit('{"id":1,"result":"0xsub"}')).when(F.col("event_id") % 17 == 0, F.lit('{"params":{"result":{"number":"0xzz"}}}')).otherwise(F.concat(F.lit('{"method":"eth_subscription","params":{"result":{"number":"'), H.to_hex(number), F.lit('"}}}')))
    return e.select("event_id", text.alias("message"))


_HEAD = "SELECT event_id, 25078000 + event_id // 2 AS block_num FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0"
query("json_head_number", _HEAD)(lambda spark, d: _heads(spark, d).select("event_id", decode.head_number("message").alias("block_num")).where("block_num is not null"))

# Scalar functions


def _keys(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"))


def _hexes(spark, d) -> DataFrame:
    """A hex text for each order, with odd ones among them."""
    k = F.col("k")
    big = k * k * 7919
    h = (
        F.when(k % 10 == 0, "").when(k % 10 == 1, "0x").when(k % 10 == 2, "0x0").when(k % 10 == 3, F.concat(F.lit("0X"), F.hex(k))).when(k % 10 == 4, "0xffffffffffffffff").when(k % 10 == 5, "0x1ffffffffffffffff")
        .when(k % 10 == 6, "0xzz").when(k % 10 == 7, F.concat(F.lit("0x00000000000000000000000"), F.lower(F.hex(k)))).when(k % 10 == 8, F.concat(F.hex(k), F.lit("g"))).otherwise(F.concat(F.lit("0x"), F.lower(F.hex(big))))
    )
    return _keys(spark, d).select("k", h.alias("h"))


_I64 = "CASE o_orderkey % 10 WHEN 3 THEN o_orderkey WHEN 4 THEN -1 WHEN 7 THEN o_orderkey WHEN 9 THEN o_orderkey * o_orderkey * 7919 ELSE 0 END"
query("fn_hex_to_i64", f"SELECT o_orderkey AS k, {_I64} AS v FROM orders")(lambda spark, d: _hexes(spark, d).select("k", H.hex_to_i64("h").alias("v")))
query("fn_hex_to_i32", f"SELECT o_orderkey AS k, least({_I64}, 2147483647)::INT AS v FROM orders")(lambda spark, d: _hexes(spark, d).select("k", H.hex_to_i32("h").alias("v")))
query("fn_hex_to_i8", f"SELECT k, CASE WHEN b > 127 THEN b - 256 ELSE b END::INT AS v FROM (SELECT o_orderkey AS k, ({_I64}) & 255 AS b FROM orders)")(lambda spark, d: _hexes(spark, d).select("k", H.hex_to_i8("h").cast("int").alias("v")))
query("fn_creation_method", "SELECT event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 99 END AS v FROM events")(
    lambda spark, d: spark.read.parquet(f"{d}/events.parquet").select("event_id", H.creation_method(F.when(F.col("event_type") == "purchase", "create").when(F.col("event_type") == "signup", "create2").when(F.col("event_type") == "view", "CREATE")).cast("int").alias("v"))
)
query("fn_method_id", "SELECT o_orderkey AS k, substr(CASE o_orderkey % 4 WHEN 0 THEN '0x' WHEN 1 THEN '0x1234567' ELSE '0x' || md5(o_orderkey::VARCHAR) END, 1, 10) AS v FROM orders")(
    lambda spark, d: _keys(spark, d).select("k", H.method_id(F.when(F.col("k") % 4 == 0, "0x").when(F.col("k") % 4 == 1, "0x1234567").otherwise(F.concat(F.lit("0x"), F.md5(F.col("k").cast("string"))))).alias("v"))
)
query("fn_lower_addr", "SELECT o_orderkey AS k, '0x' || substr(sha256('a:' || o_orderkey), 1, 40) AS v FROM orders")(
    lambda spark, d: _keys(spark, d).select("k", H.lower_address(F.concat(F.lit("0X"), F.upper(F.substring(F.sha2(F.concat(F.lit("a:"), F.col("k").cast("string")), 256), 1, 40)))).alias("v"))
)
query("fn_null_to_empty", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'x' || o_orderkey END AS v FROM orders")(
    lambda spark, d: _keys(spark, d).select("k", H.null_to_empty(F.when(F.col("k") % 3 != 0, F.concat(F.lit("X"), F.col("k").cast("string")))).alias("v"))
)
query("fn_empty_to_null", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'x' || o_orderkey END AS nullable, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'x' || o_orderkey END AS required FROM orders")(
    lambda spark, d: _keys(spark, d).withColumn("x", F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("x"), F.col("k").cast("string")))).select("k", H.empty_to_null("x").alias("nullable"), F.col("x").alias("required"))
)


@query("fn_varint", "SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN '00' WHEN 1 THEN '00FFA3' WHEN 2 THEN '00' || repeat('FF', 32) WHEN 3 THEN NULL ELSE h END AS v FROM (SELECT o_orderkey, lpad(hex(o_orderkey + 65536), 6, '0') AS h FROM orders)")
def fn_varint(spark, d):
    k = F.col("k")
    h = F.when(k % 5 == 0, "0x").when(k % 5 == 1, "0xffa3").when(k % 5 == 2, F.concat(F.lit("0x"), F.repeat(F.lit("f"), 64))).when(k % 5 == 3, "0xg1").otherwise(F.concat(F.lit("0x"), F.hex(k + 65536)))
    return _keys(spark, d).select("k", F.hex(U.varint(h)).alias("v"))


query("fn_uint256_sum", "SELECT chunk, lower(hex(sum(value::HUGEINT // 18446744073709551616)::BIGINT)) || repeat('0', 16) AS total FROM tx GROUP BY chunk")(
    lambda spark, d: transform._pairs(_decoded(spark, d), 1000, 0).groupBy("chunk").agg(*U.sum_limbs("t.value")).select("chunk", U.carried([f"limb{i}" for i in range(10)]).alias("total"))
)
query("chunk_linear", "SELECT o_orderkey AS k, (o_orderkey // 1000)::INT AS chunk FROM orders")(lambda spark, d: _keys(spark, d).select("k", H.chunk("k", 1000).alias("chunk")))
query("chunk_remap", "SELECT o_orderkey AS k, (o_orderkey % 16)::INT AS chunk FROM orders")(lambda spark, d: _keys(spark, d).select("k", H.chunk("k", 1000, 16).alias("chunk")))
query("fn_milli_fallback", "SELECT number, timestamp_ms FROM bk")(lambda spark, d: transform.blocks(_decoded(spark, d)).select("number", "timestamp_ms"))
query("fn_gas_defaults", "SELECT hash, max_priority_fee_per_gas, max_fee_per_gas, effective_gas_price FROM tx")(lambda spark, d: transform.transactions(_decoded(spark, d)).select("hash", "max_priority_fee_per_gas", "max_fee_per_gas", "effective_gas_price"))
query("contract_factory", "SELECT block_number, trace_index, contract_factory FROM ct")(lambda spark, d: transform.contracts(_decoded(spark, d)).select("block_number", "trace_index", "contract_factory"))
query("contract_bytecode", "SELECT block_number, trace_index, creation_bytecode, deployed_bytecode FROM ct")(lambda spark, d: transform.contracts(_decoded(spark, d)).select("block_number", "trace_index", "creation_bytecode", "deployed_bytecode"))
_TOPIC = "CASE WHEN n_topics > {0} THEN '0x' || sha256('t{0}:' || l_partkey) END"
_TOPICS = ", ".join(f"{_TOPIC.format(i)} AS {name}" for i, name in enumerate(("topic_zeroth", "topic_first", "topic_second", "topic_third")))
_REST = f"concat_ws(',', {', '.join(_TOPIC.format(i) for i in (4, 5, 6))}) AS rest_topics"
query("log_topics", f"SELECT block_number, log_index, {_TOPICS} FROM lg")(lambda spark, d: transform.logs(_decoded(spark, d)).select("block_number", "log_index", "topic_zeroth", "topic_first", "topic_second", "topic_third"))
query("log_rest_topics", f"SELECT block_number, log_index, {_REST} FROM lg")(lambda spark, d: _plain(transform.logs(_decoded(spark, d)).select("block_number", "log_index", "rest_topics")))
query("fn_to_hex", "SELECT o_orderkey AS k, '0x' || lower(hex(o_orderkey)) AS v FROM orders")(lambda spark, d: _keys(spark, d).select("k", H.to_hex("k").alias("v")))

# Projections and joins

query("valid_blocks", "SELECT number AS block_num FROM bk")(lambda spark, d: decode.valid(_decoded(spark, d)).select("block_num"))
_TX = "chunk, block_number, transaction_index, hash, block_timestamp_s, block_timestamp_ms, substr(input, 1, 10) AS method_id, input, from_address, to_address, value, gas_limit, gas_price, gas_used, max_priority_fee_per_gas, max_fee_per_gas, cumulative_gas_used, effective_gas_price, contract_address, status, type"
_LOG = f"chunk, block_number, transaction_index, log_index, block_timestamp_s, block_timestamp_ms, address, data, {_TOPICS}, {_REST}, transaction_hash, removed"
query("blocks", "SELECT * FROM bk")(lambda spark, d: transform.blocks(_decoded(spark, d)))
query("transactions", f"SELECT {_TX} FROM tx")(lambda spark, d: _plain(transform.transactions(_decoded(spark, d))))
query("logs", f"SELECT {_LOG} FROM lg")(lambda spark, d: _plain(transform.logs(_decoded(spark, d))))
query("internal_transactions", "SELECT * FROM itx")(lambda spark, d: _plain(transform.internal_transactions(_decoded(spark, d))))
query("contracts", "SELECT * FROM ct")(lambda spark, d: _plain(transform.contracts(_decoded(spark, d))))
query("contracts_by_addresses", "SELECT * FROM cba")(lambda spark, d: transform.contracts_by_addresses(transform.contracts(_decoded(spark, d))))
query("cba_latest", "SELECT * EXCLUDE (rn) FROM (SELECT address, creator_address AS creator, transaction_hash AS tx_hash, block_number, block_timestamp_s AS timestamp, contract_factory, creation_bytecode, deployed_bytecode, row_number() OVER (PARTITION BY address ORDER BY block_number DESC, transaction_index DESC, trace_index DESC) AS rn FROM ct) WHERE rn = 1")(
    lambda spark, d: transform.latest_by_address(transform.contracts(_decoded(spark, d)))
)
query("tx_receipt_zip", "SELECT block_number, transaction_index, hash, gas_used FROM tx")(lambda spark, d: transform.transactions(_decoded(spark, d)).select("block_number", "transaction_index", "hash", "gas_used"))
query("receipt_mismatch", "SELECT block_number, 0 AS mismatches FROM tx GROUP BY 1")(
    lambda spark, d: transform._pairs(_decoded(spark, d), 1000, 0).groupBy("block_number").agg(F.count(F.when(F.lower("t.hash") != F.lower("r.transactionHash"), 1)).cast("int").alias("mismatches"))
)
query("trace_tx_join", "SELECT block_number, trace_index, transaction_index, transaction_hash FROM tr")(
    lambda spark, d: transform.matched_traces(_decoded(spark, d)).select("block_number", "trace_index", F.col("tx.transaction_index").alias("transaction_index"), F.col("tx.hash").alias("transaction_hash"))
)


@query("trace_tx_position", "SELECT block_number, trace_index, transaction_index, transaction_hash FROM tr")
def trace_tx_position(spark, d):
    no_hash = F.transform("traces", lambda t: t.withField("transactionHash", F.lit(None).cast("string")))
    found = transform.matched_traces(_decoded(spark, d).withColumn("traces", no_hash))
    return found.select("block_number", "trace_index", F.col("tx.transaction_index").alias("transaction_index"), F.col("tx.hash").alias("transaction_hash"))


query("trace_index", "SELECT block AS block_number, trace_index, kind = 'error' AS is_reward FROM ev WHERE block % 97 <> 0")(
    lambda spark, d: decode.valid(_decoded(spark, d)).select(F.col("block_num").alias("block_number"), F.posexplode("traces").alias("trace_index", "t")).select("block_number", "trace_index", F.col("t.transactionHash").isNull().alias("is_reward"))
)
query("block_range", "SELECT unnest(range(first, last + 1)) AS block_number FROM rng")(lambda spark, d: verify.expected_blocks(spark, *_range(spark, d)))


@query("frame_counts", "SELECT block_number, count(*) AS n_rows, ((count(*) + 3) // 4) AS frames, min(CASE WHEN count(*) % 4 = 0 THEN 4 ELSE count(*) % 4 END) OVER (PARTITION BY block_number) AS last_frame FROM lg GROUP BY block_number")
def frame_counts(spark, d):
    n = F.col("n_rows")
    counted = transform.logs(_decoded(spark, d)).groupBy("block_number").agg(F.count("*").alias("n_rows"))
    return counted.select("block_number", "n_rows", F.ceil(n / 4).alias("frames"), F.when(n % 4 == 0, F.lit(4).cast("long")).otherwise(n % 4).alias("last_frame"))


@query("union_batches", "SELECT number, chunk FROM bk")
def union_batches(spark, d):
    first, last = _range(spark, d)
    middle = (first + last) // 2
    raw = bridge.raw(spark, d)
    halves = [transform.blocks(decode.decode(decode.assemble(raw.where(p)))) for p in (F.col("block_num") <= middle, F.col("block_num") > middle)]
    return halves[0].unionByName(halves[1]).select("number", "chunk")


# Completions and verification

query("block_completions", "SELECT * FROM mk")(lambda spark, d: completions.markers(_decoded(spark, d)))
query("block_completions_from_tables", "SELECT * FROM mk")(lambda spark, d: completions.from_tables(_tables(spark, d)))
query("cursor_max", "SELECT max(number) AS cursor FROM bk")(lambda spark, d: completions.cursor(transform.blocks(_decoded(spark, d))))


@query("verify_expected_linear", "SELECT c::INT AS chunk, greatest(0, least((c + 1) * 100 - 1, last) - greatest(c * 100, first) + 1) AS expected FROM rng, range((SELECT first // 100 FROM rng), (SELECT last // 100 + 1 FROM rng)) t(c)")
def verify_expected_linear(spark, d):
    return verify.chunks(spark, *_range(spark, d), chunk_size=100)


@query("verify_expected_remap", "SELECT c::INT AS chunk, (SELECT count(*) FROM range((SELECT first FROM rng), (SELECT last + 1 FROM rng)) b(n) WHERE n % 16 = c) AS expected FROM range(0, 16) t(c)")
def verify_expected_remap(spark, d):
    return verify.chunks(spark, *_range(spark, d), remap_mod=16)


_CHUNKS = "SELECT c::INT AS chunk, count(n) AS expected, count(mk.block_number) AS found, count(n) = count(mk.block_number) AS complete FROM (SELECT n, {0} AS c FROM rng, range((SELECT first FROM rng), (SELECT last + 1 FROM rng)) b(n)) LEFT JOIN mk ON mk.block_number = n GROUP BY c"


@query("verify_chunk_counts", _CHUNKS.format("n // 1000"))
def verify_chunk_counts(spark, d):
    return verify.chunk_counts(spark, completions.markers(_decoded(spark, d)), *_range(spark, d))


@query("verify_chunk_counts_remap", _CHUNKS.format("n % 16"))
def verify_chunk_counts_remap(spark, d):
    return verify.chunk_counts(spark, completions.markers(_decoded(spark, d), remap_mod=16), *_range(spark, d), remap_mod=16)


@query("verify_gaps_linear", "SELECT (block // 1000)::INT AS chunk, block AS block_number FROM allb WHERE failed")
def verify_gaps_linear(spark, d):
    return verify.gaps(spark, completions.markers(_decoded(spark, d)), *_range(spark, d))


@query("verify_gaps_remap", "SELECT (block % 16)::INT AS chunk, block AS block_number FROM allb WHERE failed")
def verify_gaps_remap(spark, d):
    return verify.gaps(spark, completions.markers(_decoded(spark, d), remap_mod=16), *_range(spark, d), remap_mod=16)


@query("verify_report", "SELECT block AS block_number, count(*) OVER () AS missing_total FROM allb WHERE failed QUALIFY row_number() OVER (ORDER BY block) <= 30")
def verify_report(spark, d):
    return verify.report(verify_gaps_linear(spark, d))


@query("verify_data_counts", "SELECT block_number, tx_count, contract_count, contract_count AS actual_contract_count FROM mk WHERE contract_count < 0 UNION ALL SELECT block_number, tx_count, contract_count, contract_count - 1 FROM mk WHERE contract_count > 0 AND block_number % 10 = 3")
def verify_data_counts(spark, d):
    """Every tenth block's table loses a contract, which its marker still counts."""
    decoded = _decoded(spark, d)
    tables = transform.entities(decoded)
    first = Window.partitionBy("block_number").orderBy("trace_index")
    tables["contracts"] = tables["contracts"].withColumn("rn", F.row_number().over(first)).where("not (rn = 1 and block_number % 10 = 3)").drop("rn")
    return verify.data_counts(completions.markers(decoded), tables).select("block_number", "tx_count", F.col("contract_count").cast("int"), F.col("actual_contract_count").cast("int"))


# Metrics, from events as durations


def _events(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").withColumn("batch", F.floor(F.col("event_id") / 100))


@query("metrics_summary", """, b AS (SELECT value AS fbdr, (value + value / 2 + value / 4) / 3 AS http FROM events WHERE event_id % 97 <> 0),
t AS (SELECT event_id // 100 AS batch, sum(value) AS tpt, max(value) AS save, count(*) AS blocks FROM events GROUP BY 1)
SELECT (SELECT count(*) FROM b) AS total_blocks, (SELECT round(avg(fbdr), 6) FROM b) AS fbdr_avg, (SELECT max(fbdr) FROM b) AS fbdr_max, (SELECT round(avg(http), 6) FROM b) AS http_avg, count(*) AS total_batches,
  round(sum(tpt), 4) AS tpt_total, round(sum(save), 4) AS save_total, (sum(blocks) * 15)::BIGINT AS total_rows, round(sum(tpt) / (SELECT count(*) FROM b), 6) AS tpt_avg FROM t""")
def metrics_summary(spark, d):
    e = _events(spark, d)
    blocks = e.where("event_id % 97 <> 0").select(F.col("event_id").alias("block_num"), F.col("value").alias("fbdr_ms"), F.col("value").alias("http_block_ms"), (F.col("value") / 2).alias("http_rcpt_ms"), (F.col("value") / 4).alias("http_trc_ms"))
    n = F.count("*")
    batches = e.groupBy("batch").agg(F.sum("value").alias("tpt_ms"), F.max("value").alias("save_ms"), n.alias("blocks"), (n * 2).alias("txs"), (n * 3).alias("logs"), (n * 4).alias("internal_txs"), (n * 5).alias("contracts"))
    s = metrics.summary(blocks, batches)
    digits = {"fbdr_avg": 6, "http_avg": 6, "tpt_avg": 6, "tpt_total": 4, "save_total": 4}
    return s.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in s.columns])


@query("rt_stats", "SELECT event_type AS phase, count(value) AS n, round(sum(value), 4) AS sum_ms, min(value) AS min_ms, max(value) AS max_ms, round(avg(value), 6) AS avg_ms FROM events GROUP BY 1")
def rt_stats(spark, d):
    s = metrics.phases(_events(spark, d), "event_type", "value")
    return s.select(F.col("event_type").alias("phase"), "n", F.round("sum_ms", 4).alias("sum_ms"), "min_ms", "max_ms", F.round("avg_ms", 6).alias("avg_ms"))


@query("latency_percentiles", "SELECT event_type AS phase, len(v) AS n, v[len(v) * 50 // 100 + 1] AS p50, v[len(v) * 95 // 100 + 1] AS p95, v[least(len(v) * 99 // 100, len(v) - 1) + 1] AS p99 FROM (SELECT event_type, list(value ORDER BY value) AS v FROM events GROUP BY 1)")
def latency_percentiles(spark, d):
    return metrics.percentiles(_events(spark, d), "event_type", "value").withColumnRenamed("event_type", "phase")


@query("throughput", "SELECT count(*) AS rows, count(DISTINCT event_id // 100) AS blocks, round(count(*) * 1000.0 / sum(value), 6) AS rows_per_s, round(sum(value) / count(DISTINCT event_id // 100), 6) AS ms_per_block FROM events")
def throughput(spark, d):
    batches = _events(spark, d).groupBy("batch").agg(F.count("*").alias("rows"), F.sum("value").alias("ms"), F.lit(1).cast("long").alias("blocks"))
    t = metrics.throughput(batches, "rows", "ms", "blocks")
    return t.select("rows", "blocks", F.round("rows_per_s", 6).alias("rows_per_s"), F.round("ms_per_block", 6).alias("ms_per_block"))


@query("batch_metrics", "SELECT event_id // 100 AS batch, count(*) AS n, round(sum(value), 4) AS total_ms, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1")
def batch_metrics(spark, d):
    return _events(spark, d).groupBy("batch").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total_ms"), F.count(F.when(F.col("event_type") == "error", 1)).alias("errors"))


# Dumps

_BATCH = 8
_DUMPED = f""", dumped AS (SELECT (number - first) // {_BATCH} AS batch_id, 0 AS table_id, chunk, number AS block FROM bk, rng UNION ALL SELECT (block_number - first) // {_BATCH}, 1, chunk, block_number FROM tx, rng UNION ALL SELECT (block_number - first) // {_BATCH}, 2, chunk, block_number FROM lg, rng
  UNION ALL SELECT (block_number - first) // {_BATCH}, 3, chunk, block_number FROM itx, rng UNION ALL SELECT (block_number - first) // {_BATCH}, 4, chunk, block_number FROM ct, rng UNION ALL SELECT (block_number - first) // {_BATCH}, 5, NULL, block_number FROM ct, rng)
"""


def _dump_rows(spark, d) -> DataFrame:
    """All data tables as dump rows, ``_BATCH`` blocks a batch."""
    first = _range(spark, d)[0]
    result = None
    for name, table in transform.entities(_decoded(spark, d), value=U.varint).items():
        rows = dump.to_values(table, name, F.floor((F.col("number" if name == "blocks" else "block_number") - first) / _BATCH))
        result = rows if result is None else result.unionByName(rows)
    return result


query("dump_rows_per_batch_table", _DUMPED + "SELECT batch_id, table_id, count(*) AS n_rows FROM dumped GROUP BY ALL")(lambda spark, d: dump.rows_per_batch_table(_dump_rows(spark, d)))
query("dump_table_counts", _DUMPED + "SELECT table_id, count(*) AS n_rows FROM dumped GROUP BY ALL")(lambda spark, d: dump.rows_per_table(_dump_rows(spark, d)))
query("dump_distinct_chunks", "SELECT count(DISTINCT chunk) AS n_chunks, string_agg(DISTINCT chunk::VARCHAR, ',' ORDER BY chunk::VARCHAR) AS chunks FROM bk")(lambda spark, d: dump.chunk_keys(_dump_rows(spark, d), listed=None))
query("dump_merge_batches", _DUMPED + "SELECT batch_id // 4 AS batch_id, table_id, count(*) AS n_rows FROM dumped GROUP BY ALL")(lambda spark, d: dump.rows_per_batch_table(dump.merged(_dump_rows(spark, d), 4)))
query("dump_rechunk", _DUMPED + "SELECT table_id, (block % 16)::INT AS chunk, count(*) AS n_rows FROM dumped WHERE table_id < 5 GROUP BY ALL")(
    lambda spark, d: dump.rechunked(_dump_rows(spark, d), 16).where("table_id < 5").groupBy("table_id", dump._number(F.get("vals", F.lit(0)), 4).alias("chunk")).agg(F.count("*").alias("n_rows"))
)


def _reloaded(spark, d) -> DataFrame:
    """Dump rows after a round through dump files."""
    path = shared_dir(spark, "dump")
    dump.write(_dump_rows(spark, d), path)
    return dump.read(spark, path)


_ROUND = "SELECT hash, block_number, transaction_index, value, input, to_address, status, type FROM tx"


@query("dump_roundtrip", _ROUND)
def dump_roundtrip(spark, d):
    back = dump.from_values(_reloaded(spark, d), "transactions", _names("transactions"))
    return _plain(back.select("hash", "block_number", "transaction_index", "value", "input", "to_address", "status", "type"))


# Sinks: a historical run into tables


def _stored(spark, d, batches: int = 2, twice: bool = False) -> str:
    root, (first, last) = shared_dir(spark, "tables"), _range(spark, d)
    raw, size = bridge.raw(spark, d), -(-(last - first + 1) // batches)
    for _ in range(1 + twice):
        historical.run(spark, raw, root, first, last, size)
    return root


_COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {view}" for name, view in zip((*DUMP_TABLES, "block_completions"), ("bk", "tx", "lg", "itx", "ct", "ct", "mk"), strict=True))
query("sink_row_counts", _COUNTS)(lambda spark, d: sinks.row_counts(spark, _stored(spark, d)))
query("sink_idempotent", _COUNTS)(lambda spark, d: sinks.row_counts(spark, _stored(spark, d, twice=True)))

_VIEWS = {"blocks": ("bk", "*"), "transactions": ("tx", _TX), "logs": ("lg", _LOG), "internal_transactions": ("itx", "*"), "contracts": ("ct", "*"), "contracts_by_addresses": ("cba", "*"), "block_completions": ("mk", "*")}


def _names(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].replace("DECIMAL(38,0)", "DECIMAL").split(", ")]


def _checked_sql(table: str) -> str:
    view, columns = _VIEWS[table]
    text = ", ".join(f"coalesce({c}::VARCHAR, '~')" for c in _names(table))
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, coalesce(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT), 0)::BIGINT AS checksum FROM (SELECT {columns} FROM {view})"


#: Number of rows and a sum over all values of each stored table.
_CHECKED = " UNION ALL ".join(map(_checked_sql, TABLES))


def _checked(spark, root: str) -> DataFrame:
    result = None
    for name in TABLES:
        stored = _plain(sinks.read_table(spark, root, name)).select(*_names(name))
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in stored.columns])
        one = stored.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")), F.lit(0)).alias("checksum"))
        result = one if result is None else result.unionByName(one)
    return result


query("sink_tables", _CHECKED)(lambda spark, d: _checked(spark, _stored(spark, d)))


@query("sink_rebatched", _CHECKED)
def sink_rebatched(spark, d):
    """The same range again with other bounds of batches, and a part of it once more: every block's rows are there once."""
    root, (first, last) = shared_dir(spark, "tables"), _range(spark, d)
    raw, n = bridge.raw(spark, d), last - first + 1
    for low, high, size in ((first, last, -(-n // 2)), (first, last, n), (first + n // 3, last - n // 5, n)):
        historical.run(spark, raw, root, low, high, size)
    return _checked(spark, root)


@query("stored_range_scan", "SELECT tx.block_number, transaction_index, hash FROM tx, rng WHERE block_number BETWEEN first + (last - first) // 4 AND last - (last - first) // 4")
def stored_range_scan(spark, d):
    """A keyed read of stored transactions: only the range's folders are read."""
    first, last = _range(spark, d)
    rows = sinks.read_table(spark, _stored(spark, d), "transactions", first + (last - first) // 4, last - (last - first) // 4)
    return rows.select("block_number", "transaction_index", "hash")


@query("run_report", "SELECT first AS from_block, last AS to_block, (SELECT count(*) FROM mk) AS total_blocks, last - first + 1 - (SELECT count(*) FROM mk) AS missing_blocks, 2 AS total_batches, (SELECT sum(tx_count)::BIGINT FROM mk) AS tx, (SELECT sum(log_count)::BIGINT FROM mk) AS log, (SELECT sum(itx_count)::BIGINT FROM mk) AS itx, (SELECT sum(contract_count)::BIGINT FROM mk) AS contract FROM rng")
def run_report(spark, d):
    """What the JSON report of a historical run says, but for its timings."""
    report = spark.read.option("multiLine", True).json(f"{_stored(spark, d)}/reports")
    return report.select("from_block", "to_block", "total_blocks", "missing_blocks", F.col("total_batches").cast("int").alias("total_batches"), "rows.tx", "rows.log", "rows.itx", "rows.contract")


@query("completed_blocks_only", "SELECT t.block_number, transaction_index, hash FROM tx t WHERE block_number % 7 <> 0")
def completed_blocks_only(spark, d):
    """Blocks whose marker is missing, every seventh here, don't show."""
    decoded = _decoded(spark, d)
    done = completions.markers(decoded).where("block_number % 7 <> 0")
    return completions.completed_only(transform.transactions(decoded), done).select("block_number", "transaction_index", "hash")


def _reload(spark, d) -> DataFrame:
    """Rows and batches of the stored tables after dump rows were loaded into them."""
    root, first = shared_dir(spark, "tables"), _range(spark, d)[0]
    reload.load(_reloaded(spark, d), root)
    result = None
    for i, name in enumerate(DUMP_TABLES):
        batch = F.floor((F.col(sinks.number_of(name)) - first) / _BATCH)
        stored = sinks.read_table(spark, root, name).select(F.lit(i).alias("table_id"), batch.alias("batch"))
        result = stored if result is None else result.unionByName(stored)
    return result.groupBy("table_id").agg(F.count("*").alias("n_rows"), F.countDistinct("batch").alias("n_batches"))


_LOADED = _DUMPED + "SELECT table_id, count(*) AS n_rows, count(DISTINCT batch_id) AS n_batches FROM dumped GROUP BY ALL"
query("dump_reload", _LOADED)(_reload)


@query("dump_reload_tables", _CHECKED)
def dump_reload_tables(spark, d):
    """All values of all tables after a round through dump files and two loads, at once and in steps."""
    root, rows = shared_dir(spark, "tables"), _reloaded(spark, d)
    reload.load(rows, root)
    reload.load(dump.merged(rows, 100), root, 1)
    return _checked(spark, root)


@query("dump_paced", _CHECKED)
def dump_paced(spark, d):
    """The same, loaded a batch at a time by a stream."""
    root = shared_dir(spark, "tables")
    reload.paced(dump.merged(_reloaded(spark, d), 100), root, "100 milliseconds")
    return _checked(spark, root)


def _stream(spark, d, files: int, per_trigger: int = 1, **options) -> str:
    """Raw rows that arrive as files, streamed into tables."""
    source, root = shared_dir(spark, "incoming"), shared_dir(spark, "tables")
    bridge.raw(spark, d).repartitionByRange(files, "block_num").sortWithinPartitions("block_num").write.parquet(source)
    realtime.run(realtime.from_files(spark, source, per_trigger), root, **options).awaitTermination()
    return root


@query("rt_single_block", f"SELECT {_TX} FROM tx")
def rt_single_block(spark, d):
    """The tables of a stream of micro-batches equal those of a batch."""
    return _plain(sinks.read_table(spark, _stream(spark, d, 3), "transactions"))


query("rt_catchup_union", _COUNTS)(lambda spark, d: sinks.row_counts(spark, _stream(spark, d, 4, 2)))
query("rt_poll_sequence", "SELECT number AS block_number FROM bk")(lambda spark, d: sinks.read_table(spark, _stream(spark, d, 3), "block_completions").select("block_number"))
@query("rt_overlap", _CHECKED)
def rt_overlap(spark, d):
    """History of the first two thirds, then a stream over the last two thirds into the same tables."""
    source, root, (first, last) = shared_dir(spark, "incoming"), shared_dir(spark, "tables"), _range(spark, d)
    raw, third = bridge.raw(spark, d), (last - first + 1) // 3
    historical.run(spark, raw, root, first, last - third, third)
    raw.where(F.col("block_num") >= first + third).repartitionByRange(2, "block_num").write.parquet(source)
    realtime.run(realtime.from_files(spark, source), root).awaitTermination()
    return _checked(spark, root)


@query("rt_restart", _CHECKED)
def rt_restart(spark, d):
    """A stream that stops, goes on from its checkpoint with more blocks, and is begun anew without one."""
    source, root, (first, last) = shared_dir(spark, "incoming"), shared_dir(spark, "tables"), _range(spark, d)
    raw, middle = bridge.raw(spark, d), (first + last) // 2
    for part in (F.col("block_num") <= middle, F.col("block_num") > middle):
        raw.where(part).coalesce(1).write.mode("append").parquet(source)
        realtime.run(realtime.from_files(spark, source), root).awaitTermination()
    store.delete(spark, f"{root}/_checkpoint")
    realtime.run(realtime.from_files(spark, source, 2), root).awaitTermination()
    return _checked(spark, root)


_WINDOW = "(SELECT min(block_num) + (max(block_num) - min(block_num)) // 4 AS low, max(block_num) - (max(block_num) - min(block_num)) // 4 AS high FROM (" + _HEAD + "))"


def _head_window(spark, d) -> tuple[DataFrame, int, int]:
    """Head numbers, and the middle half of their range."""
    numbers = _heads(spark, d).select(decode.head_number("message").alias("block_num"))
    low, high = numbers.agg(F.min("block_num"), F.max("block_num")).first()
    return numbers, low + (high - low) // 4, high - (high - low) // 4


query("rt_head_filter", f"SELECT DISTINCT block_num FROM ({_HEAD}), {_WINDOW} w WHERE block_num > low AND block_num <= high")(lambda spark, d: realtime.heads_to_process(*_head_window(spark, d)).select("block_num"))
query("rt_dedupe_heads", "SELECT DISTINCT block_num FROM (" + _HEAD + ")")(lambda spark, d: realtime.heads_to_process(_heads(spark, d).select(decode.head_number("message").alias("block_num")), 0, 2**40).select("block_num"))
query("rt_fill_heads", f"SELECT unnest(range(low + 1, high + 1)) AS block_num FROM {_WINDOW} w")(lambda spark, d: realtime.fill_heads(*_head_window(spark, d)))
query("rt_unavailable", "SELECT block AS block_num, 'eth_getBlockByNumber,eth_getBlockReceipts,trace_block' AS methods FROM allb WHERE failed")(lambda spark, d: realtime.unavailable(bridge.raw(spark, d)))


def per_block(decoded: DataFrame) -> DataFrame:
    """Number of transactions and their value by block: only the value is decoded."""
    pairs = transform._pairs(decoded, 1000, 0).select("chunk", "block_number", U.decimal("t.value").alias("value"))
    return pairs.groupBy("chunk", "block_number").agg(F.count("*").alias("tx_count"), F.sum("value").cast("string").alias("value_total"))


@query("tx_per_block", "SELECT chunk, block_number, count(*) AS tx_count, sum(value::HUGEINT)::VARCHAR AS value_total FROM tx GROUP BY ALL")
def tx_per_block(spark, d):
    """The flagship: raw responses to transactions and value by block."""
    return per_block(_decoded(spark, d))
