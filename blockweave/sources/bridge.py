"""Deterministic EVM-shaped responses from the star-schema test tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockweave.schemas import BLOCK_METHOD, METHODS, RECEIPTS_METHOD, TRACES_METHOD

FIRST_BLOCK = 25078000


def _sha(tag: str, x: Column) -> Column:
    return F.sha2(F.concat(F.lit(tag + ":"), x.cast("string")), 256)


def _upper(x: Column) -> Column:
    return F.concat(F.lit("0x"), F.upper(x))


def _hex(x: Column) -> Column:
    return F.concat(F.lit("0x"), F.hex(x.cast("long")))


def cents(x: Column) -> Column:
    return F.round(x * 100).cast("long")


def failed(block: Column) -> Column:
    return block % 97 == 0


def block_of(key: Column) -> Column:
    return (F.lit(FIRST_BLOCK) + F.floor(key / 10)).cast("long")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("k"),
        block_of(k).alias("block"),
        (k % 10).cast("int").alias("idx"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
    )


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _transaction(o: Column) -> Column:
    k, cust = o["k"], o["o_custkey"]
    kind = k % 5
    data = F.when(o["o_orderstatus"] == "O", "0x").when(o["o_orderstatus"] == "F", F.concat(F.lit("0x"), F.substring(F.md5(k.cast("string")), 1, 8))).otherwise(F.concat(F.lit("0xA9059CBB"), _sha("in", k)))
    return F.struct(
        F.concat(F.lit("0X"), F.upper(_sha("tx", k))).alias("hash"),
        _hex(o["idx"]).alias("transactionIndex"),
        _upper(F.substring(_sha("cust", cust), 1, 40)).alias("from"),
        F.when(o["o_orderpriority"] != "1-URGENT", F.concat(F.lit("0x"), F.substring(_sha("seg", cust % 7), 1, 40))).alias("to"),
        F.concat(_hex(cents(o["o_totalprice"])), F.repeat(F.lit("0"), 16)).alias("value"),
        F.lower(_hex(21000 + k % 1000)).alias("gas"),
        _hex(1000000000 + cust).alias("gasPrice"),
        data.alias("input"),
        F.concat(F.lit("0x"), kind.cast("string")).alias("type"),
        F.when(kind >= 2, _hex(1000 + k % 7)).alias("maxPriorityFeePerGas"),
        F.when(kind >= 2, _hex(2000000000 + k % 11)).alias("maxFeePerGas"),
        F.lit("0x1").alias("chainId"),
    )


def _log(item: Column, at: Column, tx: Column, idx: Column) -> Column:
    part = item["l_partkey"]
    topics = F.slice(F.array(*[F.lit(f"t{i}:") for i in range(7)]), F.lit(1), item["l_linenumber"] - 1)
    return F.struct(
        F.concat(F.lit("0x"), F.substring(_sha("part", part), 1, 40)).alias("address"),
        F.transform(topics, lambda t: _upper(F.sha2(F.concat(t, part.cast("string")), 256))).alias("topics"),
        _hex(item["l_quantity"]).alias("data"),
        tx.alias("transactionHash"),
        _hex(idx).alias("transactionIndex"),
        _hex(at).alias("logIndex"),
        (item["l_returnflag"] == "R").alias("removed"),
    )


def _receipts(block: Column, own: Column, items: Column) -> Column:
    """A block's receipts in order, from its orders and line items."""
    held = F.array_sort(F.flatten(F.transform(own, lambda o: F.filter(items, lambda i: i["l_orderkey"] == o["k"]))))
    present = F.filter(own, lambda o: ~((o["idx"] == 9) & (block % 50 == 7)))

    def receipt(o: Column, placed: Column, tx: Column) -> Column:
        k, used = o["k"], 21000 + o["k"] % 500
        return F.struct(
            tx.alias("transactionHash"),
            _hex(o["idx"]).alias("transactionIndex"),
            _hex(used).alias("gasUsed"),
            _hex(used * (o["idx"] + 1)).alias("cumulativeGasUsed"),
            F.when(k % 11 != 0, _hex(1000000000 + o["o_custkey"])).alias("effectiveGasPrice"),
            F.when(o["o_orderpriority"] == "1-URGENT", _upper(F.substring(_sha("new", k), 1, 40))).alias("contractAddress"),
            F.when(o["o_orderstatus"] == "F", "0x0").otherwise("0x1").alias("status"),
            F.transform(F.filter(placed, lambda p: p["item"]["l_orderkey"] == k), lambda p: _log(p["item"], p["at"], tx, o["idx"])).alias("logs"),
        )

    return _let(F.transform(held, lambda i, at: F.struct(i.alias("item"), at.alias("at"))), lambda placed: F.transform(present, lambda o: _let(F.concat(F.lit("0X"), F.upper(_sha("tx", o["k"]))), lambda tx: receipt(o, placed, tx))))


def _block(block: Column, own: Column) -> Column:
    stamp = F.lit(1700000000) + 12 * (block - FIRST_BLOCK)
    return F.struct(
        _hex(block).alias("number"),
        _hex(stamp).alias("timestamp"),
        F.when(block % 2 == 0, _hex(stamp * 1000 + 250)).alias("milliTimestamp"),
        _upper(F.substring(_sha("miner", block % 25), 1, 40)).alias("miner"),
        F.lit("0xdead").alias("extraData"),
        F.transform(own, _transaction).alias("transactions"),
    )


def _trace(e: Column, o: Column) -> Column:
    kind, event, user = e["event_type"], e["event_id"], e["user_id"]
    call, created = kind.isin("view", "click"), kind.isin("purchase", "signup")
    own = _upper(F.substring(_sha("cust", o["o_custkey"]), 1, 40))
    return F.struct(
        F.when(call | created, F.concat(F.lit("0X"), F.upper(_sha("tx", o["k"])))).alias("transactionHash"),
        F.when(call | created, o["idx"]).alias("transactionPosition"),
        F.struct(
            F.when(~(call | created), "").when(event % 2 == 0, own).otherwise(_upper(F.substring(_sha("factory", user), 1, 40))).alias("from"),
            F.when(call, F.concat(F.lit("0x"), F.substring(_sha("seg", user % 7), 1, 40))).alias("to"),
            F.when(kind == "view", _hex(cents(e["value"]))).when(created, "0x0").alias("value"),
            F.when(kind == "purchase", F.concat(F.lit("0x60"), _sha("init", event))).alias("init"),
            F.when(kind == "signup", "").alias("input"),
            F.when(kind == "purchase", "create").when(kind == "signup", "create2").alias("creationMethod"),
        ).alias("action"),
        F.when(
            created,
            F.struct(_upper(F.substring(_sha("contract", event % 1500), 1, 40)).alias("address"), F.when(kind == "purchase", F.concat(F.lit("0x61"), _sha("code", event))).alias("code")),
        ).alias("result"),
    )


def _traces(own: Column, events: Column) -> Column:
    of = lambda e: F.filter(own, lambda o: o["k"] == e["event_id"] - e["event_id"] % 3)
    return F.flatten(F.transform(events, lambda e: F.transform(of(e), lambda o: _trace(e, o))))


def _gathered(rows: DataFrame, by: str, name: str, *fields: str) -> DataFrame:
    """The rows of each key as a sorted array of their plain columns, after one shuffle of these."""
    return rows.repartition(by).groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def facts(spark: SparkSession, sf_dir: str, methods: tuple[str, ...] = METHODS, size: int = 0) -> DataFrame:
    """block and the rows of the tables that its answers to ``methods`` are made of: own (orders), items, events; or all of ``size`` blocks by first_block.

    Only these rows shuffle, once a table: answers are many times as large, and are made of a row's own arrays, where they are used.
    """
    by = "first_block" if size else "block"

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("first_block", F.col("block") - F.col("block") % size) if size else rows

    result = _gathered(keyed(orders(spark, sf_dir)), by, "own", "idx", "k", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    if RECEIPTS_METHOD in methods:
        # in this order the items take their places in a block; columns after the flag can't change an answer
        fields = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
        items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_orderkey is not null").select(block_of(F.col("l_orderkey")).alias("block"), *fields)
        result = result.join(_gathered(keyed(items), by, "items", *fields), by, "left")
    if TRACES_METHOD in methods:
        event = F.col("event_id")
        events = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id is not null").select(block_of(event - event % 3).alias("block"), "event_id", "user_id", "event_type", "value")
        result = result.join(_gathered(keyed(events), by, "events", "event_id", "user_id", "event_type", "value"), by, "left")
    return result


def answer(method: str, block: Column, own: Column, more: Column) -> Column:
    """A block's result for a method; ``more``: its line items or events, null for none."""
    if method == BLOCK_METHOD:
        return _block(block, own)
    made = _receipts(block, own, F.coalesce(more, F.array())) if method == RECEIPTS_METHOD else _traces(own, more)
    return F.coalesce(made, F.array())


_MORE = {BLOCK_METHOD: "own", RECEIPTS_METHOD: "items", TRACES_METHOD: "events"}


def _result(method: str) -> Column:
    return answer(method, F.col("block"), F.col("own"), F.col(_MORE[method]))


def _body(result: Column) -> Column:
    return F.to_json(F.struct(F.lit("2.0").alias("jsonrpc"), F.lit(1).alias("id"), result.alias("result")))


def raw(spark: SparkSession, sf_dir: str, reserve: bool = False, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """Raw rows (block_num, method, body, failed) of some methods; the reserve serves the failed blocks with even numbers."""
    r = facts(spark, sf_dir, methods)
    down = failed(F.col("block"))
    if reserve:
        r, down = r.where(down), F.col("block") % 2 != 0
    rows = r.select("*", F.explode(F.array(*map(F.lit, methods))).alias("method"))
    body = F.coalesce(*[F.when(F.col("method") == m, _body(_result(m))) for m in methods])
    return rows.select(F.col("block").alias("block_num"), "method", F.when(~down, body).alias("body"), down.alias("failed"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as one row a block, as ``decode.assemble`` gives it; the generator keeps filters above the bodies, so that each is made once."""
    down = failed(F.col("block"))
    bodies = [F.when(~down, _body(_result(m))).alias(name) for m, name in zip(METHODS, ("block_body", "receipts_body", "traces_body"), strict=True)]
    return facts(spark, sf_dir).select(F.col("block").alias("block_num"), F.inline_outer(F.array(F.struct(*bodies, down.alias("any_failed")))))


def _numbered(number: Column, down: Column, result: Column) -> Column:
    """One element of an array response."""
    return F.concat(F.lit('{"jsonrpc":"2.0","id":'), number.cast("string"), F.lit(',"result":'), F.when(down, "null").otherwise(F.to_json(result)), F.lit("}"))


def _listed(elements: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(elements, ","), F.lit("]"))


def method_batches(spark: SparkSession, sf_dir: str, size: int = 10, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """first_block, method, body: array responses of ``size`` blocks for one method, in reverse order of ids."""
    numbers = F.reverse(F.array_sort(F.array_distinct(F.transform("own", lambda o: block_of(o["k"])))))
    of = {
        BLOCK_METHOD: lambda b: F.lit(None),
        RECEIPTS_METHOD: lambda b: F.filter("items", lambda i: block_of(i["l_orderkey"]) == b),
        TRACES_METHOD: lambda b: F.filter("events", lambda e: block_of(e["event_id"] - e["event_id"] % 3) == b),
    }

    def body(method: str) -> Column:
        def one(b: Column) -> Column:
            own = F.filter("own", lambda o: block_of(o["k"]) == b)
            return _let(own, lambda own: _numbered((b - F.col("first_block")).cast("int"), failed(b), answer(method, b, own, of[method](b))))

        return _listed(F.transform(numbers, one))

    rows = facts(spark, sf_dir, methods, size).select("*", F.explode(F.array(*map(F.lit, methods))).alias("method"))
    return rows.select("first_block", "method", F.coalesce(*[F.when(F.col("method") == m, body(m)) for m in methods]).alias("body"))


def block_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """block_num, body: array responses of a block's three calls with ids 0, 1, 2."""
    elements = [_numbered(F.lit(i), failed(F.col("block")), _result(m)) for i, m in reversed(list(enumerate(METHODS)))]
    return facts(spark, sf_dir).select(F.col("block").alias("block_num"), _listed(F.array(*elements)).alias("body"))
