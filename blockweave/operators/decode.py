"""Decoding of raw bodies, and assembly of a block's three responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockweave.functions.hexnum import hex_to_i64_or_null
from blockweave.schemas import BLOCK_METHOD, METHODS, RECEIPTS_METHOD, RESULT, TRACES_METHOD

FIELDS = {BLOCK_METHOD: "block", RECEIPTS_METHOD: "receipts", TRACES_METHOD: "traces"}


def result(body: Column | str, method: str) -> Column:
    """The typed result; null if missing, null or unreadable.  The explicit schema skips unknown fields, and Catalyst prunes those not used."""
    return F.from_json(body, f"result {RESULT[method]}")["result"]


def assemble(raw: DataFrame) -> DataFrame:
    """block_num, the three bodies and any_failed, one row a block, from rows of a response each.

    One shuffle of the bodies by block; sources that have a block's responses together give this form themselves.
    """
    if "block_body" in raw.columns:
        return raw
    body = [F.max(F.when((F.col("method") == m) & ~F.col("failed"), F.col("body"))).alias(f"{FIELDS[m]}_body") for m in METHODS]
    return raw.groupBy("block_num").agg(*body, F.max("failed").alias("any_failed"))


def decode(assembled: DataFrame) -> DataFrame:
    """block_num, block, receipts, traces and err: a block is in error if a call failed or a result is null; also fetch_ms if it is there.

    The generator keeps the filter on err above the parsed results: below, Catalyst would parse all three bodies a second time for it.
    """
    more = [c for c in ("fetch_ms",) if c in assembled.columns]
    results = F.struct(*[result(f"{FIELDS[m]}_body", m).alias(FIELDS[m]) for m in METHODS])
    typed = assembled.select("block_num", "any_failed", *more, F.inline_outer(F.array(results)))
    missing = F.col("block").isNull() | F.col("receipts").isNull() | F.col("traces").isNull()
    return typed.select("block_num", "block", "receipts", "traces", (F.col("any_failed") | missing).alias("err"), *more)


def valid(decoded: DataFrame) -> DataFrame:
    """Complete blocks; filtered before anything is exploded."""
    return decoded.where(~F.col("err"))


def _body(result: Column) -> Column:
    return F.when(result.isNotNull(), F.concat(F.lit('{"result":'), result, F.lit("}")))


def _of_id(items: str, i: Column | int) -> Column:
    """The first result of an id in an array response."""
    return F.get(F.filter(items, lambda x: (x["id"] == i) & x["result"].isNotNull()), F.lit(0))["result"]


def method_batch(bodies: DataFrame) -> DataFrame:
    """Array responses of one method, one a row, routed by id: raw rows; within a row, without a shuffle.

    The id is the block's place in its batch, in any order; the first of equal ids counts.
    """
    items = F.from_json("body", "array<struct<id:int, result:string>>")
    ids = F.array_distinct(F.filter(F.transform("items", lambda x: x["id"]), lambda i: i >= 0))
    routed = F.transform(ids, lambda i: F.struct(i.alias("id"), _of_id("items", i).alias("result")))
    row = bodies.select("first_block", "method", items.alias("items")).select("first_block", "method", F.explode(routed).alias("x"))
    return row.select((F.col("first_block") + F.col("x.id")).alias("block_num"), "method", _body(F.col("x.result")).alias("body"), F.col("x.result").isNull().alias("failed"))


def block_batch(bodies: DataFrame, wide: bool = False) -> DataFrame:
    """Array responses of a block's three calls, ids 0, 1, 2, as raw rows, or ``wide`` as one row a block; within a row, without a shuffle."""
    items = F.from_json("body", "array<struct<id:int, result:string>>")

    def pick(i: int) -> Column:
        return F.get(F.filter("items", lambda x: x["id"] == i), F.lit(0))["result"]

    held = bodies.select("block_num", items.alias("items"))
    if wide:
        whole = F.struct(*[_body(pick(i)).alias(f"{FIELDS[m]}_body") for i, m in enumerate(METHODS)])
        rows = held.select("block_num", F.inline_outer(F.array(whole)))
        return rows.withColumn("any_failed", F.greatest(*[F.col(f"{FIELDS[m]}_body").isNull() for m in METHODS]))
    parts = F.array(*[F.struct(F.lit(m).alias("method"), pick(i).alias("result")) for i, m in enumerate(METHODS)])
    rows = held.select("block_num", F.explode(parts).alias("x"))
    return rows.select("block_num", "x.method", _body(F.col("x.result")).alias("body"), F.col("x.result").isNull().alias("failed"))


def head_number(event: Column | str) -> Column:
    """Block number of a newHeads event; null if there is none."""
    return hex_to_i64_or_null(F.get_json_object(event, "$.params.result.number"))


def retry(primary: DataFrame, reserve: DataFrame) -> DataFrame:
    """Raw rows in which the reserve's answers replace all three of a failed block's; blocks the reserve lacks stay failed."""
    down = primary.where("failed").select("block_num").distinct()
    again = reserve.join(down, "block_num", "left_semi").select("block_num", "method", F.col("body").alias("r_body"), F.col("failed").alias("r_failed"))
    joined = primary.join(again, ["block_num", "method"], "left")
    taken = F.col("r_failed").isNotNull()
    return joined.select("block_num", "method", F.when(taken, F.col("r_body")).otherwise(F.col("body")).alias("body"), F.when(taken, F.col("r_failed")).otherwise(F.col("failed")).alias("failed"))
