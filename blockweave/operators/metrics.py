"""Run metrics."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockweave.operators import sinks, store


def _per(total: Column, n: Column) -> Column:
    return F.coalesce(total / F.nullif(n, F.lit(0)), F.lit(0.0))


def summary(blocks: DataFrame, batches: DataFrame) -> DataFrame:
    """One row for a run: averages are per complete block, 0 if there is none; rows don't count the address table and markers."""
    http = (F.col("http_block_ms") + F.col("http_rcpt_ms") + F.col("http_trc_ms")) / 3
    b = blocks.agg(
        F.count("*").alias("total_blocks"),
        _per(F.sum("fbdr_ms"), F.count("*")).alias("fbdr_avg"),
        F.coalesce(F.max("fbdr_ms"), F.lit(0.0)).alias("fbdr_max"),
        _per(F.sum(http), F.count("*")).alias("http_avg"),
    )
    rows = F.col("blocks") + F.col("txs") + F.col("logs") + F.col("internal_txs") + F.col("contracts")
    t = batches.agg(F.count("*").alias("total_batches"), F.coalesce(F.sum("tpt_ms"), F.lit(0.0)).alias("tpt_total"), F.coalesce(F.sum("save_ms"), F.lit(0.0)).alias("save_total"), F.coalesce(F.sum(rows), F.lit(0)).alias("total_rows"))
    return b.crossJoin(t).withColumn("tpt_avg", _per(F.col("tpt_total"), F.col("total_blocks")))


def phases(durations: DataFrame, phase: str = "phase", ms: str = "ms") -> DataFrame:
    """n, sum, min, max and average of each phase."""
    return durations.groupBy(phase).agg(F.count(ms).alias("n"), F.sum(ms).alias("sum_ms"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.avg(ms).alias("avg_ms"))


#: Parts that a key's values are split into for its percentiles.
PARTS = 64


def percentiles(durations: DataFrame, key: str, value: str, points=(50, 95, 99)) -> DataFrame:
    """The value at place ``n * p div 100`` of the sorted values, for each key, exactly.

    Equal values are counted before the shuffle.  An approximate sketch, whose size is bounded, splits each key's values into parts;
    exact numbers of the parts say which part holds a place, and only those parts' values are put in order, a part in a
    task.  How good the sketch is changes the sizes of the parts alone.
    """
    rows = durations.where(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).alias("v"))
    counted = rows.groupBy("k", "v").agg(F.count("*").alias("c"))
    cuts = rows.groupBy(F.col("k").alias("of")).agg(F.percentile_approx("v", [i / PARTS for i in range(1, PARTS)], 10_000).alias("cuts"))
    placed = counted.join(cuts, F.col("k").eqNullSafe(F.col("of"))).select("k", "v", "c", F.size(F.filter("cuts", lambda x: x < F.col("v"))).alias("part"))
    by_part = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = placed.groupBy("k", "part").agg(F.sum("c").alias("held")).withColumn("upto", F.sum("held").over(by_part)).withColumn("n", F.sum("held").over(Window.partitionBy("k")))
    place = {p: F.least(F.floor(F.col("n") * p / 100), F.col("n") - 1) for p in points}
    asked = F.array(*[F.struct(F.lit(p).alias("p"), place[p].alias("at")) for p in points])
    asked = parts.select("k", "part", "n", (F.col("upto") - F.col("held")).alias("before"), "upto", F.explode(asked).alias("x")).where("x.at >= before and x.at < upto")
    asked = asked.select(F.col("k").alias("of"), F.col("part").alias("in"), "n", "x.p", (F.col("x.at") - F.col("before")).alias("rest"))
    within = Window.partitionBy("of", "p").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.join(asked, F.col("k").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).withColumn("seen", F.sum("c").over(within)).where("seen > rest")
    return found.groupBy(F.col("of").alias(key)).agg(F.max("n").alias("n"), *[F.min(F.when(F.col("p") == p, F.col("v"))).alias(f"p{p}") for p in points])


def throughput(batches: DataFrame, rows: str, ms: str, blocks: str) -> DataFrame:
    total = batches.agg(F.sum(rows).alias("rows"), F.sum(ms).alias("ms"), F.sum(blocks).alias("blocks"))
    return total.select("rows", "blocks", _per(F.col("rows") * 1000.0, F.col("ms")).alias("rows_per_s"), _per(F.col("ms"), F.col("blocks")).alias("ms_per_block"))


def report(spark: SparkSession, root: str, batches: list[dict], first: int, last: int) -> dict:
    """Figures of a run over the blocks from first to last: its batches' timings, and rows as the markers count them."""
    done = sinks.read_table(spark, root, "block_completions", first, last)
    counts = ("tx_count", "log_count", "itx_count", "contract_count")
    stored = done.agg(F.count("*").alias("blocks"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).first()
    fetched = [b for b in batches if b.get("fbdr_avg") is not None]
    total = sum(b["total_ms"] for b in batches)
    rows = stored["blocks"] + sum(stored[c] for c in counts)
    return {
        "from_block": first,
        "to_block": last,
        "total_blocks": stored["blocks"],
        "missing_blocks": last - first + 1 - stored["blocks"],
        "total_batches": len(batches),
        "rows": {"blocks": stored["blocks"], **{c.removesuffix("_count"): stored[c] for c in counts}, "total": rows},
        "fbdr_avg_ms": sum(b["fbdr_avg"] for b in fetched) / len(fetched) if fetched else 0.0,
        "fbdr_max_ms": max((b["fbdr_max"] for b in fetched), default=0.0),
        "tpt_total_ms": sum(b["tpt_ms"] for b in batches),
        "save_total_ms": sum(b["save_ms"] for b in batches),
        "total_ms": total,
        "ms_per_block": total / stored["blocks"] if stored["blocks"] else 0.0,
        "rows_per_s": 1000 * rows / total if total else 0.0,
        "batches": batches,
    }


def write_report(spark: SparkSession, root: str, batches: list[dict], first: int, last: int) -> str:
    """Stores a run's report as JSON beside the tables and returns its path."""
    path = f"{root}/reports/{time.time_ns():020d}-{first}-{last}.json"
    store.write_text(spark, path, json.dumps(report(spark, root, batches, first, last), indent=1))
    return path
