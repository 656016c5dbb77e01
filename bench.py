"""Times the headline queries and prints one JSON line.

The raw responses are made from the test tables once and stored as the RPC source gives them, a block's three answers in a row, by
ranges of blocks; what is timed reads them as a run reads a node's answers.
``historical_batch`` writes all six tables and the markers, the work the published ms-per-block figures describe.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    work = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from blockweave import queries as engine
    from blockweave.operators import completions, decode, sinks, transform, verify
    from blockweave.plans import historical
    from blockweave.schemas import WIDE
    from blockweave.sources import bridge

    wide = decode.assemble(bridge.raw(spark, SF_DIR)).withColumn("fetch_ms", F.lit(0.0))
    wide.repartitionByRange(4 * int(CPUS), "block_num").write.parquet(f"{work}/raw")
    raw = spark.read.schema(WIDE).parquet(f"{work}/raw")
    decoded = decode.decode(decode.assemble(raw))
    first, last = engine._range(spark, SF_DIR)
    stored = f"{work}/tables"

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    runs = {
        "blocks": lambda: noop(transform.blocks(decoded)),
        "transactions": lambda: noop(transform.transactions(decoded)),
        "logs": lambda: noop(transform.logs(decoded)),
        "internal_transactions": lambda: noop(transform.internal_transactions(decoded)),
        "contracts": lambda: noop(transform.contracts(decoded)),
        "cba_latest": lambda: noop(transform.latest_by_address(transform.contracts(decoded))),
        "block_completions": lambda: noop(completions.markers(decoded)),
        "historical_batch": lambda: historical.run(spark, raw, stored, first, last),
        "verify_gaps_linear": lambda: noop(verify.gaps(spark, sinks.read_table(spark, stored, "block_completions", first, last), first, last)),
        "verify_chunk_counts": lambda: noop(verify.chunk_counts(spark, sinks.read_table(spark, stored, "block_completions", first, last), first, last)),
        "latency_percentiles": lambda: noop(engine.QUERIES["latency_percentiles"](spark, SF_DIR)),
        "metrics_summary": lambda: noop(engine.QUERIES["metrics_summary"](spark, SF_DIR)),
        "tx_per_block": lambda: noop(engine.per_block(decoded)),
    }
    seconds = {}
    for name, run in runs.items():
        best = []
        for _ in range(3):
            if name == "historical_batch":
                shutil.rmtree(stored, ignore_errors=True)
            began = time.perf_counter()
            run()
            best.append(time.perf_counter() - began)
        seconds[name] = round(min(best), 3)
    rows = sum(r["n_rows"] for r in sinks.row_counts(spark, stored).collect())
    blocks = spark.read.parquet(f"{stored}/blocks").count()
    batch = seconds["historical_batch"]
    result = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}
    result["historical"] = {"rows": rows, "blocks": blocks, "rows_per_sec": round(rows / batch), "ms_per_block": round(1000 * batch / max(1, blocks), 3)}
    spark.stop()
    shutil.rmtree(work, ignore_errors=True)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
