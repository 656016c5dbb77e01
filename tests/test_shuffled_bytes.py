"""Queries over the bridged tables shuffle rows of these tables, not the answers that are made of them."""

import pytest

from blockweave import queries
from blockweave.operators import decode

SF = "/root/testdata/sf0.001"
#: Findings' numbers and queries; bodies in shuffles take several times as much of each row of the tables.
QUERIES = [
    "block_completions", "blocks", "cba_latest", "completed_blocks_only", "completions_ordered", "completions_range_scan", "contracts", "contracts_by_addresses", "cursor_start", "dump_merge_batches", "fn_milli_fallback",
    "fn_uint256_sum", "json_batch_by_id", "json_block", "json_block_batch", "json_envelope", "json_log", "json_receipt", "json_trace", "json_tx", "log_rest_topics", "log_topics", "logs", "retry_coalesce",
]
BYTES_A_ROW = 200


def _shuffled(node) -> int:
    """Bytes that a plan's exchanges took in, as it ran."""
    kind = node.nodeName()
    if kind == "AdaptiveSparkPlan":
        return _shuffled(node.executedPlan())
    if kind.endswith("QueryStage"):
        return _shuffled(node.plan())
    own = node.metrics().apply("dataSize").value() if kind == "Exchange" else 0
    return own + sum(_shuffled(node.children().apply(i)) for i in range(node.children().size()))


@pytest.mark.parametrize("name", QUERIES)
def test_only_rows_of_the_tables_shuffle(spark, name):
    df = queries.QUERIES[name](spark, SF)
    df.collect()
    rows = sum(spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("orders", "lineitem", "events"))
    assert _shuffled(df._jdf.queryExecution().executedPlan()) < BYTES_A_ROW * rows


def test_range_scan_shuffles_the_rows_of_its_range_alone(spark):
    whole, part = queries.QUERIES["block_completions"](spark, SF), queries.QUERIES["completions_range_scan"](spark, SF)
    assert 0 < len(part.collect()) < 0.6 * len(whole.collect())
    own, all_rows = (_shuffled(df._jdf.queryExecution().executedPlan()) for df in (part, whole))
    assert 0 < own < 0.6 * all_rows


def test_array_responses_are_routed_within_their_row(spark):
    body = '[{"id":1,"result":null},{"id":1,"result":{"number":"0x1"}},{"id":-1,"result":{}},{"id":0,"result":{"number":"0x0"}},{"id":1,"result":{"number":"0x2"}}]'
    df = decode.method_batch(spark.createDataFrame([(20, "m", body), (30, "m", None)], "first_block long, method string, body string"))
    assert sorted((r["block_num"], r["failed"], r["body"]) for r in df.collect()) == [(20, False, '{"result":{"number":"0x0"}}'), (21, False, '{"result":{"number":"0x1"}}')]
    assert _shuffled(df._jdf.queryExecution().executedPlan()) == 0


def test_wide_block_batch_fails_as_one(spark):
    body = '[{"id":2,"result":[]},{"id":0,"result":{"number":"0x7"}}]'
    (row,) = decode.block_batch(spark.createDataFrame([(7, body)], "block_num long, body string"), wide=True).collect()
    assert (row["block_num"], row["block_body"], row["receipts_body"], row["traces_body"], row["any_failed"]) == (7, '{"result":{"number":"0x7"}}', None, '{"result":[]}', True)


@pytest.mark.parametrize("name", ["blocks", "cba_latest", "completions_range_scan", "json_block_batch", "log_topics"])
def test_bodies_are_parsed_once(spark, name):
    """A filter on complete blocks below the parsing parses all three bodies for itself."""
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(result,") == 3
