"""Hand-written responses: framings, quirks and edge cases."""

import json

from blockweave.operators import completions, decode, sinks, transform, verify
from blockweave.plans import historical, verify_run
from blockweave.schemas import METHODS, RAW
from blockweave.streaming import realtime


def block(number, txs=(), **more):
    return {"number": hex(number), "timestamp": "0x64", "miner": "0xAB", "transactions": list(txs), "other": 1, **more}


def tx(i, h, **more):
    return {"hash": h, "transactionIndex": hex(i), "from": "0xFA", "to": None, "value": "0x1", "gas": "0x5", "gasPrice": "0x6", "input": "0xABCDEF1234", "type": "0x2", **more}


def receipt(i, h, logs=()):
    return {"transactionHash": h, "transactionIndex": hex(i), "gasUsed": "0x7", "cumulativeGasUsed": "0x8", "status": "0x1", "logs": list(logs)}


def raw(spark, blocks):
    """blocks: number -> (block, receipts, traces); None is a failed call."""
    rows = []
    for number, parts in blocks.items():
        for method, part in zip(METHODS, parts, strict=True):
            rows.append((number, method, None if part is None else json.dumps({"jsonrpc": "2.0", "id": 1, "result": part}), part is None))
    return spark.createDataFrame(rows, RAW)


def decoded(spark, blocks):
    return decode.decode(decode.assemble(raw(spark, blocks)))


def test_envelopes(spark):
    rows = [(1, METHODS[1], '{"result":null}'), (2, METHODS[1], '{"error":{"code":1}}'), (3, METHODS[1], '{"result":[]}'), (4, METHODS[1], "broken")]
    df = spark.createDataFrame(rows, "n int, m string, body string")
    got = {r["n"]: r["r"] for r in df.select("n", decode.result("body", METHODS[1]).alias("r")).collect()}
    assert got == {1: None, 2: None, 3: [], 4: None}


def test_incomplete_blocks_are_dropped(spark):
    df = decoded(spark, {1: (block(1), [], []), 2: (block(2), None, []), 3: (None, [], []), 4: (block(4), [], None)})
    assert [r["number"] for r in transform.blocks(df).collect()] == [1]


def test_receipts_pair_by_place_and_the_shorter_list_counts(spark):
    txs = [tx(0, "0xA0"), tx(1, "0xA1"), tx(2, "0xA2")]
    df = decoded(spark, {1: (block(1, txs), [receipt(0, "0xZZ"), receipt(1, "0xA1")], []), 2: (block(2, txs[:1]), [receipt(0, "0xA0"), receipt(1, "0xA1")], [])})
    rows = transform.transactions(df).orderBy("block_number", "transaction_index").collect()
    assert [(r["block_number"], r["hash"]) for r in rows] == [(1, "0xa0"), (1, "0xa1"), (2, "0xa0")]
    assert rows[0]["to_address"] is None and rows[0]["max_fee_per_gas"] == 0 and rows[0]["method_id"] == "0xabcdef12"


def trace(h="0xA0", frm="0xFA", value="0x1", result=None, **more):
    return {"transactionHash": h, "action": {"from": frm, "to": None, "value": value, **more}, "result": result}


def test_traces(spark):
    made = {"address": "0xCC", "code": None}
    traces = [trace(h=None), trace(h="0xunknown"), trace(frm=""), trace(value=None), trace(), trace(result=made), trace(frm="0xFB", result=made, init="", input="0x9", creationMethod="create2")]
    df = decoded(spark, {1: (block(1, [tx(0, "0xA0")]), [receipt(0, "0xA0")], traces)})
    itx = transform.internal_transactions(df).orderBy("trace_index").collect()
    assert [r["trace_index"] for r in itx] == [4, 5, 6] and itx[0]["to_address"] == ""
    made = transform.contracts(df).orderBy("trace_index").collect()
    assert [(r["trace_index"], r["address"], r["contract_factory"], r["creation_bytecode"], r["deployed_bytecode"], r["creation_method"]) for r in made] == [(5, "0xcc", None, "0x", "0x", 99), (6, "0xcc", "0xfb", "0x", "0x", 1)]
    assert [r["tx_hash"] for r in transform.latest_by_address(transform.contracts(df)).collect()] == ["0xa0"]


def test_equal_hashes_take_the_last_and_positions_only_stand_in(spark):
    txs = [tx(0, "0xA0"), tx(1, "0xA0"), tx(2, "0xA2")]
    traces = [trace(), {**trace(h=None), "transactionPosition": 2}, {**trace(h=None), "transactionPosition": "0x1"}, {**trace(h=None), "transactionPosition": 3}, {**trace(h="0xA2"), "transactionPosition": 0}]
    df = decoded(spark, {5: (block(5, txs), [receipt(i, "0x") for i in range(3)], traces)})
    rows = transform.internal_transactions(df).orderBy("trace_index").collect()
    assert [(r["trace_index"], r["transaction_index"]) for r in rows] == [(0, 1), (1, 2), (2, 1), (4, 2)]


def test_unreadable_quantities_go_to_quarantine(spark):
    df = decoded(spark, {1: (block(1, [tx(0, "0xA0", value="0xg1"), tx(1, "0xA1", value="0x" + "f" * 64)]), [receipt(0, "0xA0"), receipt(1, "0xA1")], [])})
    assert {r["place"] for r in transform.quarantine(df).collect()} == {0, 1}
    assert transform.transactions(df).count() == 2


def test_array_responses(spark):
    items = [{"id": 2, "result": block(12)}, {"id": 0, "result": block(10)}, {"id": 1, "result": None}]
    df = spark.createDataFrame([(10, METHODS[0], json.dumps(items))], "first_block long, method string, body string")
    rows = {r["block_num"]: r["failed"] for r in decode.method_batch(df).collect()}
    assert rows == {10: False, 11: True, 12: False}
    one = [{"id": 2, "result": []}, {"id": 0, "result": block(7)}]
    df = spark.createDataFrame([(7, json.dumps(one))], "block_num long, body string")
    assert {r["method"]: r["failed"] for r in decode.block_batch(df).collect()} == {METHODS[0]: False, METHODS[1]: True, METHODS[2]: False}


def test_reserve_replaces_failed_blocks_only(spark):
    primary = raw(spark, {1: (block(1), [], []), 2: (block(2), None, []), 3: (None, None, None)})
    reserve = raw(spark, {1: (None, None, None), 2: (block(2), [], []), 3: (block(3), None, [])})
    df = decode.decode(decode.assemble(decode.retry(primary, reserve)))
    assert sorted(r["number"] for r in transform.blocks(df).collect()) == [1, 2]


def test_runs_leave_gaps_and_repeat_without_change(spark, tmp_path):
    blocks = {n: (block(n, [tx(0, f"0x{n}")]), [receipt(0, f"0x{n}", [])], [trace(h=f"0x{n}")]) for n in range(100, 140)}
    for n in (100, 117, 139):
        blocks[n] = (None, [], [])
    root = str(tmp_path / "t")
    for _ in range(2):
        historical.run(spark, raw(spark, blocks), root, 100, 139, 16, chunk_size=10)
        counts = {r["table_name"]: r["n_rows"] for r in sinks.row_counts(spark, root).collect()}
        assert counts == {"blocks": 37, "transactions": 37, "logs": 0, "internal_transactions": 37, "contracts": 0, "contracts_by_addresses": 0, "block_completions": 37}
    assert sinks.read_cursor(spark, root) == 139
    found = verify_run.run(spark, root, 100, 139, chunk_size=10)
    assert sorted(r["block_number"] for r in found["gaps"].collect()) == [100, 117, 139]
    assert [r["missing_total"] for r in found["report"].collect()] == [3, 3, 3]
    assert found["data"].count() == 0
    assert {r["chunk"]: r["complete"] for r in found["chunks"].collect()} == {10: False, 11: False, 12: True, 13: False}


def test_report_lists_thirty_of_all(spark):
    markers = spark.createDataFrame([], "chunk int, block_number long")
    rows = verify.report(verify.gaps(spark, markers, 0, 99, 10)).collect()
    assert [r["block_number"] for r in rows] == list(range(30)) and rows[0]["missing_total"] == 100


def test_markers_agree_with_tables(spark):
    logs = [{"address": "0x1", "topics": [], "data": "0x", "transactionHash": "0xA0", "transactionIndex": "0x0", "logIndex": "0x0", "removed": False}]
    df = decoded(spark, {1: (block(1, [tx(0, "0xA0")]), [receipt(0, "0xA0", logs)], [trace(result={"address": "0xCC", "code": "0x1"})]), 2: (block(2), [], [])})
    key = lambda rows: sorted(tuple(r[c] for c in ("block_number", "tx_count", "log_count", "itx_count", "contract_count")) for r in rows)
    assert key(completions.markers(df).collect()) == key(completions.from_tables(transform.entities(df)).collect()) == [(1, 1, 1, 1, 1), (2, 0, 0, 0, 0)]


def test_stream_equals_batch(spark, tmp_path):
    blocks = {n: (block(n, [tx(0, f"0x{n}")]), [receipt(0, f"0x{n}")], []) for n in range(20)}
    blocks[3] = (None, None, [])
    for i in range(4):
        raw(spark, {n: blocks[n] for n in range(i * 5, i * 5 + 5)}).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    root = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        realtime.run(realtime.from_files(spark, str(tmp_path / "in")), root).awaitTermination()
    got = sorted(r["block_number"] for r in sinks.read_table(spark, root, "block_completions").collect())
    assert got == [n for n in range(20) if n != 3]
    assert [r["block_num"] for r in spark.read.parquet(f"{root}/dead_letters").collect()] == [3]


def test_heads(spark):
    heads = spark.createDataFrame([(5,), (7,), (7,), (6,), (10,), (12,)], "block_num long")
    assert sorted(r[0] for r in realtime.heads_to_process(heads, 5, 10).collect()) == [6, 7, 10]
    assert sorted(r[0] for r in realtime.fill_heads(heads, 5, 10).collect()) == [6, 7, 8, 9, 10]
