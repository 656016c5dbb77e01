"""Reruns, restarts and reports of runs against local nodes."""

import json
import threading
import time
from collections import Counter

import pytest
from test_decode_transform import block, raw, receipt, trace, tx
from test_sources import node  # noqa: F401

from blockweave.operators import sinks, store
from blockweave.plans import historical, verify_run
from blockweave.sources import heads, rpc
from blockweave.streaming import realtime


def chain(numbers, extra=""):
    return {n: (block(n, [tx(0, f"0x{n}{extra}")]), [receipt(0, f"0x{n}{extra}")], [trace(h=f"0x{n}{extra}")]) for n in numbers}


def stored(spark, root, name="blocks"):
    return sorted(r[0] for r in sinks.read_table(spark, root, name).select(sinks.number_of(name)).collect())


@pytest.mark.parametrize("bounds", [[(0, 39, 40)], [(10, 29, 20)], [(38, 39, 1), (0, 20, 9)]])
def test_reruns_with_other_bounds_replace_blocks(spark, tmp_path, monkeypatch, bounds):
    monkeypatch.setattr(sinks, "BUCKET_BLOCKS", 16)
    root = str(tmp_path / "t")
    historical.run(spark, raw(spark, chain(range(40))), root, 0, 39, 13)
    for first, last, size in bounds:
        historical.run(spark, raw(spark, chain(range(40), "f")), root, first, last, size)
    for name in ("blocks", "transactions", "internal_transactions", "block_completions"):
        assert stored(spark, root, name) == list(range(40)), name
    again = {n for first, last, _ in bounds for n in range(first, last + 1)}
    assert {r["block_number"] for r in sinks.read_table(spark, root, "transactions").where("hash like '%f'").collect()} == again
    assert sinks.read_cursor(spark, root) == 39


def test_rows_that_a_rerun_lacks_are_gone_and_failed_blocks_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_BLOCKS", 10)
    root = str(tmp_path / "t")
    historical.run(spark, raw(spark, chain(range(20))), root, 0, 19)
    empty = {n: (block(n), [], []) for n in range(10)} | {n: (None, None, None) for n in range(10, 15)}
    historical.run(spark, raw(spark, empty), root, 0, 14)
    assert stored(spark, root) == list(range(20)) and stored(spark, root, "transactions") == list(range(10, 20))
    sinks.compact(spark, root, "blocks", 0, 19)
    assert stored(spark, root) == list(range(20))


def test_a_range_is_read_from_its_own_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_BLOCKS", 10)
    root = str(tmp_path / "t")
    historical.run(spark, raw(spark, chain(range(50))), root, 0, 49)
    rows = sinks.read_table(spark, root, "block_completions", 12, 28)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket#" in plan
    assert sorted(r["block_number"] for r in rows.collect()) == list(range(12, 29))
    assert {r["f"].split("bucket=")[1][0] for r in rows.selectExpr("input_file_name() as f").collect()} == {"1", "2"}


def test_the_report_and_frames(spark, tmp_path):
    root = str(tmp_path / "t")
    blocks = chain(range(30)) | {7: (None, [], [])}
    assert historical.run(spark, raw(spark, blocks), root, 0, 29, 10) == 3
    (name,) = store.names(spark, f"{root}/reports")
    report = json.loads(open(f"{root}/reports/{name}").read())
    assert (report["total_blocks"], report["missing_blocks"], report["total_batches"], report["rows"]["tx"]) == (29, 1, 3, 29)
    assert report["save_total_ms"] > 0 and len(report["batches"]) == 3 and report["ms_per_block"] > 0
    from blockweave.operators import decode

    sinks.write_batch(decode.decode(decode.assemble(raw(spark, chain(range(30))).coalesce(1))), str(tmp_path / "f"), 0, 29, max_records=4)
    sizes = Counter(r["f"] for r in sinks.read_table(spark, str(tmp_path / "f"), "transactions").selectExpr("input_file_name() as f").collect())
    assert max(sizes.values()) <= 4


def test_the_cursor_is_there_before_and_after(spark, tmp_path):
    root = str(tmp_path / "t")
    assert sinks.read_cursor(spark, root) is None
    for n in (5, 3, 11):
        sinks.write_cursor(spark, root, n)
    assert sinks.read_cursor(spark, root) == 11 and store.names(spark, f"{root}/cursor") == [f"{11:020d}"]
    store.write_text(spark, f"{root}/cursor/{12:020d}", "")  # a crash before the old one was deleted
    assert sinks.read_cursor(spark, root) == 12


def test_every_block_is_asked_for_once(spark, node, tmp_path, monkeypatch):  # noqa: F811
    asked = Counter()

    class Seen:
        def __contains__(self, number):
            asked[number] += 1
            return False

    historical.from_rpc(spark, str(tmp_path / "t"), node(Seen()), 10, 29, batch_blocks=5)
    assert asked == {n: 3 for n in range(10, 30)}


@pytest.mark.parametrize("mode", rpc.FETCH_MODES)
def test_wide_rows_and_bodies_as_sent(spark, node, mode):  # noqa: F811
    url = node({12})
    rows = {r["block_num"]: r for r in rpc.read(spark, url, 10, 14, mode, batch_size=5, wide=True).collect()}
    assert sorted(rows) == [10, 11, 12, 13, 14] and [n for n, r in rows.items() if r["any_failed"]] == [12]
    assert json.loads(rows[10]["block_body"])["jsonrpc"] == "2.0" and rows[10]["fetch_ms"] > 0
    assert realtime.unavailable(rpc.read(spark, url, 10, 14, mode, wide=True)).first()[1] == "eth_getBlockByNumber,eth_getBlockReceipts,trace_block"


def test_array_elements_keep_their_text():
    text = ' [ {"id":1, "result":"a,]"} ,\n[2], null,"x" ]'
    assert [t for _, t in rpc.elements(text)] == ['{"id":1, "result":"a,]"}', "[2]", "null", '"x"']
    with pytest.raises(ValueError):
        list(rpc.elements("[1, 2"))


def live(spark, root, url, first, last, **options):
    query = realtime.live(spark, root, url, first, last, interval="50 milliseconds", patience=0.2, timeout=1, **options)
    end = time.time() + 60
    while (sinks.read_cursor(spark, root) or -1) < last and time.time() < end and query.isActive:
        time.sleep(0.1)
    return query


def test_a_restart_goes_on_and_a_node_that_is_down_changes_nothing(spark, node, tmp_path):  # noqa: F811
    root = str(tmp_path / "t")
    historical.from_rpc(spark, root, node(), 10, 14)
    live(spark, root, node(), 10, 20).stop()
    assert stored(spark, root) == list(range(10, 21)) and sinks.read_cursor(spark, root) == 20
    down = live(spark, root, "http://127.0.0.1:1", 10, 19)
    time.sleep(1.5)
    down.stop()
    assert down.exception() is None and stored(spark, root) == list(range(10, 21))
    asked = set()

    class Seen:
        def __contains__(self, number):
            asked.add(number)
            return False

    live(spark, root, node(Seen()), 10, 25).stop()
    assert stored(spark, root) == list(range(10, 26)) and min(asked) == 21
    found = verify_run.run(spark, root, 10, 25)
    assert found["gaps"].count() == 0 and found["data"].count() == 0


def test_dead_letters_go_when_the_block_comes(spark, node, tmp_path):  # noqa: F811
    root = str(tmp_path / "t")
    live(spark, root, node({12}), 10, 14).stop()
    dead = lambda: [tuple(r) for r in sinks.read_table(spark, root, "dead_letters").collect()]
    assert dead() == [(12, "eth_getBlockByNumber,eth_getBlockReceipts,trace_block")] and stored(spark, root) == [10, 11, 13, 14]
    realtime.process(rpc.read(spark, node(), 11, 13, wide=True), 0, root)
    assert dead() == [] and stored(spark, root) == list(range(10, 15)) and sinks.read_cursor(spark, root) == 14


def test_offsets_never_go_back():
    reader = heads._Reader({"fromBlock": "21", "url": "http://127.0.0.1:1", "maxBlocks": "5"})
    assert reader.latestOffset() == {"block": 20}
    reader.partitions({"block": 20}, {"block": 25})  # a batch made again
    assert reader.latestOffset() == {"block": 25}
    reader.head = 100
    assert reader.latestOffset() == {"block": 30}
    reader.commit({"block": 30})
    assert reader.latestOffset() == {"block": 35}
    push = heads._Reader({"fromBlock": "10", "wsUrl": "ws://127.0.0.1:1/"})
    assert push.latestOffset() == {"block": 9}


def test_a_feed_cut_within_a_frame_is_taken_up_again(monkeypatch):
    import socket

    monkeypatch.setattr(heads, "RECONNECT_S", 0.05)
    monkeypatch.setattr(heads, "SILENCE_S", 0.3)
    server = socket.create_server(("127.0.0.1", 0))
    text = json.dumps({"params": {"result": {"number": "0x7"}}}).encode()
    frames = [b"\x81", b"\x81\x7e\x01", None, bytes([0x81, len(text)]) + text]  # cut, cut in the size, silent, whole

    def serve():
        for data in frames:
            sock, _ = server.accept()
            sock.recv(4000)
            sock.sendall(b"HTTP/1.1 101 Switching Protocols\r\n\r\n")
            if data:
                sock.sendall(data)
                time.sleep(0.2)
                sock.close()
            else:
                time.sleep(1)

    threading.Thread(target=serve, daemon=True).start()
    listener = heads.Listener(f"ws://127.0.0.1:{server.getsockname()[1]}/feed")
    end = time.time() + 20
    while listener.head != 7 and time.time() < end:
        time.sleep(0.05)
    assert listener.head == 7


def test_percentiles_by_parts(spark, monkeypatch):
    from blockweave.operators import metrics

    monkeypatch.setattr(metrics, "PARTS", 4)
    rows = [(k, float((i * 7919) % 101 % (10 if k == "b" else 101))) for k, n in (("a", 1), ("b", 57), ("c", 1000), (None, 3)) for i in range(n)] + [("a", None)]
    got = {r["k"]: tuple(r)[1:] for r in metrics.percentiles(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    for k in ("a", "b", "c", None):
        v = sorted(x for key, x in rows if key == k and x is not None)
        assert got[k] == (len(v), *[v[min(len(v) * p // 100, len(v) - 1)] for p in (50, 95, 99)])
