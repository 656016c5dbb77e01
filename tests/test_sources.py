"""Data sources against local servers and files."""

import base64
import hashlib
import io
import json
import socket
import struct
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from blockweave.operators import decode, sinks, transform
from blockweave.plans import historical
from blockweave.schemas import METHODS
from blockweave.sources import dump, heads, rpc
from blockweave.streaming import realtime


def answer(call, missing):
    number = int(call["params"][0], 16) if call["params"] else 0
    if call["method"] == "eth_blockNumber":
        result = hex(29)
    elif number in missing:
        result = None
    elif call["method"] == "eth_getBlockByNumber":
        result = {"number": call["params"][0], "timestamp": "0x1", "miner": "0xM", "transactions": []}
    else:
        result = []
    return {"jsonrpc": "2.0", "id": call["id"], "result": result}


@pytest.fixture
def node():
    servers = []

    def start(missing=()):
        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                payload = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                out = [answer(c, missing) for c in reversed(payload)] if isinstance(payload, list) else answer(payload, missing)
                body = json.dumps(out).encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        servers.append(server)
        return f"http://127.0.0.1:{server.server_port}"

    yield start
    for server in servers:
        server.shutdown()


@pytest.mark.parametrize("mode", rpc.FETCH_MODES)
def test_fetch_modes_and_reserve(spark, node, mode):
    raw = rpc.read(spark, node({12, 15}), 10, 29, mode, node({15}), batch_size=7)
    blocks = transform.blocks(decode.decode(decode.assemble(raw)))
    assert sorted(r["number"] for r in blocks.collect()) == [n for n in range(10, 30) if n != 15]
    assert raw.count() == 60


def test_unknown_fetch_mode():
    with pytest.raises(ValueError):
        rpc._Reader({"url": "", "fromBlock": "0", "toBlock": "1", "fetchMode": "3"})


def test_historical_run_resumes_after_the_cursor(spark, node, tmp_path):
    root = str(tmp_path / "t")
    assert historical.from_rpc(spark, root, node(), 10, 19, batch_blocks=5) == 2
    assert historical.from_rpc(spark, root, node(), 10, 24, batch_blocks=5) == 1
    assert sinks.read_table(spark, root, "blocks").count() == 15 and sinks.read_cursor(spark, root) == 24


def test_polled_stream(spark, node, tmp_path):
    url, root = node({21}), str(tmp_path / "t")
    query = realtime.run(realtime.from_node(spark, url, 20, 27), root)
    query.awaitTermination(60)
    query.stop()
    assert sorted(r["number"] for r in sinks.read_table(spark, root, "blocks").collect()) == [n for n in range(20, 28) if n != 21]


class Late:
    """Blocks that a node has only after it was asked for them some times."""

    def __init__(self, numbers, times):
        self.left = dict.fromkeys(numbers, times)

    def __contains__(self, number):
        self.left[number] = self.left.get(number, 0) - 1
        return self.left[number] >= 0


def failed(rows):
    return {r[0] for r in rows if r[3]}


@pytest.mark.parametrize("mode", rpc.FETCH_MODES)
def test_a_late_block_is_fetched_again(node, mode):
    url = node(Late({21}, 7))  # two rounds of three calls, and one response of the third
    assert failed(rpc.fetch_with_reserve(url, None, [20, 21, 22], mode)) == {21}
    rows = rpc.fetch_with_reserve(url, None, [20, 21, 22], mode, patience=10)
    assert not failed(rows) and sorted((r[0], r[1]) for r in rows) == sorted((b, m) for b in (20, 21, 22) for m in METHODS)
    rows = rpc.fetch_with_reserve(node(Late({21, 22}, 4)), node({21}), [20, 21, 22], mode, patience=10)
    assert not failed(rows) and len(rows) == 9


def test_patience_ends(node):
    begin = time.time()
    assert failed(rpc.fetch_with_reserve(node({21}), node({21}), [20, 21], 0, patience=0.5)) == {21}
    assert time.time() - begin < 5


def test_a_stream_waits_for_late_blocks(spark, node, tmp_path):
    root = str(tmp_path / "t")
    query = realtime.run(realtime.from_node(spark, node(Late({20, 21, 27}, 8)), 20, 27), root)
    assert query.awaitTermination(60)
    assert sorted(r["number"] for r in sinks.read_table(spark, root, "blocks").collect()) == list(range(20, 28))
    assert spark.read.schema("block_num LONG, methods STRING").parquet(f"{root}/dead_letters").count() == 0


def test_pushed_heads():
    server = socket.create_server(("127.0.0.1", 0))

    def serve():
        sock, _ = server.accept()
        head = b""
        while b"\r\n\r\n" not in head:
            head += sock.recv(1000)
        key = [x for x in head.decode().split("\r\n") if x.lower().startswith("sec-websocket-key")][0].split(": ")[1]
        accept = base64.b64encode(hashlib.sha1((key + "258EAFA5-E914-47DA-95CA-C5AB0DC85B11").encode()).digest()).decode()
        sock.sendall(f"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: {accept}\r\n\r\n".encode())
        sock.recv(1000)
        for text in ('{"id":1,"result":"0x1"}', *(json.dumps({"params": {"result": {"number": n}, "pad": "x" * 200}}) for n in ("0x5", "0x9", "0x7", "0xzz"))):
            data = text.encode()
            sock.sendall(b"\x81" + (bytes([len(data)]) if len(data) < 126 else b"\x7e" + struct.pack(">H", len(data))) + data)
        sock.sendall(b"\x89\x01p")
        time.sleep(2)

    threading.Thread(target=serve, daemon=True).start()
    reader = heads._Reader({"fromBlock": "3", "toBlock": "8", "wsUrl": f"ws://127.0.0.1:{server.getsockname()[1]}/feed"})
    end = time.time() + 10
    while reader.latestOffset()["block"] < 8 and time.time() < end:
        time.sleep(0.05)
    assert reader.latestOffset() == {"block": 8}
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [r[0] for p in parts for r in reader.read(p)] == [3, 4, 5, 6, 7, 8]


def test_dump_frames():
    rows = [(0, [b"\0\0\0\1", None, b""]), (5, [b"text"])]
    data = dump.MAGIC + dump.encode(7, rows) + dump.encode(8, [])
    assert list(dump.decode(io.BytesIO(data))) == [(7, t, v) for t, v in rows]
    assert data[6:16] == b"\xff\x00" + struct.pack(">II", 7, 2)
    with pytest.raises(ValueError):
        list(dump.decode(io.BytesIO(b"nothing")))
    with pytest.raises(ValueError):
        list(dump.decode(io.BytesIO(data[:-18])))


def test_dump_files_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(b, t, [bytes([b]), None]) for b in range(5) for t in range(3)], dump.SCHEMA)
    for _ in range(2):
        dump.write(rows, str(tmp_path / "d"))
    key = lambda df: sorted((r["batch_id"], r["table_id"], [v and bytes(v) for v in r["vals"]]) for r in df.collect())
    assert key(dump.read(spark, str(tmp_path / "d"))) == key(rows)
    assert dump.merged(rows, 2).select("batch_id").distinct().count() == 3
