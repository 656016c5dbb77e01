"""New heads as a stream of block numbers: a Python streaming data source that polls a node or listens to its push feed.

The offset is the last block handed out, so heads that repeat or arrive out of order change nothing, and a jump of
several blocks is filled from the last one on.

Spark doesn't tell a restarted reader where its checkpoint stands, and takes a lower offset for new blocks.  So ``fromBlock`` of a
restart must be the block after the last one stored (``realtime.live`` takes it from the cursor): the reader never answers less, and
a batch that Spark makes again raises it to that batch's end.
"""

from __future__ import annotations

import base64
import json
import os
import socket
import struct
import threading
import time
import urllib.request
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


#: Seconds before a broken feed is taken up again; seconds of silence after which it is asked for a sign of life, and
#: after as many again given up.
RECONNECT_S, SILENCE_S = 1.0, 20.0


def polled_head(url: str, timeout: float = 10.0) -> int | None:
    payload = json.dumps({"jsonrpc": "2.0", "id": 1, "method": "eth_blockNumber", "params": []}).encode()
    try:
        with urllib.request.urlopen(urllib.request.Request(url, payload, {"Content-Type": "application/json"}), timeout=timeout) as answer:
            return int(json.loads(answer.read())["result"], 16)
    except (OSError, ValueError, KeyError, TypeError):
        return None


def pushed_number(message: str) -> int | None:
    """The block number of a newHeads notification."""
    try:
        return int(json.loads(message)["params"]["result"]["number"], 16)
    except (ValueError, KeyError, TypeError):
        return None


class Listener:
    """Keeps the highest head that a WebSocket subscription has announced."""

    def __init__(self, url: str):
        self.url, self.head, self.error = url, None, None
        threading.Thread(target=self._run, daemon=True).start()

    def _frame(self, sock, data: bytes, code: int = 1) -> None:
        mask = os.urandom(4)
        size = len(data)
        head = bytes([0x80 | code]) + (bytes([0x80 | size]) if size < 126 else bytes([0x80 | 126]) + struct.pack(">H", size))
        sock.sendall(head + mask + bytes(b ^ mask[i % 4] for i, b in enumerate(data)))

    def _run(self) -> None:
        while True:  # a feed that breaks off is taken up again; the offset fills what it missed
            try:
                self._listen()
            except Exception as e:  # a cut frame, a refused connection, an unreadable size: any of them breaks the feed
                self.error = e
            time.sleep(RECONNECT_S)

    def _listen(self) -> None:
        parts = urlsplit(self.url)
        with socket.create_connection((parts.hostname, parts.port or 80), timeout=SILENCE_S) as sock:
            key = base64.b64encode(os.urandom(16)).decode()
            sock.sendall(f"GET {parts.path or '/'} HTTP/1.1\r\nHost: {parts.netloc}\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Key: {key}\r\nSec-WebSocket-Version: 13\r\n\r\n".encode())
            while self._line(sock).strip():
                pass
            self._frame(sock, json.dumps({"jsonrpc": "2.0", "id": 1, "method": "eth_subscribe", "params": ["newHeads"]}).encode())
            text = b""
            while True:
                head = self._take(sock, 2)
                code, size = head[0] & 15, head[1] & 127
                if size == 126:
                    size = struct.unpack(">H", self._take(sock, 2))[0]
                elif size == 127:
                    size = struct.unpack(">Q", self._take(sock, 8))[0]
                data = self._take(sock, size)
                if code == 8:
                    return
                if code == 9:
                    self._frame(sock, data, 10)
                elif code in (0, 1):
                    text += data
                    if head[0] & 0x80:
                        number = pushed_number(text.decode(errors="replace"))
                        text = b""
                        if number is not None:
                            self.head = max(self.head or 0, number)

    def _take(self, sock, size: int) -> bytes:
        """So many bytes; a silent feed is pinged once, one that ends or stays silent raises."""
        data, asked = b"", False
        while len(data) < size:
            try:
                part = sock.recv(min(1 << 16, size - len(data)))
            except TimeoutError:
                if asked:
                    raise
                asked = True
                self._frame(sock, b"", 9)
                continue
            if not part:
                raise ConnectionError("the feed ended")
            data, asked = data + part, False
        return data

    def _line(self, sock) -> bytes:
        line = b""
        while not line.endswith(b"\n"):
            line += self._take(sock, 1)
        return line


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.first, self.last = int(options["fromBlock"]), int(options.get("toBlock") or 2**62)
        self.slice = int(options.get("batchSize", 100))
        self.listener = Listener(options["wsUrl"]) if options.get("wsUrl") else None
        self.url, self.head = options.get("url"), self.first - 1
        self.given, self.most = self.head, int(options.get("maxBlocks") or 2**62)

    def initialOffset(self):
        return {"block": self.first - 1}

    def latestOffset(self):
        head = self.listener.head if self.listener else polled_head(self.url)
        self.head = max(self.head, min(head, self.last) if head is not None else self.head)
        return {"block": max(self.given, min(self.head, self.given + self.most))}

    def partitions(self, start, end):
        low, high = start["block"] + 1, end["block"]
        self.given, self.head = max(self.given, high), max(self.head, high)
        return [_Range(a, min(a + self.slice - 1, high)) for a in range(low, high + 1, self.slice)]

    def read(self, part):
        for number in range(part.first, part.last + 1):
            yield (number,)

    def commit(self, end):
        self.given, self.head = max(self.given, end["block"]), max(self.head, end["block"])


class HeadsDataSource(DataSource):
    """``spark.readStream.format("block_heads")`` with ``url`` (polling) or ``wsUrl`` (push), ``fromBlock``, ``toBlock``, and ``maxBlocks``, the most blocks of a micro-batch."""

    @classmethod
    def name(cls):
        return "block_heads"

    def schema(self):
        return "block_num LONG"

    def streamReader(self, schema):
        return _Reader(self.options)
