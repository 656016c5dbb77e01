"""A node's JSON-RPC interface as a Python data source: raw rows of a range of blocks.

Every partition is a slice of the range; a task fetches its slice with a small thread pool.  Fetch mode 0 sends three single
requests a block, 1 one array request for each method and slice, 2 one array request a block.  Answers pass through as the node
sent them, array answers cut into their elements; a parse only tells whether there is a result.  Blocks that fail are
fetched again from the reserve, without a limit, and live ones before that from the node itself, until their patience ends;
what still fails comes as rows with ``failed``.

Rows are a block's response each (``RAW``), or with the option ``wide`` a block with its three responses (``WIDE``), which
is what a run decodes: they come from one task, so that bodies don't have to meet in a shuffle.
"""

from __future__ import annotations

import json
import re
import time
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from blockweave.schemas import METHODS, RAW, WIDE

FETCH_MODES = (0, 1, 2)
#: Seconds before a live block is asked for again: at first, and at most.
RETRY_S, RETRY_MAX_S = 0.005, 0.5


def call(method: str, block: int, number: int = 1) -> dict:
    params = [hex(block), True] if method == METHODS[0] else [hex(block)]
    return {"jsonrpc": "2.0", "id": number, "method": method, "params": params}


def post(url: str, payload, timeout: float) -> str:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode()


def _row(block: int, method: str, found: tuple | None) -> tuple:
    """A raw row from (result, text) of an answer."""
    failed = found is None or found[0] is None
    return block, method, None if failed else found[1], failed


_DECODER = json.JSONDecoder()
_BETWEEN = re.compile(r"[\s,]*")


def elements(text: str) -> Iterator[tuple[object, str]]:
    """The values of a JSON array, each with its own text."""
    at = _BETWEEN.match(text).end()
    if text[at : at + 1] != "[":
        raise ValueError("no array")
    at = _BETWEEN.match(text, at + 1).end()
    while text[at : at + 1] != "]":
        value, end = _DECODER.raw_decode(text, at)
        yield value, text[at:end]
        at = _BETWEEN.match(text, end).end()


def _array(url: str, calls: list[dict], timeout: float) -> dict:
    """Result and text of each answer by id; the first of equal ids counts."""
    out: dict = {}
    try:
        for a, text in elements(post(url, calls, timeout)):
            if isinstance(a, dict) and a.get("result") is not None:
                out.setdefault(a.get("id"), (a["result"], text))
    except (OSError, ValueError):
        pass
    return out


def fetch(url: str, blocks: list[int], mode: int, timeout: float = 30.0, threads: int = 8) -> list[tuple]:
    """Raw rows of some blocks."""

    def single(key):
        block, method = key
        try:
            text = post(url, call(method, block), timeout)
            return _row(block, method, (json.loads(text).get("result"), text))
        except (OSError, ValueError, AttributeError):
            return _row(block, method, None)

    def of_method(method):
        found = _array(url, [call(method, b, i) for i, b in enumerate(blocks)], timeout)
        return [_row(b, method, found.get(i)) for i, b in enumerate(blocks)]

    def of_block(block):
        found = _array(url, [call(m, block, i) for i, m in enumerate(METHODS)], timeout)
        return [_row(block, m, found.get(i)) for i, m in enumerate(METHODS)]

    with ThreadPoolExecutor(threads) as pool:
        if mode == 0:
            return list(pool.map(single, [(b, m) for b in blocks for m in METHODS]))
        parts = pool.map(of_method, METHODS) if mode == 1 else pool.map(of_block, blocks)
        return [row for part in parts for row in part]


def wide(rows: list[tuple], ms: float) -> list[tuple]:
    """One row a block from its raw rows: the bodies in the order of the methods, whether one failed, and the milliseconds of the fetch."""
    held: dict = {}
    for block, method, body, _ in rows:
        held.setdefault(block, {})[method] = body
    return [(block, *(got.get(m) for m in METHODS), any(got.get(m) is None for m in METHODS), ms) for block, got in sorted(held.items())]


def fetch_with_reserve(url: str, reserve: str | None, blocks: list[int], mode: int, timeout: float = 30.0, patience: float = 0.0) -> list[tuple]:
    """Raw rows of some blocks; those of which a response failed come from the reserve.

    With ``patience`` the node itself is asked for them again first, and both until they are complete or so many seconds are over;
    ``math.inf`` waits without an end.
    """
    rows = fetch(url, blocks, mode, timeout)
    end, pause, again = time.monotonic() + patience, RETRY_S, patience > 0

    def replaced(source: str) -> list[tuple]:
        down = {r[0] for r in rows if r[3]}
        return [r for r in rows if r[0] not in down] + fetch(source, sorted(down), mode, timeout) if down else rows

    while True:
        if again and any(r[3] for r in rows):
            time.sleep(pause)
            rows = replaced(url)
        if reserve:
            rows = replaced(reserve)
        pause = min(2 * pause, RETRY_MAX_S)
        again = time.monotonic() + pause < end
        if not again or not any(r[3] for r in rows):
            return rows


class _Slice(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.url, self.reserve = options["url"], options.get("reserveUrl") or None
        self.first, self.last = int(options["fromBlock"]), int(options["toBlock"])
        self.mode, self.size = int(options.get("fetchMode", 0)), int(options.get("batchSize", 10))
        self.timeout, self.wide = float(options.get("timeout", 30)), str(options.get("wide", "")).lower() == "true"
        if self.mode not in FETCH_MODES:
            raise ValueError(f"fetchMode is one of {FETCH_MODES}")

    def partitions(self):
        return [_Slice(a, min(a + self.size - 1, self.last)) for a in range(self.first, self.last + 1, self.size)]

    def read(self, part):
        began = time.perf_counter()
        rows = fetch_with_reserve(self.url, self.reserve, list(range(part.first, part.last + 1)), self.mode, self.timeout)
        yield from wide(rows, 1000 * (time.perf_counter() - began)) if self.wide else rows


class RpcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "block_rpc"

    def schema(self):
        return WIDE if str(self.options.get("wide", "")).lower() == "true" else RAW

    def reader(self, schema):
        return _Reader(self.options)


def read(spark: SparkSession, url: str, first: int, last: int, fetch_mode: int = 0, reserve_url: str | None = None, batch_size: int = 10, wide: bool = False) -> DataFrame:
    spark.dataSource.register(RpcDataSource)
    return (
        spark.read.format("block_rpc")
        .option("url", url)
        .option("reserveUrl", reserve_url or "")
        .option("fromBlock", first)
        .option("toBlock", last)
        .option("fetchMode", fetch_mode)
        .option("batchSize", batch_size)
        .option("wide", str(wide).lower())
        .load()
    )
