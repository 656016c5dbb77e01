"""Dump files: a Python data source that reads and writes the framed binary format.

A file is a six-byte magic, then batches: ``FF 00``, batch id and number of rows (big-endian u32 each), then rows: table
id (u8), number of values (u16), length (u32), and the values, each a big-endian i32 length (-1 for null) and its bytes.
One file is one input partition; the writer makes one file a task, so that reading and writing are parallel by files.  Paths go
through Arrow's file systems (local, ``hdfs://``, ``s3://``, ``gs://``); files are read and written as streams.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from blockweave.functions import uint256 as U
from blockweave.schemas import DUMP_TABLES

# Fixed values of the format: the magic, the batch mark and the header layouts.
MAGIC = b"ZIG2D\x01"
SCHEMA = "batch_id LONG, table_id INT, vals ARRAY<BINARY>"

_BATCH, _ROW = struct.Struct(">2sII"), struct.Struct(">BHI")


def encode(batch_id: int, rows: list[tuple[int, list[bytes | None]]]) -> bytes:
    """One batch."""
    out = [_BATCH.pack(b"\xff\x00", batch_id, len(rows))]
    for table_id, values in rows:
        body = b"".join(struct.pack(">i", -1) if v is None else struct.pack(">i", len(v)) + bytes(v) for v in values)
        out += [_ROW.pack(table_id, len(values), len(body)), body]
    return b"".join(out)


def decode(stream) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """(batch id, table id, values) of each row of an open file."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a dump file")
    while head := stream.read(_BATCH.size):
        mark, batch_id, n = _BATCH.unpack(head)
        if mark != b"\xff\x00":
            raise ValueError("no batch where one should begin")
        for _ in range(n):
            table_id, n_values, size = _ROW.unpack(stream.read(_ROW.size))
            body, at, values = stream.read(size), 0, []
            if len(body) != size:
                raise ValueError("the file ends within a row")
            for _ in range(n_values):
                (length,) = struct.unpack_from(">i", body, at)
                at += 4
                values.append(None if length < 0 else body[at : at + length])
                at += max(0, length)
            yield batch_id, table_id, values


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _place(path: str):
    """Arrow's file system and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def _dumps(system, path: str) -> list[str]:
    from pyarrow import fs

    if system.get_file_info(path).type != fs.FileType.Directory:
        return [path]
    return sorted(f.path for f in system.get_file_info(fs.FileSelector(path)) if f.path.endswith(".dump"))


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [_File(f) for f in _dumps(*_place(self.path))]

    def read(self, partition):
        with _place(self.path)[0].open_input_stream(partition.path) as f:
            yield from decode(f)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, rows):
        system, path = _place(self.path)
        system.create_dir(path, recursive=True)
        name = f"{path}/part-{uuid.uuid4().hex}.tmp"
        with system.open_output_stream(name) as f:
            f.write(MAGIC)
            held, of = [], None
            for row in rows:  # sorted by batch within a task
                if held and row.batch_id != of:
                    f.write(encode(of, held))
                    held = []
                of = row.batch_id
                held.append((row.table_id, list(row.vals)))
            if held:
                f.write(encode(of, held))
        message = WriterCommitMessage()
        message.name = name
        return message

    def commit(self, messages):
        system, path = _place(self.path)
        new = [m.name for m in messages if m is not None]
        if self.overwrite and new:
            for f in _dumps(system, path):
                system.delete_file(f)
        for name in new:
            system.move(name, name[: -len(".tmp")] + ".dump")

    def abort(self, messages):
        from pyarrow import fs

        system = _place(self.path)[0]
        for m in messages:
            if m is not None and system.get_file_info(m.name).type == fs.FileType.File:
                system.delete_file(m.name)


class DumpDataSource(DataSource):
    """``spark.read.format("block_dump").load(path)``; executors and driver must reach the path."""

    @classmethod
    def name(cls):
        return "block_dump"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], overwrite)


def write(rows: DataFrame, path: str) -> None:
    """Writes rows (batch_id, table_id, vals), a batch in one file."""
    spark = rows.sparkSession
    spark.dataSource.register(DumpDataSource)
    rows.select("batch_id", "table_id", "vals").repartition("batch_id").sortWithinPartitions("batch_id", "table_id").write.format("block_dump").mode("overwrite").save(path)


def read(spark, path: str) -> DataFrame:
    spark.dataSource.register(DumpDataSource)
    return spark.read.format("block_dump").load(path)


# Values of the six tables.


def _fixed(x: Column, width: int) -> Column:
    digits = F.hex(x.cast("long"))
    return F.unhex(F.when(x.isNotNull(), F.right(F.lpad(digits, 16, "0"), F.lit(2 * width))))


def _number(b: Column, width: int) -> Column:
    h = F.hex(b)
    value = F.conv(h, 16, -10).cast("decimal(20,0)")
    if width < 8:
        wrap = 1 << (8 * width)
        value = F.when(value >= wrap // 2, value - wrap).otherwise(value)
    return value.cast({1: "tinyint", 4: "int", 8: "long"}[width])


_KINDS = {
    "blocks": "i4 i8 i8 i8 s",
    "transactions": "i4 i8 i4 s i8 i8 s s s s v i8 i8 i8 i8 i8 i8 i8 s i1 i1",
    "logs": "i4 i8 i4 i4 i8 i8 s s s s s s l s b",
    "internal_transactions": "i4 i8 i8 i8 i4 s i4 s s v",
    "contracts": "i4 i8 i4 s i4 i8 i8 s i1 s s s s",
    "contracts_by_addresses": "s s s i8 i8 s s s",
}


def _list(x: Column) -> Column:
    """A list of texts: its number, then each length and text."""
    parts = F.transform(x, lambda t: F.concat(F.lpad(F.hex(F.octet_length(t).cast("long")), 8, "0"), F.hex(t)))
    return F.unhex(F.concat(F.lpad(F.hex(F.size(x).cast("long")), 8, "0"), F.array_join(parts, "")))


def _texts(b: Column) -> Column:
    """The list of texts that ``_list`` encoded."""
    h = F.hex(b)

    def number(at: Column) -> Column:
        return F.conv(F.substring(h, at, F.lit(8)), 16, 10).cast("int")

    def item(held: Column, _: Column) -> Column:
        size = 2 * number(held["at"])
        text = F.decode(F.unhex(F.substring(h, held["at"] + 8, size)), "UTF-8")
        return F.struct((held["at"] + 8 + size).alias("at"), F.concat(held["texts"], F.array(text)).alias("texts"))

    start = F.struct(F.lit(9).alias("at"), F.array().cast("array<string>").alias("texts"))
    n = number(F.lit(1))
    items = F.when(n > 0, F.sequence(F.lit(1), n)).when(n == 0, F.array().cast("array<int>"))
    return F.aggregate(items, start, item, lambda held: held["texts"])


def to_values(table: DataFrame, name: str, batch: Column) -> DataFrame:
    """Rows (batch_id, table_id, vals) of a data table; quantities come as two's complement bytes (``uint256.varint``)."""
    out = []
    for column, kind in zip(table.columns, _KINDS[name].split(), strict=True):
        x = F.col(f"`{column}`")
        if kind[0] == "i":
            value = _fixed(x, int(kind[1]))
        elif kind == "v":
            value = x
        elif kind == "b":
            value = F.unhex(F.when(x, "01").otherwise("00"))
        elif kind == "l":
            value = _list(x)
        else:
            value = x.cast("binary")
        out.append(value)
    return table.select(batch.cast("long").alias("batch_id"), F.lit(DUMP_TABLES.index(name)).alias("table_id"), F.array(*out).alias("vals"))


def from_values(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """A data table's rows from dump rows."""
    out = []
    for i, (column, kind) in enumerate(zip(columns, _KINDS[name].split(), strict=True)):
        b = F.get("vals", F.lit(i))
        if kind[0] == "i":
            value = _number(b, int(kind[1]))
        elif kind == "v":
            value = U.decimal(F.hex(b))
        elif kind == "b":
            value = F.hex(b) != "00"
        elif kind == "l":
            value = _texts(b)
        else:
            value = F.decode(b, "UTF-8")
        out.append(value.alias(column))
    return rows.where(F.col("table_id") == DUMP_TABLES.index(name)).select("batch_id", *out)


def rechunked(rows: DataFrame, mod: int) -> DataFrame:
    """Dump rows with chunk = block number modulo ``mod`` in the tables that have a chunk, in place of the stored one."""
    number = _number(F.get("vals", F.lit(1)), 8)
    first = F.when(F.col("table_id") < 5, _fixed(F.pmod(number, F.lit(mod)), 4)).otherwise(F.get("vals", F.lit(0)))
    return rows.withColumn("vals", F.concat(F.array(first), F.slice("vals", F.lit(2), F.greatest(F.size("vals") - 1, F.lit(0)))))


def merged(rows: DataFrame, n: int) -> DataFrame:
    """Every n batches become one, renumbered in order; batch ids are expected to count from 0."""
    return rows.withColumn("batch_id", F.floor(F.col("batch_id") / n)) if n > 1 else rows


def chunk_keys(rows: DataFrame, listed: int | None = 32) -> DataFrame:
    """Distinct chunk keys: their number, and the keys in order if there are at most ``listed``, else the least and greatest; None lists all, by their text."""
    key = _number(F.get("vals", F.lit(0)), 4).alias("chunk")
    keys = rows.where("table_id < 5").select(key).distinct()
    kept = F.when(F.col("chunk").isNotNull(), F.col("chunk").cast("string") if listed is None else F.col("chunk"))
    counted = keys.agg(F.count("*").alias("n_chunks"), F.min("chunk").alias("low"), F.max("chunk").alias("high"), F.array_sort(F.collect_list(kept)).alias("all"))
    every = F.array_join(F.transform("all", lambda x: x.cast("string")), ",")
    if listed is None:
        return counted.select("n_chunks", every.alias("chunks"))
    return counted.select("n_chunks", F.when(F.col("n_chunks") <= listed, every).otherwise(F.concat_ws("..", "low", "high")).alias("chunks"))


def rows_per_table(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_id").agg(F.count("*").alias("n_rows"))


def rows_per_batch_table(rows: DataFrame) -> DataFrame:
    return rows.groupBy("batch_id", "table_id").agg(F.count("*").alias("n_rows"))


