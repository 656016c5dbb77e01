"""Chunk keys of dumps, listed whole or shortened."""

import struct

from blockweave.sources import dump


def test_all_keys_are_listed_by_their_text(spark):
    keys = range(80, 120)
    rows = spark.createDataFrame([(0, 0, [bytearray(struct.pack(">i", k))]) for k in [*keys, *keys]], dump.SCHEMA)
    assert tuple(dump.chunk_keys(rows, listed=None).first()) == (40, ",".join(sorted(map(str, keys))))
    assert tuple(dump.chunk_keys(rows).first()) == (40, "80..119")
