"""A Bloom filter of values that may repeat, of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest filter in bits (32 MB).  Past ``MAX_BITS / BITS_EACH`` values the share of false positives rises, so that
#: more rows take the shuffled way; results stay the same.
MAX_BITS = 1 << 28
MIN_BITS = 1 << 16
BITS_EACH = 16


def size_for(n: int) -> int:
    """A power of two of bits for n values, within the bounds."""
    return min(MAX_BITS, max(MIN_BITS, 1 << max(0, int(n * BITS_EACH - 1).bit_length())))


def slots(value: Column, bits: int) -> list[Column]:
    """The two places of a 64-bit value."""
    return [F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(bits)) for seed in (11, 29)]


def bitmap(marked: DataFrame, bits: int) -> np.ndarray:
    """The bits at column ``slot`` as a numpy array of words; the driver gets one row for each word that isn't zero."""
    word = F.expr("shiftright(slot, 6)").alias("word")
    packed = marked.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    table = packed.toArrow()
    out = np.zeros(bits >> 6, dtype=np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def repeated(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """First pass: the filter's bits that more than one row sets."""
    each = values.select(F.explode(F.array(*slots(F.col(column), bits))).alias("slot"))
    return bitmap(each.groupBy("slot").count().where("count > 1"), bits)


def present(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """The filter's bits that any row sets."""
    return bitmap(values.select(F.explode(F.array(*slots(F.col(column), bits))).alias("slot")), bits)


def holds(words: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Second pass: whether both places of each value are set."""
    hit = np.ones(len(first), dtype=bool)
    for slot in (first, second):
        slot = slot.astype(np.int64)
        hit &= (words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
    return hit


def may_repeat(rows: DataFrame, value: Column, words: np.ndarray, bits: int, flag: str) -> DataFrame:
    """Adds a boolean column: whether the filter holds the value."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def test(first: pa.Array, second: pa.Array) -> pa.Array:
        return pa.array(holds(shared.value, first.to_numpy(), second.to_numpy()))

    return rows.withColumn(flag, test(*slots(value, bits)))
