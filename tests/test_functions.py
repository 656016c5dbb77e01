"""Hand-written edge cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from blockweave.functions import hexnum as H
from blockweave.functions import uint256 as U


def value(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).cast("string" if v is None or isinstance(v, str) else "long").alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, want",
    [("", 0), ("0x", 0), ("0x0", 0), ("0XfF", 255), ("0xffffffffffffffff", -1), ("0x1ffffffffffffffff", 0), ("0xzz", 0), ("0x00000000000000000000000a", 10), ("1g", 0), (None, 0)],
)
def test_hex_to_i64(spark, text, want):
    assert value(spark, H.hex_to_i64("h"), h=text) == want


def test_narrow_numbers(spark):
    assert value(spark, H.hex_to_i32("h"), h="0x80000000") == 2147483647
    assert value(spark, H.hex_to_i8("h"), h="0xff") == -1
    assert value(spark, H.hex_to_i8("h"), h="0x17f") == 127


@pytest.mark.parametrize(
    "text, want",
    [("0x", "00"), ("0x0", "00"), ("0x7f", "7F"), ("0x80", "0080"), ("0xffa3", "00FFA3"), ("0x" + "f" * 64, "00" + "FF" * 32), ("0xg1", None)],
)
def test_varint(spark, text, want):
    got = value(spark, U.varint("h"), h=text)
    assert (got if got is None else bytes(got).hex().upper()) == want


def test_decimal(spark):
    assert value(spark, U.decimal("h"), h="0x" + "f" * 31) == 16**31 - 1
    assert value(spark, U.decimal("h"), h="0x1" + "0" * 31) is None
    assert value(spark, U.decimal("h"), h="0x") == 0


def test_sum_of_large_quantities(spark):
    numbers = [2**256 - 1, 2**255 + 12345, 7, 0]
    df = spark.createDataFrame([(hex(n),) for n in numbers], "h string")
    got = df.agg(*U.sum_limbs("h")).select(U.carried([f"limb{i}" for i in range(10)]).alias("v")).first()["v"]
    assert int(got, 16) == sum(numbers)


@pytest.mark.parametrize("text, want", [("0x", "0x"), ("0x1234567", "0x1234567"), ("0x12345678", "0x12345678"), ("0x123456789a", "0x12345678")])
def test_method_id(spark, text, want):
    assert value(spark, H.method_id("h"), h=text) == want


@pytest.mark.parametrize("text, want", [("create", 0), ("create2", 1), ("CREATE", 99), (None, 99)])
def test_creation_method(spark, text, want):
    assert value(spark, H.creation_method("m"), m=text) == want


@pytest.mark.parametrize("n, sizes", [(0, (0, 0)), (1, (1, 0)), (4, (4, 0)), (5, (4, 1)), (6, (4, 2))])
def test_topics(spark, n, sizes):
    topics = F.array(*[F.lit(f"0xA{i}") for i in range(n)]).cast("array<string>")
    row = spark.range(1).select(*[H.topic(topics, i).alias(f"t{i}") for i in range(4)], H.rest_topics(topics).alias("r")).first()
    assert sum(row[f"t{i}"] != "" for i in range(4)) == sizes[0]
    assert row["r"] == [f"0xa{i}" for i in range(4, n)]


@pytest.mark.parametrize("init, data, want", [("0x1", "0x2", "0x1"), (None, "0x2", "0x2"), ("", "0x2", "0x"), (None, None, "0x"), (None, "", "0x")])
def test_bytecode(spark, init, data, want):
    assert value(spark, H.creation_bytecode(F.col("i"), F.col("d")), i=init, d=data) == want


@pytest.mark.parametrize("chunk, want", [(10, 1), (4, 1), (5, 0)])
def test_expected_remap(spark, chunk, want):
    assert value(spark, H.expected_remap(F.col("c"), 16, 10, 20), c=chunk) == want


@pytest.mark.parametrize("chunk, want", [(25078, 803), (25079, 197), (25080, 0)])
def test_expected_linear(spark, chunk, want):
    assert value(spark, H.expected_linear(F.col("c"), 1000, 25078197, 25079196), c=chunk) == want
