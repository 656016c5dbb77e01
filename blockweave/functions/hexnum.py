"""Scalar functions as column expressions; all stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digits(h: Column | str) -> Column:
    """A hex quantity without its prefix."""
    return F.regexp_replace(_col(h), "^0[xX]", "")


def significant(h: Column | str) -> Column:
    """Lower-case digits without prefix and leading zeros: the canonical text of an unbounded quantity; null if it isn't hex."""
    d = digits(h)
    return F.when(d.rlike("^[0-9a-fA-F]*$"), F.lower(F.regexp_replace(d, "^0+", "")))


#: A quantity of up to 64 bits; the group is what follows its leading zeros.
_SHORT = "^(?:0[xX])?(?=.)0*([0-9a-fA-F]{0,16})$"


def _short(h: Column) -> Column:
    """The value of a text that fits ``_SHORT``, else 0: one match and one conversion."""
    return F.conv(F.concat(F.lit("0"), F.regexp_extract(h, _SHORT, 1)), 16, -10).cast("long")


def hex_to_i64_or_null(h: Column | str) -> Column:
    """Up to 64 bits, reinterpreted as signed; null where it isn't a quantity."""
    return F.when(_col(h).rlike(_SHORT), _short(_col(h)))


def hex_to_i64(h: Column | str) -> Column:
    """As above, 0 where it isn't a quantity."""
    return F.coalesce(_short(_col(h)), F.lit(0).cast("long"))


def hex_to_i32(h: Column | str) -> Column:
    return F.least(hex_to_i64(h), F.lit(2147483647).cast("long")).cast("int")


def hex_to_i8(h: Column | str) -> Column:
    """The low byte as a signed byte."""
    return (hex_to_i64(h).bitwiseAND(F.lit(255)).bitwiseXOR(F.lit(128)) - 128).cast("tinyint")


def creation_method(m: Column | str) -> Column:
    m = _col(m)
    return F.when(m == "create", 0).when(m == "create2", 1).otherwise(99).cast("tinyint")


def method_id(data: Column | str) -> Column:
    return F.substring(_col(data), 1, 10)


def lower_address(x: Column | str) -> Column:
    return F.lower(_col(x))


def null_to_empty(x: Column | str) -> Column:
    return F.coalesce(F.lower(_col(x)), F.lit(""))


def empty_to_null(x: Column | str) -> Column:
    return F.nullif(_col(x), F.lit(""))


def chunk(number: Column | str, chunk_size: int = 1000, remap_mod: int = 0) -> Column:
    """The partition key of a block: remainder when a remap is set, else the range it falls in."""
    number = _col(number)
    value = F.pmod(number, F.lit(remap_mod)) if remap_mod > 0 else F.floor(number / F.lit(chunk_size))
    return value.cast("int")


def milliseconds(milli: Column | str, seconds: Column) -> Column:
    milli = _col(milli)
    return F.when(milli.isNotNull(), hex_to_i64(milli)).otherwise(seconds * 1000)


def contract_factory(trace_from: Column, creator: Column) -> Column:
    return F.when(trace_from == creator, F.lit("")).otherwise(trace_from)


def creation_bytecode(init: Column, data: Column) -> Column:
    return F.coalesce(F.nullif(F.coalesce(init, data, F.lit("0x")), F.lit("")), F.lit("0x"))


def deployed_bytecode(code: Column) -> Column:
    return F.coalesce(code, F.lit("0x"))


def topic(topics: Column, i: int) -> Column:
    return F.coalesce(F.lower(F.get(topics, F.lit(i))), F.lit(""))


def rest_topics(topics: Column) -> Column:
    return F.transform(F.slice(topics, 5, F.greatest(F.size(topics), F.lit(1))), lambda t: F.lower(t))


def to_hex(number: Column | str) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(_col(number))))


def expected_linear(chunk_no: Column, chunk_size: int, first: int, last: int) -> Column:
    """Blocks of a range that fall in a chunk."""
    low, high = F.greatest(chunk_no * chunk_size, F.lit(first)), F.least((chunk_no + 1) * chunk_size - 1, F.lit(last))
    return F.greatest(F.lit(0), high - low + 1).cast("long")


def expected_remap(chunk_no: Column, mod: int, first: int, last: int) -> Column:
    start = F.lit(first) + F.pmod(chunk_no - F.lit(first), F.lit(mod))
    return F.when(start > last, 0).otherwise(F.floor((F.lit(last) - start) / F.lit(mod)) + 1).cast("long")
