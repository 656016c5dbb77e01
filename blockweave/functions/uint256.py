"""Quantities beyond 64 bits: canonical hex text, exact decimals where they fit, two's complement bytes, and exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockweave.functions.hexnum import significant

#: Hex digits of which any value fits decimal(38, 0).
DECIMAL_DIGITS = 31
_PART = 7  # hex digits of a limb: its decimal products stay within 38 digits


#: A quantity that fits; the group is what follows its leading zeros.
_FITS = f"^(?:0[xX])?0*([0-9a-fA-F]{{0,{DECIMAL_DIGITS}}})$"


def decimal(h: Column | str) -> Column:
    """decimal(38, 0) where the value has at most 31 digits, else null: two halves of 64 bits."""
    h = F.col(h) if isinstance(h, str) else h
    padded = F.lpad(F.regexp_extract(h, _FITS, 1), 32, "0")
    high, low = (F.conv(F.substring(padded, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17))
    return F.when(h.rlike(_FITS), (high * F.lit(str(1 << 64)).cast("decimal(20,0)") + low).cast("decimal(38,0)"))


def varint(h: Column | str) -> Column:
    """Big-endian two's complement: a zero byte in front where the first bit is set; a single zero byte for nothing; null if it isn't hex."""
    s = F.coalesce(F.nullif(significant(h), F.lit("")), F.when(significant(h).isNotNull(), F.lit("0")))
    even = F.when(F.length(s) % 2 == 1, F.concat(F.lit("0"), s)).otherwise(s)
    return F.unhex(F.when(even.rlike("^[89a-f]"), F.concat(F.lit("00"), even)).otherwise(even))


def sum_limbs(h: Column | str, parts: int = 10) -> list[Column]:
    """Aggregates of 28-bit limbs, least first; their carried value is the exact sum of 256-bit quantities."""
    padded = F.lpad(significant(h), _PART * parts, "0")
    limb = [F.conv(F.substring(padded, _PART * (parts - 1 - i) + 1, _PART), 16, 10).cast("long") for i in range(parts)]
    return [F.coalesce(F.sum(x), F.lit(0)).alias(f"limb{i}") for i, x in enumerate(limb)]


def carried(names: list[str]) -> Column:
    """Lower-case hex text of the limbs' sum, without leading zeros ("0" for nothing)."""
    digits, carry = [], F.lit(0).cast("long")
    for name in names:
        total = F.col(name) + carry
        digits.append(F.lpad(F.lower(F.hex(total.bitwiseAND(F.lit(16**_PART - 1)))), _PART, "0"))
        carry = F.shiftright(total, 4 * _PART)
    text = F.concat(F.lower(F.hex(carry)), *reversed(digits))
    return F.coalesce(F.nullif(F.regexp_replace(text, "^0+", ""), F.lit("")), F.lit("0"))
