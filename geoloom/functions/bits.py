"""Exact conversion between doubles and IEEE-754 hex digits in Spark expressions.

Spark has no built-in for the bit pattern of a double, so exponent and mantissa
are worked out by arithmetic on powers of two, which is exact in binary floating
point. Chained ``transform`` calls bind intermediate values, so nothing is
computed twice per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MANTISSA_BITS = 52
EXPONENT_BIAS = 1023
SMALLEST_NORMAL = 2.2250738585072014e-308


def le_int_hex(value: Column) -> Column:
    """32-bit integer -> 8 upper-case hex digits, least significant byte first."""
    word = F.lpad(F.hex(value.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.concat(*[F.substring(word, at, 2) for at in (7, 5, 3, 1)])


def le_int(data: Column, at: int) -> Column:
    """Four bytes of a binary column from 1-based ``at``, least significant first."""
    digits = F.hex(F.substring(data, at, 4))
    return F.conv(F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("bigint")


def signed_int32(value: Column) -> Column:
    """Unsigned 32-bit value held in a bigint -> the signed int with the same bits."""
    return F.when(value >= 2**31, value - 2**32).otherwise(value).cast("int")


def _pow2(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _exponent(magnitude: Column) -> Column:
    """floor(log2) of a normal magnitude, within one of the right value."""
    return F.least(F.greatest(F.floor(F.log2(magnitude)), F.lit(-1022)), F.lit(1023))


def _split(value: Column) -> Column:
    # abs() keeps -0.0 apart from 0.0 only in the text form, hence the string test.
    negative = (value < 0) | ((value == 0) & (value.cast("string") == "-0.0"))
    magnitude = F.abs(value)
    return F.struct(
        magnitude.alias("a"),
        F.when(negative, F.lit(2048)).otherwise(F.lit(0)).alias("sign"),
        F.when(
            (magnitude >= SMALLEST_NORMAL) & (magnitude < float("inf")), _exponent(magnitude)
        ).alias("e"),
    )


def _correct(parts: Column) -> Column:
    a, e = parts["a"], parts["e"]
    fixed = F.when(_pow2(e) > a, e - 1).when((e < 1023) & (_pow2(e + 1) <= a), e + 1).otherwise(e)
    return F.struct(a.alias("a"), parts["sign"].alias("sign"), fixed.alias("e"))


def _word(parts: Column) -> Column:
    """(magnitude, sign, exponent) -> 16 hex digits, most significant first."""
    a, e = parts["a"], parts["e"]
    digits = lambda top, mantissa: F.concat(
        F.lpad(F.hex(parts["sign"] + top), 3, "0"), F.lpad(F.hex(mantissa.cast("bigint")), 13, "0")
    )
    return (
        F.when(F.isnan(a), F.lit("7FF8000000000000"))
        .when(a == float("inf"), digits(F.lit(2047), F.lit(0)))
        .when(a == 0, digits(F.lit(0), F.lit(0)))
        .when(a < SMALLEST_NORMAL, digits(F.lit(0), a * 2.0**537 * 2.0**537))
        .otherwise(digits(e + EXPONENT_BIAS, (a / _pow2(e) - 1) * 2.0**MANTISSA_BITS))
    )


def _swap_bytes(word: Column) -> Column:
    return F.concat(*[F.substring(word, at, 2) for at in range(15, 0, -2)])


def doubles_hex(values: Column) -> Column:
    """array<double> -> one string of little-endian hex, 16 digits per value."""
    words = F.transform(F.transform(F.transform(values, _split), _correct), _word)
    return F.array_join(F.transform(words, _swap_bytes), "")


def _from_bits(bits: Column) -> Column:
    exponent = F.shiftrightunsigned(bits, MANTISSA_BITS).bitwiseAND(F.lit(2047))
    mantissa = bits.bitwiseAND(F.lit(2**MANTISSA_BITS - 1)).cast("double")
    sign = F.when(bits < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return (
        F.when((exponent == 2047) & (mantissa == 0), sign * F.lit(float("inf")))
        .when(exponent == 2047, F.lit(float("nan")))
        .when(exponent == 0, sign * mantissa * F.pow(F.lit(2.0), F.lit(-1074.0)))
        .otherwise(sign * (1 + mantissa / 2.0**MANTISSA_BITS) * _pow2(exponent - EXPONENT_BIAS))
    )


def le_double(data: Column, at: int | Column) -> Column:
    """Eight little-endian bytes of a binary column from 1-based ``at`` -> double.

    Slices the binary value, not its hex text: a slice of a string walks it from
    the start, which is quadratic over a long line.
    """
    at = at if isinstance(at, Column) else F.lit(at)
    word = _swap_bytes(F.hex(F.substring(data, at, F.lit(8))))
    bits = F.conv(word, 16, -10).cast("bigint")
    return F.get(F.transform(F.array(bits), _from_bits), F.lit(0))
