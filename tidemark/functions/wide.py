"""Whole numbers beyond the 38 digits of a decimal, as arrays of limbs: exact sums and texts, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c

DIGITS = 6  # of a limb; a sum of whole 64-bit numbers has room for 10^12 of them
PIECE = 3  # limbs that are read from the text at once
LIMBS = 5  # pieces: 90 digits, enough for 256-bit amounts
LIMB = "bigint"


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast(LIMB))


def wide(col: str | Column, limbs: int = LIMBS) -> Column:
    """The limbs of a whole number given as text, lowest first, each with the number's sign; limbs of NULL if it is no such text.

    A number of more than 18 digits times ``limbs`` fails when it is read.
    """
    return _limbs(col, limbs, signed=True)


def wide_sign(col: str | Column) -> Column:
    """-1 for a text that starts with a minus, else 1."""
    return F.when(F.trim(_c(col).cast("string")).startswith("-"), F.lit(-1)).otherwise(F.lit(1)).cast(LIMB)


def wide_size(col: str | Column, limbs: int = LIMBS) -> Column:
    """The limbs of a number without its sign."""
    return _limbs(col, limbs, signed=False)


def _limbs(col: str | Column, limbs: int, signed: bool) -> Column:
    # No CASE around the array: Spark computes what its parts share once, but not inside a branch.
    text = F.trim(_c(col).cast("string"))
    room = DIGITS * PIECE * limbs
    digits = F.when(text.rlike("^[+-]?[0-9]+$"), F.regexp_extract(text, "^[+-]?0*([0-9]*)$", 1))
    padded = F.when(F.length(digits) > room, F.raise_error(F.concat(F.lit(f"more than {room} digits: "), text)).cast("string")).otherwise(F.lpad(digits, room, "0"))
    out = []
    for i in range(limbs):
        piece = F.substring(padded, room - DIGITS * PIECE * (i + 1) + 1, DIGITS * PIECE).cast(LIMB)
        out += [_div(piece, 10 ** (DIGITS * j)) % 10**DIGITS for j in range(PIECE)]
    return F.array(*[x * wide_sign(col) if signed else x for x in out])


def wide_sum(col: str | Column, limbs: int = LIMBS, sign: Column | None = None) -> Column:
    """Aggregate: the sum of the limbs (times a sign), each on its own; ``wide_text`` carries between them. NULL if there is no number."""
    c = _c(col)
    sums = F.array(*[F.sum(F.get(c, F.lit(i)) if sign is None else F.get(c, F.lit(i)) * sign) for i in range(PIECE * limbs)])
    return F.when(F.count(F.get(c, F.lit(0))) > 0, sums)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _carried(limbs: Column) -> Column:
    """``(carry, digits)``: the digits of limbs from 0 to one less than their base, and what is left over above them, negative if the number is."""
    base = F.lit(10**DIGITS).cast(LIMB)

    def add(s: Column, limb: Column) -> Column:
        t = s["carry"] + limb
        rest = F.pmod(t, base)
        return F.struct(_div(t - rest, 10**DIGITS).alias("carry"), F.concat(F.lpad(rest.cast("string"), DIGITS, "0"), s["digits"]).alias("digits"))

    return F.aggregate(limbs, F.struct(F.lit(0).cast(LIMB).alias("carry"), F.lit("").alias("digits")), add)


def wide_text(limbs: str | Column) -> Column:
    """The number that (sums of) limbs stand for, as text without leading zeros."""
    c = _c(limbs)
    plain = lambda s: F.regexp_replace(F.concat(s["carry"].cast("string"), s["digits"]), "^0+(?=.)", "")
    negated = F.concat(F.lit("-"), _once(_carried(F.transform(c, lambda x: -x)), plain))
    return F.when(F.get(c, F.lit(0)).isNotNull(), _once(_carried(c), lambda s: F.when(s["carry"] < 0, negated).otherwise(plain(s))))


def wide_scaled(text: str | Column, decimals: str | Column | int) -> Column:
    """A whole number as text times 10^-decimals, exactly: the point is set and trailing zeros go; NULL decimals count as 0."""
    t = _c(text)
    places = F.lit(decimals) if isinstance(decimals, int) else F.coalesce(_c(decimals).cast("int"), F.lit(0))
    digits = F.regexp_replace(t, "^[+-]", "")
    padded = F.when(F.length(digits) <= places, F.lpad(digits, places + 1, "0")).otherwise(digits)
    whole, rest = F.substr(padded, F.lit(1), F.length(padded) - places), F.substr(padded, F.length(padded) - places + 1, places)
    point = F.when(places > 0, F.regexp_replace(F.concat(whole, F.lit("."), rest), r"\.?0*$", "")).otherwise(whole)
    return F.when(t.startswith("-"), F.concat(F.lit("-"), point)).otherwise(point)
