"""Scalar building blocks.  Each returns a Column of built-in expressions."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


# Decimal places whose amounts are summed exactly, in two ranges: each keeps every
# digit of an integer of 19 digits and leaves room for sums.
COARSE_PLACES = range(-2, 9)
FINE_PLACES = range(9, 19)


def scaled_amount(value: str, places: str, mode: str = "zero") -> Column:
    """``value / 10^(places - 2)`` as double; ``value`` is an integer column.

    ``mode="zero"``: places of NULL or 0 give 0.
    ``mode="raw"``: places of 0 give the value itself, places of NULL give NULL.
    """
    shifted = f"{value} / POWER(10.0D, {places} - 2)"
    if mode == "zero":
        return F.expr(f"CASE WHEN coalesce({places}, 0) = 0 THEN 0.0D ELSE {shifted} END")
    if mode == "raw":
        return F.expr(f"CASE WHEN {places} = 0 THEN CAST({value} AS DOUBLE) ELSE {shifted} END")
    raise ValueError(f"mode must be 'zero' or 'raw', not {mode!r}")


def _shifted(value: str, places: str, shifts: range, kind: str) -> str:
    """``value / 10^(places - 2)`` in decimal arithmetic for ``places`` in ``shifts``, else NULL.

    The powers are one constant array: a CASE per power would name the inputs,
    and with them whatever they are derived from, once per branch.
    """
    powers = ", ".join(f"CAST({Decimal(10) ** (2 - dp):f} AS {kind})" for dp in shifts)
    product = f"{value} * array({powers})[{places} - ({shifts[0]})]"
    return f"CASE WHEN {places} BETWEEN {shifts[0]} AND {shifts[-1]} THEN {product} END"


def summed_amount(
    value: str, places: str, mode: str = "zero", exact: bool = True, copies: str | None = None
) -> Column:
    """Aggregate: the sum of ``scaled_amount``, each row counted ``copies`` times, as double.

    Sums of doubles depend on the order in which rows arrive, so a task that is
    run again may get another last digit; ``exact=True`` sums decimals, which do
    not.  No digit is cut: amounts of up to 8 places and of 9 to 18 places have a
    decimal sum each.  Places outside -2 to 18 are summed as double.
    """
    times = F.lit(1) if copies is None else F.col(copies)
    if not exact:
        return F.sum(scaled_amount(value, places, mode) * times)
    own = f"coalesce({places}, 0) = 0" if mode == "zero" else f"{places} = 0"
    whole = f"CAST({value} AS DECIMAL(19,0))" + ("" if copies is None else f" * CAST({copies} AS DECIMAL(10,0))")
    fine = f"CAST({whole} AS DECIMAL(21,0))"
    itself = "CAST(0 AS DECIMAL(38,6))" if mode == "zero" else f"CAST({whole} AS DECIMAL(38,6))"
    coarse = f"CASE WHEN {own} THEN {itself} ELSE CAST({_shifted(whole, places, COARSE_PLACES, 'DECIMAL(11,6)')} AS DECIMAL(38,6)) END"
    beyond = f"{places} < {COARSE_PLACES[0]} OR {places} > {FINE_PLACES[-1]}"
    parts = [
        F.sum(F.expr(coarse)).cast("double"),
        F.sum(F.expr(_shifted(fine, places, FINE_PLACES, "DECIMAL(16,16)"))).cast("double"),
        F.sum(F.when(F.expr(beyond), scaled_amount(value, places, mode) * times)),
    ]
    # NULL only if all are; as a function over an array this is little generated code.
    start = F.lit(None).cast("double")
    return F.aggregate(F.array(*parts), start, lambda total, part: F.coalesce(total + part, total, part))


def joined_text(*parts: Column) -> Column:
    """Concatenate with NULL read as the empty string."""
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def currency_text(amount: Column, null_text: str | None = "$nu") -> Column:
    """Dollar text with thousands separators.

    A NULL amount prints ``$nu``, which is what the format gives for NULL cut to
    two characters; pass ``null_text=None`` to keep NULL.
    """
    text = F.format_string("$%,.2f", amount)
    return F.when(amount.isNotNull(), text).otherwise(F.lit(null_text))


def number_prefix(text: Column) -> Column:
    """Leading digits; empty when there are none, NULL for NULL."""
    return F.regexp_extract(text, "^([0-9]+)", 1)


def none_contained(text: Column, upper: tuple[str, ...] = (), lower: tuple[str, ...] = ()) -> Column:
    """True when the text holds none of the words; NULL text passes."""
    known = F.coalesce(text, F.lit("[]"))
    tests = [~F.upper(known).contains(word) for word in upper]
    tests += [~F.lower(known).contains(word) for word in lower]
    return reduce(lambda a, b: a & b, tests)


def to_integer(text: Column, strict: bool = True) -> Column:
    """Integer cast; ``strict=False`` turns text that is no number into NULL."""
    return text.cast("int") if strict else text.try_cast("int")


def day(value: Column) -> Column:
    """The calendar day of a date, a timestamp or ISO text with a time part."""
    return F.left(value.cast("string"), F.lit(10)).cast("date")


def text_of(name: str) -> str:
    """The name under which a date that is stored as text is kept beside its date."""
    return f"{name}_text"


def since(df: DataFrame, name: str, first: date) -> DataFrame:
    """Rows from ``first`` on.

    A cast in a filter keeps it out of the scan.  Where the date is stored as text, the
    text is therefore bounded as well, by the year: text that begins with
    the four digits of a year sorts by it, and what a cast also accepts before a year,
    space or a sign, sorts before all digits and stays.  Years of more than four
    digits do not occur in documents and are not supported as text.
    """
    wanted = F.col(name) >= F.lit(first)
    if text_of(name) in df.columns:
        text = F.col(text_of(name))
        wanted &= (text >= F.lit(f"{first.year:04d}")) | (text < F.lit("0"))
    return df.filter(wanted)
