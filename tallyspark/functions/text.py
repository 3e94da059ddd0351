"""Display text for alerts and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

UNKNOWN_MERCHANT = "(unknown merchant)"


def one_digit(value: Column) -> Column:
    """A non-negative double with one decimal, rounded half-even on its exact binary value.

    ``format_string('%.1f')`` rounds half-up on the shortest decimal form, which differs
    on values like 10.45 whose binary form lies below the tie. The fraction of a double
    is a multiple of 2**-59 for every value that can reach the first decimal, so tenths
    and remainder are exact in 64-bit integers.
    """
    whole = F.floor(value)
    scaled = ((value - whole) * F.lit(float(1 << 59))).cast("long") * F.lit(10)
    tenths = F.shiftright(scaled, 59)
    rest = scaled.bitwiseAND(F.lit((1 << 59) - 1))
    half = F.lit(1 << 58)
    up = (rest > half) | ((rest == half) & (tenths % 2 == 1))
    carried = tenths + F.when(up, 1).otherwise(0)
    return F.concat(
        (whole + F.when(carried >= 10, 1).otherwise(0)).cast("string"),
        F.lit("."),
        (carried % 10).cast("string"),
    )


def percent(fraction: Column) -> Column:
    return F.concat(one_digit(fraction * 100), F.lit("%"))


def thousands(count: Column) -> Column:
    return F.format_number(count, 0)


def money(amount: Column) -> Column:
    return F.concat(F.lit("R$ "), F.format_number(amount, 2))


def short_label(category: Column) -> Column:
    return F.replace(category, F.lit("UNRECONCILED_"), F.lit("UNR_"))


def display_name(trade: Column, legal: Column, merchant: Column) -> Column:
    """Trade name, else legal name, else merchant id; empty text counts as absent."""
    present = [F.nullif(c, F.lit("")) for c in (trade, legal, merchant)]
    return F.coalesce(*present, F.lit(UNKNOWN_MERCHANT))


def joined(column: str, order: Sequence[str], separator: str = ", ") -> Column:
    """Aggregate: the texts of a group in order of ``order``, which should leave no ties.

    NULL texts are left out; a group without texts gives NULL. A group is put together in one
    task, so this is for groups of a known size. ``profile.ordered_fingerprint`` compares whole tables.
    """
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg(`{column}`, '{quoted}') WITHIN GROUP (ORDER BY {', '.join(f'`{c}`' for c in order)})")
