"""Amount parsing and the money rules shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def normalize_amount(amount: Column) -> Column:
    """Settlement amount text as DECIMAL(18,2); NULL where the text is no number.

    Text with a comma is Brazilian notation (``R$ 32.245,91``): dots group thousands
    and the comma is the decimal mark. Any other text has a decimal dot.
    """
    bare = F.regexp_replace(F.trim(amount), r"^R\$\s*", "")
    brazilian = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(bare.contains(","), brazilian).otherwise(bare).try_cast(MONEY)


def ambiguous_amount(amount: Column) -> Column:
    """A comma followed by a dot (``1,234.50``) parses, but hardly as it was meant."""
    return amount.rlike(r",.*\.")


def financial_amount(processor: Column, internal: Column) -> Column:
    """The processor's figure where there is one, else our own."""
    return F.coalesce(processor, internal)


def share(part: Column, whole: Column, digits: int = 6) -> Column:
    """part / whole as a rounded double, NULL for an absent or zero whole."""
    return F.when(whole != 0, F.round(part.cast("double") / whole, digits))
