"""Typed casts from raw strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldspark.functions.text import text as cleaned_text


def ident(col: Column, id_type: str = "int", strict: bool = True) -> Column:
    """An id or whole number; text with a decimal point, as exports of columns with gaps have
    it, is rounded, halves to the even neighbour. Strict casts fail on a bad value in every session
    mode; otherwise a bad value becomes null. Use ``bigint`` beyond 2^31 rows."""
    text = col.cast("string")
    rounded = F.bround(text.try_cast("decimal(38,10)")).try_cast(id_type)
    number = F.when(F.contains(text, F.lit(".")), rounded).otherwise(text.try_cast(id_type))
    if not strict:
        return number
    bad = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast(id_type)
    return F.when(text.isNotNull() & number.isNull(), bad).otherwise(number)


def misread(col: Column, id_type: str = "int") -> Column:
    """The text that ``ident`` cannot read as a number of that type; null where it can."""
    return F.when(ident(col, id_type, strict=False).isNull(), col.cast("string"))


def number_or_error(number: Column, bad: Column, id_type: str = "int") -> Column:
    """The number, or an error where there is a bad text in its place."""
    error = F.raise_error(F.concat(F.lit("not a whole number: "), bad)).cast(id_type)
    return F.when(bad.isNotNull(), error).otherwise(number)


def optional_ident(col: Column, id_type: str = "int", strict: bool = True) -> Column:
    """An id that may be blank: blank becomes null before the cast."""
    return ident(cleaned_text(col), id_type, strict)


def real(col: Column) -> Column:
    """A number as a double. A sign put before the text of a negative zero makes a text that is no number
    (``--0.0``); it is zero whatever its signs mean. Any other bad value is left to the session mode."""
    text = col.cast("string")
    zero = F.when(F.regexp_like(text, F.lit(r"^\s*[+-]{2,}0+(\.0*)?\s*$")), F.lit(0.0)).otherwise(col.cast("double"))
    return F.coalesce(text.try_cast("double"), zero)


def float_or_zero(col: Column) -> Column:
    return F.coalesce(col.cast("float"), F.lit(0.0).cast("float"))


def boolean(col: Column) -> Column:
    return col.cast("boolean")
