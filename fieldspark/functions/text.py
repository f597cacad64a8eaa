"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def label(col: Column) -> Column:
    """Trim; a blank stays an empty string."""
    return F.trim(col.cast("string"))


def text(col: Column) -> Column:
    """Trim; a blank becomes null."""
    return _blank_to_null(label(col))


def code(col: Column) -> Column:
    """Trim and upper-case; a blank stays an empty string."""
    return F.upper(label(col))


def category(col: Column) -> Column:
    """Trim and upper-case; a blank becomes null."""
    return _blank_to_null(code(col))


def imputed_code(col: Column, prefix: str, ident: Column) -> Column:
    """A code, or ``prefix`` + id where it is missing, so the fill stays visible."""
    return F.coalesce(category(col), F.concat(F.lit(prefix), ident.cast("string")))

