"""Rates and aggregate expressions shared by marts and KPIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Visit status codes and list separator.
DONE_STATUSES = ("OK", "INCID", "INFO")
INCIDENT = "INCID"
NOT_VISITED = "NOVIS"
VISIT_STATUSES = ("OK", "INCID", "INFO", "NOVIS")
QUESTION_TYPES = ("S", "M", "N", "T", "D")
LIST_SEPARATOR = ", "


def rate(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double with four decimals; 0.0 for an empty whole."""
    share = F.coalesce(part, F.lit(0)).cast("double") / whole.cast("double")
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.round(share, 4))


def sorted_text(values: Column) -> Column:
    """Join an array of strings in binary string order; null when it is empty."""
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), LIST_SEPARATOR))


def distinct_when(condition: Column, value: Column) -> Column:
    """Distinct values among the rows that meet a condition."""
    return F.count_distinct(F.when(condition, value))
