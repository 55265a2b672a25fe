"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_distance(left: Column, right: Column) -> Column:
    """Levenshtein distance without regard to case."""
    return F.levenshtein(F.lower(left), F.lower(right))


def table_name(key: Column) -> Column:
    """Entity name of a key column: ``_id`` removed, lower case."""
    return F.lower(F.replace(key, F.lit("_id"), F.lit("")))


def pair_name(left: Column, right: Column) -> Column:
    """Junction name of two entities, in sorted order."""
    return F.array_join(F.array_sort(F.array(left, right)), "_")


def stripped(value: Column) -> Column:
    """The text without white space at either end; tabs and line ends included."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")
