"""Text clean-up expressions: null tokens and declared cleansing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value" once surrounding spaces are removed (case matters).
NULL_TOKENS = ["NA", "N/A", "N/a", "n/a", "null", "NULL", "None", "none", ""]


def blank_to_null(c: Column) -> Column:
    """NULL when the space-trimmed text is a null token; other values come back untrimmed.

    One list search instead of a chain of comparisons: contracts are wide, and the code Spark
    generates for all columns has to stay small enough for the JVM to compile.
    """
    return F.when(F.find_in_set(F.trim(c), F.lit(",".join(NULL_TOKENS))) == 0, c)


def remove_dashes_and_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"[-\s]", "")


def strip_non_numeric_except_plus(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9+]", "")


CLEANSERS: dict[str, Callable[[Column], Column]] = {
    "remove_dashes_and_spaces": remove_dashes_and_spaces,
    "strip_non_numeric_except_plus": strip_non_numeric_except_plus,
}


def cleanser(name: str) -> Callable[[Column], Column]:
    if name not in CLEANSERS:
        raise ValueError(f"cleansing {name!r} is not one of {sorted(CLEANSERS)}")
    return CLEANSERS[name]
