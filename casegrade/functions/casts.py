"""Staging casts.

Spark 4 runs in ANSI mode: a plain ``cast`` of unreadable text raises. The
staging models are lenient by intent (bad values become null and are then
caught by the not-null tests), so ``try_cast`` is the default; ``strict=True``
keeps the raising cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_type(col: Column | str, type_name: str, strict: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(type_name) if strict else c.try_cast(type_name)


def clean_text(col: Column | str) -> Column:
    """``trim(cast(x as string))`` — spaces only; tabs survive, as in SQL trim."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c.cast("string"))


def clean_lower(col: Column | str) -> Column:
    return F.lower(clean_text(col))


def present(col: Column | str) -> Column:
    """Not null and not the empty string."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))
