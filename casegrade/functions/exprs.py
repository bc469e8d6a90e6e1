"""Small building blocks for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def plain_path(path: Column | str) -> Column:
    """A listed file path in the one spelling that every table uses."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(c, "^file:/+", "file:/")


def source_path() -> Column:
    """The file of a row read from files, spelled as :func:`plain_path` does.

    ``_metadata.file_path`` is percent-encoded; a plus sign there is a plus.
    """
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return plain_path(F.url_decode(encoded))
