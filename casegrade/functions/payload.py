"""Payload helpers: hash, strict JSON documents, records, record count.

A payload file holds one JSON document, or JSON Lines (one document per
line). Record count of a document: a list -> its length; an object whose
``data`` is a list -> that length; else an object whose ``results`` is a
list -> that length; anything else -> 1.

Documents are split into record texts with ``from_json(..., 'array<string>')``
(a streaming parse, limited only by the row size). Each record is then parsed
by itself, so a record that does not parse costs nothing but itself, and the
record count is the number of rows by construction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import let

_TEXTS = "array<string>"
_ENVELOPE = "struct<data:array<string>,results:array<string>>"


def payload_hash(text: Column | str) -> Column:
    """Hex SHA-256 of the bytes of a text or of binary content."""
    c = F.col(text) if isinstance(text, str) else text
    return F.sha2(c.cast("binary"), 256)


def _values(text: Column) -> Column:
    # The parsers stop after the first JSON value ('{"a":1} xx' parses);
    # inside brackets they have to read, and check, the whole text. Each top
    # level value comes back as its (compact) JSON text.
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), _TEXTS)


def is_one_document(text: Column) -> Column:
    return F.coalesce(F.size(_values(text)) == 1, F.lit(False))


def document_texts(text: Column | str) -> Column:
    """``array<string>`` of the JSON documents of a payload file, or null.

    The whole text when it is exactly one document; else its non-blank lines
    when each is exactly one document (JSON Lines); else null (not JSON, or
    not UTF-8).
    """
    c = F.col(text) if isinstance(text, str) else text
    c = F.when(F.is_valid_utf8(c), F.regexp_replace(c, "^﻿", ""))        # a leading byte-order mark

    def by_line(t):
        lines = F.transform(F.filter(F.split(t, "\n"), lambda ln: F.trim(ln) != ""), _values)
        return let(lines, lambda found: F.when(
            (F.size(found) > 0) & F.forall(found, lambda a: F.coalesce(F.size(a) == 1, F.lit(False))),
            F.transform(found, lambda a: a[0])))
    return let(c, lambda t: let(_values(t), lambda whole: F.when(F.size(whole) == 1, whole).otherwise(by_line(t))))


def list_document(text: Column | str) -> Column:
    """The record texts of a file that is exactly one list, in a single parse;
    null for any other file (``document_texts`` takes those)."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.when(F.is_valid_utf8(c), F.regexp_replace(c, "^﻿", ""))
    # in brackets the whole text has to be one value, as in _values
    return let(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<array<string>>"),
               lambda a: F.when(F.size(a) == 1, a[0]))


def record_texts(doc: Column) -> Column:
    """Record texts of one document: the list, the ``data`` list, the
    ``results`` list, else the document itself (as one record)."""
    first = F.substring(doc, 1, 1)
    # a field that is not a list comes back null
    in_object = let(F.from_json(doc, _ENVELOPE), lambda env: F.coalesce(env["data"], env["results"], F.array(doc)))
    return (F.when(first == "[", F.from_json(doc, _TEXTS))
            .when(first == "{", in_object)
            .otherwise(F.array(doc)))


def payload_record_texts(docs: Column) -> Column:
    """The record texts of all documents of a file; null without documents."""
    return F.flatten(F.transform(docs, record_texts))


def payload_record_count(docs: Column) -> Column:
    """Sum of the record counts of a file's documents; null without documents."""
    return F.aggregate(F.transform(docs, lambda d: F.size(record_texts(d)).cast("bigint")),
                       F.lit(0).cast("bigint"), lambda a, b: a + b)


# FIXED VALUE — landed payload files are named
# medical_activity_<UTC time as yyyyMMdd_HHmmss>.json
PAYLOAD_FILE_PREFIX = "medical_activity_"
PAYLOAD_FILE_TIME_FORMAT = "yyyyMMdd_HHmmss"


def payload_file_name(ts: Column | None = None) -> Column:
    """Landing file name of a payload fetched at ``ts`` (default: now, UTC session)."""
    t = ts if ts is not None else F.current_timestamp()
    return F.concat(F.lit(PAYLOAD_FILE_PREFIX), F.date_format(t, PAYLOAD_FILE_TIME_FORMAT), F.lit(".json"))
