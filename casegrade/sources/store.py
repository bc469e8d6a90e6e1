"""Reading files from inside a task, in pieces of bounded size."""

from __future__ import annotations

import codecs
import hashlib
import os
import re
from collections.abc import Iterator

from pyarrow import fs as pafs

#: Schemes that pyarrow opens itself; others are read by Spark's own reader.
STREAMED_SCHEMES = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")
PIECE = 8 << 20
FIRST_PIECE = 16 << 10
_BLANK = bytes(range(33))


def scheme(uri: str) -> str:
    head, sep, _ = uri.partition(":")
    return head.lower() if sep and "/" not in head else "file"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if scheme(uri) == "file":
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def is_folder(uri: str) -> bool:
    """Whether pyarrow opens the store here and finds a folder."""
    try:
        store, path = open_store(uri)
        return store.get_file_info(path).type == pafs.FileType.Directory
    except (OSError, ValueError, NotImplementedError):
        return False


def entries(uri: str) -> Iterator[tuple[str, bool, int]]:
    """(name, whether it is a folder, length) of what lies in a folder; a local
    folder of any size is read entry by entry."""
    store, path = open_store(uri)
    if not isinstance(store, pafs.LocalFileSystem):
        for found in store.get_file_info(pafs.FileSelector(path)):
            yield found.base_name, found.type == pafs.FileType.Directory, found.size or 0
        return
    with os.scandir(path) as listed:
        for entry in listed:
            try:
                entry.name.encode()
                folder = entry.is_dir()
                size = 0 if folder else entry.stat().st_size
            except (FileNotFoundError, UnicodeEncodeError):      # gone meanwhile, or a name that is no text
                continue
            yield entry.name, folder, size


def sha256_of(uri: str) -> tuple[str, int]:
    """Hex SHA-256 and size of a file of any size, read piece by piece (its bytes as they are)."""
    store, path = open_store(uri)
    digest, size = hashlib.sha256(), 0
    with store.open_input_stream(path, compression=None) as source:
        while piece := source.read(PIECE):
            digest.update(piece)
            size += len(piece)
    return digest.hexdigest(), size


def first_line(uri: str) -> str | None:
    """The first line of a text file that is not white space alone, without a byte
    order mark; None if there is none. The file is read up to that line."""
    store, path = open_store(uri)
    with store.open_input_stream(path) as source:
        size, held = FIRST_PIECE, source.read(FIRST_PIECE).removeprefix(codecs.BOM_UTF8)
        while True:
            *lines, rest = re.split(b"[\r\n]", held)
            found = next((line for line in lines if line.strip(_BLANK)), None)
            if found is not None:
                return found.decode("utf-8", "replace")
            piece = source.read(size)
            if not piece:
                return rest.decode("utf-8", "replace") if rest.strip(_BLANK) else None
            held, size = rest + piece, min(2 * size, PIECE)
