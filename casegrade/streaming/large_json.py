"""Splitting large JSON payload files into records over many tasks.

A file is read in byte ranges of ``SPLIT_BYTES``, each by its own task:

1. ``transitions``: what a range does to a reader that enters it outside a
   string, inside a "string" or inside a 'string': the state it leaves in, how
   much deeper in brackets, and how shallow it got on the way. A quote swaps two
   of the three states, so one prefix product of these swaps covers all entry
   states. (Whether the first byte is escaped is seen from the bytes before it.)
2. ``entered``: the ranges of a file are composed in order; each range then
   knows its entry state and depth.
3. ``marks``: ranges that get down to the depth of the document's own members
   report where its record list opens and closes, and whether anything follows
   the document. Ranges deep inside the list are not read again.
4. ``runs``: each range cuts out the records that start in it, in runs of about
   ``RUN_BYTES``, reading past its end to finish the last one.

Runs are parsed by the same functions as a small file, and so is the document
with its records taken out; a file is one document exactly if all of it parses.
What reaches the driver is one row per file.

A single record, and what a document holds beside its records, has to fit a row
(2 GiB).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import plain_path
from ..functions.payload import _values
from ..session import scratch_dir, ship_package
from ..sources.store import STREAMED_SCHEMES, open_store, scheme

SPLIT_BYTES = 32 << 20
RUN_BYTES = 4 << 20
PIECE_BYTES = 4 << 20
MAX_TASKS = 100_000
#: Up to this many ranges have a task each; more share tasks by their bytes.
RANGE_TASKS = 1000
#: A row holds less than 2 GiB.
ROW_BYTES = (2 << 30) - (1 << 20)
#: What a file is: a document around a record list, a single record, several
#: documents (or no bracket at the start), or brackets that do not match.
LIST, SINGLE, MORE, BROKEN = "list", "single", "more", "broken"
ROLES = ("data", "results")
_SPACE = b" \t\r\n"
#: The states of a reader: outside strings, in a "string", in a 'string'.
_OUT = 0
_STATES = 3
_BOM = b"\xef\xbb\xbf"

#: The permutations of the three states as tuples, and their products (first i, then j).
_PERMUTATIONS = [(0, 1, 2), (1, 0, 2), (2, 1, 0), (0, 2, 1), (1, 2, 0), (2, 0, 1)]
_APPLY = np.array(_PERMUTATIONS, np.uint8)
_PRODUCT = np.array([[_PERMUTATIONS.index(tuple(b[a[s]] for s in range(3))) for b in _PERMUTATIONS]
                     for a in _PERMUTATIONS], np.uint8)
_BRACKET = np.zeros(256, np.int8)
for _c, _step in ((b"[", 1), (b"{", 1), (b"]", -1), (b"}", -1)):
    _BRACKET[_c[0]] = _step
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACE)] = True


class Scan:
    """The strings and brackets of some bytes, for every entry state."""

    def __init__(self, data: bytes, escaped: bool = False):
        self.bytes = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero((self.bytes == 34) | (self.bytes == 39))
        self.quotes = quotes[~self._escaped(quotes, escaped)]
        swaps = np.where(self.bytes[self.quotes] == 34, 1, 2).astype(np.uint8)
        step = 1
        while step < len(swaps):                     # prefix products
            swaps = np.concatenate([swaps[:step], _PRODUCT[swaps[:-step], swaps[step:]]])
            step *= 2
        self.swaps = np.concatenate([np.zeros(1, np.uint8), swaps])
        self.brackets = np.flatnonzero(_BRACKET[self.bytes])

    def _escaped(self, at: np.ndarray, first: bool) -> np.ndarray:
        """Whether an odd run of backslashes ends just before each place."""
        slashes = np.flatnonzero(self.bytes == 92)
        out = np.zeros(len(at), bool)
        if len(slashes):
            begins = np.r_[True, np.diff(slashes) > 1]
            start = slashes[np.maximum.accumulate(np.where(begins, np.arange(len(slashes)), 0))]
            near = np.searchsorted(slashes, at - 1)
            near[near == len(slashes)] = 0
            own = slashes[near] == at - 1
            # an escaped first byte takes one slash off a run that begins there
            run = at - start[near] - (first & (start[near] == 0))
            out = own & (run % 2 == 1)
        if first:
            out |= at == 0
        return out

    def state(self, at: np.ndarray, entry: int) -> np.ndarray:
        """The state in which each place is read."""
        return _APPLY[self.swaps[np.searchsorted(self.quotes, at)], entry]

    def leaves(self, entry: int) -> int:
        return int(_APPLY[self.swaps[-1], entry])

    def depths(self, entry: int) -> tuple[np.ndarray, np.ndarray]:
        """Brackets outside strings, and the depth after each, from 0."""
        at = self.brackets[self.state(self.brackets, entry) == _OUT]
        return at, np.cumsum(_BRACKET[self.bytes[at]], dtype=np.int64)

    def deeper(self, entry: int) -> int:
        _, depths = self.depths(entry)
        return int(depths[-1]) if len(depths) else 0

    def commas(self, entry: int, depth: int) -> np.ndarray:
        """Commas outside strings at a depth (counted from the start)."""
        at = np.flatnonzero(self.bytes == 44)
        at = at[self.state(at, entry) == _OUT]
        brackets, depths = self.depths(entry)
        return at[np.r_[0, depths][np.searchsorted(brackets, at)] == depth]


def _read(uri: str, start: int, end: int) -> bytes:
    store, path = open_store(uri)
    with store.open_input_file(path) as source:
        source.seek(start)
        return source.read(max(0, end - start))


def _escaped_at(uri: str, start: int) -> bool:
    """Whether an odd run of backslashes ends just before ``start``."""
    run, width = 0, 64
    while start - run > 0:
        before = _read(uri, max(0, start - run - width), start - run)
        trailing = len(before) - len(before.rstrip(b"\\"))
        run, width = run + trailing, width * 4
        if trailing < len(before):
            break
    return run % 2 == 1


def _scan(uri: str, start: int, end: int) -> tuple[bytes, Scan]:
    data = _read(uri, start, end)
    if start < 3 and _read(uri, 0, 3) == _BOM:
        mark = min(3 - start, len(data))
        data = b" " * mark + data[mark:]
    return data, Scan(data, _escaped_at(uri, start))


_NUMBERS = [f"{kind}{s}" for s in range(_STATES) for kind in ("leaves", "deeper", "lowest")]
_TRANSITIONS = "path string, size bigint, start bigint, stop bigint, head string, " + ", ".join(f"{n} bigint" for n in _NUMBERS)
_ENTERED = ("path string, size bigint, start bigint, stop bigint, top string, began boolean, state int, depth bigint, "
            "lowest bigint")
_MARKS = ("path string, top string, start bigint, begins bigint, opens array<bigint>, roles array<string>, "
          "closes array<bigint>, first_close bigint, ends bigint, follows boolean")
_OUTCOME = "path string, kind string, open bigint, close bigint"
_RUNS = "path string, n bigint, value binary"
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
          "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _each_row(rows: DataFrame, task: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """The tuples that ``task`` gives for each row, one at a time."""
    names, kinds = zip(*(part.split() for part in schema.split(", ")))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for found in task(row):
                    yield pa.RecordBatch.from_arrays([pa.array([v], _ARROW[k]) for v, k in zip(found, kinds)], list(names))
    return rows.mapInArrow(run, schema)


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartition(max(1, min(n, MAX_TASKS)))


def _transition(row: dict) -> Iterator[tuple]:
    data, scan = _scan(row["path"], row["start"], row["stop"])
    text = data.lstrip(_SPACE)
    numbers = []
    for entry in range(_STATES):
        _, depths = scan.depths(entry)
        numbers += [scan.leaves(entry), scan.deeper(entry), min(0, int(depths.min(initial=0)))]
    yield row["path"], row["size"], row["start"], row["stop"], chr(text[0]) if text else None, *numbers


def transitions(spark: SparkSession, files: dict[str, int], split_bytes: int) -> DataFrame:
    """A row for each range of each file."""
    listed = spark.createDataFrame(list(files.items()), "path string, size bigint")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = listed.select("path", "size", F.explode(starts).alias("start")).withColumn(
        "stop", F.least(F.col("size"), F.col("start") + split_bytes))
    return _each_row(_dealt(ranges, n_tasks(spark, files, split_bytes)), _transition, _TRANSITIONS)


def n_ranges(files: dict[str, int], split_bytes: int) -> int:
    return sum(-(-max(1, n) // split_bytes) for n in files.values())


def n_tasks(spark: SparkSession, files: dict[str, int], split_bytes: int) -> int:
    """Beyond ``RANGE_TASKS``, a task reads ranges of ``SPLIT_BYTES`` in all, one at a
    time, however small they are."""
    by_bytes = -(-sum(files.values()) // max(split_bytes, SPLIT_BYTES))
    return min(n_ranges(files, split_bytes), max(by_bytes, RANGE_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _compose(ranges: pd.DataFrame) -> pd.DataFrame:
    state, depth, began, out = _OUT, 0, False, []
    tops = [h for h in ranges.sort_values("start")["head"] if isinstance(h, str)]
    for r in ranges.sort_values("start").itertuples():
        out.append((r.path, r.size, r.start, r.stop, tops[0] if tops else None, began, state, depth,
                    depth + getattr(r, f"lowest{state}")))
        depth += getattr(r, f"deeper{state}")
        state = getattr(r, f"leaves{state}")
        began = began or isinstance(r.head, str)
    return pd.DataFrame(out, columns=[part.split()[0] for part in _ENTERED.split(", ")])


def entered(found: DataFrame) -> DataFrame:
    """The ranges with their entry state and depth, the document's first
    character, and whether that lies in an earlier range."""
    return found.groupBy("path").applyInPandas(_compose, _ENTERED)


def _role_of(uri: str, data: bytes, start: int, place: int) -> str | None:
    """``data`` or ``results`` if the bracket at ``place`` opens the value of that key."""
    width = 64
    while True:
        at = start + place
        before = data[place - width:place] if place >= width else _read(uri, max(0, at - width), at)
        text = before.rstrip(_SPACE)
        if text.endswith(b":"):
            text = text[:-1].rstrip(_SPACE)
            if len(text) > 12 or width >= at:
                keys = [(role, quote + role.encode() + quote) for role in ROLES for quote in (b'"', b"'")]
                return next((role for role, key in keys
                             if text.endswith(key) and not text.removesuffix(key).endswith(b"\\")), None)
        elif text or width >= at:
            return None
        width *= 8


def _mark(row: dict) -> Iterator[tuple]:
    uri, start = row["path"], row["start"]
    data, scan = _scan(uri, start, row["stop"])
    at, depths = scan.depths(row["state"])
    before, after = np.r_[0, depths[:-1]][:len(at)] + row["depth"], depths + row["depth"]
    begins = ends = None
    if not row["began"] and data.strip(_SPACE):
        begins = start + len(data) - len(data.lstrip(_SPACE))
    closing = at[(after <= 0) & (before > after)]
    if len(closing):
        ends = start + int(closing[0])
    if row["began"] and row["depth"] <= 0:                   # after the end
        follows = bool(data.strip(_SPACE))
    else:
        follows = ends is not None and bool(data[ends - start + 1:].strip(_SPACE))
    opens, roles, closes, first = [], [], [], None
    if row["top"] == "{" and not follows:
        back = at[(after == 1) & (before == 2)]              # closed down to the document's members
        first = start + int(back[0]) if len(back) else None
        for place in at[(before == 1) & (after == 2) & (scan.bytes[at] == 91)].tolist():
            role = _role_of(uri, data, start, place)
            if role:
                i = int(np.searchsorted(back, place))
                opens.append(start + place)
                roles.append(role)
                closes.append(start + int(back[i]) if i < len(back) else -1)
    yield uri, row["top"], start, begins, opens, roles, closes, first, ends, follows


def _outcome(marks: pd.DataFrame) -> pd.DataFrame:
    """What a file is, and where its record list opens and closes."""
    marks = marks.sort_values("start")

    def answer(kind, opened=0, closed=0):
        return pd.DataFrame([(marks["path"].iloc[0], kind, opened, closed)], columns=["path", "kind", "open", "close"])
    ends, begins = marks["ends"].dropna(), marks["begins"].dropna()
    if marks["top"].iloc[0] not in ("[", "{") or marks["follows"].any():
        return answer(MORE)
    if not len(ends):
        return answer(BROKEN)
    if marks["top"].iloc[0] == "[":
        return answer(LIST, int(begins.iloc[0]), int(ends.iloc[0]))
    chosen = {}
    for i, r in enumerate(marks.itertuples()):
        for at, role, close in zip(r.opens, r.roles, r.closes):
            if close < 0:                                    # in a later range
                close = int(marks["first_close"].iloc[i + 1:].dropna().iloc[0])
            chosen[role] = int(at), int(close)               # the last of a repeated key counts
    found = next((chosen[role] for role in ROLES if role in chosen), None)
    return answer(LIST, *found) if found else answer(SINGLE)


def outcomes(ranges: DataFrame) -> DataFrame:
    """(path, kind, open, close): one row per file."""
    # lists of the document's members open at depth 1, the document ends at depth 0
    near = ranges.filter(F.col("lowest") <= F.when(F.col("top") == "{", 1).otherwise(0))
    return _each_row(near, _mark, _MARKS).groupBy("path").applyInPandas(_outcome, _OUTCOME)


def _run(row: dict) -> Iterator[tuple]:
    """Runs of the records that start in a range; ``level`` is the depth of the list's commas."""
    uri, opened, closed, level = row["path"], row["open"], row["close"], row["level"]
    stop = min(row["stop"], closed)
    data, scan = _scan(uri, row["start"], stop)
    commas = row["start"] + scan.commas(row["state"], level - row["depth"])
    bounds = commas[(commas > opened) & (commas < closed)].tolist()
    if opened >= row["start"]:
        bounds.insert(0, opened)
    if not bounds:
        return                                       # inside a record of an earlier range
    parts, at, end = [data], stop, closed if stop == closed else None
    state, depth = scan.leaves(row["state"]), row["depth"] + scan.deeper(row["state"])
    while end is None:                               # to the end of the last record
        piece, more = _scan(uri, at, min(at + PIECE_BYTES, closed))
        if not piece:
            raise OSError(f"{uri} is shorter than it was")
        commas = more.commas(state, level - depth)
        if len(commas):
            end = at + int(commas[0])
        elif at + len(piece) >= closed:
            end = closed
        depth += more.deeper(state)
        state = more.leaves(state)
        parts.append(piece)
        at += len(piece)
        if at - bounds[-1] > ROW_BYTES:              # a record that fits no row
            yield uri, 1, None
            return
    data = b"".join(parts)
    bounds.append(end)
    first = 0
    while first < len(bounds) - 1:
        last = min(max(first + 1, int(np.searchsorted(bounds, bounds[first] + RUN_BYTES))), len(bounds) - 1)
        text = data[bounds[first] + 1 - row["start"]:bounds[last] - row["start"]]
        if text.strip(_SPACE) or bounds[first] != opened or bounds[last] != closed:       # not an empty list
            yield uri, last - first, text
        first = last


def _bare(row: dict) -> Iterator[tuple]:
    """A document without its records."""
    head, tail = _read(row["path"], 0, row["open"] + 1), _read(row["path"], row["close"], row["size"])
    yield row["path"], 0, head.removeprefix(_BOM) + tail


def cut_files(spark: SparkSession, files: dict[str, int], split_bytes: int | None = None
              ) -> tuple[dict[str, int], DataFrame | None, list[str], list[str], list[str]]:
    """Of files (path -> length): the record counts of those that are one
    document around a list, and their records (_source_file, t); the single
    records; the JSON Lines (and other stores' files); and what is not JSON."""
    ship_package(spark)
    split_bytes = split_bytes or SPLIT_BYTES
    own = {p: n for p, n in files.items() if scheme(p) in STREAMED_SCHEMES}
    single, bad, lines, lists = [], [], [p for p in files if p not in own], []
    if not own:
        return {}, None, single, lines, bad
    folder = scratch_dir(spark, "json-ranges")
    entered(transitions(spark, own, split_bytes)).write.mode("overwrite").parquet(folder)
    ranges = spark.read.schema(_ENTERED).parquet(folder)
    for r in outcomes(ranges).collect():
        if r.kind == LIST and files[r.path] - (r.close - r.open) < ROW_BYTES:
            lists.append((r.path, files[r.path], r.open, r.close))
        elif r.kind == SINGLE and files[r.path] < ROW_BYTES:
            single.append(r.path)
        else:
            (lines if r.kind == MORE else bad).append(r.path)
    if not lists:
        return {}, None, single, lines, bad
    spans = spark.createDataFrame(lists, "path string, size bigint, open bigint, close bigint")
    work = (ranges.drop("size").join(F.broadcast(spans), "path")
            .filter((F.col("start") < F.col("close")) & (F.col("stop") > F.col("open")))
            .withColumn("level", F.when(F.col("top") == "{", 2).otherwise(1))
            .select("path", "start", "stop", "state", "depth", "open", "close", "level"))
    text = F.col("value").cast("string")
    parts = (_each_row(_dealt(work, n_tasks(spark, own, split_bytes)), _run, _RUNS)
             .withColumn("found", F.when(F.is_valid_utf8(text), _values(text)))
             .withColumn("ok", F.coalesce(F.size("found") == F.col("n"), F.lit(False))))
    bare = _each_row(_dealt(spans, n_tasks(spark, own, split_bytes)), _bare, _RUNS).withColumn(
        "ok", F.coalesce(F.when(F.is_valid_utf8(text), F.size(_values(text)) == 1), F.lit(False)))
    judged = (parts.select("path", "n", "ok").unionByName(bare.select("path", "n", "ok"))
              .groupBy("path").agg(F.bool_and("ok").alias("ok"), F.sum("n").alias("n")).collect())
    counts = {r.path: r.n for r in judged if r.ok}
    bad += [r.path for r in judged if not r.ok]
    if not counts:
        return {}, None, single, lines, bad
    good = F.broadcast(spark.createDataFrame([(p,) for p in counts], "path string"))
    records = parts.join(good, "path").select(plain_path("path").alias("_source_file"), F.explode("found").alias("t"))
    return counts, records, single, lines, bad
