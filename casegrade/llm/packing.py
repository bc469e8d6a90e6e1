"""Best-fit packing by a linear grouping scheme.

Documents are tokenized, ended by an end-of-text id and, if longer than a
sequence, cut into pieces of a full sequence (the first piece takes the rest).
Which lengths share a sequence is then planned on the *histogram of lengths*
(at most ``capacity`` counts, whatever the size of the corpus):

1. Full pieces are sequences. Linear grouping: the other pieces longer than
   ``capacity / SMALL_SHARE`` are sorted and cut into ``GROUPS`` groups of equal
   cardinality; each counts as its group's longest, so few sizes are left.
2. Configurations: how often to use which configuration of these sizes is a
   linear program, solved by column generation (a knapsack over sums prices new
   configurations). ``USED_SHARE`` of each amount, rounded down, is used.
3. Substitution: a configuration's slots take the longest actual lengths that
   fit them, its last slot the longest that fits the room left. (A slot taken by
   a longer piece leaves a shorter one for a larger slot, so there is always one.)
4. Best fit: the pieces left and the small ones, longest first, go where the
   least room is left.

The plan is a list of runs "the items of this length with ranks a to b go to
sequences c to c + b - a at this offset". Its size depends on the capacity
only. Each piece gets its rank among the pieces of its length by a distributed
two-level count (``sharding.add_slots``) and looks its run up in the broadcast
plan. No task holds all pieces of a length.

Defined cases: a null text is an empty one (the end id alone); rows of one id
are separate documents; equal rows are packed as separate items; an empty
table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored
from .sharding import add_slots

CAPACITY = 1024
GROUPS = 60
SMALL_SHARE = 3
USED_SHARE = 0.9
#: The end-of-text id of the packing, and the splitting pattern of
#: this kind of tokenizer.
END_ID = 2
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern for ``single_spaced`` texts, where looking ahead changes nothing.
SPACED_PATTERN = PATTERN.replace(r"\s+(?!\S)|\s+", r"\s")
_OTHER_SPACE = re.compile(r"[^\S \n]")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies print visible Latin-1 bytes as themselves and
    the others, in order, as the characters from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def single_spaced(text: str) -> bool:
    """Whether all white space of a text is single spaces and line feeds between
    visible characters. There a space starts a token, and a line feed is one."""
    return bool(text) and not (
        text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        or _OTHER_SPACE.search(text))


def plain_byte_bpe(spec: dict) -> bool:
    """Whether a tokenizers JSON is what the fast path implements: nothing is
    normalized, ``PATTERN`` splits, and merges come in the order of their ids."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    off = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if (spec.get("normalizer") or spec.get("truncation") or spec.get("padding") or model.get("type") != "BPE"
            or any(model.get(k) for k in off) or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space", True) or not split.get("use_regex", True)):
        return False
    vocab = model["vocab"]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    order = [vocab.get(m, -1) for m in merged]
    byte = _byte_of_symbol()
    return (all(i < j for i, j in zip([-1, *order], order)) and all(c in vocab for c in byte)
            and set(merged) == {t for t in vocab if len(t) > 1 and all(c in byte for c in t)})


class Tokenizer:
    """A byte-level BPE vocabulary (tokenizers JSON): the ids of texts as
    little-endian unsigned 32-bit values.

    Added tokens of the JSON (special ones too) are matched in a text first, the
    leftmost and longest, and what lies between them is encoded by itself. Texts
    that hold an added token with matching rules of its own (single words,
    stripped or normalized), and all texts if the JSON is not ``plain_byte_bpe``,
    go through the tokenizers library.
    """

    def __init__(self, path: str):
        import tiktoken
        import tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        added = [t for t in spec.get("added_tokens") or [] if t["content"]]
        self._plain_bpe = plain_byte_bpe(spec)
        self._library = None
        if not self._plain_bpe or any(t.get(rule) for t in added for rule in ("single_word", "lstrip", "rstrip", "normalized")):
            self._library = tokenizers.Tokenizer.from_file(path)
        self._added = {t["content"]: np.array([vocab.get(t["content"], t["id"])], "<u4").tobytes() for t in added}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")
        if self._plain_bpe:
            byte = _byte_of_symbol()
            ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if all(c in byte for c in token)}
            self._any, self._spaced = (tiktoken.Encoding(f"corpus-{i}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
                                       for i, pattern in enumerate((PATTERN, SPACED_PATTERN)))

    def _ids(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        encoding = self._spaced if single_spaced(text) else self._any
        return np.array(encoding.encode_ordinary(text), "<u4").tobytes() if text else b""

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        out = []
        for text in texts:
            text = text or ""
            held = any(token in text for token in self._added)
            if self._library and (held or not self._plain_bpe):
                out.append(np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            elif held:                               # every second part is an added token
                parts = self._cut.split(text)
                out.append(b"".join(self._added[p] if k % 2 else self._ids(p) for k, p in enumerate(parts)))
            else:
                out.append(self._ids(text))
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str | None) -> Tokenizer:
    return Tokenizer(path or default_tokenizer())


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the pieces of each document.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit values.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    out = rows.select("id").withColumns({
        "piece": F.lit(0), "start": F.lit(0).cast("long"), "length": F.lit(0).cast("long"),
        "ids_crc32": F.lit(0).cast("long")})
    if with_ids:
        out = out.withColumn("ids", F.lit(b""))
    names, end = out.columns, np.array([END_ID], "<u4").tobytes()

    def task(batches):
        tokens = tokenizer(tokenizer_path)
        for run in slices(batches, 1, max_bytes=2 << 20):
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(tokens.encode(run.column(1).to_pylist())):
                data += end
                n = len(data) // 4
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
                for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = data[4 * a:4 * b]
                    owner.append(i)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [run.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names)
    return rows.mapInArrow(task, out.schema)


def equal_groups(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Runs [length, number], the longest first, in groups of equal cardinality.

    A length may be split over groups; groups with the same largest length are one.
    """
    total = sum(counts.values())
    ends = [total * (g + 1) // groups for g in range(groups)]
    out: dict[int, list[list[int]]] = {}              # by largest length
    g = seen = size = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if seen == ends[g] or not seen:
                g, size = next(i for i in range(g, groups) if ends[i] > seen), length
            n = min(left, ends[g] - seen)
            out.setdefault(size, []).append([length, n])
            seen, left = seen + n, left - n
    return list(out.values())


def knapsack(sizes: list[int], worth: np.ndarray, room: int) -> tuple[float, list[int]]:
    """The most that items (repeats allowed) within ``room`` are worth, and their indices."""
    size, least = np.array(sizes), min(sizes)
    best, last = np.zeros(room + 1), np.full(room + 1, -1)        # last: an item of the best filling
    for w in range(least, room + 1):
        fits = size <= w
        ways = np.where(fits, best[np.where(fits, w - size, 0)] + worth, -np.inf)
        i = int(ways.argmax())
        best[w] = best[w - 1]
        if ways[i] > best[w] + 1e-12:
            best[w], last[w] = ways[i], i
    config, w = [], room
    while w >= least:
        if last[w] < 0:
            w -= 1
        else:
            config.append(int(last[w]))
            w -= sizes[config[-1]]
    return float(best[room]), config


def configurations(sizes: list[int], demand: list[int], room: int) -> list[tuple[list[int], float]]:
    """Configurations (indices of sizes, with repeats) and how often to use each.

    The linear program "as few configurations as meet the demand" by column
    generation: the knapsack over the duals prices a new configuration, which
    enters the basis until none is worth more than the sequence it costs. Any
    basis on the way is a plan, so the steps are bounded.
    """
    n = len(sizes)
    used = [[i] * (room // size) for i, size in enumerate(sizes)]
    basis = np.diag([float(len(c)) for c in used])
    for _ in range(40 * n + 200):
        value, config = knapsack(sizes, np.linalg.solve(basis.T, np.ones(n)), room)
        if value <= 1 + 1e-7:
            break
        column = np.bincount(config, minlength=n).astype(float)
        amount, change = np.linalg.solve(basis, np.array(demand, float)), np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.where(change > 1e-9, change, 1), np.inf)
        leaves = int(ratio.argmin())
        basis[:, leaves], used[leaves] = column, config
    return list(zip(used, np.linalg.solve(basis, np.array(demand, float)).tolist()))


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
         small_share: int = SMALL_SHARE) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, number, first sequence, offset), and the number of sequences."""
    runs: list[tuple[int, int, int, int, int]] = []
    taken = dict.fromkeys(counts, 0)
    bins: dict[int, list[tuple[int, int]]] = {}          # room left -> (first sequence, number)
    n_bins = 0

    def put(length, number, sequence, offset):
        runs.append((length, taken[length], number, sequence, offset))
        taken[length] += number

    if counts.get(capacity):
        put(capacity, counts[capacity], 0, 0)
        n_bins = counts[capacity]
    large = {s: n for s, n in counts.items() if capacity // small_share < s < capacity and n}
    members = equal_groups(large, min(groups, sum(large.values())))
    sizes = [g[0][0] for g in members]
    found = configurations(sizes, [sum(n for _, n in g) for g in members], capacity) if members else []
    lengths = sorted(large)                              # those of which some are left
    for config, amount in sorted(found, key=lambda c: sorted((sizes[i] for i in c[0]), reverse=True), reverse=True):
        times = int(amount * USED_SHARE + 1e-6)
        if times <= 0:
            continue
        classes = [(n_bins, times, 0)]
        n_bins += times
        for slot, size in enumerate(sorted((sizes[i] for i in config), reverse=True), 1):
            filled = []
            for sequence, number, used in classes:
                limit = capacity - used if slot == len(config) else size
                while number:                            # at least as many lengths fit as slots are left
                    at = bisect_right(lengths, limit) - 1
                    length = lengths[at]
                    n = min(number, large[length] - taken[length])
                    put(length, n, sequence, used)
                    filled.append((sequence, n, used + length))
                    sequence, number = sequence + n, number - n
                    if taken[length] == large[length]:
                        del lengths[at]
            classes = filled
        for sequence, number, used in classes:
            bins.setdefault(capacity - used, []).append((sequence, number))
    for length in sorted((s for s in counts if s < capacity), reverse=True):
        n = counts[length] - taken[length]
        while n:
            room = next((r for r in range(length, capacity + 1) if bins.get(r)), None)
            if room is None:
                room, number = capacity, -(-n * length // (capacity - capacity % length))
                bins[room] = [(n_bins, number)]
                n_bins += number
            sequence, number = bins[room].pop()
            m = min(n, number)
            put(length, m, sequence, capacity - room)
            n -= m
            bins.setdefault(room - length, []).append((sequence, m))
            if m < number:
                bins[room].append((sequence + m, number - m))
    return runs, n_bins


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset: one row per piece."""
    spark: SparkSession = docs.sparkSession
    cut = stored(pieces(docs, id_col, text_col, capacity, tokenizer_path, with_ids)
                 .withColumn("__row", F.monotonically_increasing_id()), "packing-pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    tables, by_length = {}, {}
    for run in runs:
        by_length.setdefault(run[0], []).append(run[1:])
    for length in counts:
        own = np.array(sorted(by_length[length]), np.int64)
        tables[length] = own[:, 0].copy(), own[:, 2].copy(), own[:, 3].copy()
    shared = spark.sparkContext.broadcast(tables)

    @F.pandas_udf("long")
    def place(length: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.zeros(len(length), np.int64)
        rank = rank.to_numpy(np.int64)
        for value, rows in length.groupby(length).indices.items():
            first, sequence, offset = shared.value[int(value)]
            run = np.searchsorted(first, rank[rows], side="right") - 1
            out[rows] = (sequence[run] + rank[rows] - first[run]) * (capacity + 1) + offset[run]
        return pd.Series(out)
    ranked = add_slots(cut, "length", "__row", "__rank")
    spot = F.col("__spot")
    return (ranked.withColumn("__spot", place("length", "__rank"))
            .withColumns({"sequence_id": F.expr(f"__spot div {capacity + 1}"),
                          "offset": spot % (capacity + 1)})
            .drop("__spot", "__rank", "__row"))
