"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text has a lookup table over bins; some pairs of features
have a table over pairs of bins. The score is the logistic of their sum, so
scoring is one addition per table. Cyclic boosting fits the tables: in turn,
each feature gets a shallow tree (at most four leaves over its bins) fitted to
the current gradient, of which a small step is added to its table; then pairs,
chosen by what their joint bins explain of the residual, get the same with
trees that split either feature.

Training uses at most ``TRAIN_ROWS`` labelled rows (those with the smallest
hashes of their ids), brought to the driver as feature rows of about 100 bytes;
of rows with one id the text with the smallest hash teaches.
Bins are quantiles of that sample. All texts are scored, whole.

Defined cases: a null or empty text has the features of an empty text and a
score like any other; a null label or id teaches nothing; of contradictory
labels of one id the lowest counts; without labels of both kinds the score is
the smoothed share of label 1 (0.5 without labels); one output row for each
input row; equal texts get equal scores; a text of any length is scored whole
(a task holds its words).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, named, slices

TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 6
RATE = 0.1
PENALTY = 1.0
MIN_HESSIAN = 1.0

FEATURES = ("log_words", "word_length", "symbols", "upper", "punctuation", "digits", "high_bytes", "bars",
            "repeated_lines", "line_words", "distinct_words", "distinct_triples", "top_word", "same_next")
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&<>@~^_=+\\{}[]"
_PUNCTUATION = b".,;:!?'\"()-"
_HIGH = bytes(range(128, 256))


def features(text: bytes | None) -> list[float]:
    """The feature values of a text, in the order of ``FEATURES``."""
    text = text or b""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))

    def share(chars):
        return (len(text) - len(text.translate(None, chars))) / size
    lines = [x for x in (line.strip() for line in text.split(b"\n")) if x]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    triples = max(1, len(words) - 2)
    return [
        np.log1p(len(words)), sum(map(len, words)) / n, share(_SYMBOLS), share(_UPPER), share(_PUNCTUATION),
        share(_DIGITS), share(_HIGH), share(b"|"), (len(lines) - len(set(lines))) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))), len(seen) / n,
        len(set(zip(words, words[1:], words[2:]))) / triples if len(words) > 2 else 1.0,
        max(seen.values(), default=0) / n, sum(map(bytes.__eq__, words, words[1:])) / n]


def _table(run: pa.RecordBatch, column: int) -> np.ndarray:
    rows = [features(t.as_py()) for t in run.column(column)]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)         # fine bin -> pair bin, per feature
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        for b, table in zip(bins, self.tables):
            total += table[b]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain and cut of a run of bins in two (0: no cut)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + PENALTY) + gr ** 2 / (hr + PENALTY) - g.sum() ** 2 / (h.sum() + PENALTY)
    gain[(hl < MIN_HESSIAN) | (hr < MIN_HESSIAN)] = 0.0
    cut = int(gain.argmax())
    return (float(gain[cut]), cut + 1) if gain[cut] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values of a tree over a grid of bins of any number of dimensions."""
    best = (0.0, 0, 0)
    for axis in range(g.ndim) if depth else ():
        others = tuple(a for a in range(g.ndim) if a != axis)
        gain, cut = _split(g.sum(axis=others), h.sum(axis=others))
        best = max(best, (gain, axis, cut))
    if not best[2]:
        return np.full(g.shape, g.sum() / (h.sum() + PENALTY))
    _, axis, cut = best
    left, right = np.split(g, [cut], axis=axis), np.split(h, [cut], axis=axis)
    return np.concatenate([_tree(a, b, depth - 1) for a, b in zip(left, right)], axis=axis)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on the rows of ``x`` with labels ``y`` (0 or 1)."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Model(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
        model.edges.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
        model.coarse.append(np.arange(len(cuts) + 1) * PAIR_BINS // (len(cuts) + 1))
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def gradient():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    def step(table, flat):
        g, h = gradient()
        update = RATE * _tree(np.bincount(flat, g, table.size).reshape(table.shape),
                              np.bincount(flat, h, table.size).reshape(table.shape), 2)
        table += update
        total[:] += update.ravel()[flat]
    for _ in range(ROUNDS):
        for b, table in zip(bins, model.tables):
            step(table, b)
    g, h = gradient()
    coarse = [c[b] for c, b in zip(model.coarse, bins)]

    def strength(i, j):
        flat = coarse[i] * PAIR_BINS + coarse[j]
        a, b = np.bincount(flat, g, PAIR_BINS ** 2), np.bincount(flat, h, PAIR_BINS ** 2)
        return (a ** 2 / (b + PENALTY)).sum()
    every = [(i, j) for i in range(len(bins)) for j in range(i + 1, len(bins))]
    model.pairs = sorted(every, key=lambda p: -strength(*p))[:PAIRS]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step(table, coarse[i] * PAIR_BINS + coarse[j])
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", usable: Column | None = None, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` of the labels of documents in ``docs``; ``usable`` filters label rows."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.filter(usable) if usable is not None else known
    known = known.join(docs.select(F.col(id_col).alias("__held")).distinct(), F.col(id_col) == F.col("__held"), "left_semi")
    picked = (known.groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).cast("int").alias("y"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    labelled = texts.join(F.broadcast(picked), F.col("id") == F.col("label_id")).select(
        "t", "label_id", F.xxhash64("t").alias("h"), "y")

    def task(batches):
        for run in slices(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [*run.columns[1:], *(pa.array(c) for c in _table(run, 0).T.copy())], ["label_id", "h", "y", *FEATURES])
    schema = labelled.drop("t").withColumns({name: F.lit(0.0) for name in FEATURES}).schema
    one = (labelled.mapInArrow(task, schema).groupBy("label_id")
           .agg(F.min(F.struct("h", *FEATURES, "y")).alias("row")))
    got = one.select(*[F.col(f"row.{name}") for name in (*FEATURES, "y")]).toArrow()
    x = np.stack([got.column(name).to_numpy() for name in FEATURES], axis=1) if got.num_rows else \
        np.zeros((0, len(FEATURES)))
    order = np.lexsort(x.T) if len(x) else []
    return fit(x[order], got.column("y").to_numpy().astype(np.float64)[order])


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] = (),
          score_col: str = "score") -> DataFrame:
    """The ``keep`` columns with the probability of label 1."""
    if score_col in keep:
        raise ValueError(f"output column exists already: {score_col}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).cast("binary").alias("__t"), *named(keep))
    out = rows.drop("__t").withColumn(score_col, F.lit(0.0))
    names = out.columns

    def task(batches):
        for run in slices(batches, 0):
            yield pa.RecordBatch.from_arrays([*run.columns[1:], pa.array(shared.value.score(_table(run, 0)))], names)
    return map_arrow(rows, task, out.schema)
