"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to 3 characters) of every labelled text, per
language and bucket, in each task; Spark sums the tasks' counts. The
log-probability matrix (languages x buckets) is broadcast after a check of its
size. Scoring works on runs of texts: the n-grams of a run are one sparse list
of buckets, each language's log probabilities are gathered by bucket and summed
per text.

Characters: letters are lower-cased, everything else is one space, and a text
starts and ends with a space. Texts longer than ``SEGMENT`` characters are read
in segments that carry on the characters before them; their n-grams are those of
the whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from. Equal texts get equal
predictions. Ties between languages go to the alphabetically first. A row with
a null language is not learned from. One output row for each input row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, named, slices, stored

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SEGMENT = 1 << 20
TASK_LANGUAGES = 256
MAX_MATRIX_BYTES = 256 << 20
UNKNOWN = "und"
_SPACE = 32
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a space for what is not a letter."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            table[cp] = ord(ch.lower()[0])
    return table


def _codes(text: str) -> np.ndarray:
    return _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    h = np.full(len(codes) - order + 1, order, np.uint64)
    for j in range(order):
        h += codes[j:j + len(h)] * _MIX[j]
    h ^= h >> np.uint64(29)
    h *= _MIX[0]
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _run_buckets(texts: list[str], first: int):
    """The n-grams of a run of whole texts, numbered from ``first``."""
    codes = _codes(" " + "  ".join(texts) + " ")
    doc = np.repeat(np.arange(first, first + len(texts)), [len(t) + 2 for t in texts])
    space = codes == _SPACE
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (doc[1:] == doc[:-1]))
    codes, doc, space = codes[keep].astype(np.uint64), doc[keep], space[keep]
    lettered = np.unique(doc[~space])
    for order in ORDERS:
        if len(codes) < order:
            continue
        inside = ~space if order == 1 else doc[:len(doc) - order + 1] == doc[order - 1:]
        yield _buckets(codes, order)[inside], doc[:len(doc) - order + 1][inside], lettered


def _long_buckets(text: str, number: int):
    """The same of one long text, a segment at a time: each carries on the last
    characters of the folded text before it, so no n-gram is lost at a cut."""
    carried = np.array([_SPACE], np.uint64)
    for at in range(0, len(text), SEGMENT):
        fresh = _codes(text[at:at + SEGMENT] + (" " if at + SEGMENT >= len(text) else "")).astype(np.uint64)
        codes = np.concatenate([carried, fresh])
        space = codes == _SPACE
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        codes, space, old = codes[keep], space[keep], int(keep[:len(carried)].sum())
        lettered = np.full(int((~space).any()), number)
        for order in ORDERS:
            start = max(0, old - order + 1)          # n-grams with a character of this segment
            if len(codes) - start < order or len(codes) == old:
                continue
            found = _buckets(codes[start:], order)
            if order == 1:
                found = found[~space[start:]]
            yield found, np.full(len(found), number), lettered
        carried = codes[-(max(ORDERS) - 1):]


def ngram_buckets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of (bucket, text index) of all n-grams, and the texts with a letter."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size + len(texts[end] or "") <= SEGMENT:
            size += len(texts[end] or "")
            end += 1
        if end > at:
            yield from _run_buckets([t or "" for t in texts[at:end]], at)
        else:
            yield from _long_buckets(texts[at], at)
            end += 1
        at = end


def _count_task(batches):
    """Dense counts per language in the task; one row for each bucket in use.

    At most ``TASK_LANGUAGES`` tables are held; they are given away when more come.
    """
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def found():
        for name, counts in totals.items():
            used = np.flatnonzero(counts)
            bucket = np.append(used, -1).astype(np.int32)        # -1: the number of texts
            n = np.append(counts[used], docs[name])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(bucket), pa.string()), pa.array(bucket), pa.array(n)], ["lang", "bucket", "n"])

    def parts():
        for run in slices(batches, 0):
            if len(set(run.column(1).to_pylist())) <= TASK_LANGUAGES:
                yield run
            else:
                yield from (run.slice(i, TASK_LANGUAGES) for i in range(0, run.num_rows, TASK_LANGUAGES))
    for run in parts():
        texts, langs = run.column(0).to_pylist(), run.column(1).to_pylist()
        names = sorted(set(langs))
        if len(set(totals).union(names)) > TASK_LANGUAGES:
            yield from found()
            totals, docs = {}, {}
        index = np.array([names.index(x) for x in langs], np.int64)
        for name in names:
            totals.setdefault(name, np.zeros(BUCKETS, np.int64))
            docs[name] = docs.get(name, 0) + langs.count(name)
        for bucket, owner, _ in ngram_buckets(texts):
            flat = np.bincount(index[owner] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
            for i, name in enumerate(names):
                totals[name] += flat[i * BUCKETS:(i + 1) * BUCKETS]
    yield from found()


class Model:
    """Languages, log-probability matrix and log priors."""

    def __init__(self, languages: list[str], matrix: np.ndarray, priors: np.ndarray):
        self.languages, self.matrix, self.priors = languages, matrix, priors


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from every row whose language is not null.

    What reaches the driver is languages x buckets sums, not texts; more
    languages than ``MAX_MATRIX_BYTES`` allows raise an error.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = stored(rows.filter(F.col("lang").isNotNull())
                    .mapInArrow(_count_task, "lang string, bucket int, n bigint")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "langid-counts")
    most = MAX_MATRIX_BYTES // (BUCKETS * 4)
    langs = sorted(r.lang for r in counts.filter("bucket = -1").select("lang").limit(most + 1).collect())
    if len(langs) > most:
        raise ValueError(f"over {most} languages: the matrix would exceed {MAX_MATRIX_BYTES} bytes")
    matrix, priors = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    row = {lang: i for i, lang in enumerate(langs)}
    table = counts.toArrow() if langs else None
    if table is not None:
        who = np.array([row[x] for x in table.column("lang").to_pylist()], np.int64)
        bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
        total = bucket < 0
        priors[who[total]] = n[total]
        matrix[who[~total], bucket[~total]] = n[~total]
    matrix += SMOOTHING
    matrix = np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(langs, matrix, np.log(priors / max(1, priors.sum())) if langs else priors)


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    n, k = len(texts), len(model.languages)
    total = np.zeros((k, n))
    lettered = np.zeros(n, bool)
    if k:
        total += model.priors[:, None]
        for bucket, owner, with_letter in ngram_buckets(texts):
            lettered[with_letter] = True
            for i in range(k):
                total[i] += np.bincount(owner, weights=model.matrix[i][bucket], minlength=n)
    if not k or not n:
        return [UNKNOWN] * n, np.zeros(n)
    best = total.argmax(axis=0)
    score = 1.0 / np.exp(total - total.max(axis=0)).sum(axis=0)
    return ([model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
            np.where(lettered, np.clip(score, 0.0, 1.0), 0.0))


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] = (),
            pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The ``keep`` columns with a predicted language and its posterior."""
    clash = {pred_col, score_col} & set(keep)
    if clash:
        raise ValueError(f"output columns exist already: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), *named(keep))

    def score_task(batches):
        for run in slices(batches, 0):
            names, score = predict_texts(shared.value, run.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*run.columns[1:], pa.array(names, pa.string()), pa.array(score, pa.float64())], out_names)
    out_names = [*keep, pred_col, score_col]
    schema = rows.drop("__text").withColumn(pred_col, F.lit("")).withColumn(score_col, F.lit(0.0)).schema
    return map_arrow(rows, score_task, schema)
