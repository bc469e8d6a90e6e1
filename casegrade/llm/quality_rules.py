"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Measures of a text (words lie between ASCII white space): words, their
characters, symbols, lines equal to an earlier line, words in 8-word windows
found twice or more. Two base rules are fixed; the others reject a text whose
ratio is above a cutoff that labelled documents choose:

For each stratum (language), rule and candidate cutoff, count the labelled good
documents ``n`` and those the cutoff would reject, ``k``. If the true rate of
false rejections were ``limit``, seeing ``k`` or fewer would have the exact
binomial probability P(Bin(n, limit) <= k). The cutoff is certified if that is
at most ``RISK`` / (number of tests): with all strata, rules and cutoffs
corrected for together (Bonferroni), the chance that any certified cutoff
rejects more than ``limit`` of the good documents of its stratum is at most
``RISK``. Each rule takes its lowest certified cutoff; none certified, or a
stratum without labels, means the rule rejects nothing there. Per stratum, all
rules together reject at most ``MAX_FALSE_REJECTION`` of good documents.

The cutoffs are a fixed grid, so every label is held out: nothing was fitted.

Windows of a text are equal if their 64-bit hashes are. Nothing is shuffled
but the labelled rows and one row per stratum and task.

Defined cases: a null text is an empty one (no words: base-failed); a null
language is the stratum ``none``; a null id matches no label; of contradictory
labels of one document the worst counts; one output row for each input row; an
empty table gives no rows, an empty label table no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, stored

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
MAX_FALSE_REJECTION = 0.04
RISK = 0.05
SMALL_ROWS = 100_000

#: Rule -> (ratio of the measures, candidate cutoffs).
RULES: dict[str, tuple[str, list[float]]] = {
    "repeats": ("n_repeat_words / n_words", [0.02 * i for i in range(1, 16)]),
    "dup_lines": ("n_dup_lines / n_lines", [0.05 * i for i in range(1, 13)]),
    "symbols": ("n_symbols / word_chars", [0.005 * i for i in range(1, 21)]),
    "word_length": ("word_chars / n_words", [6.0 + 0.5 * i for i in range(0, 25)]),
}
_WHITE = " \t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, whatever body does with it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(w: Column, window: int) -> Column:
    """Words inside windows whose hash occurs twice or more in the array ``w``."""
    last = F.size(w) - window
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(w, i + 1, window)))

    def covered(at):
        return F.aggregate(
            F.transform(at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window)))),
            F.lit(0), lambda a, x: a + x)

    def twice(s):
        return F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))

    def search(h):
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = _let(ordered, lambda s: F.array_sort(F.transform(twice(s), lambda e: e["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(starts, covered))
    return F.when(last < 1, 0).otherwise(_let(hashes, search)).cast("long")


def measures(text: Column) -> Column:
    """A struct of the measures of a text."""
    text = F.coalesce(text, F.lit(""))

    def of(w):
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_WHITE)) != "")
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("all"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))).alias("lines"),
            _repeat_words(w, REPEAT_WINDOW).alias("n_repeat_words"))
    return _let(F.array_remove(F.split(text, r"[ \t-\r]+"), ""), of)


def measured(docs: DataFrame, text_col: str = "text", stratum_col: str = "lang", keep: list[str] = ()) -> DataFrame:
    """``keep`` columns, measures, ratios (struct ``ratio``), stratum, base_failed."""
    rows = docs.select(*named(keep), F.coalesce(F.col(stratum_col).cast("string"), F.lit("none")).alias("stratum"),
                       measures(F.col(text_col)).alias("m"))
    rows = rows.select(*named(keep), "stratum", "m.n_words", "m.word_chars", "m.n_symbols",
                       F.col("m.lines.all").alias("n_lines"), F.col("m.lines.again").alias("n_dup_lines"),
                       "m.n_repeat_words")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    ratio = F.struct(*[F.coalesce(F.expr(f"try_divide({a}, {b})"), F.lit(0.0)).alias(name)
                       for name, (expr, _) in RULES.items() for a, b in [expr.split(" / ")]])
    return rows.withColumns({"base_failed": base, "ratio": ratio})


def _log_gamma(x: Column) -> Column:
    """ln(gamma(x)) for x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    z = x + 8.0
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7)
    back = sum((F.log(x + float(i)) for i in range(1, 8)), F.log(x))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - back


def binomial_tail(n: Column, k: Column, rate: float, terms: int = 5000) -> Column:
    """P(Bin(n, rate) <= k), or 1 where k is at least the mean.

    Summed downwards from k; what lies beyond ``terms`` is bounded by a
    geometric series and added, so the value is never too small.
    """
    n, k = n.cast("double"), k.cast("double")
    log_top = (_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
               + k * math.log(rate) + (n - k) * math.log1p(-rate))

    def ratio(j):
        return (k - j) * (1 - rate) / ((n - k + j + 1) * rate)
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(terms))).cast("int"))
    total = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct((a["term"] * ratio(j.cast("double"))).alias("term"), (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"] + F.when(k > terms, a["term"] / (1 - ratio(F.lit(float(terms))))).otherwise(0.0))
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_top) * total))


def thresholds(good: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, risk: float = RISK) -> DataFrame:
    """(stratum, cutoffs): the lowest certified cutoff of each rule, or null.

    ``good`` holds the measured, labelled good documents that pass the base rules.
    """
    tests = [(name, c) for name, (_, cutoffs) in RULES.items() for c in cutoffs]
    counts = good.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(c).alias("cutoff"),
                           F.count_if(F.col("ratio")[name] > c).alias("k")) for name, c in tests]).alias("tests"))
    strata = counts.agg(F.count(F.lit(1)).alias("n_strata"))
    each = counts.crossJoin(F.broadcast(strata)).select("stratum", "n", "n_strata", F.explode("tests").alias("t"))
    certified = binomial_tail(F.col("n"), F.col("t.k"), max_false_rejection / len(RULES)) <= \
        risk / (F.col("n_strata") * len(tests))
    return each.filter(certified).groupBy("stratum").agg(
        F.struct(*[F.min(F.when(F.col("t.rule") == name, F.col("t.cutoff"))).alias(name) for name in RULES])
        .alias("cutoffs"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", label_id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """id, measures, base_failed, kept, and the rules that rejected the row."""
    rows = stored(measured(docs.select(F.col(id_col).alias("id"), text_col, stratum_col), text_col, stratum_col, ["id"]),
                  "quality-measures")
    good_ids = (labels.groupBy(F.col(label_id_col).alias("good_id")).agg(F.min(label_col).alias("worst"))
                .filter("worst = 1").select("good_id"))
    good = rows.filter(~F.col("base_failed")).join(good_ids, F.col("id") == F.col("good_id"), "left_semi")
    cutoffs = stored(thresholds(good), "quality-cutoffs").withColumnRenamed("stratum", "its")
    if cutoffs.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        cutoffs = F.broadcast(cutoffs)
    met = rows.join(cutoffs, F.col("stratum") == F.col("its"), "left")
    broken = [F.when(F.col("ratio")[name] > F.col("cutoffs")[name], F.lit(name)) for name in RULES]
    return met.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.array_compact(F.array(*broken)).alias("broken")).withColumn(
            "kept", ~F.col("base_failed") & (F.size("broken") == 0))
