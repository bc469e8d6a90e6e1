"""Tables of odd rows for the corpus operators."""

#: doc_id, text and other columns whose names clash with those of the operators
DOCS_DDL = ("doc_id long, text string, lang string, source string, n_chars long, id string, d string, k string, "
            "fp string, score string, length string, start string, term string, block string, t string, u string, "
            "`odd.name` string, N_Words string, n_removed string, removed string, kept_text string, __d string, rank string, "
            "size string, item string")


def docs_df(spark, rows):
    """Rows of (doc_id, text[, lang]) as a table with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *["x"] * 20) for r in rows]
    return spark.createDataFrame(full, DOCS_DDL)


LONG = " ".join(f"w{i * 7919 % 1013}" for i in range(20_000))
#: nulls, empty and blank texts, odd white space, a very long text, equal rows, one id with two texts
ODD_ROWS = [
    (None, "no id at all but some words here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
    (5, "Zwei Wörter\x0bund  Tab\tund\nZeile   geschützt   weit"), (6, LONG), (7, LONG), (8, "same row"),
    (8, "same row"), (8, "same id, other text"), (9, "\x00 control \x1c chars \U0001F600 emoji İ dotted"),
    (None, None), (10, " leading and trailing "), (-3, "negative id"),
]
