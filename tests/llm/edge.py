"""Documents with the awkward cases every operator must take."""

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "s"),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "s"),   # repeated row
    (2, None, "en", "s"),
    (3, "", None, None),
    (4, " \t\n\x0b ", "de", None),
    (5, LONG, "en", "s"),
    (6, "x", None, "s"),
    (None, "A row without an identifier has ten words or more, it does.", "en", "s"),
    (1, "The same identifier again with quite another text, which is allowed here.", "en", "t"),
    (7, "Ünï\u0000cödé \U0001F600   mixed\r\nlines ▁ here", "fr", "s"),
    (None, None, None, None),
]
CLASH = ("kept", "n", "node", "text_hash", "lang_pred", "_decided", "d2", "x0", "m", "q", "target", "bands", "part", "row_key", "base")


def documents(spark, rows=ROWS, clash=True):
    """A documents table, with extra columns named like work columns."""
    extra = CLASH if clash else ()
    data = [(*r, len(r[1]) if r[1] is not None else None, *("?" for _ in extra)) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame(data, schema)
