"""Rows that every operator must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use as names of their own.
CLASH = (
    "size long, target double, taken long, start long, key string, digest string, kept boolean, point long, label string, "
    "fingerprint string, component_id long, tokens long, sequence_id long, offset long, spans string, score double, id long, "
    "_told string, _row_key string, _chosen_id long, _chosen_key string, _times int, row string, told string, times int, "
    "chosen_id long, chosen_key string, text_key long, order long, lang_pred string, values string, quality int, n long, "
    "form string, h1 long, output string, term string, `a.b` string"
)


def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and further columns with clashing names."""
    long_text = " ".join(f"wort{i % 97} wörter{i % 31}" for i in range(4000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "b", 0),
        (3, " \t\n", "en", "b", 3),
        (4, long_text, "de", "a", len(long_text)),
        (5, "Same text here, twice.", "en", "a", 1),
        (6, "SAME text here, twice.", "en", None, 1),
        (6, "SAME text here, twice.", "en", None, 1),
        (7, "12345 --- 67890", "en", "c", 1),
        (None, "a row without an id", "fr", "c", 1),
        (None, None, None, None, None),
        (8, "x" * 5000, "en", "a", 5000),
        (9, "ünïcödé 日本語 \U0001f600 text", "de", "c", 1),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    for column in CLASH.split(", "):
        name, kind = column.split()
        frame = frame.selectExpr("*", f"cast({1 if kind != 'string' else repr(name)} as {kind}) as {name}")
    return frame


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
