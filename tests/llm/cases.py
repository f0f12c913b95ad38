"""Odd rows that every operator has to take, with other columns whose names clash."""

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ODD_ROWS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "one two three"),
    (None, None), (5, "One  TWO\nthree"), (6, LONG), (7, LONG), (7, LONG), (4, "another four"),
]
EXTRA = ("words string, n_words string, score int, fp string, at string, text_key string, "
         "spans string, digest string, label string, lang_pred string, m string, "
         "fresh string, cuts string, told string, doc string")


def odd_documents(spark, rows=ODD_ROWS):
    rows = [(*row, *["x"] * 2, 3, *["y"] * 12) for row in rows]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {EXTRA}")


def repeated_by_id(rows):
    """The distinct (doc_id, text) of rows, null texts as empty ones."""
    return {(doc, text or "") for doc, text in rows}
