"""Documents that operators must handle without a special case."""

DOCS = "doc_id bigint, text string, source string, lang string, n_words bigint, size string, score string, items string, p string, m_u string"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def docs(spark, rows):
    """Rows of (doc_id, text, source) with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, s, None, 5, "x", "y", "z", "a", "u") for i, t, s in rows], DOCS)


HARD = [(1, None, "p"), (2, "", None), (3, "one two", "p"), (3, "one two", "p"), (None, "one two", None), (4, LONG, "q"),
        (5, LONG + " end", "q"), (6, "\u00e9\u00e8 \u4f60\u597d \U0001f600\u00a0x\n\n\t", "q"), (7, "   \n ", "p")]
