"""Documents for the tests."""

EXTRA = (
    "doc_id long, text string, lang string, source string, n_chars long, words string, n int, node string, site string, "
    "kept int, row string, leaks int, hash long"
)


def documents(spark, texts, lang="en", source="s"):
    """Documents with columns whose names operators use for their own."""
    rows = [(i, t, lang, source, len(t or ""), "w", 1, "n", "s", 1, "r", 0, 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, EXTRA)


def prose(draw, n, words=400):
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))
