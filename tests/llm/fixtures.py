"""Small tables with the awkward rows every operator must take."""

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties, a
    long text."""
    text = "The quick brown fox jumps over the lazy dog and runs away from it"
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [(1, text, "en", "a", len(text)), (2, text, "en", "b", len(text)), (2, text, "en", "b", len(text)),
            (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \n\t ", "de", "a", 4), (None, text, None, None, None),
            (None, None, None, None, None), (6, long, "en", "a", len(long)), (7, long + " end", "en", "c", None),
            (8, "one two", "en", "a", 7), (9, "one two", "en", "c", 7), (10, "Ünï cödé 漢字 🙂\n\nx", "fr", "é", None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
