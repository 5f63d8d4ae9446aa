import pytest

#: Names that operators use for columns of their own.
CLASHING = ("score", "predicted", "kept", "class_id", "row", "hits", "bands", "h", "length", "fingerprint",
            "next_text", "clean_text", "sequence_id", "n_words", "segments", "_range", "difference")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows and
    extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 13}." for i in range(30_000))
    prose = "The quick brown fox jumps over the lazy dog near the river bank. " * 3 \
        + " ".join(f"Sentence number {i} tells another story." for i in range(20))
    rows = [(1, prose), (2, None), (3, ""), (4, long), (5, prose), (5, prose), (6, " \n\t "), (None, "orphan text"),
            (None, None), (7, "漢字" * 400), (8, "one"), (9, prose + " Tail."), (9, "same id, other text"),
            (10, "\n\n|||\n"), (11, "x" * 5000)]
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, "en", None, None, *([None] * len(CLASHING))) for r in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
