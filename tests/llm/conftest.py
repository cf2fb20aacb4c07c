import pytest

from fieldmill.llm.tables import table


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, and a clashing extra column."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, None, None, None, 0),
        (2, "", "s", "en", 1),
        (3, " \t\n ", "s", None, 2),
        (4, "one two", "s", "en", 3),
        (4, "one two", "s", "en", 3),
        (None, "one two", None, "en", 4),
        (5, long, "t", "de", 5),
        (6, long + " more", "t", "de", 6),
        (7, "Größe ÄÖ \U0001f600 été", "t", "fr", None),
    ]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, n_chars long"
    )
    # names that the operators use themselves
    for name in ("bands", "block", "seed", "score", "row", "component_id", "range", "head", "at"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame
