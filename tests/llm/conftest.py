import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with names used inside."""
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \t\n ", None),
        (4, long, "en"),
        (4, long, "en"),
        (5, long + " tail", "en"),
        (6, "x" * 300_000, "en"),
        (None, "no id here", "fr"),
        (None, "no id here", "fr"),
        (None, None, None),
        (7, "Ünïcödé ▁ 日本語 🙂 \x00 text", "de"),
        (8, "a a a a a " * 40, "en"),
        (9, "12345 67890 !!!", "en"),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long,"
        " k0 int, t string, h long, code string, score double, c0 string, `a.b` int, row int, spans string"
    )
    return spark.createDataFrame(
        [(i, t, l, "s", len(t or ""), 1, "t", 2, "c", 0.5, "z", 3, 4, "y") for i, t, l in rows], schema
    )


@pytest.fixture(scope="session")
def rows_of():
    """Rows as sorted text, so that nulls compare."""
    return lambda df: sorted(repr(tuple(r)) for r in df.collect())
