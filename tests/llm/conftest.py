import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, copies, ties, repeated rows, and extra columns of clashing names."""
    rows = [
        (1, "Same text here", "en", "a", 14), (2, "Same text here", "en", "a", 14), (2, "Same text here", "en", "a", 14), (3, "", "en", "b", 0), (4, None, None, None, None), (5, " ".join(WORDS * 3000), "en", "a", 1),
        (6, "A line that is long enough to count\nother", "de", "c", 2), (7, "  a LINE that is long enough to count\t\nmine\nmine", "de", "c", 2), (8, "x\nA line that is long enough to count", "fr", "a", 3),
        (None, "Same text here", "en", "a", 14), (9, "\n\n", "en", "b", 2), (10, "日本語のとても長いテキスト行がここにあります、二十文字以上\n短い", "ja", "d", 5), (-3, "é" * 19 + "\nnegative id", "fr", "b", 4),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in ("digest", "key", "fp", "label", "_n", "h", "node", "slice", "tokens", "t", "_drop", "_doc", "_n_lines", "_n_dropped", "_score", "_predicted", "_nearest", "_gone", "_mixed", "_epoch", "_turn", "_place", "epoch", "place", "keep_id")}).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def huge():
    """A text of 50 MB: words, long lines, and one line that other texts have too."""
    line = " ".join(f"{w}{i}" for i in range(300) for w in WORDS)
    own = "\n".join(f"{k} {line}" for k in range(50_000_000 // len(line)))
    return f"{own}\nA line that is long enough to count\nTOKEN = \"0cf1bbc67ab39b2ddebadc809bed189ed8c6ac4d\"\n"
