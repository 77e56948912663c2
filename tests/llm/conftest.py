import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    """Texts with the odd cases: null, empty, blank, very long, repeated rows, null ids, ties."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "one two three"), (5, "one two three"), (None, "no id here"), (6, long)]
    return spark.createDataFrame(rows, "doc_id long, text string")
