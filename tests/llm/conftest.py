import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"


def edge_rows(start):
    """Null, empty, wordless, very long and repeated rows, and one without an id."""
    return [
        (start, None, None, None, None), (start + 1, "", "en", "src1", 0), (start + 2, " \n\t ", "de", None, 4),
        (start + 3, "a " * 30_000, "en", "src2", 60_000), (start + 3, "a " * 30_000, "en", "src2", 60_000),
        (None, "no id but a text of some words that others have too, some words that others have", "en", "src1", 80),
        (start + 4, "7 7 7 4111 1111 1111 1111", None, "src3", 25), (start + 5, "é" * 200 + " ñ", "es", "src3", 202),
    ]


@pytest.fixture(scope="session")
def documents():
    """Rows (doc_id, text, lang, source, n_chars)."""
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in table]
    return rows + edge_rows(10_000)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, run long, score double, _id long"


@pytest.fixture(scope="session")
def docs(spark, documents):
    """The rows with extra columns whose names the operators use themselves."""
    rows = [(*r, "x", 1, 0.5, 7) for r in documents]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHING = ["_row", "_done", "_spans", "_candidates", "_copy", "_order", "_found", "_all", "_id", "score", "lang_pred",
            "rejected", "fingerprint", "__mix_n", "rate", "counts", "measures", "kept", "piece", "tree", "path"]


@pytest.fixture(scope="session")
def clashing(spark, documents):
    """The rows with columns that bear all names the operators use for themselves."""
    rows = [(*r, *[f"{c}-{r[0]}" for c in CLASHING]) for r in documents]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3).cache()
