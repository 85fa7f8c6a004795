import pytest
from pyspark.sql import types as T

LONG_ID = 7


def _texts() -> dict:
    """Documents with every odd case: null and empty texts, ties, repeats, one long text, odd spaces."""
    sentence = "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf near the river"
    passage = " ".join(f"w{i}" for i in range(60))
    return {
        0: sentence,
        1: sentence + " today",
        2: "",
        3: None,
        4: "   \t\n ",
        5: f"{sentence}\n{passage} end of five",
        6: f"start of six {passage} and more {sentence}",
        LONG_ID: " ".join(f"{sentence} {i} l'été, naïve 日本語  double" for i in range(120)),
        8: "one",
        9: "Two  words",
        10: passage,
        11: passage,
        12: "x" * 400 + " " + "y" * 500,
        13: "don't we're   many    spaces and　marks ▁ <|endoftext|> </s>",
        14: "1234 !!! ???",
    }


@pytest.fixture(scope="session")
def documents(spark):
    """The odd documents with two columns that clash with results, one row twice, one without an id."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "clash", -1.0) for i, t in _texts().items()]
    rows += [(9, "Two  words", None, None, None, None, None), (None, "a row without an id", "en", "s", 19, None, 0.5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def rows_of(documents):
    return [(r["doc_id"], r["text"] or "") for r in documents.collect()]


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory, documents, no_documents):
    """Folders with small tables: ``full`` has the odd documents, ``empty`` has tables without rows."""
    root = tmp_path_factory.mktemp("tables")
    labels = "doc_id long, quality int, toxic int"
    vectors = "vec_id long, embedding array<float>, label int"
    documents.drop("fingerprint", "score").write.parquet(f"{root}/full/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(0, 15)] + [(3, None, None)], labels).write.parquet(f"{root}/full/labels.parquet")
    nan, inf = float("nan"), float("inf")
    some = [(i, [((i * 7 + d * 3) % 11 - 5) / 8 for d in range(4)], 0) for i in range(45)]
    odd = [(100, None, 0), (120, [1.0, None, 0.0, 1.0], 0), (140, [nan, 1.0, 1.0, 1.0], 0), (160, [inf, 1.0, 1.0, 1.0], 0), (180, [], 0), (20, [0.5] * 4, 1), (None, [0.25] * 4, 0)]
    spark.createDataFrame(some + odd, vectors).write.parquet(f"{root}/full/embeddings.parquet")
    no_documents.write.parquet(f"{root}/empty/documents.parquet")
    spark.createDataFrame([], labels).write.parquet(f"{root}/empty/labels.parquet")
    spark.createDataFrame([], vectors).write.parquet(f"{root}/empty/embeddings.parquet")
    assert isinstance(documents.schema, T.StructType)
    return root
