import pytest
from pyspark.sql import functions as F

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, uid string, size string, "
        "fp string, found string, taken string, component string, `a b` string")
LONG = "palabra " * 30_000 + "x" * 50_000


def odd_rows():
    clean = " ".join(f"wort{i}" for i in range(40))
    rows = [
        (1, clean, "de", "s1"), (2, clean, "de", "s1"),              # equal texts
        (2, clean, "de", "s1"),                                      # repeated row
        (3, None, "de", "s2"), (4, "", None, None), (5, " \t\n ", "en", None),
        (6, LONG, "es", "s2"), (None, "id less text of words", "en", "s1"), (None, None, None, None),
        (7, "<|im_end|> \x1c▁ é ß 你好 🙂", "fr", ""),
        (8, "mail a.b@c.example.org ip 10.0.0.1 or +1 (724) 555-7058 card 4111 1111 1111 1111.", "en", "s3"),
    ]
    return [(i, t, lang, s, None, "u", "s", "f", "x", "t", "c", "sp") for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, None), (8, None, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "*", F.lit(1).alias("uid")).cache()
