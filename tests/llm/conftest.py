"""Small fixtures: edge rows, and tables written as the queries read them."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that an operator could use for itself
    T.StructField("size", T.StringType()), T.StructField("_row", T.StringType()),
    T.StructField("n_words", T.StringType()), T.StructField("bucket", T.StringType())])

SYLLABLES = ["an", "ble", "tion", "é", "ouê", "ñas", "the", "wh", "ing", "ço", "ß", "ment", "日本"]


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        out.append("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))))
        if i % 17 == 16:
            out[-1] += ".\n" if i % 34 == 33 else ","
    return " ".join(out).replace("\n ", "\n")


def edge_texts() -> list:
    rng = random.Random(7)
    base = prose(rng, 120)
    return [None, "", " ", "\n\n \t", "a", "A b", "one two three four five", base, base,
            base.replace("the", "The"), base + " tail", "x" * 30000, prose(rng, 9000),
            "line one is here\nline one is here\n\nline one is here\nother", "#*$%& <|> #### a", "a  b\n\n c\r\n\x0bd   e f",
            "word " * 400, "<|endoftext|> a\x00b", "ÀÉ ümlaut İstanbul", *[prose(rng, rng.randint(5, 300)) for _ in range(40)]]


def rows_of(texts: list, first: int = 0) -> list:
    rng = random.Random(3)
    rows = []
    for i, t in enumerate(texts):
        lang = None if i % 11 == 10 else rng.choice(["en", "fr", "de"])
        source = None if i % 13 == 12 else ("src0" if i % 3 == 0 else f"src{rng.randint(1, 4)}")
        rows.append((first + 3 * i, t, lang, source, len(t or ""), "s", "r", "w", "b"))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    from aisle.llm.queries import share_code
    share_code(spark)
    return spark.createDataFrame(rows_of(edge_texts()), DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark, edge_docs):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def table(tmp_path):
    """Write DataFrames as <name>.parquet in a new folder; returns the folder."""
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write
