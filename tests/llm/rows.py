"""Awkward documents for every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD = [
    (1, None, None, None, None),
    (None, "a text whose id is null, of the and the to in", "en", "src0", 10),
    (None, None, None, None, None),
    (2, "", "en", "src0", 0),
    (3, " \t\n\r\x0b\x0c ", "en", None, 6),
    (4, "one", "en", "src1", 3),
    (5, "Ünïcödé 日本語 \U0001f600 text\x00with nul <|endoftext|> password = \"abcdefgh1\"", "xx-YY", "src1", 30),
    (6, "same words here " * 40, "en", "src1", 640),
    (6, "same words here " * 40, "en", "src1", 640),
    (6, "same id, another text of the kind that is not like it at all", "en", "src1", 60),
    (7, "long " * 60_000 + "token=0123456789abcdef0123456789abcdef01234567", "en", "src1", 300_046),
    (8, "x" * 100_000, "en", "src1", 100_000),
    (9, "same words here " * 40, "de", "src2", 640),
    (-3, "line one of the text\n\nline one of the text\nline two", None, "src2", 50),
]


def odd_documents(spark: SparkSession, extra: bool = True) -> DataFrame:
    """The rows above, with further columns named like operators' own."""
    docs = spark.createDataFrame(ODD, SCHEMA)
    names = "fp fingerprint component_id ids decoded kept score label key rate copies spans language p tokens id part host".split()
    return docs.withColumns({n: F.lit("clash") for n in names}) if extra else docs


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, texts, **columns) -> DataFrame:
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)
