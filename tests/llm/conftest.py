import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_texts import ODD_TEXTS  # noqa: E402

CLASHING = "row class shard slot rank text_key component component_id label a b n id bits bucket part host group key kept score places restored hash page".split()

@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns named like inner ones."""
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in ODD_TEXTS], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
