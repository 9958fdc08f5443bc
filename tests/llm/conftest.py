from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with
    columns whose names the operators use themselves."""

    def make(rows):
        full = [(r + (None, None))[:4] + (len(r[1] or ""),) for r in map(tuple, rows)]
        from pyspark.sql import functions as F
        return (spark.createDataFrame(full, DOCS).withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit(7))
                .withColumn("component_id", F.lit(-1)).withColumn("score", F.lit("x")).withColumn("n", F.lit(None)))

    return make
