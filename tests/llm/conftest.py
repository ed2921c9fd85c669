import pytest

from streamsync.llm.common import ship_package

#: Columns that have names which the operators use themselves.
CLASHING = "score found held_out Epoch n_tokens weight component nth run place query length sequence_id hashed"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """Build a documents table from (doc_id, text, lang, source), with clashing columns."""

    def build(rows):
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame(rows, schema)
        from pyspark.sql import functions as F

        return df.select("*", *[F.lit("x").alias(c) for c in CLASHING.split()])

    return build
