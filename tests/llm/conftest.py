import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from waymark.llm.common import ship
    ship(spark)


@pytest.fixture
def rows(spark):
    """rows(data, schema): a small table with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    def make(data, schema, extra=True):
        df = spark.createDataFrame(data, schema)
        if extra:
            for c in ("n", "k", "h", "id", "hits", "score", "part", "copy", "label", "_wm_text"):
                if c not in df.columns:
                    df = df.withColumn(c, F.lit("extra"))
        return df
    return make
