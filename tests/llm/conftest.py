import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a DataFrame of several partitions."""

    def made(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return made
