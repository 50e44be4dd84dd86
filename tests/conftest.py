import pytest

from lotwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def one(spark):
    """Evaluate expressions over one literal row given as keyword columns."""
    from pyspark.sql import functions as F

    def run(expression, schema: str, *rows):
        df = spark.createDataFrame(list(rows), schema)
        return [r[0] for r in df.select(expression.alias("v")).collect()]

    return run
