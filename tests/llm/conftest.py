import pytest

from swipeflow.llm.common import ship_package


@pytest.fixture()
def session(spark):
    ship_package(spark)
    return spark


def clashing(df):
    """The table with extra columns that bear names used inside the operators."""
    from pyspark.sql import functions as F

    for name in ("_id", "_text", "_y", "score", "fp", "rep", "n", "node", "path", "_key", "distance"):
        df = df.withColumn(name, F.lit("x"))
    return df
