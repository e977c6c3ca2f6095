import pytest
from odd_cases import SCHEMA, SF_DIR, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(
        [(i, t, None, None, None, *["x", None] * 5, "y", *["z", None] * 3) for i, t in odd_rows()], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
