import pytest

from pulseframe.session import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows, columns="doc_id LONG, text STRING"):
        return spark.createDataFrame(rows, columns)

    return make
