import pytest

from settlekit.llm.blocks import ship


@pytest.fixture(scope="session")
def sc(spark):
    ship(spark)
    return spark
