import pytest

from ticklake.llm.registry import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Workers find the package from wherever the tests are started."""
    ship(spark)
