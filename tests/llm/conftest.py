import pytest

from tierfold.llm.common import release


@pytest.fixture(autouse=True)
def released(spark):
    yield
    release(spark)
