import pytest

from tidewright.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build(4, spark__sql__shuffle__partitions="4", spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")), spark__driver__memory="3g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield s


@pytest.fixture
def rows():
    """The rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
