import pytest

from quarry.llm.common import WorkFolder


@pytest.fixture()
def work(spark):
    folder = WorkFolder(spark)
    yield folder
    folder.release()
