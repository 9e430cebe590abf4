import pytest
from text_rows import hard_documents


@pytest.fixture
def documents(spark):
    return hard_documents(spark)


@pytest.fixture
def no_documents(spark):
    return hard_documents(spark, empty=True)


@pytest.fixture
def labels(spark):
    rows = [(i, i % 2, int(i == 12)) for i in range(1, 14)] + [(None, 1, 1), (3, None, None), (3, 1, 0), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
