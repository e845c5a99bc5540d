import pytest

from sideline.functions.lineage import discard
from tests.session import session


@pytest.fixture(scope="session")
def spark():
    spark = session()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    discard(spark)
    spark.stop()
