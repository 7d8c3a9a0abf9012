import pytest

from tarn.session import local_session


@pytest.fixture(scope="session")
def spark():
    spark = local_session(4, "4g")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()
