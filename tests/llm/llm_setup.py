import pytest


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables of these tests are tiny; most of their time is tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
