import pytest
from pyspark.sql import SparkSession

from tablevault import TableName, Vault


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def vault(spark, tmp_path):
    return Vault(spark, str(tmp_path / "vault"))


@pytest.fixture
def name():
    return TableName("shop", "sales", "orders")


@pytest.fixture
def sample(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1, 'test1', 100), (2, 'test2', 200), (3, 'test3', 300) "
        "AS t(id, name, value)"
    )


@pytest.fixture(scope="session")
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
