import pytest

from runledger.session import session_builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        session_builder(
            "runledger-tests",
            conf={
                "spark.sql.shuffle.partitions": "4",
                "spark.ui.enabled": "false",
                "spark.sql.maxMetadataStringLength": "1000",
                "spark.checkpoint.dir": str(root / "shared"),
                "spark.sql.warehouse.dir": str(root / "warehouse"),
                "spark.driver.memory": "6g",
            },
        )
        .master("local[8]")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
