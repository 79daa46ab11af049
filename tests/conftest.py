import sys
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("registrylake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    return folder


@pytest.fixture
def pack(bronze):
    """Write a zip archive: pack("Cnaes0", b"..."), or several members by name."""

    def write(stem, content=b"", members=None, compression=zipfile.ZIP_DEFLATED):
        with zipfile.ZipFile(bronze / f"{stem}.zip", "w", compression) as packed:
            for name, data in (members or {f"{stem}.csv": content}).items():
                packed.writestr(name, data)
        return str(bronze)

    return write
