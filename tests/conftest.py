from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("landfold-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def drop(tmp_path):
    """Write a file of lines below the landing folder, optionally with a modification time."""
    import os

    landing = tmp_path / "landing"
    landing.mkdir()

    def write(name: str, lines: list[str], at: int | None = None) -> str:
        path = landing / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        if at is not None:
            os.utime(path, (at, at))
        return str(path)

    write.landing = str(landing)
    write.root = str(tmp_path / "tables")
    return write
