import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def layouts(spark, tmp_path_factory):
    """The events table as one file, and as nine files of which one holds a third of the rows."""
    import pyarrow.parquet as pq

    one = f"{DATA}/events.parquet"
    table = pq.read_table(one)
    folder = tmp_path_factory.mktemp("events")
    n = table.num_rows
    edges = [0, 10, 11, 60, 60 + n // 3, 600, 700, 800, 900, n]
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        pq.write_table(table.slice(a, b - a), folder / f"part-{i:03d}.parquet", row_group_size=40)
    return {"one": one, "nine": f"{folder}/*.parquet"}


@pytest.fixture(scope="session")
def event_rows(spark):
    import pyarrow.parquet as pq

    return pq.read_table(f"{DATA}/events.parquet").to_pylist()
