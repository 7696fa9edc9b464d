from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from closebook.session import apply_settings


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared)
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return apply_settings(session)


@pytest.fixture
def frame(spark):
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def rows():
    def collect(df, *order):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
