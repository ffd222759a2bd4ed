import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from voxlake.settings import TableLayout, lend_shared_folder, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, **{"spark.sql.maxMetadataStringLength": "10000"})
    session.sparkContext.setLogLevel("ERROR")
    lend_shared_folder(session)
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return TableLayout(str(tmp_path / "lake"))


@pytest.fixture
def one(spark):
    """Value of a column function for each given value of column x."""
    def values(function, inputs, kind="string"):
        from pyspark.sql import functions as F
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
        result = rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
        return [row.y for row in result]
    return values
