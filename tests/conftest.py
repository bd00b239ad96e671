import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from custarc.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def values(spark):
    """values(col_fn, inputs, type): the results of a column function on single values."""

    def run(fn, inputs, dtype="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
        return [r.out for r in df.select("i", fn(df.v).alias("out")).orderBy("i").collect()]

    return run
