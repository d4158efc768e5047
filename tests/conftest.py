import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillwork.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tillwork-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tillwork-tests-")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tuned(session)
    session.stop()


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)
