import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# the workers' import path, whatever folder the tests are started in
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Applies a function of columns to rows of values and returns the results."""

    def run(f, *rows, types="string"):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        kinds = types.split(",") if "," in types else [types] * len(rows[0])
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} {t}" for k, t in enumerate(kinds)))
        from pyspark.sql import functions as F

        out = df.select("i", f(*[F.col(f"c{k}") for k in range(len(kinds))]).alias("x")).orderBy("i").collect()
        return [r.x for r in out]

    return run
