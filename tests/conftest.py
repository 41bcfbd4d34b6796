import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("OMP_NUM_THREADS", "1")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    tmp = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp}/shared")
        .config("spark.sql.warehouse.dir", f"file://{tmp}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def rows(table):
    """The rows of an Arrow table or DataFrame as comparable text, columns by name."""
    t = table if hasattr(table, "column_names") else table.toArrow()
    names = sorted(t.column_names)
    columns = [t.column(n).to_pylist() for n in names]
    return names, sorted(repr(r) for r in zip(*columns))


@pytest.fixture(scope="session")
def same(spark, duck):
    """Whether a query gives the rows of its SQL."""

    def check(query, sql, sf=SF):
        got, want = rows(query(spark, sf)), rows(duck.execute(sql).to_arrow_table())
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        assert got[1] == want[1]

    return check
