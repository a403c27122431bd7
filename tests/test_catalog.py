"""Every query of the catalogue against its SQL on the smallest driver tables, or on rows only where there is none."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from framegauge.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are missing")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: "~" if v is None or v != v else f"{float(v):.6f}" if isinstance(v, float) else str(v)
    return sorted("|".join(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = df.collect()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert df.columns and rows is not None
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in rows], df.columns) == normal(result.fetchall(), columns)


def test_contract(spark):
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q)
    assert isinstance(__spark_entry__.entry(spark).limit(5).toPandas(), pd.DataFrame)


def test_without_optional_part():
    """The library and its queries don't need the corpus subpackage."""
    import subprocess
    import sys

    code = "import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n        if name.startswith(('framegauge.llm', 'corpus_pipeline')):\n            raise ImportError(name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nq = e.queries()\nassert q and not [n for n in q if n.startswith('op')] and 'pipeline' not in q and e.oracle_sql()\n"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_four_defects_are_reported(spark):
    got = {(r.issue_type, r.frame_start, r.frame_end) for r in catalog.queries()["v1_four_defects"](spark, SF).collect()}
    assert got == {("timestamp_interval", 49, 50), ("timestamp_interval", 50, 51), ("frozen_frame_run", 119, 129), *((("state_continuity_spike"), i, i) for i in (79, 80, 81))}


@pytest.mark.parametrize("name", ["stream_rolling_stats", "stream_session_runs", "stream_outliers"])
def test_streams_are_written_by_their_tasks(spark, name):
    """No driver holds what a stream gave."""
    assert catalog.queries()[name](spark, SF).inputFiles()


def test_stream_of_several_batches(spark, tmp_path):
    """A whole result takes the place of the batch before it, appended rows stay; nothing gives no row."""
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    read = lambda at: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(at)
    assert sorted(r.id for r in catalog._streamed(spark, read(f"{tmp_path}/in/*"), "append").collect()) == list(range(30))
    assert [(r.k, r["count"]) for r in catalog._streamed(spark, read(f"{tmp_path}/in/*").selectExpr("id % 1 as k").groupBy("k").count(), "complete").collect()] == [(0, 30)]
    (tmp_path / "none").mkdir()
    assert catalog._streamed(spark, read(f"{tmp_path}/none"), "append").collect() == []
