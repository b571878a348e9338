"""Every registered query against its SQL counterpart, on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows
from telhado.suite.views import TABLES

from given_tables import SMALL


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    frame = entry.queries()[name](spark, SMALL)
    got = frame.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.columns, got) == rows(columns, result.fetchall())


@pytest.mark.parametrize(
    "name",
    ["first_per_url", "dedupe_except_url", "merge_prev_wins", "merge_new_wins", "backfill_merge", "bronze_munic", "indicators_munic"],
)
def test_one_partition_or_many(spark, name):
    """The shuffle's width changes no result."""
    frames = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        frame = entry.queries()[name](spark, SMALL)
        frames.append(rows(frame.columns, frame.collect()))
    assert frames[0] == frames[1]


def test_runs_from_any_folder(tmp_path):
    """Python workers need neither the repository's folder nor an installed package."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {here!r})\n"
        "import __spark_entry__ as entry\n"
        "from telhado.session import local_session\n"
        f"print('rows', entry.queries()['hex_clip'](local_session(2), {SMALL!r}).count())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 259" in done.stdout, done.stderr[-2000:]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:5] == ["municipio", "preco_max", "preco_min", "preco_med", "preco_medio_area"]
    assert frame.count() == 26
