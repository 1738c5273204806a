"""Every registered query with SQL against DuckDB on the smallest tables, and kernels against plain versions."""

import decimal
import os

import numpy as np
import pytest

import __spark_entry__
from pathloom.operators import tracks
from pathloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if v is None:
        return "null"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_plain, v)) + "]"
    return str(v)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(want.fetchall(), want.columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_sharp_waves():
    t = np.arange(600.0)
    y = np.where((t >= 200) & (t < 230), 30 * np.sin((t - 200) / 30 * np.pi), 0.0)
    mask = tracks.spike_mask(t * 2, y)
    assert mask[205:225].all() and not mask[:180].any() and not mask[250:].any()
    assert not tracks.spike_mask(t * 2, np.where((t >= 100) & (t < 400), 30 * np.sin((t - 100) / 300 * np.pi), 0.0)).any()  # too long
    assert not tracks.spike_mask(t * 2, y, steepness=5.0).any() and not tracks.spike_mask(t[:5], t[:5]).any()


def test_line_pieces_of_both_directions(spark):
    rows = [(1, i, 5.0, 10.0 * i) for i in range(60)] + [(1, 60 + i, 5.0 + 10 * i, 590.0) for i in range(60)]
    got = tracks.line_pieces(spark.createDataFrame(rows, "m long, f long, x double, y double"), ["m"], "f", least=25).collect()
    assert any(r.start <= 2 and 57 <= r.end <= 62 for r in got) and any(58 <= r.start <= 62 and r.end >= 117 for r in got)
