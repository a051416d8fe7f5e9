"""Every query of the catalogue against its SQL on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = [n for n in entry.queries() if not re.match(r"op\d|pipeline", n)]
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def rows(frame: pd.DataFrame) -> list[str]:
    cols = sorted(frame.columns)
    out = []
    for r in frame[cols].astype(object).itertuples(index=False):
        out.append(repr([None if pd.isna(x) else round(float(x), 6) if isinstance(x, float) else x.item() if hasattr(x, "item") else x for x in r]))
    return sorted(out)


@pytest.mark.parametrize("name", OWN)
def test_against_oracle(spark, name):
    got = entry.queries()[name](spark, SF)
    if name not in ORACLE:
        assert got.count() > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(ORACLE) <= set(entry.queries())
