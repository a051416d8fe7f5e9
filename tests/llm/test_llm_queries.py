"""The registered queries against their SQL, and the pipeline, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from attesta.llm.sql import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels pages".split()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.execute(ORACLE_SQL[name]).df(), entry.queries()[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    key = lambda f: sorted(map(repr, f[cols].astype(object).round(6).itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{i}" for i in range(1, 14)} <= names and "pipeline" in names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for _name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas().astype({"n_chars": "int64"}), docs.schema)
        assert docs.columns == columns and docs.count() > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert pieces.groupby("sequence_id").length.sum().max() <= 2048
    assert len(corpus_pipeline.run(spark, SF).toPandas()) == len(pieces)
