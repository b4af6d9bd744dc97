import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from cabline.llm import pieces
from .conftest import SF

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet") or not os.path.exists(pieces.PieceParams().model), reason="needs tables and vocabulary")


def test_stages_in_order_on_the_table(spark):
    out = P.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns[: len(P.DOCUMENT)] == list(P.DOCUMENT)
    ids = {r.doc_id for r in docs.collect()}
    rows = out.withColumn("back", pieces.decode(F.col("ids"))).collect()
    assert rows and all(r.doc_id in ids and r.back == r.text and r.n_chars == len(r.text) for r in rows)


def test_stages_take_awkward_rows_and_empty_tables(spark, awkward):
    for _, stage in P.STAGES:
        assert stage(spark, awkward, SF).columns[: len(awkward.columns)] == awkward.columns
        assert stage(spark, awkward.limit(0), SF).count() == 0
