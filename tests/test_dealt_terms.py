"""Terms are counted by tasks of bounded text; feature rows are unfolded in slices."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmart.plans import linear_svm, text_features as TF
from sparkmart.session import written


def test_terms_of_one_part_are_dealt_by_id(spark, monkeypatch):
    monkeypatch.setattr(TF, "CHARS_A_TASK", 100)
    df = spark.range(0, 500, 1, 1).selectExpr("id", "concat('ab ', id) AS t")
    for terms in (TF.char_terms(df, "id", "t", (2, 3)), TF.word_terms(df, "id", "t")):
        assert terms.rdd.getNumPartitions() >= 20
    assert TF.char_terms(df.where("id = 7"), "id", "t", (2, 3)).count() == 3 + 2


def test_written_keeps_columns_that_parquet_cannot_hold(spark):
    df = spark.range(3).select("id", F.lit(None).alias("none"))
    assert [tuple(r) for r in written(df, "t").orderBy("id").collect()] == [(0, None), (1, None), (2, None)]
    assert written(df.select("id"), "t").inputFiles()      # a Parquet copy elsewhere


def test_sliced_rows_are_those_of_the_batch(monkeypatch):
    vec = [{"type": 0, "size": 5, "indices": [i % 5], "values": [float(i)]} for i in range(10)]
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([pa.array(vec, kind)], names=["x"])
    monkeypatch.setattr(linear_svm, "SLICE_BYTES", 100)
    parts = list(linear_svm._row_slices([batch]))
    assert len(parts) > 1
    got = [linear_svm.sparse_rows(p, "x") for p in parts]
    assert np.concatenate([g[2] for g in got]).tolist() == [float(i) for i in range(10)]
    assert np.concatenate([g[1] for g in got]).tolist() == [i % 5 for i in range(10)]
    assert [g[0].tolist() for g in got] == [list(range(p.num_rows)) for p in parts]
    assert linear_svm.sparse_rows(batch, "x")[2] == pytest.approx(np.arange(10.0))
