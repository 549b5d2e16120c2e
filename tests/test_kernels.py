"""Order kernels and reproducible sampling against brute force."""
import math

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dichot.operators import ordered, sampling
from dichot.plans import frames

from conftest import SF_MID, SF_SMALL


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    """Force many buckets on the small fixtures so the offset logic is exercised."""
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 50)


def _lineitem(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/lineitem.parquet")


def test_running_sums_grouped_matches_pandas(spark):
    li = _lineitem(spark).select("l_returnflag", "l_extendedprice", "l_quantity")
    levels = li.groupBy("l_returnflag", "l_extendedprice").agg(F.sum("l_quantity").alias("q"))
    out = ordered.running_sums(levels, ["l_extendedprice"], ["q"], group_cols=["l_returnflag"],
                               num_partitions=5).toPandas()
    ref = levels.toPandas().sort_values(["l_returnflag", "l_extendedprice"])
    ref["cum_q"] = ref.groupby("l_returnflag")["q"].cumsum()
    m = ref.merge(out, on=["l_returnflag", "l_extendedprice"], suffixes=("", "_s"))
    assert len(m) == len(ref)
    assert np.allclose(m["cum_q"], m["cum_q_s"])


def test_running_sums_descending_and_partitions(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    a = ordered.running_sums(o, ["o_totalprice", "o_orderkey"], ["o_totalprice"], descending=True,
                             num_partitions=3).toPandas()
    b = ordered.running_sums(o.repartition(7), ["o_totalprice", "o_orderkey"], ["o_totalprice"],
                             descending=True, num_partitions=11).toPandas()
    ref = o.toPandas().sort_values(["o_totalprice", "o_orderkey"], ascending=False)
    ref["c"] = ref["o_totalprice"].cumsum()
    for got in (a, b):
        m = ref.merge(got, on="o_orderkey")
        assert np.allclose(m["c"], m["cum_o_totalprice"])


def test_row_index_is_dense_and_ordered(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    idx = ordered.row_index(o, ["o_orderkey"], num_partitions=4).toPandas().sort_values("o_orderkey")
    assert list(idx["row_idx"]) == list(range(1, len(idx) + 1))


def test_exact_quantiles_type7(spark):
    li = _lineitem(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ordered.exact_quantiles(li, "l_extendedprice", probs, group_cols=["l_linestatus"]).toPandas()
    pdf = li.select("l_linestatus", "l_extendedprice").toPandas()
    for (g, p), q in got.set_index(["l_linestatus", "prob"])["quantile"].items():
        ref = np.quantile(pdf[pdf.l_linestatus == g].l_extendedprice, p)  # numpy "linear" = R type 7
        assert math.isclose(q, ref, rel_tol=1e-12)


def test_lag_stats(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    s = ordered.lag_stats(o, ["o_orderkey"], "o_totalprice", num_partitions=6)
    e = o.toPandas().sort_values("o_orderkey")["o_totalprice"].to_numpy()
    assert s["n"] == len(e)
    assert math.isclose(s["sum_adj_diff2"], float(((e[1:] - e[:-1]) ** 2).sum()), rel_tol=1e-10)
    assert math.isclose(s["sum_adj_prod"], float((e[1:] * e[:-1]).sum()), rel_tol=1e-10)


def test_stratified_split_exact_and_partition_free(spark):
    o = frames.orders_labeled(spark, SF_MID).select("o_orderkey", "y")
    a = sampling.stratified_flag(o, "y", ["o_orderkey"], 0.8, 99).toPandas()
    b = sampling.stratified_flag(o.repartition(13), "y", ["o_orderkey"], 0.8, 99).toPandas()
    m = a.merge(b, on=["o_orderkey", "y"])
    assert (m.in_train_x == m.in_train_y).all()
    for y, g in a.groupby("y"):
        assert g.in_train.sum() == math.ceil(0.8 * len(g))


def test_kfold_and_downsample(spark):
    o = frames.orders_labeled(spark, SF_MID).select("o_orderkey", "y")
    f = sampling.kfold(o, "y", ["o_orderkey"], 5, 7).toPandas()
    sizes = f.groupby(["y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()
    assert len(f) == o.count()
    d = sampling.downsample(o, "y", ["o_orderkey"], 7).toPandas()
    counts = d.groupby("y").size()
    assert counts.nunique() == 1
    assert d.o_orderkey.is_unique


def test_split_parts_disjoint_and_exhaustive(spark):
    o = frames.orders_labeled(spark, SF_SMALL).select("o_orderkey", "y")
    train, test = sampling.stratified_split(o, "y", ["o_orderkey"], 0.75, 3)
    a = set(r[0] for r in train.select("o_orderkey").collect())
    b = set(r[0] for r in test.select("o_orderkey").collect())
    assert not (a & b)
    assert len(a | b) == o.count()


def test_bucket_count_adapts_to_size(spark, monkeypatch):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 10**9)
    _, nb = ordered._bucketed(o, ["o_orderkey"], False, 16)
    assert nb == 1
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 100)
    _, nb = ordered._bucketed(o, ["o_orderkey"], False, 16)
    assert nb == 15  # ceil(1500 rows / 100), below the 16 partitions


def test_few_small_vectors_are_added_in_one_stage(spark):
    """A pass of few tasks takes no shuffle; many or large vectors are still added by Spark."""
    from dichot.functions import linalg
    rows = spark.range(0, 40, 1, 4).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([[float(b.num_rows), 2.0, -1.0]], pa.list_(pa.float64()))], names=["v"])
                         for b in batches), "v array<double>")
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("few-vectors", "test")
    got = linalg.add_vectors(rows, 3, 4)
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup("few-vectors") for i in tracker.getJobInfo(j).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) == 1 and got.tolist() == [40.0, 8.0, -4.0] == linalg.add_vectors(rows, 3).tolist()
    assert linalg.add_vectors(rows.where("size(v) = 0"), 3, 4).tolist() == [0.0] * 3
