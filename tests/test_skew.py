"""A hot engine (one key holding a third of all rows) through the real pipeline:
view numbering, labels, window features and last windows equal a brute force."""

import numpy as np
import pandas as pd
from dataclasses import replace

from pyspark.sql import functions as F

from wearline.config import LINEITEM_FLEET
from wearline.operators import labels as LB
from wearline.operators import windows as W
from wearline.sources.views import lineitem_fleet


def write_lineitem(tmp_path, n=6000):
    rng = np.random.default_rng(4)
    supp = np.where(np.arange(n) % 3 == 0, 0, 1 + rng.integers(0, 20, size=n))  # supplier 0: 1/3 of rows
    df = pd.DataFrame({
        "l_orderkey": rng.permutation(n).astype("int64"),
        "l_partkey": rng.integers(0, 500, size=n).astype("int64"),
        "l_suppkey": supp.astype("int64"),
        "l_linenumber": rng.integers(1, 8, size=n).astype("int32"),
        "l_quantity": rng.integers(1, 50, size=n).astype("float64"),
        "l_extendedprice": np.round(rng.uniform(900, 90000, size=n), 2),
        "l_discount": np.round(rng.uniform(0, 0.1, size=n), 2),
        "l_tax": np.round(rng.uniform(0, 0.08, size=n), 2),
        "l_returnflag": "N",
        "l_linestatus": np.where(rng.uniform(size=n) < 0.5, "O", "F"),
        "l_shipdate": pd.Timestamp("1995-01-01") + pd.to_timedelta(rng.integers(0, 2000, size=n), unit="D"),
    })
    d = tmp_path / "sf"
    d.mkdir()
    df.to_parquet(d / "lineitem.parquet", index=False, coerce_timestamps="us")
    return str(d), df


def test_hot_engine_pipeline_matches_brute_force(spark, tmp_path):
    sf, pdf = write_lineitem(tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")  # 16 ranges: the hot key spans several
    try:
        view = lineitem_fleet(spark, sf).cache()
        view.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # brute force: per supplier order, number, life
    pdf = pdf.sort_values(["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])
    pdf["engine_id"] = pdf["l_suppkey"] + 1
    pdf["cycle"] = pdf.groupby("engine_id").cumcount() + 1
    pdf["life"] = pdf.groupby("engine_id")["cycle"].transform("max")
    got = view.select("engine_id", "cycle", "life", "quantity").toPandas().sort_values(["engine_id", "cycle"])
    want = pdf[["engine_id", "cycle", "life", "l_quantity"]].rename(columns={"l_quantity": "quantity"})
    assert got.reset_index(drop=True).equals(want.reset_index(drop=True).astype(got.dtypes.to_dict()))
    assert int(got[got.engine_id == 1].cycle.max()) == 2000

    spec = replace(LINEITEM_FLEET, block=128)  # the hot engine spans 16 blocks
    lab = LB.label_train_rul(view, spec.cap)
    wf = W.window_features(lab, spec).filter(F.col("engine_id") == 1).select("cycle", "quantity_mean", "rul").toPandas()
    hot = pdf[pdf.engine_id == 1].set_index("cycle")
    roll = hot["l_quantity"].rolling(spec.window).mean()
    assert len(wf) == 2000 - spec.window + 1
    for r in wf.itertuples():
        assert abs(r.quantity_mean - roll.loc[r.cycle]) < 1e-9
        assert r.rul == min(2000 - r.cycle, spec.cap)
    lw = {r.engine_id: r for r in W.last_window(lab, spec, "partial").collect()}
    assert lw[1].first_cycle == 2000 - spec.window + 1 and lw[1].n_rows == spec.window
