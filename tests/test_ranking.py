import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.operators import ranking


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({
        "id": [f"k{i:05d}" for i in range(n)],
        "g": rng.choice(["a", "b", "c"], size=n, p=[0.6, 0.3, 0.1]),
        # heavy ties: a third of rows share one value
        "v": np.where(rng.random(n) < 0.33, 5.0, rng.integers(0, 50, n).astype(float)),
    })
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_row_number_global(data, parts):
    pdf, df = data
    out = ranking.row_number_global(df, [F.col("v").desc(), F.col("id")], out="rn",
                                    size_out="n", num_partitions=parts).toPandas()
    exp = pdf.sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
    exp["rn"] = np.arange(1, len(exp) + 1)
    m = out.merge(exp[["id", "rn"]], on="id", suffixes=("", "_e"))
    assert (m.rn == m.rn_e).all() and (out.n == len(pdf)).all()


@pytest.mark.parametrize("parts", [1, 5])
def test_row_number_grouped(data, parts):
    pdf, df = data
    out = ranking.row_number_global(df, [F.col("v"), F.col("id")], ["g"], out="rn",
                                    size_out="n", num_partitions=parts).toPandas()
    exp = pdf.sort_values(["g", "v", "id"]).copy()
    exp["rn"] = exp.groupby("g").cumcount() + 1
    m = out.merge(exp[["id", "rn"]], on="id", suffixes=("", "_e"))
    assert (m.rn == m.rn_e).all()


def test_rank_min(data):
    pdf, df = data
    out = ranking.rank_min(df, "v", "id", "r", num_partitions=6).toPandas()
    exp = pdf.assign(r=pdf.v.rank(ascending=False, method="min").astype(int))
    m = out.merge(exp[["id", "r"]], on="id", suffixes=("", "_e"))
    assert len(m) == len(pdf) and (m.r == m.r_e).all()


def test_qcut_first(data):
    pdf, df = data
    out = ranking.qcut_first(df, "v", "id", "q", num_partitions=7).toPandas()
    s = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    s["rk"] = np.arange(1, len(s) + 1)
    s["q"] = pd.qcut(s.rk, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    m = out.merge(s[["id", "q"]], on="id", suffixes=("", "_e"))
    assert (m.q == m.q_e).all()


@pytest.mark.parametrize("parts", [1, 9])
def test_exact_quantiles(data, parts):
    pdf, df = data
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    out = ranking.exact_quantiles(df, "v", probs, num_partitions=parts).toPandas()
    for k, p in probs.items():
        assert abs(out[k][0] - pdf.v.quantile(p)) < 1e-9
    grp = ranking.exact_quantiles(df, "v", {"med": 0.5}, ["g"], num_partitions=parts).toPandas()
    exp = pdf.groupby("g").v.median()
    for _, r in grp.iterrows():
        assert abs(r.med - exp[r.g]) < 1e-9


def test_running_sum(data):
    pdf, df = data
    out = ranking.running_sum(df, "v", [F.col("v").desc(), F.col("id")], "cs",
                              num_partitions=5).toPandas()
    s = pdf.sort_values(["v", "id"], ascending=[False, True]).copy()
    s["cs"] = s.v.cumsum()
    m = out.merge(s[["id", "cs"]], on="id", suffixes=("", "_e"))
    assert np.allclose(m.cs, m.cs_e)
