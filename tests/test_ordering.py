import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from periodlens.operators.ordering import count_values, exact_quantiles, rank_rows, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, scores with heavy ties, one NULL group."""
    random = np.random.default_rng(3)
    rows = 6000
    group = random.choice(["hot", "a", "b", None], rows, p=[0.66, 0.14, 0.1, 0.1])
    score = np.where(random.random(rows) < 0.4, 0.25, random.random(rows).round(3))
    pdf = pd.DataFrame({"g": group, "score": score, "k": np.arange(rows), "w": random.integers(0, 5, rows)})
    return spark.createDataFrame(pdf, "g string, score double, k long, w long").repartition(7), pdf


def test_rank_matches_pandas(skewed):
    df, pdf = skewed
    found = rank_rows(df, ["g"], [F.desc("score"), "k"], "rn", "n").toPandas()
    wanted = pdf.sort_values(["score", "k"], ascending=[False, True])
    wanted["rn"] = wanted.groupby("g", dropna=False).cumcount() + 1
    wanted["n"] = wanted.groupby("g", dropna=False)["k"].transform("size")
    merged = found.merge(wanted[["k", "rn", "n"]], on="k", suffixes=("", "_wanted"))
    assert len(merged) == len(pdf)
    assert (merged.rn == merged.rn_wanted).all() and (merged.n == merged.n_wanted).all()


def test_rank_without_groups(skewed):
    df, pdf = skewed
    found = rank_rows(df, [], ["k"], "rn").toPandas()
    assert (found.rn == found.k + 1).all() and len(found) == len(pdf)


def test_rank_of_nothing(skewed):
    df, _ = skewed
    assert rank_rows(df.where("k < 0"), ["g"], ["k"]).count() == 0


def test_running_totals_match_pandas(skewed):
    df, pdf = skewed
    found = running_totals(df, ["g"], [F.desc("score"), "k"], {"upto": "w"}).toPandas()
    wanted = pdf.sort_values(["score", "k"], ascending=[False, True])
    wanted["upto"] = wanted.groupby("g", dropna=False)["w"].cumsum()
    wanted["upto_all"] = wanted.groupby("g", dropna=False)["w"].transform("sum")
    merged = found.merge(wanted[["k", "upto", "upto_all"]], on="k", suffixes=("", "_wanted"))
    assert len(merged) == len(pdf)
    assert (merged.upto == merged.upto_wanted).all() and (merged.upto_all == merged.upto_all_wanted).all()


def test_quantiles_match_numpy(skewed):
    df, pdf = skewed
    counted = count_values(df, ["score", "w"])
    found = exact_quantiles(counted, ["name"], {"low": 0.05, "mid": 0.5, "high": 0.95}).collect()
    assert {r["name"] for r in found} == {"score", "w"}
    for row in found:
        wanted = np.quantile(pdf[row["name"]], [0.05, 0.5, 0.95])
        assert [row.low, row.mid, row.high] == pytest.approx(wanted, abs=1e-12)


def test_quantiles_of_three_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    row = exact_quantiles(count_values(df, ["v"]), ["name"], {"p05": 0.05, "p95": 0.95}).first()
    assert (row.p05, row.p95) == pytest.approx((1.1, 9.2))
