"""Brute-force checks on random small inputs (hypothesis): operators vs a
direct pandas computation of the same result."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablekit.operators import relational as R
from tablekit.operators import skew as SK

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

rows3 = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 3),
                           st.integers(-50, 50)), min_size=1, max_size=40)


@SETTINGS
@given(data=rows3)
def test_pivot_both_paths_match_pandas(spark, data):
    df = spark.createDataFrame(data, "g string, m int, x int")
    months = {1: "JAN", 2: "FEB", 3: "MAR"}
    cond = R.pivot(df, ["g"], "m", months, {"S": F.sum, "M": F.max}, value_col="x")
    spk = R.pivot(df, ["g"], "m", months, {"S": F.sum("x"), "M": F.max("x")})
    pdf = pd.DataFrame(data, columns=["g", "m", "x"])
    want = {}
    for g, grp in pdf.groupby("g"):
        row = {}
        for m, a in months.items():
            sel = grp[grp.m == m].x
            row[f"{a}_S"] = int(sel.sum()) if len(sel) else None
            row[f"{a}_M"] = int(sel.max()) if len(sel) else None
        want[g] = row
    for out in (cond, spk):
        got = {r["g"]: {k: r[k] for k in want[r["g"]]} for r in out.collect()}
        assert got == want


@SETTINGS
@given(data=rows3, n=st.integers(1, 3))
def test_top_n_matches_pandas_dense_rank(spark, data, n):
    df = spark.createDataFrame(data, "g string, m int, x int")
    got = sorted((r["g"], r["m"], r["x"], r["rank"])
                 for r in R.top_n_per_group(df, ["g"], [F.desc("x")], n).collect())
    pdf = pd.DataFrame(data, columns=["g", "m", "x"])
    pdf["rank"] = pdf.groupby("g")["x"].rank(method="dense", ascending=False).astype(int)
    want = sorted(map(tuple, pdf[pdf["rank"] <= n][["g", "m", "x", "rank"]].values.tolist()))
    assert got == want


keys = st.lists(st.sampled_from([None, *range(7)]), min_size=1, max_size=60)


@SETTINGS
@given(big_keys=keys, small_keys=st.lists(st.integers(0, 8), min_size=0, max_size=9, unique=True),
       hot=st.lists(st.sampled_from([None, *range(7)]), max_size=3, unique=True), salts=st.integers(2, 5),
       how=st.sampled_from(["inner", "left"]))
def test_salted_join_equals_plain_join(spark, big_keys, small_keys, hot, salts, how):
    big = spark.createDataFrame([(k, i) for i, k in enumerate(big_keys)], "k int, i int")
    small = spark.createDataFrame([(k, f"v{k}") for k in small_keys], "k2 int, v string")
    plain = big.join(small, big.k == small.k2, how)
    salted = SK.salted_join(big, small, "k", "k2", {k: salts for k in hot}, ["i"], how=how)
    cols = ["k", "i", "k2", "v"]
    assert sorted(map(tuple, plain.select(cols).collect()), key=str) == \
        sorted(map(tuple, salted.select(cols).collect()), key=str)
