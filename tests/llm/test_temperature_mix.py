import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tablekit.llm import temperature_mix as M


def corpus(seed=1, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        src = rng.choices(["a", "b", "c", None, "tiny"], [500, 250, 100, 40, 8])[0]
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 200])), "en", src))
    return rows


def shares(rows):
    t = Counter()
    for _, text, _, s in rows:
        t[s] += len(text.split()) if text else 0
    return t


def entropy(w):
    return -sum(x * math.log(x) for x in w if x > 0)


def bisect(t, meets):
    """Plain bisection for a condition that holds at 0 and fails at 1."""
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if meets(mid) else (lo, mid)
    return lo


def weights(t, a):
    total = sum(t.values())
    raw = {s: (n / total) ** a for s, n in t.items() if n}
    return {s: x / sum(raw.values()) for s, x in raw.items()}


def test_exponent_equals_bisection(spark, make_docs):
    rows = corpus()
    t = shares(rows)
    sh = M.source_shares(M.as_items(make_docs(rows)))
    n = sum(1 for x in t.values() if x)
    for target in (0.7, 0.9, 0.99):
        want = bisect(t, lambda a: entropy(weights(t, a).values()) >= target * math.log(n))
        assert abs(M.find_exponent(sh, entropy=target) - want) < 1e-6
    total = sum(t.values())
    for limit in (1.5, 3.0):
        low = bisect(t, lambda a: max(w * total / t[s] for s, w in weights(t, a).items()) > limit)
        assert abs(M.find_exponent(sh, max_repetition=limit, budget_ratio=1.0) - low) < 1e-6
    assert M.find_exponent(sh, entropy=0.0) == 1.0
    assert M.find_exponent(sh, max_repetition=1e9) == 0.0


@pytest.mark.parametrize("params", [dict(entropy=0.95, budget_ratio=1.0), dict(max_repetition=2.0),
                                    dict(entropy=1.0, budget_ratio=0.3), dict(max_repetition=4.0, budget_ratio=2.5)])
def test_quotas_are_met_by_whole_passes_and_a_part(spark, make_docs, monkeypatch, params):
    monkeypatch.setattr(M, "BLOCK_DOCS", 20)
    rows = corpus(2)
    t = shares(rows)
    size = {i: len(x.split()) for i, x, _, _ in rows}
    docs = make_docs(rows)
    placed = M.mix_plan(docs, **params).collect()
    sh = M.source_shares(M.as_items(docs))
    plan = {r.source: r for r in M.quotas(
        sh, M.find_exponent(sh, **{"entropy": None, "max_repetition": None, **params}),
        params.get("budget_ratio")).collect()}
    got, most = defaultdict(int), max(size.values())
    per_epoch = defaultdict(list)
    for r in placed:
        got[r.source] += r.tokens
        per_epoch[r.source, r.epoch].append(r)
    for s, p in plan.items():
        if t[s]:
            assert p.quota <= got[s] < p.quota + most or got[s] == p.quota
            for (src, e), rs in per_epoch.items():
                if src == s:
                    ids = [r.doc_id for r in rs]
                    assert len(ids) == len(set(ids))                 # a permutation, or a part of one
                    if (e + 1) * t[s] <= p.quota:
                        assert sum(r.tokens for r in rs) == t[s]
                    at = 0
                    for r in sorted(rs, key=lambda r: (r.start, r.tokens)):
                        assert r.start == at
                        at += r.tokens
    if "max_repetition" in params and "budget_ratio" not in params:
        assert all(p.quota >= t[s] for s, p in plan.items() if t[s])       # no source is cut
        assert max(p.quota / t[s] for s, p in plan.items() if t[s]) <= 2.01


def test_edge_rows(spark, make_docs):
    rows = [(1, "a b c", None, "s"), (1, "a b c", None, "s"), (2, None, None, "s"), (3, "", None, "empty"),
            (None, "x y", None, None), (4, "long " * 100_000, None, "big"), (5, "p q", None, "t")]
    docs = make_docs(rows, extra=("epoch", "tokens", "copies", "k1", "its"))
    out = M.mix_documents(docs, max_repetition=1.0)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.source) for r in out.collect())
    assert {k: v for k, v in got.items() if k[0] not in (2,)} == {(1, "s"): 2, (None, None): 1, (4, "big"): 1, (5, "t"): 1}
    assert M.mix_documents(docs.limit(0)).count() == 0
    only_empty = make_docs([(1, None), (2, "")])
    assert M.mix_documents(only_empty).count() == 0


def test_token_count_is_of_ascii_white_space(spark, make_docs):
    texts = ["a b", " a\tb\x0bc\x0cd\re\n", "a b c", "", "\n", "é ü"]
    df = make_docs(list(enumerate(texts))).select("text", M.token_count(df_col := __import__("pyspark.sql.functions",
                                                                        fromlist=["col"]).col("text")).alias("n"))
    assert df_col is not None
    for r in df.collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text))


def test_very_many_copies_need_no_long_array(spark, make_docs, monkeypatch):
    """Numbers come in steps: a count far beyond the longest array is only read as far as asked."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("a", 73_825_566_222), ("b", 0), ("c", 3), ("d", 1)], "k string, n long")
    small = rows.where("k <> 'a'")
    assert [(r.k, r.i) for r in M.numbered(small, "n", "i").where("k = 'c'").collect()] == [("c", 0), ("c", 1), ("c", 2)]
    assert M.numbered(small, "n", "i").where("k = 'b'").count() == 0
    # the arrays of the huge count: as many steps as it has, each of one size
    steps = rows.where("k = 'a'").select(F.expr(f"size(sequence(0L, (n - 1) div {M.AT_ONCE}))").alias("s")).first().s
    assert steps == -(-73_825_566_222 // M.AT_ONCE)
    monkeypatch.setattr(M, "AT_ONCE", 4)
    got = [r.i for r in M.numbered(small.withColumn("n", F.lit(11).cast("long")), "n", "i").where("k = 'c'").collect()]
    assert sorted(got) == list(range(11))


def test_a_small_source_beside_a_huge_one(spark, make_docs):
    """The weights of a source of 10**13 tokens beside one of 50: quotas and epochs stay whole numbers."""
    shares = spark.createDataFrame([("big", 0, 10**13, 10**6, 10**13 / (10**13 + 50)), ("tiny", 1, 50, 1, 50 / (10**13 + 50))],
                                   "source string, sid long, tokens long, docs long, share double")
    plan = {r.source: r for r in M.quotas(shares, M.find_exponent(shares, entropy=0.95), 1.0).collect()}
    assert plan["tiny"].epochs > 2**31 and plan["tiny"].epochs * 50 >= plan["tiny"].quota > (plan["tiny"].epochs - 1) * 50
