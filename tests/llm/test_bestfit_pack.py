import random
import re

import pytest

from tablekit.llm import bestfit_pack as B


def check(rows, pieces, sizes=B.SIZES, costs=None):
    costs = costs or {c: c + B.OVERHEAD for c in sizes}
    top = max(sizes)
    want = sorted(((i, n) for i, n in rows if n), key=repr)
    # every token of every document exactly once
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.n_tokens))
    total = {}
    for i, n in want:
        total[i] = total.get(i, 0) + n
    assert {i: sum(k for _, k in x) for i, x in by_doc.items()} == total
    for i, n in want:
        if sum(j == i for j, _ in want) == 1:
            at = 0
            for start, k in sorted(by_doc[i]):
                assert start == at
                at += k
            assert at == n
    # bins: permitted, not overfull, contents side by side, downsized
    bins = {}
    for p in pieces:
        assert 0 < p.n_tokens <= top
        bins.setdefault(p.bin, []).append(p)
    for ps in bins.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.n_tokens
        assert {(p.used, p.capacity) for p in ps} == {(at, B.least_cost(at, sizes, costs))}
    return bins


def words(n):
    return " ".join(["w"] * n)


def test_pieces_cover_every_text(spark, make_docs):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, 3, 100, 511, 512, 513, 900, 2047, 4096, 4097, 9000, 30_000])) for i in range(300)]
    docs = make_docs([(i, words(n)) for i, n in rows], extra=("bin", "n_tokens", "key"))
    pieces = B.pack_documents(docs).collect()
    bins = check(rows, pieces)
    tokens = sum(n for _, n in rows)
    assert sum({b: ps[0].capacity for b, ps in bins.items()}.values()) < 1.02 * tokens + 4096


def test_shards_split_the_work(spark, make_docs):
    rows = [(i, 50 + i % 700) for i in range(500)]
    docs = make_docs([(i, words(n)) for i, n in rows])
    from pyspark.sql import functions as F
    items = docs.select("doc_id", F.xxhash64("doc_id").alias("key"),
                        F.size(F.split("text", " ")).cast("long").alias("n_tokens"))
    pieces = B.pack(items, 500, sizes=(256, 1024), per_shard=60).collect()
    check(rows, pieces, (256, 1024))
    assert len({p.bin >> 32 for p in pieces}) > 5


def test_edge_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "x\x0by\tz z"), (4, "x\x0by\tz z"), (5, words(200_000))]
    pieces = B.pack_documents(make_docs(rows)).collect()
    n = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows}
    check([(i, n[i]) for i, _ in rows], pieces)
    assert B.pack_documents(make_docs(rows).limit(0)).count() == 0


def plain(lengths, sizes, costs, preferred=None):
    """Best fit by looking at every open bin; opens the least cost a token, or one preferred length throughout."""
    bins, where, left = [], [], sum(lengths)
    for n in lengths:
        fits = [b for b in bins if b["size"] - b["used"] >= n]
        if fits:
            least = min(b["size"] - b["used"] for b in fits)
            b = [b for b in fits if b["size"] - b["used"] == least][-1]
        else:
            able = [c for c in sizes if c >= n]
            if preferred is None:
                per = [(costs[c] / min(c, left), c) for c in able]
                size = min(per)[1]
            else:
                size = max(preferred, min((costs[c], c) for c in able)[1])
            b = {"used": 0, "size": size, "at": len(bins)}
            bins.append(b)
        b["used"] += n
        left -= n
        where.append(b["at"])
    return where, [min((costs[c], c) for c in sizes if c >= b["used"])[1] for b in bins]


def whole_cost(capacity, costs):
    return sum(costs[c] for c in capacity)


@pytest.mark.parametrize("seed", range(12))
def test_equals_plain_best_fit_with_the_opening_rule(seed):
    rng = random.Random(seed)
    sizes = (64, 128, 256, 512)
    costs = {c: c ** rng.choice([0.8, 1.0, 1.3]) + rng.choice([0, 40]) for c in sizes}
    lengths = sorted((rng.randrange(1, 513) for _ in range(rng.choice([1, 5, 60, 400]))), reverse=True)
    where, used, capacity = B.best_fit(lengths, sizes, costs)
    filled = [0] * len(used)
    for b, n in zip(where, lengths):
        filled[b] += n
    assert filled == used and all(u <= c for u, c in zip(used, capacity))
    other, caps = plain(lengths, sizes, costs)
    # which of two equally full bins takes a piece may differ: the bins do not
    assert sorted(capacity) == sorted(caps) and len(used) == len(caps)
    # no worse than the best single length for the whole shard, but for a few bins
    least = min(whole_cost(plain(lengths, sizes, costs, p)[1], costs) for p in sizes)
    assert whole_cost(capacity, costs) <= 1.05 * least + 2 * max(costs.values())


def test_each_opening_takes_the_least_cost_a_token():
    costs = {512: 544, 1024: 1056, 4096: 4128}
    assert B.opened(100, 10_000, (512, 1024, 4096), costs) == 4096
    assert B.opened(100, 900, (512, 1024, 4096), costs) == 512                     # little is left: 544 for 512, 1056 for 900
    assert B.opened(600, 900, (512, 1024, 4096), costs) == 1024
    assert B.opened(100, 100, (512, 1024, 4096), costs) == 512
    assert B.opened(100, 10_000, (512, 1024, 4096), {512: 300, 1024: 900, 4096: 4000}) == 512


def test_best_fit_takes_the_fullest_bin():
    where, used, _ = B.best_fit([60, 50, 45, 40, 5], (100,), {100: 100})
    assert where == [0, 1, 1, 0, 1] and used == [100, 100]


def test_copies_are_dealt_apart(spark, make_docs):
    docs = make_docs([(1, words(300))] * 3000 + [(i, words(200)) for i in range(2, 2000)])
    from pyspark.sql import functions as F

    items = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"),
                        F.size(F.split("text", " ")).cast("long").alias("n_tokens"))
    pieces = B.pack(items, 5000, per_shard=500).collect()
    check([(1, 300)] * 3000 + [(i, 200) for i in range(2, 2000)], pieces)
    rows = {}
    for p in pieces:
        rows[p.bin >> 32] = rows.get(p.bin >> 32, 0) + 1
    assert len(rows) >= 9 and max(rows.values()) < 1500
