import random
import re

import numpy as np
import pytest

from tablekit.llm import signature_join as J
from tablekit.llm.common import table
from tests.conftest import SF_ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts, size):
    out = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = WORD.findall(low)
        out.append({tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)})
    return out


def brute_components(ids, texts, size, percent):
    sets = brute_sets(texts, size)
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {}
    for i in range(len(ids)):
        members = [x for x in groups[find(i)] if x is not None]
        least[i] = min(members) if members else None
    return [(ids[i], len(sets[i]), least[i] if sets[i] else ids[i]) for i in range(len(ids))]


def families(seed, n_families=12, members=14):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n_families):
        base = rng.choices(vocab, k=rng.choice([3, 9, 11, 14, 20, 45, 90, 200, 600]))
        for _ in range(members):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
                at = rng.randrange(len(w))
                act = rng.random()
                if act < 0.5:
                    w[at] = rng.choice(vocab)
                elif act < 0.75 and len(w) > 1:
                    del w[at]
                else:
                    w.insert(at, rng.choice(vocab))
            texts.append(" ".join(x.upper() if rng.random() < 0.2 else x for x in w))
    rng.shuffle(texts)
    return texts


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 5, 80), (3, 2, 70), (4, 2, 60), (5, 1, 50)])
def test_equals_brute_force_on_families(spark, make_docs, seed, size, percent):
    texts = families(seed)
    ids = list(range(100, 100 + len(texts)))
    got = J.near_components(make_docs(list(zip(ids, texts))), size, percent)
    assert result(got) == sorted(brute_components(ids, texts, size, percent), key=repr)


@pytest.mark.parametrize("percent", [50, 60, 65, 70, 72, 80, 90])
def test_nested_sets_share_a_key(percent):
    """The extreme partners: a set and its smallest part that still links."""
    rng = np.random.default_rng(percent)
    for n in [*range(3, 60), 100, 333, 1000, 4321]:
        big = np.unique(rng.integers(1, 2**62, size=n).astype(np.uint64))
        small = np.sort(rng.permutation(big)[:-(-len(big) * percent // 100)])
        shared = np.intersect1d(J.bucket_keys(big, percent), J.bucket_keys(small, percent))
        assert len(small) == len(big) or len(shared), (n, len(small))


def test_equals_brute_force_on_the_documents(spark):
    docs = table(spark, SF_ORACLE, "documents")
    rows = docs.select("doc_id", "text").collect()
    got = J.op4(spark, SF_ORACLE)
    want = brute_components([r.doc_id for r in rows], [r.text for r in rows], 3, 90)
    assert result(got) == sorted(want, key=repr)


def test_edge_rows(spark, make_docs):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "One two"), (3, "one  TWO"), (9, "two one"), (None, "one two"),
            (10, long), (4, long + " tail"), (11, "É two three"), (12, "é two three"), (8, "One two"), (8, "other words here")]
    docs = make_docs(rows, extra=("rid", "node", "k1", "bits"))
    want = brute_components([r[0] for r in rows], [r[1] for r in rows], 3, 90)
    assert result(J.near_components(docs, 3, 90)) == sorted(want, key=repr)
    empty = docs.limit(0)
    assert J.near_components(empty, 3, 90).count() == 0
    assert J.drop_near_copies(empty).count() == 0


def test_one_document_of_each_component_stays(spark, make_docs):
    rows = [(4, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (9, "q r s t u v"), (7, None),
            (8, ""), (None, "q r s t u v")]
    kept = J.drop_near_copies(make_docs(rows, extra=("nth", "copies")), 5, 80)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "nth", "copies"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(2, "a b c d e f g h"), (9, "q r s t u v"), (7, None), (8, "")], key=repr)


def test_many_near_copies_make_few_pairs(spark, make_docs):
    """A large group of near copies that all link: one component, and the pairs
    compared stay near one a member instead of all pairs."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(1500):
        w = list(base)
        w[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = J.near_components(make_docs(rows), 3, 90).collect()
    assert {r.component_id for r in got} == {0}


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    n = 700
    base = rng.integers(0, 2**63, size=(8, 260), dtype=np.uint64)
    sets = []
    for i in range(n):
        s = base[i % 8].copy()
        k = rng.integers(0, 40)
        s[rng.choice(260, k, replace=False)] = rng.integers(0, 2**63, size=k, dtype=np.uint64)
        sets.append(np.unique(s[:260 - rng.integers(0, 20)]))
    sizes = np.array([len(s) for s in sets])
    bits = np.array([J.bitmap(s, J.bitmap_width(len(s))).tobytes() for s in sets], dtype=object)
    comp, node = np.arange(n) // 2, np.arange(n)
    for side in (np.zeros(n, int), (np.arange(n) % 2)):
        got = {tuple(x) for x in J.block_pairs(side, node, sizes, bits, comp, 90)}
        for i in range(n):
            for j in range(i + 1, n):
                if side.any() and side[i] == side[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j]))
                if comp[i] != comp[j] and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                    assert (i, j) in got
        assert len(got) < n * n / 8


def test_overlaps_both_ways(monkeypatch):
    rng = np.random.default_rng(8)
    tokens = [np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint64)) for _ in range(40)]
    pairs = np.array([(a, b) for a in range(40) for b in range(a)])
    want = [len(set(tokens[a]) & set(tokens[b])) for a, b in pairs]
    assert J.overlaps(pairs, tokens).tolist() == want
    monkeypatch.setattr(J, "MATRIX_BYTES", 0)
    assert J.overlaps(pairs, tokens).tolist() == want


def test_joining_links_are_a_forest():
    pairs = np.array([(0, 1), (1, 2), (2, 0), (3, 4), (0, 3), (4, 1)])
    assert J.joining_links(pairs, [0, 1, 2, 3, 4]) == [0, 1, 3, 4]
    assert J.joining_links(pairs, [7, 7, 7, 3, 3]) == [4]
