import math
import re
from collections import Counter

import numpy as np

from tablekit.llm import quality_llr as Q
from tablekit.llm.common import WordHashes, packed, table, words
from tests.conftest import SF_ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def brute_scores(rows, good, buckets, prior):
    """LLR per text from plain counters."""
    memo = WordHashes()

    def grams(t):
        return Counter(Q.ngram_buckets(memo.of(words(t)), buckets).tolist()) if words(t) else Counter()

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw += grams(t)
        if i in good:
            target += grams(t)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    prior = max(prior, Q.PRIOR_SHARE * n_target / buckets)
    out = []
    for _, t in rows:
        g = grams(t)
        n = sum(g.values())
        out.append(sum(c * math.log((target[b] + prior) / (raw[b] * n_target / n_raw + prior))
                       for b, c in g.items()) / n if n else 0.0)
    return out


def test_equals_brute_force_on_the_documents(spark):
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    good = {r.doc_id for r in table(spark, SF_ORACLE, "labels").where("quality = 1").collect()}
    got = {r.doc_id: r for r in Q.op1(spark, SF_ORACLE).collect()}
    want = brute_scores(rows, good, Q.BUCKETS, Q.PRIOR)
    assert len(got) == len(rows)
    for (i, t), llr in zip(rows, want):
        r, base = got[i], brute_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert abs(r.llr - llr) < 1e-6
        assert r.kept == (not r.base_failed and llr >= Q.THRESHOLD)


def test_junk_is_rejected_and_clean_text_kept(spark):
    from pyspark.sql import functions as F
    r = (Q.op1(spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
         .where("not base_failed").groupBy("quality")
         .agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect())
    kept = {x.quality: x.kept for x in r}
    assert kept[1] > 0.998 and kept[0] < 0.1


def test_edge_rows(spark, make_docs, make_labels):
    rep = " ".join(["again and again it goes"] * 4)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e f g h i"), (5, "a b c d e f g h i j"), (6, rep),
            (7, "x y z w v " * 2), (8, "l1 a\nl1 a\n\n \nl1 a "), (None, "no id but ten words are in this text here"),
            (5, "a b c d e f g h i j"), (9, "w\x85x y \x1c z#*$%&|<>"), (10, "word " * 50_000)]
    labels = make_labels([(5, 1, 0), (5, 1, 0), (None, 1, 0), (99, 1, None), (4, None, 0), (6, 0, 0)])
    docs = make_docs(rows, extra=("kept", "llr", "n_words"))
    out = Q.score(packed(docs), Q.fit(docs, labels)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(r.text)
    kept = Q.filter_quality(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {5, None}
    assert Q.filter_quality(docs.limit(0), labels).count() == 0
    assert not Q.fit(docs, labels.limit(0)).any()


def test_repeated_words_by_brute_force():
    rng = np.random.default_rng(1)
    for n in (0, 1, 4, 5, 6, 30, 200):
        for v in (2, 3, 50):
            w = [str(x) for x in rng.integers(0, v, n)]
            assert Q.repeated_words(WordHashes().of([x.encode() for x in w])) == brute_base(" ".join(w))[4]


def test_the_verdict_does_not_change_with_the_tables_size(spark, make_docs, make_labels):
    """The same texts a hundred times over: the prior grows with the trusted counts, so the ratios stay."""
    texts = [f"alpha beta gamma delta {i % 7} epsilon zeta" if i % 3 else f"BUY now {i % 5} cheap cheap pills" for i in range(30)]
    few = make_docs(list(enumerate(texts)))
    many = make_docs([(k * 30 + i, t) for k in range(40) for i, t in enumerate(texts)])
    good = [i for i in range(30) if i % 3]
    a = Q.fit(few, make_labels([(i, 1, 0) for i in good]), buckets=64, prior=0.0)
    b = Q.fit(many, make_labels([(k * 30 + i, 1, 0) for k in range(40) for i in good]), buckets=64, prior=0.0)
    assert abs(a - b).max() < 1e-12 and abs(a).max() > 0.1
