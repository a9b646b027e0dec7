import math
import zlib
from collections import Counter

import numpy as np

from tablekit.llm import ppm_langid as P
from tablekit.llm.common import table


def brute_lengths(train, text):
    """Code length under each language by walking plain dictionaries; same pruning."""
    out = []
    for lang in sorted(train):
        counts = {}
        for t in train[lang]:
            b = b" " * P.ORDER + P.normal_bytes(t)
            for i in range(P.ORDER, len(b)):
                for k in range(P.ORDER + 1):
                    counts.setdefault(b[i - k:i], Counter())[b[i]] += 1
        counts = {c: n for c, n in counts.items() if not c or sum(n.values()) >= P.MIN_CONTEXT}

        def cost(context, byte, counts=counts):
            while context and context not in counts:
                context = context[1:]
            n = counts[context]
            total, distinct = sum(n.values()), len(n)
            if byte in n:
                return math.log2((total + distinct) / n[byte])
            rest = cost(context[1:], byte) if context else 8.0
            return math.log2((total + distinct) / distinct) + rest

        b = b" " * P.ORDER + P.normal_bytes(text)
        out.append(sum(cost(b[i - P.ORDER:i], b[i]) for i in range(P.ORDER, len(b))))
    return np.array(out)


TRAIN = {"aa": ["the cat sat on the mat and the dog sat too " * 3, "a cat, the hat!"],
         "bb": ["der hund und die katze sitzen auf der matte " * 3, "üben ÜBEN öl 123"]}


def model():
    rows = Counter()
    for lang, texts in TRAIN.items():
        for t in texts:
            for code in P.sequence_codes(P.normal_bytes(t)).tolist():
                rows[lang, code >> 8, code & 255] += 1
    return P.freeze([(*k, c) for k, c in rows.items()])


def test_code_lengths_equal_the_walk(monkeypatch):
    m = model()
    texts = ["the cat", "die katze", "zzz 你好 qqq", "ÜBEN\n99", "x", "the dog und der hund " * 40]
    want = np.stack([brute_lengths(TRAIN, t) for t in texts])
    got = m.lengths([P.normal_bytes(t) for t in texts]) / P.UNITS
    assert np.allclose(got, want, atol=1e-3 * max(len(t) for t in texts))
    monkeypatch.setattr(P, "CHUNK", 7)                       # pieces of a long text change nothing
    assert (m.lengths([P.normal_bytes(t) for t in texts]) / P.UNITS == got).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    rows = P.op10(spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.99


def test_edge_rows(spark, make_docs):
    rows = [(i, t, lang, "s") for i, (lang, t) in enumerate((lang, t) for lang in TRAIN for t in TRAIN[lang] * 3)]
    rows += [(100, None, "aa", "s"), (101, "", "aa", "s"), (102, "123 !!", "bb", "s"), (None, "the cat", None, "s"),
             (103, "der hund", None, "s"), (103, "der hund", None, "s"), (104, "the cat " * 200_000, None, "s"),
             (105, "你好", None, "s")]
    docs = make_docs(rows, extra=("lang_pred", "score", "th", "its"))
    m = P.fit(docs)
    assert [x.langs for x in m] == [["aa", "bb"]]
    got = P.identify(docs, m).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[None][0] == "aa" and by[103][0] == "bb" and by[104][0] == "aa" and by[105][0] in ("aa", "bb")
    assert all(0.0 <= r.score <= 1.0 for r in got)
    assert P.identify(docs.limit(0), m).count() == 0
    nothing = P.fit(docs.where("lang = 'zz'"))
    assert {r.lang_pred for r in P.identify(docs, nothing).collect()} == {"und"}


def test_groups_of_languages_change_nothing(spark, make_docs):
    rows = [(i, t, lang, "s") for i, (lang, t) in enumerate((lang, t) for lang in TRAIN for t in TRAIN[lang] * 3)]
    rows += [(90 + i, "le chat et le chien sont sur le tapis " * (i + 1), "cc", "s") for i in range(6)]
    rows += [(200, "the cat und die katze", None, "s"), (200, "the cat und die katze", None, "s"), (201, None, None, "s"),
             (202, "le chat", None, "s"), (None, "der hund", None, "s")]
    docs = make_docs(rows)
    one, many = P.fit(docs), P.fit(docs, model_bytes=1)
    assert [m.langs for m in one] == [["aa", "bb", "cc"]] and [m.langs for m in many] == [["aa"], ["bb"], ["cc"]]
    a, b = (sorted(((r.doc_id or -1, r.lang_pred, round(r.score, 9)) for r in P.identify(docs, m).collect())) for m in (one, many))
    assert a == b and len(a) == len(rows)


def test_every_language_is_learned(spark, make_docs):
    """Also the rarest of hundreds; contexts are kept by how often they are seen, not by number."""
    rows = [(k, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}" for c in "xyzuvw") * 3, f"l{k:03}", "s") for k in range(230)]
    rows = [(4 * i + j, t, lang, "s") for i, (_, t, lang, _) in enumerate(rows) for j in range(4)]
    docs = make_docs(rows)
    learned = [lang for m in P.fit(docs) for lang in m.langs]
    assert learned == sorted({r[2] for r in rows})
    assert P.groups_of([("a", 10), ("b", 10), ("c", 10**9), ("d", 1)], 21 * 1024 * 2) == [["a", "b"], ["c"], ["d"]]


def test_sample_is_of_whole_documents_within_its_bytes(spark, make_docs):
    rows = [(i, "abc def " * (10 if i < 50 else 10_000), "aa", "s") for i in range(60)]
    counts = P.sequence_counts(make_docs(rows), lang_bytes=20_000).where("lang = 'aa'")
    used = sum(r.c for r in counts.collect())
    kept = sum(len(t) for i, t, *_ in rows if i < 50 and zlib.crc32(str(i).encode()) % 4 != 2)
    assert used == kept                                            # whole short ones, no part of a long one
