import zlib

from tablekit.llm import compress_quality as C
from tablekit.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = C.op6(spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    good = [r.predicted for r in held if r.quality == 1]
    bad = [r.predicted for r in held if r.quality == 0]
    assert len(good) > 300 and sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.1
    # calibrated: the mean score is near the share of label 1
    assert abs(sum(r.score for r in held) / len(held) - len(good) / len(held)) < 0.05


def test_every_byte_counts():
    """A long text's sizes are the sums over all its blocks."""
    m = C.SizeModel(C.train_dictionary([b"alpha beta gamma " * 50] * 50), C.train_dictionary([b"OMEGA!! PSI!! " * 50] * 50),
                    (0.0, 10.0, 0.0, 0.0))
    a, b = b"alpha beta gamma " * 2000, b"OMEGA!! PSI!! " * 2000
    blocks = [(a + b)[i:i + C.BLOCK] for i in range(0, len(a + b), C.BLOCK)]
    parts = [m.features(x)[0] * len(x) for x in blocks]
    assert abs(m.features(a + b)[0] - sum(parts) / len(a + b)) < 1e-12
    assert m.score(a.decode()) > 0.5 > m.score(b.decode())


def test_edge_rows(spark, make_docs, make_labels):
    clean = [(i, " ".join(f"word{(i * 7 + j * j) % 50} flows" for j in range(60))) for i in range(60)]
    junk = [(100 + i, " ".join(f"BUY{(i + j) % 9}!!" for j in range(60))) for i in range(60)]
    rows = [*clean, *junk, (500, None), (501, ""), (None, "word1 flows word2 flows"), (502, "x"), (0, clean[0][1]),
            (503, "word3 flows " * 100_000)]
    labels = make_labels([(i, 1, 0) for i, _ in clean] + [(i, 0, None) for i, _ in junk]
                         + [(None, 1, 0), (502, None, 0), (999, 1, 0), (5, 0, 0), (1, 1, 0)])
    docs = make_docs(rows, extra=("score", "quality"))
    got = C.score_documents(docs, C.fit(docs, labels)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0.0 <= r.score <= 1.0
        by.setdefault(r.doc_id, r.score)
    assert by[500] == by[501] == 0.0
    assert by[3] > 0.5 > by[103] and by[503] > 0.5
    assert C.score_documents(docs.limit(0), C.fit(docs.limit(0), labels)).count() == 0
    one = C.fit(docs, labels.where("quality = 1"))
    assert all(x > 0.99 for x in [one.score("anything")])
    none = C.fit(docs, labels.limit(0))
    assert none.score("anything") == 0.5


def test_held_out_labels_teach_nothing(spark, make_docs, make_labels):
    rows = [(i, f"text number {i} " * 20) for i in range(100)]
    docs = make_docs(rows)
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0]
    m = C.fit(docs, make_labels([(i, i % 2, 0) for i in held]))
    assert m.weights == (0.0, 0.0, 0.0, 0.0)


def test_equals_plain_python(spark, make_docs, make_labels):
    """Dictionaries, sizes, curve and scores again, from the rows alone."""
    import math
    import random

    import numpy as np
    import xxhash
    import zstandard

    rng = random.Random(2)
    good, bad = [f"g{i}" for i in range(300)], [f"b{i}" for i in range(120)] + [f"g{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(rng.choice([30, 400, 2500])))) for i in range(150)]
    got = {r.doc_id: r.score for r in C.score_documents(
        make_docs(rows), C.fit(make_docs(rows), make_labels([(i, i % 2, 0) for i, _ in rows]))).collect()}

    def place(i):                                                  # hash of an int literal, then the id
        h = xxhash.xxh64_intdigest((5).to_bytes(4, "little"), seed=42)
        h = xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed=h)
        return (h - (1 << 64) if h >> 63 else h) % C.CALIBRATE_ONE_IN

    known = [(i, t.encode()) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    packers = []
    for q in (1, 0):
        train = [t[k:k + C.PIECE] for i, t in known if i % 2 == q and place(i) for k in range(0, len(t), C.PIECE)]
        size = min(C.DICT_BYTES, max(sum(map(len, train)) // 8, 1024))
        d = zstandard.ZstdCompressionDict(zstandard.train_dictionary(size, train).as_bytes())
        packers.append(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False,
                                                write_dict_id=False))
    alone = zstandard.ZstdCompressor(level=3, write_content_size=False)

    def x(t):
        g, b = (sum(len(p.compress(t[k:k + C.BLOCK])) for k in range(0, len(t), C.BLOCK)) for p in packers)
        return [(b - g) / len(t), g / len(t), len(alone.compress(t)) / len(t)]

    seen = [(x(t), i % 2) for i, t in known if not place(i)]
    n = {q: sum(i % 2 == q for i, _ in known) for q in (0, 1)}
    w = [n[y] / sum(b == y for _, b in seen) for _, y in seen]
    w = [v * len(w) / sum(w) for v in w]
    cols = list(zip(*[a for a, _ in seen]))
    mean = [sum(c) / len(c) for c in cols]
    scale = [math.sqrt(sum((a - m) ** 2 for a in c) / len(c)) + 1e-9 for c, m in zip(cols, mean)]
    z = [[1.0, *((a - m) / s for a, m, s in zip(row, mean, scale))] for row, _ in seen]
    beta = np.zeros(4)
    for _ in range(60):                                            # Newton, row by row
        grad, hess = -1e-3 * beta, 1e-3 * np.eye(4)
        for row, (_, y), v in zip(z, seen, w):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(beta @ row)))))
            grad = grad + v * (y - p) * np.array(row)
            hess = hess + v * p * (1 - p) * np.outer(row, row)
        step = np.linalg.solve(hess, grad)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    for i, t in rows:
        row = [1.0, *((a - m) / s for a, m, s in zip(x(t.encode()), mean, scale))]
        want = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(beta @ row)))))
        assert abs(got[i] - want) < 1e-6, i


def test_sample_is_of_whole_documents_within_its_bytes(spark, make_docs, make_labels):
    rows = [(i, f"{'good' if i % 2 else 'BAD!'} {i} " * (20 if i < 100 else 4000)) for i in range(104)]
    fits = [C.fit(make_docs(r), make_labels([(i, i % 2, 0) for i, _ in r]), class_bytes=30_000) for r in (rows, rows[:100])]
    assert fits[0].good == fits[1].good and fits[0].bad == fits[1].bad          # the four long ones do not fit
