import hashlib
import random

from pyspark.sql import functions as F

from tablekit.llm import line_dedup as L

WS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    """Expected (doc_id, n_lines, n_dropped, kept) per row."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))

    holders = {}
    for i, t in rows:
        if i is not None:
            for line in set(map(key, (t or "").split("\n"))):
                holders.setdefault(line, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            k = key(line)
            docs = holders.get(k, set())
            gone = i is not None and len(k) >= min_chars and len(docs) >= min_docs and i < max(docs)
            if not gone:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r._n_lines, r._n_dropped, r.text or "") for r in df.collect()), key=repr)


def test_edge_rows(spark, make_docs):
    line = "A line that is long enough to count"
    rows = [*[(30 + k % 2, "rows of one id are one document") for k in range(4)], (1, line), (2, " " + line.upper() + "\t"), (3, f"x\n{line}\ny\n{line}\n"), (3, line), (4, None), (5, ""),
            (6, "\n\n"), (7, "short line here 1234"), (8, "short line here 1234"), (9, "short line here 123"),
            (10, "short line here 123"), (11, "short line here 123"), (None, line), (12, "é" * 20), (13, "é" * 20),
            (14, "É" * 20), (15, "é" * 20 + "\x0b"), (16, "\n".join(f"row {i} of a very long text" for i in range(5000))),
            (17, "\n".join(f"row {i} of a very long text" for i in range(0, 5000, 2))),
            (18, "\n".join(f"ROW {i} of a very long text" for i in range(0, 5000, 3)))]
    docs = make_docs(rows, extra=("lines", "words", "id", "th", "h1", "n_lines"))
    out = L.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    assert result(out) == brute(rows)
    assert L.dedup_lines(docs.limit(0)).count() == 0


def test_line_in_very_many_documents(spark, make_docs):
    """Enough holders for the frequent-key path; the same rule holds."""
    rng = random.Random(2)
    pool = [f"boilerplate sentence number {i} here" for i in range(6)]
    rows = []
    for i in range(4000):
        lines = [rng.choice(pool) for _ in range(rng.randrange(3))] + [f"own line of document {i % 3500}"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    docs = make_docs(rows)
    lines = L.line_rows(docs, 20)
    assert L._hot(lines).count() >= 5
    assert result(L.dedup_lines(docs)) == brute(rows)


def test_other_bounds(spark, make_docs):
    rows = [(i, f"only {i % 2}\nshared by all of them\nseen {i // 2} twice") for i in range(8)]
    for chars, docs in ((5, 2), (5, 4), (0, 5), (22, 3)):
        assert result(L.dedup_lines(make_docs(rows), chars, docs)) == brute(rows, chars, docs)


def test_digest_of_kept_text(spark, make_docs):
    out = L.dedup_lines(make_docs([(1, None)])).select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")).first()
    assert out.h == hashlib.sha256(b"").hexdigest()


def test_own_columns_give_way_to_the_callers(spark, make_docs):
    import corpus_pipeline

    line = "a line that many documents share, long enough"
    docs = make_docs([(i, f"{line}\nown {i}") for i in range(4)], extra=("_n_dropped", "_N_LINES"))
    out = L.dedup_lines(docs)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    assert {r.doc_id: (r._n_dropped, r["__n_dropped"]) for r in out.collect()} == {
        0: ("x", 1), 1: ("x", 1), 2: ("x", 1), 3: ("x", 0)}
    kept = corpus_pipeline.line_dedup(spark, docs, None)
    assert kept.columns == docs.columns and {r.n_chars for r in kept.where("doc_id < 3").collect()} == {5}
