import random
from collections import Counter

import corpus_pipeline as P
from tablekit.llm import quality_llr as Q
from tablekit.llm.common import packed, table
from tests.conftest import SF_SMALL
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_signature_join import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, df, name):
    from tablekit.session import shared_dir
    path = shared_dir(spark, "tests", name, unique=True)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_each_stage_against_brute_force(spark):
    """Every stage on what the one before wrote, compared with plain Python."""
    docs = table(spark, SF_SMALL, "documents")
    stage = dict(P.STAGES)
    assert [name for name, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_copies", "mix_sources",
                                              "pack_sequences"]

    kept = write(spark, stage["quality_rules"](spark, docs, SF_SMALL), "s1")
    scored = Q.score(packed(docs), Q.fit(docs, table(spark, SF_SMALL, "labels"))).where("kept")
    assert kept.columns == COLUMNS
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.collect()}

    lines = write(spark, stage["line_dedup"](spark, kept, SF_SMALL), "s2")
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert lines.columns == COLUMNS
    got = {r.doc_id: r for r in lines.collect()}
    for i, _, dropped, text in brute_lines(rows):
        assert got[i].text == text
        assert dropped == 0 or got[i].n_chars == len(text)
    assert len(got) == len(rows)

    single = write(spark, stage["near_copies"](spark, lines, SF_SMALL), "s3")
    rows = sorted((r.doc_id, r.text) for r in lines.collect())
    comps = brute_components([i for i, _ in rows], [t for _, t in rows], 5, 80)
    assert single.columns == COLUMNS
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, n, c in comps})

    mixed = write(spark, stage["mix_sources"](spark, single, SF_SMALL), "s4")
    assert mixed.columns == COLUMNS
    copies = Counter(r.doc_id for r in mixed.collect())
    words = {r.doc_id: len((r.text or "").split()) for r in single.collect()}
    assert set(copies) >= {i for i, n in words.items() if n}          # no document with words is left out
    assert max(copies.values()) <= 2

    packed_rows = stage["pack_sequences"](spark, mixed, SF_SMALL).collect()
    tokens = Counter()
    for r in packed_rows:
        tokens[r.doc_id] += r.n_tokens
    from tablekit.llm.temperature_mix import token_count
    from pyspark.sql import functions as F
    want = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.sum(token_count(F.col("text"))).alias("n")).collect()}
    assert tokens == Counter({i: n for i, n in want.items() if n})


def test_run_is_the_stages_in_order(spark):
    rows = P.run(spark, SF_SMALL).collect()
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in P.STAGES:
        docs = write(spark, stage(spark, docs, SF_SMALL), "run")
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_edge_rows(spark, make_docs):
    rng = random.Random(1)

    def text(n):
        return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))

    one = text(80)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, one, "en", "a"), (3, one, "en", "a"), (4, one, None, "b"),
            (None, text(60), "en", None), (5, text(20_000), "en", "c"), *[(10 + i, text(40), "en", "a") for i in range(30)]]
    from tablekit.session import shared_dir
    sf = shared_dir(spark, "tests", "no_labels", unique=True)         # nothing is trusted: the base rules decide
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(sf + "/labels.parquet")
    for docs in (make_docs(rows, extra=("kept", "k1", "copies", "lines")), make_docs(rows).limit(0)):
        columns = docs.columns
        for name, stage in P.STAGES:
            docs = write(spark, stage(spark, docs, sf), name)
            if name != "pack_sequences":
                assert docs.columns == columns
        ids = {r.doc_id for r in docs.collect()}
        # 3 (twice) and 4 are copies: one row of them stays, that of the least id
        assert ids in ({3, None, 5, *range(10, 40)}, set())
