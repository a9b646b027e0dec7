"""Quality rules (operator 1): simple counts per text, then a hashed n-gram
log-likelihood ratio between a trusted-target and a raw-corpus multinomial.

Every word and every pair of neighbouring words of a text falls into one of
``buckets`` hash buckets. Two multinomials are estimated over the buckets: the
raw one from all documents, the target one from trusted documents (label
quality = 1; at most ``max_trusted``, the first by hash of doc_id). A text's
score is the mean over its n-grams of log p_target - log p_raw, so length does
not matter; it is kept if it passes the base rules and scores at least
``threshold``. The threshold is fixed, so a document's verdict depends on its
text and the two models alone.

Counting is one pass whose tasks send at most one row per bucket, summed by a
partially aggregated group-by; the model is one number per bucket, whatever
the corpus. Scoring is a second pass without any shuffle.

Defined cases: null text has no words and is rejected; texts under
``min_words`` words or with over ``max_repeat_pct`` percent repeated words are
rejected whatever their score; repeated rows are counted and scored each; null
or repeated label rows are ignored; without trusted text both models are equal
and all scores are 0; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import WS, WordHashes, mix, packed, table, unpacked, window_hashes, words

SYMBOLS = "#*$%&|<>"
#: Log-likelihood ratio per n-gram below which a text is rejected.
THRESHOLD = -0.2
BUCKETS = 1 << 16
#: Pseudo-counts of a bucket, as a share of the mean trusted count of a bucket, so
#: that the verdict does not change with the table's size; and the least, so that
#: with few trusted texts the ratio shrinks to 0 and clean texts that happen not
#: to be labelled are not held against chance.
PRIOR_SHARE, PRIOR = 0.25, 10.0
#: Bound on the labelled documents the target model is fitted on.
MAX_TRUSTED = 20_000
WINDOW = 5
def ngram_buckets(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (of a power of two) of every word and of every pair of neighbouring words."""
    return (np.concatenate([mix(h), window_hashes(h, 2)]) & np.uint64(buckets - 1)).view(np.int64)


def repeated_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of so many words that occur twice or more."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    key = window_hashes(h, window)
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[at] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


def base_counts(text: str | None, ws: list[bytes], h: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(WS)]
    return (len(ws), len(text) - sum(map(text.count, WS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(h))


def _add(found: list[list[np.ndarray]], total: np.ndarray) -> None:
    """Counts the buckets of other and trusted texts into raw and target."""
    for trusted, lists in enumerate(found):
        if lists:
            n = np.bincount(np.concatenate(lists), minlength=total.shape[1])
            total[0] += n
            total[1] += n * trusted
            lists.clear()


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
        max_trusted: int = MAX_TRUSTED, prior: float = PRIOR) -> np.ndarray:
    """log p_target - log p_raw of each bucket; the target multinomial is
    smoothed by pseudo-counts at the raw corpus's rate: PRIOR_SHARE of a bucket's
    mean trusted count, at least ``prior``."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)
    texts = (docs.select("doc_id", "text").where("text is not null")
             .join(F.broadcast(good.select("doc_id", F.lit(True).alias("trusted"))), "doc_id", "left")
             .select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")))

    def count(batches):
        memo, total = WordHashes(), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            found = [[], []]
            for text, trusted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[trusted].append(ngram_buckets(memo.of(words(text)), buckets))
                if len(found[trusted]) == 500:
                    _add(found, total)
            _add(found, total)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])],
                                         names=["bucket", "raw", "target"])

    sums = (texts.mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    counts = np.zeros((2, buckets), dtype=np.float64)
    for row in sums.collect():                       # one row a bucket at most
        counts[0, row.bucket], counts[1, row.bucket] = row.raw, row.target
    if not counts[1].any():
        return np.zeros(buckets)
    expected = counts[0] * (counts[1].sum() / counts[0].sum())
    prior = max(prior, PRIOR_SHARE * counts[1].sum() / buckets)
    return np.log((counts[1] + prior) / (expected + prior))


SCORE_COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                 "base_failed boolean, llr double, kept boolean")


def score(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, min_words: int = 10,
          max_repeat_pct: int = 20) -> DataFrame:
    """``doc_id, text, rest`` of :func:`packed` documents and SCORE_COLUMNS."""
    buckets = len(ratio)

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                ws = words(text)
                h = memo.of(ws)
                counts = base_counts(text, ws, h)
                failed = counts[0] < min_words or 100 * counts[4] > max_repeat_pct * counts[0]
                llr = float(ratio[ngram_buckets(h, buckets)].mean()) if ws else 0.0
                out.append((*counts, failed, llr, not failed and llr >= threshold))
            cols = list(zip(*out)) if out else [()] * 8
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, t) for c, t in zip(cols, types)]],
                names=[*batch.schema.names, *[c.split()[0] for c in SCORE_COLUMNS.split(", ")]])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, {SCORE_COLUMNS}")


def filter_quality(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The kept documents, with all their columns."""
    ratio = fit(docs, labels)
    return unpacked(score(packed(docs), ratio, **params).where("kept"), docs.columns)


def op1(spark, sf_dir: str) -> DataFrame:
    """Base counts, LLR and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratio = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, ratio).drop("text").withColumn("llr", F.round("llr", 9))
