"""Compression classifier of text quality (operator 6).

Two zstandard dictionaries are trained, one on good and one on bad labelled
text. A text is cut into blocks of BLOCK bytes, every block is compressed with
both, and the difference of the compressed sizes (bad minus good) per byte says
whose kind of text it is: the dictionary that knows the text makes it smaller.
A logistic curve, fitted on whole labelled texts that the dictionaries have not
seen, turns the normalised difference, with the compressed shares under the good
dictionary and of the text by itself (text that repeats itself shrinks), into a
probability of label 1. It is weighted to the class shares among all labelled
rows that may be learned from.

Fitted on a bounded sample of rows: per class the first ``PER_CLASS`` labelled
documents by hash of doc_id, as far as they fit into ``CLASS_BYTES`` together
(the larger ones come last; a document that does not fit is passed over, none is
cut). The dictionaries see every byte of their texts. Scoring covers every byte
of every text, in one pass without a shuffle.

Defined cases: null or empty text scores 0.0; null labels and labels of unknown
documents are ignored; a document labelled both ways counts with neither;
repeated rows are scored each; with one class only, or none, every non-empty
text scores that class's share (0.5 for none); an empty table gives an empty
result; a null doc_id is not held out and not learned from.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import join_few, stored, table

BLOCK = 2048
LEVEL = 3
DICT_BYTES = 112 << 10
#: Bounds on what the classifier is fitted on.
PER_CLASS, CLASS_BYTES = 2250, 16 << 20
#: Pieces that a text is trained on in.
PIECE = 1024
#: Of the sample, one in so many (by hash) calibrates; the rest trains the dictionaries.
CALIBRATE_ONE_IN = 3
FOLDS, PREDICT_AT = 5, 0.3


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def pieces(data: bytes) -> list[bytes]:
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or the raw blocks where there are too few to train on."""
    raw = b"".join(blocks)
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(len(raw) // 8, 1024)), blocks).as_bytes()
    except zstandard.ZstdError:
        return raw or b"."


class SizeModel:
    """Both dictionaries and the calibration; sent to the tasks as a whole (about 230 KB)."""

    def __init__(self, good: bytes, bad: bytes, weights=(0.0, 0.0, 0.0, 0.0)):
        self.good, self.bad, self.weights = good, bad, tuple(weights)

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "weights": self.weights}

    @cached_property
    def _compressors(self):
        made = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False))
        return [*made, zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]

    def features(self, data: bytes) -> tuple[float, float, float]:
        """Per byte: bad size - good size, good size, and the size of the whole
        text by itself."""
        good = bad = 0
        by_good, by_bad, alone = self._compressors
        for i in range(0, len(data), BLOCK):
            block = data[i:i + BLOCK]
            good += len(by_good.compress(block))
            bad += len(by_bad.compress(block))
        return (bad - good) / len(data), good / len(data), len(alone.compress(data)) / len(data)

    def score(self, text: str | None) -> float:
        if not text:
            return 0.0
        z = self.weights[0]
        for w, x in zip(self.weights[1:], self.features(text.encode("utf-8", "surrogatepass"))):
            z += w * x
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps on standardised features; a
    small ridge keeps separable samples finite. Intercept first."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(y)), (x - mean) / scale])
    w, ridge = np.zeros(z.shape[1]), 1e-3
    for _ in range(60):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / scale
    return np.concatenate([[w[0] - slopes @ mean], slopes])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES) -> SizeModel:
    known = (labels.where("doc_id is not null and quality in (0, 1)")
             .where(fold(F.col("doc_id"), FOLDS) != 0)
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .where("quality = other").select("doc_id", "quality"))
    known = stored(known, "known_quality")
    sizes = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = stored(known.where("quality = 0").orderBy(*by_hash).limit(per_class)
                 .union(known.where("quality = 1").orderBy(*by_hash).limit(per_class)), "quality_sample")
    texts = join_few(docs.select("doc_id", "text").where("text is not null and text != ''"), few, ["doc_id"],
                     2 * per_class)
    # one text an id, at most 2 x per_class; whole ones, as far as the bytes go
    texts = stored(texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "quality_texts")
    so_far = Window.partitionBy("quality").orderBy("large", *by_hash).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = (texts.select("doc_id", "quality", F.octet_length("text").cast("long").alias("size"))
            .withColumn("large", F.col("size") > class_bytes // 16)
            .withColumn("sum", F.sum("size").over(so_far)).where(F.col("sum") <= class_bytes).select("doc_id"))
    texts = texts.join(F.broadcast(fits), "doc_id")                            # at most 2 x per_class ids
    calibrates = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(CALIBRATE_ONE_IN)) == 0

    rows = texts.where(~calibrates).select("doc_id", "quality", "text").orderBy("doc_id").collect()
    train = {q: [b for r in rows if r.quality == q for b in pieces(r.text.encode("utf-8", "surrogatepass"))] for q in (0, 1)}
    model = SizeModel(train_dictionary(train[1]), train_dictionary(train[0]))

    def measure(batches):
        for batch in batches:
            f = [model.features(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
            cols = list(zip(*f)) if f else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"),
                                              *[pa.array(c, pa.float64()) for c in cols]],
                                             names=["doc_id", "quality", "a", "b", "c"])

    seen = (texts.where(calibrates).select("doc_id", "quality", "text")
            .mapInArrow(measure, "doc_id long, quality int, a double, b double, c double").orderBy("doc_id").collect())
    y = np.array([r.quality for r in seen], dtype=float)
    if not train[0] or not train[1] or len(set(y.tolist())) < 2:
        share = sizes.get(1, 0) / max(1, sum(sizes.values())) if sizes else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return SizeModel(b".", b".", (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    weight = np.array([sizes[int(q)] / (y == q).sum() for q in y])
    x = np.array([(r.a, r.b, r.c) for r in seen])
    model.weights = tuple(float(v) for v in logistic(x, y, weight / weight.mean()))
    return model


def score_documents(docs: DataFrame, model: SizeModel) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([model.score(t) for t in batch.column("text").to_pylist()],
                                                  pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op6(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
