"""Substring dedup by sliding sentence spans (operator 8).

Texts are split into sentences (after . ! ? followed by white space, and at line
ends). A run is two or more consecutive sentences with words, of ``min_words``
words or more. From every sentence on, and up to every sentence back, the
shortest run is hashed to 96 bits over its words, A-Z lowered. Any longer run
is covered by the shortest ones inside it, so a repeat of any run of several
sentences is found by these. Runs are joined globally on the hash. The first
run of a hash, by doc_id and position, stays; every sentence covered by any
other run is removed. Of a repeated passage thus go, in all documents but the
first, its whole sentences, if they are a run; a passage without one (a single
sentence, glued to its neighbours without an end mark or line end, or of two
sentences whose outer ends differ) stays. Shared phrases and short boilerplate stay.

Only hashes and positions are shuffled, and one streaming window pass per hash
finds its first run. Hashes that are frequent in a 1/64 hash sample of the
documents (at most MAX_HOT of them) stay out of that shuffle: their first runs
are exact, a minimum taken over all rows within each task before it is shuffled,
and the rows are judged where they are, with the removed runs of a document
merged at once. The sample only steers the layout. The removed spans meet the
text in one join.

Defined cases: null or empty text has no sentence and stays as it is; repeats
inside one document count; rows equal in id and text are one document and keep
or lose the same sentences; a null doc_id comes after all others; a text whose
sentences all go becomes empty; an empty table gives an empty result; other
columns pass through :func:`dedup_spans`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import mix, packed, stored, table, text_hash, unpacked, unused, words

MIN_WORDS = 15
#: Layout only: the share of documents looked at for frequent hashes, the
#: sampled runs that make one frequent, and the most handled apart.
SAMPLE_ONE_IN, HOT_ROWS, MAX_HOT = 64, 16, 2048
_END = re.compile(r"[.!?]+[ \t\x0b\x0c\r]+|[ \t\x0b\x0c\r]*\n\s*")
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def sentence_starts(text: str) -> list[int]:
    """Where each sentence begins; a sentence keeps the white space after it."""
    starts = [0]
    starts += [m.end() for m in _END.finditer(text) if m.end() < len(text)]
    return starts


def runs(text: str, min_words: int):
    """(first, end, h1, h2) arrays of the distinct runs; sentences first..end-1."""
    starts = sentence_starts(text)
    pieces = [words(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])]
    filled = np.array([k for k, p in enumerate(pieces) if p], dtype=np.int64)
    pieces = [p for p in pieces if p]                       # sentences without words bind nothing
    n = np.array([len(p) for p in pieces], dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(n)])
    if before[-1] < min_words:
        return None
    hashes = [xxhash.xxh3_128_intdigest(b" ".join(p).lower()) for p in pieces]
    # ends of the shortest run from each sentence on, and starts of that up to each
    i = np.arange(len(n))
    end = np.searchsorted(before, before[:-1] + min_words)            # before[end] - before[i] >= min_words
    ok = end <= len(n)
    longer = ok & (end == i + 1)                                      # one sentence is no run
    end = np.where(longer, np.searchsorted(before, np.minimum(before[:-1] + n + 1, before[-1] + 1)), end)
    ok = end <= len(n)
    first = np.searchsorted(before, before[1:] - min_words, side="right") - 1
    back = before[1:] >= min_words
    longer = back & (first == i)
    first = np.where(longer, np.searchsorted(before, before[:-1] - 1, side="right") - 1, first)
    back &= first >= 0
    spans = np.concatenate([np.stack([i[ok], end[ok]], 1), np.stack([first[back], i[back] + 1], 1)])
    if not len(spans):
        return None
    spans = np.unique(spans, axis=0)
    a, b = spans[:, 0], spans[:, 1]
    out = []
    for shift, base in zip((0, 64), _BASE):
        h = np.array([(x >> shift) & 0xFFFFFFFFFFFFFFFF for x in hashes], dtype=np.uint64)
        # h[a] * base^(k-1) + ... + h[b-1], all runs at once, longest run steps
        key = np.zeros(len(a), dtype=np.uint64)
        for step in range(int((b - a).max())):
            on = a + step < b
            key[on] = mix(key[on] * base + h[a[on] + step])
        out.append(key)
    return filled[a], filled[b - 1] + 1, out[0], out[1]


def run_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, th, a, b, h1, h2) of every run of every text."""
    def run(batches):
        for batch in batches:
            held = []
            for k, text in enumerate(batch.column("text").to_pylist()):
                found = runs(text, min_words) if text else None
                if found:
                    held.append((np.full(len(found[0]), k), *found))
            if held:
                k, a, b, h1, h2 = (np.concatenate(x) for x in zip(*held))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(k)), batch.column("th").take(pa.array(k)),
                     pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(h1.view(np.int64)),
                     pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32))],
                    names=["doc_id", "th", "a", "b", "h1", "h2"])

    return (docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text")
            .mapInArrow(run, "doc_id long, th long, a int, b int, h1 long, h2 int"))


class _Hot:
    """Rows of frequent hashes in a batch of run rows."""

    def __init__(self, keys):
        keys = sorted(dict(keys).items())                  # one h2 for each h1
        self.h1 = np.array([k for k, _ in keys], dtype=np.int64)
        self.h2 = np.array([k for _, k in keys], dtype=np.int64)

    def rows(self, batch):
        """(row number, place of its hash) of the rows with a frequent hash."""
        h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
        if not len(self.h1) or not len(h1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        hit = np.flatnonzero((self.h1[at] == h1) & (self.h2[at] == h2))
        return hit, at[hit]


def _places(batch, hit):
    """(id is null, id, th, a) of the rows: what decides which run is first."""
    part = batch.take(pa.array(hit))
    return [(i is None, i or 0, t, a) for i, t, a in
            zip(*(part.column(c).to_pylist() for c in ("doc_id", "th", "a")))]


def removed_in_place(rows: DataFrame, keys) -> DataFrame:
    """(doc_id, th, a, b): merged spans of the runs with a frequent hash that are not its first."""
    hot = _Hot(keys)

    def least(batches):
        best = {}
        for batch in batches:
            hit, at = hot.rows(batch)
            for k, place in zip(at.tolist(), _places(batch, hit)):
                if k not in best or place < best[k]:
                    best[k] = place
        ks = list(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ks, pa.int64()), *(pa.array([best[k][j] for k in ks], t)
                                         for j, t in enumerate((pa.bool_(), pa.int64(), pa.int64(), pa.int32())))],
            names=["k", "no_id", "id", "th", "a"])

    firsts = {r.k: tuple(r.least) for r in
              rows.mapInArrow(least, "k long, no_id boolean, id long, th long, a int")
              .groupBy("k").agg(F.min(F.struct("no_id", "id", "th", "a")).alias("least")).collect()}

    def judge(batches):
        for batch in batches:
            hit, at = hot.rows(batch)
            ends = batch.column("b").take(pa.array(hit)).to_pylist()
            spans = {}
            for k, place, b in zip(at.tolist(), _places(batch, hit), ends):
                if place != firsts[k]:
                    spans.setdefault(place[:3], []).append((place[3], b))
            out = [(None if null else i, th, a, b) for (null, i, th), own in spans.items()
                   for a, b in merged(own)]
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["doc_id", "th", "a", "b"])

    return rows.mapInArrow(judge, "doc_id long, th long, a int, b int")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same sentences as few spans."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def removed_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, th, a, b) covering every run that is not the first of its hash."""
    hot = (rows.where(F.pmod(F.xxhash64("doc_id", "th"), F.lit(SAMPLE_ONE_IN)) == 0)
           .groupBy("h1", "h2").agg(F.count("*").alias("c")).where(F.col("c") >= HOT_ROWS)
           .orderBy(F.desc("c"), "h1", "h2").limit(MAX_HOT).groupBy("h1").agg(F.min("h2").alias("h2")))
    hot = stored(hot, "hot_runs")
    keys = [(r.h1, r.h2) for r in hot.collect()]             # at most MAX_HOT
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "th", "a")
    seen = (Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "th", "a")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rest = (rows.join(F.broadcast(hot), ["h1", "h2"], "left_anti").withColumn("least", F.first(place).over(seen))
            .where(place != F.col("least")).select("doc_id", "th", "a", "b"))
    return rest.union(removed_in_place(rows, keys)) if keys else rest


def cut_sentences(text: str, spans) -> tuple[str, int, list[int]]:
    """The text without the sentences of the spans, their number and which."""
    starts = [*sentence_starts(text), len(text)]
    gone = np.zeros(len(starts), dtype=np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    kept = "".join(text[starts[i]:starts[i + 1]] for i in np.flatnonzero(~gone))
    return kept, int(gone.sum()), np.flatnonzero(gone).tolist()


def dedup_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the kept sentences in ``text``, plus ``_n_sentences`` (before),
    ``_n_removed`` and ``_removed`` (numbers of the removed sentences), by other
    names where the caller has such columns (``common.unused``)."""
    rows = stored(run_rows(docs.select("doc_id", "text"), min_words), "runs")
    spans = (removed_spans(rows).groupBy("doc_id", "th")
             .agg(F.collect_set(F.struct("a", "b")).alias("spans"))
             .select(F.col("doc_id").alias("id"), "th", "spans").hint("shuffle_hash"))
    d = packed(docs).withColumn("hash", text_hash(F.col("text")))
    met = (d.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th")), "left")
           .select("doc_id", "text", "rest", "spans"))

    def run(batches):
        for batch in batches:
            text, n, k, which = [], [], [], []
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                n.append(len(sentence_starts(t)) if t else 0)
                kept, count, gone = cut_sentences(t, [(s["a"], s["b"]) for s in spans]) if spans else (t, 0, [])
                text.append(kept), k.append(count), which.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(text, pa.string()), batch.column("rest"), pa.array(n, pa.int64()),
                 pa.array(k, pa.int64()), pa.array(which, pa.list_(pa.int32()))],
                names=["doc_id", "text", "rest", "n_sentences", "n_removed", "removed"])

    rest = met.schema["rest"].dataType.simpleString()
    done = met.mapInArrow(run, f"doc_id long, text string, rest {rest}, n_sentences long, n_removed long,"
                               " removed array<int>")
    return unpacked(done, docs.columns, **{unused(f"_{c}", docs.columns): F.col(c)
                                           for c in ("n_sentences", "n_removed", "removed")})


def op8(spark, sf_dir: str) -> DataFrame:
    """Every document without sentences of repeated spans."""
    out = dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_sentences").alias("n_sentences"), F.col("_n_removed").alias("n_removed"),
                      F.col("_removed").alias("removed"), "text")
