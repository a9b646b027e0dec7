"""Line dedup (operator 9), DataFrame functions only.

A line's key is the line stripped of ASCII white space and with A-Z lowered.
Keys of at least ``min_chars`` code points that occur in at least ``min_docs``
documents lose all their lines, except in the largest doc_id that holds them.

Lines become 128-bit key hashes with their document and position. The hashes
are range-partitioned and, within a partition, sorted by document (largest
first), so one streaming window pass sees the keeper of each key first and
drops what follows. The decisions come back as one compressed bitmap per
document (only the 64-line words with a dropped line), never as text; applying
them is one join on the document.

Skew: keys that are frequent in a 1/64 hash sample of the documents (at most
``MAX_HOT``, so the list can be broadcast) never enter the range shuffle. Their
keeper and document count are exact, from a partially aggregated group-by over
all rows, and decide the lines in place. The sample only steers the layout.

Defined cases: null or empty text is one empty line and stays; a null doc_id
takes no part (its lines stay and are not counted); rows that share a doc_id
are one document, none of them loses a line to the other; an empty table gives
an empty result; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import (
    UPPER,
    WS,
    ascii_lower,
    packed,
    stored,
    table,
    text_hash,
    unpacked,
    unused,
)

#: Layout only: one document in so many is looked at for frequent keys, a key
#: counts as frequent from so many sampled lines, and the list has at most so
#: many keys (any key with over 1/MAX_HOT of the sampled lines is in it).
SAMPLE_ONE_IN, HOT_LINES, MAX_HOT = 64, 8, 1024


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, h1, h2) of every line whose key is long enough."""
    key = ascii_lower(F.btrim("line", F.lit(WS)))
    return (docs.where("doc_id is not null")
            .select("doc_id", text_hash(F.col("text")).alias("th"),
                    F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
            .withColumn("key", key)
            .where(F.char_length("key") >= min_chars)
            .select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(1), "key").alias("h2")))


def _hot(lines: DataFrame) -> DataFrame:
    sample = lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_ONE_IN)) == 0)
    return (sample.groupBy("h1", "h2").agg(F.count("*").alias("c"))
            .where(F.col("c") >= HOT_LINES)
            .orderBy(F.desc("c"), "h1", "h2").limit(MAX_HOT).select("h1", "h2"))


def _at_least(n: int, stream):
    """Whether the key has n documents, seen from a row after the first: by its
    rank, or by looking the missing rows ahead. Spark's window holds a key's rows
    while it passes over them (and spills them); frequent keys do not come here."""
    enough = F.col("rank") >= n
    for ahead in range(1, n - 1):
        enough = enough | ((F.col("rank") == n - ahead) & F.lead("doc_id", ahead).over(stream).isNotNull())
    return enough


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, th, n_dropped, dropped) for the documents that lose lines;
    ``dropped`` maps a 64-line word to its bits, absent words keep all."""
    lines = stored(line_rows(docs, min_chars), "lines")
    hot = stored(_hot(lines), "hot_lines")

    per_doc = (lines.join(F.broadcast(hot), ["h1", "h2"])
               .groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("c")))
    keeper = (per_doc.groupBy("h1", "h2")
              .agg(F.max("doc_id").alias("keeper"), F.count("*").alias("n_docs"))
              .where(F.col("n_docs") >= min_docs))
    dropped_hot = (lines.join(F.broadcast(keeper), ["h1", "h2"])
                   .where("doc_id < keeper").select("doc_id", "th", "pos"))

    rest = lines.join(F.broadcast(hot), ["h1", "h2"], "left_anti")
    stream = Window.partitionBy("h1", "h2").orderBy(F.desc("doc_id"))
    first = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dropped_rest = (
        rest.repartitionByRange("h1", "h2")
        .groupBy("h1", "h2", "doc_id").agg(F.collect_set(F.struct("th", "pos")).alias("places"))
        .withColumn("rank", F.row_number().over(stream))
        .withColumn("keeper", F.first("doc_id").over(first))
        .withColumn("enough", _at_least(min_docs, stream))
        .where("doc_id < keeper and enough")
        .select("doc_id", F.explode("places").alias("place")).select("doc_id", "place.th", "place.pos"))

    bits = (dropped_hot.union(dropped_rest).repartition("doc_id", "th")
            .groupBy("doc_id", "th", F.expr("pos div 64").cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("bits")))
    return (bits.groupBy("doc_id", "th")
            .agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
                 F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped")))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` (all columns, all rows) with the kept text in ``text``, plus
    ``_n_lines`` (before) and ``_n_dropped`` (by other names where the caller has
    such columns, see ``common.unused``)."""
    bitmaps = (keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
               .withColumnRenamed("doc_id", "id").hint("shuffle_hash"))
    d = packed(docs).withColumn("hash", text_hash(F.col("text")))
    # one dense array of words per text, so that each line's bit is one lookup
    dense = F.expr("transform(sequence(0, (n_lines - 1) div 64),"
                   " w -> coalesce(dropped[cast(w as int)], 0L))")
    kept = F.expr("filter(lines, (line, i) ->"
                  " (shiftright(words[i div 64], cast(i % 64 as int)) & 1L) = 0)")
    done = (d.join(bitmaps, (F.col("doc_id") == F.col("id")) & (F.col("hash") == F.col("th")), "left")
            .withColumn("lines", _lines(F.col("text")))
            .withColumn("n_lines", F.size("lines").cast("long"))
            .withColumn("words", F.when(F.col("dropped").isNotNull(), dense))
            .withColumn("text", F.when(F.col("dropped").isNull(), F.col("text"))
                        .otherwise(F.array_join(kept, "\n"))))
    return unpacked(done, docs.columns, **{
        unused("_n_lines", docs.columns): F.col("n_lines"),
        unused("_n_dropped", docs.columns): F.coalesce("n_dropped", F.lit(0).cast("long"))})


def op9(spark, sf_dir: str) -> DataFrame:
    """Line dedup of every document: lines before, lines dropped, digest of the rest."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      '{UPPER}', '{UPPER.lower()}') AS key FROM lines
), keepers AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.line, k.pos, (p.keeper IS NOT NULL AND k.doc_id < p.keeper) AS gone
  FROM keyed k LEFT JOIN keepers p ON k.key = p.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
