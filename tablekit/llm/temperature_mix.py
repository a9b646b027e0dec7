"""Mixing sources to target weights (operator 5), DataFrame functions only.

Temperature mixing: a source's weight is its share of all tokens raised to an
exponent and normalised (1 leaves the shares, 0 makes all sources equal). The
exponent is found by repeated section of [0, 1] until it meets a target
entropy, or the least flattening that keeps every source's repetition within a
limit. Each round evaluates SECTIONS exponents in one aggregate over the
sources, so sources are never collected.

The weights are realised over a token budget as block permutations: a source's
quota is weight x budget, met by whole passes (epochs) over its documents and a
part of one more. Per epoch the documents of a source are dealt by hash to
blocks of about ``block_tokens`` tokens, blocks are put in hash order, and
documents in hash order within their block. Running sums are taken over block
totals and inside single blocks, so a source with a third of all rows is spread
over its blocks and nothing sorts a whole source. A document is taken if it
starts before its source's quota ends: a source overshoots by less than one
document.

Defined cases: null is a source of its own; a source without tokens has weight
0 and none of its documents is taken; null or empty texts hold no tokens and
are taken with the epoch they fall in; rows equal in id and text are one item
that counts with all its rows; an empty table gives an empty result; other
columns pass through :func:`mix_documents`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import packed, stored, table, unpacked

#: Exponents tried per round, and rounds: the exponent is exact to 65**-4.
SECTIONS, ROUNDS = 64, 4
BLOCK_TOKENS, BLOCK_DOCS = 1_000_000, 4096
#: Copies of a row that one array numbers.
AT_ONCE = 1_000_000


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_shares(items: DataFrame) -> DataFrame:
    """(source, sid, tokens, docs, share); sid numbers the sources."""
    sums = stored(items.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("docs")),
                  "source_sums")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    return stored(sums.withColumn("sid", F.monotonically_increasing_id())
                  .withColumn("share", F.col("tokens") / F.lit(float(max(total, 1)))), "sources")


def find_exponent(shares: DataFrame, entropy: float | None = None, max_repetition: float | None = None,
                  budget_ratio: float | None = None) -> float:
    """The largest exponent in [0, 1] whose weights have at least ``entropy``
    (a fraction of the largest possible), or the least one that repeats no
    source more than ``max_repetition`` times. ``budget_ratio`` is the budget in
    corpus sizes; None means the least budget that uses every source in full."""
    live = shares.where("tokens > 0")
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / (SECTIONS + 1) for i in range(SECTIONS + 2)]
        q = [F.pow(F.col("share"), F.lit(a)) for a in tried]
        rep = [F.pow(F.col("share"), F.lit(a - 1.0)) for a in tried]
        sums = live.agg(F.count("*").alias("n"),
                        *[F.sum(x).alias(f"z{i}") for i, x in enumerate(q)],
                        *[F.sum(x * F.log(x)).alias(f"s{i}") for i, x in enumerate(q)],
                        *[F.max(x).alias(f"most{i}") for i, x in enumerate(rep)],
                        *[F.min(x).alias(f"least{i}") for i, x in enumerate(rep)]).first()
        if not sums.n:
            return 1.0

        def meets(i, sums=sums):
            if entropy is not None:
                return math.log(sums[f"z{i}"]) - sums[f"s{i}"] / sums[f"z{i}"] >= entropy * math.log(sums.n) - 1e-12
            top = sums[f"most{i}"] / (sums[f"least{i}"] if budget_ratio is None else sums[f"z{i}"] / budget_ratio)
            return top <= max_repetition + 1e-12

        ok = [meets(i) for i in range(len(tried))]
        if entropy is not None:                      # holds up to some exponent
            last = max((i for i, x in enumerate(ok) if x), default=0)
            if last == len(tried) - 1:
                return high
            low, high = tried[last], tried[last + 1]
        else:                                        # holds from some exponent on
            first = min((i for i, x in enumerate(ok) if x), default=len(tried) - 1)
            if first == 0:
                return low
            low, high = tried[first - 1], tried[first]
    return low if entropy is not None else high


def quotas(shares: DataFrame, exponent: float, budget_ratio: float | None = None) -> DataFrame:
    """(source, sid, tokens, docs, weight, quota, epochs)."""
    raw = shares.withColumn("raw", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0))
    sums = raw.agg(F.sum("raw").alias("z"), F.sum("tokens").alias("total"),
                   F.min(F.when(F.col("tokens") > 0, F.col("raw") / F.col("share"))).alias("least")).first()
    z = sums.z or 1.0
    budget = (sums.total or 0) * ((z / sums.least if sums.least else 0.0) if budget_ratio is None else budget_ratio)
    return (raw.withColumn("weight", F.col("raw") / F.lit(z))
            # rounded up to whole tokens, after taking off what floating point adds
            .withColumn("quota", F.ceil(F.col("weight") * F.lit(float(budget)) - F.lit(1e-6)).cast("long"))
            .withColumn("epochs", F.when(F.col("tokens") > 0, F.ceil(F.col("quota") / F.col("tokens"))).otherwise(0))
            .drop("raw", "share"))


def numbered(rows: DataFrame, count: str, name: str) -> DataFrame:
    """Each row ``count`` times (a long), numbered from 0 in ``name``: in steps of
    AT_ONCE, so that no array grows with the count."""
    outer = F.explode(F.expr(f"sequence(0L, ({count} - 1) div {AT_ONCE})"))
    inner = F.explode(F.expr(f"sequence(_outer * {AT_ONCE}, least({count}, (_outer + 1) * {AT_ONCE}) - 1)"))
    return rows.where(f"{count} > 0").withColumn("_outer", outer).withColumn(name, inner).drop("_outer")


def placed(items: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per taken copy of an item: its columns, epoch, block (its place in
    the epoch's permutation) and start (first token within the epoch)."""
    plan = plan.select("source", "sid", F.col("tokens").alias("all_tokens"), "docs", "quota", "epochs")
    s = plan.withColumnRenamed("source", "its")
    dealt = (numbered(items.join(s, items["source"].eqNullSafe(s["its"])), "epochs", "epoch")
             .withColumn("blocks", F.expr(f"greatest(all_tokens div {BLOCK_TOKENS}, docs div {BLOCK_DOCS}) + 1"))
             .withColumn("deal", F.pmod(F.xxhash64(F.lit(1), "epoch", "k1", "k2"), F.col("blocks")))
             .drop("its", "blocks", "docs", "epochs"))
    sums = dealt.groupBy("sid", "epoch", "deal").agg(F.sum("tokens").alias("held"))
    order = Window.partitionBy("sid", "epoch").orderBy(F.xxhash64(F.lit(2), "sid", "epoch", "deal"), "deal")
    blocks = (sums.withColumn("block", F.row_number().over(order) - 1)
              .withColumn("before", F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)))
              .select("sid", "epoch", "deal", "block", F.coalesce("before", F.lit(0)).alias("before")))
    inside = (Window.partitionBy("sid", "epoch", "deal")
              .orderBy(F.xxhash64(F.lit(3), "epoch", "k1", "k2"), "k1", "k2")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.withColumn("ahead", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
            .join(blocks, ["sid", "epoch", "deal"])
            .withColumn("start", F.col("before") + F.col("ahead"))
            .where("start < quota - epoch * all_tokens")
            .drop("sid", "deal", "ahead", "before", "all_tokens", "quota"))


def as_items(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, source, tokens, rows): rows equal in id and text are one item."""
    return (docs.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"),
                        "doc_id", "source", token_count(F.col("text")).alias("tokens"))
            .groupBy("k1", "k2", "doc_id", "source")
            .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")))


def mix_plan(docs: DataFrame, entropy=None, max_repetition=None, budget_ratio=None) -> DataFrame:
    items = stored(as_items(docs), "mix_items")
    shares = source_shares(items)
    exponent = find_exponent(shares, entropy, max_repetition, budget_ratio)
    return placed(items, quotas(shares, exponent, budget_ratio))


def mix_documents(docs: DataFrame, entropy=None, max_repetition=2.0, budget_ratio=None) -> DataFrame:
    """``docs`` with each row as often as its source's weight asks for."""
    copies = (mix_plan(docs, entropy, max_repetition, budget_ratio)
              .groupBy("k1", "k2", "source").agg(F.count("*").alias("copies"))
              .withColumnRenamed("source", "its").hint("shuffle_hash"))
    d = (packed(docs).withColumn("from", F.col("rest.source"))
         .withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64(F.lit(1), "doc_id", "text")))
    done = d.join(copies, ["k1", "k2"]).where(F.col("from").eqNullSafe(F.col("its")))
    return unpacked(numbered(done, "copies", "copy"), docs.columns)


def op5(spark, sf_dir: str) -> DataFrame:
    """Mix at 0.95 of the largest entropy over a budget of one corpus size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mix_plan(docs, entropy=0.95, budget_ratio=1.0)
            .select("doc_id", "source", "epoch", F.col("block").cast("long").alias("block"), "start",
                    F.col("tokens").alias("n_tokens")))
