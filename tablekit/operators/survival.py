"""Time-to-event tables and their check: product-limit (Kaplan-Meier) estimate
and concordance index, from grouped counts.

Rows are counted by time before anything is ordered, so the ordered steps run
over distinct times (days: some thousands), however many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def kaplan_meier(df: DataFrame, time: str, event: str, by: Sequence[str] = ()) -> DataFrame:
    """Survival after each time at which an event or a censoring happened, for
    each group: rows at risk just before it, events, censored, the estimate, and
    Greenwood's standard error. Rows without a time take no part; a NULL event
    counts as censored."""
    hit = F.coalesce(F.col(event).cast("boolean"), F.lit(False))
    per = (df.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("time"))
           .agg(F.count_if(hit).alias("n_events"), F.count_if(~hit).alias("n_censored")))
    group = Window.partitionBy(*by).orderBy("time")
    onward = group.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_risk = per.withColumn("n_risk", F.sum(F.col("n_events") + F.col("n_censored")).over(onward))
    left = F.col("n_risk") - F.col("n_events")
    over = F.max((left == 0).cast("int")).over(so_far) == 1                       # nobody is left
    logs = F.sum(F.when(left > 0, F.ln(left / F.col("n_risk")))).over(so_far)
    spread = F.sum(F.when(left > 0, F.col("n_events") / (F.col("n_risk") * left))).over(so_far)
    survival = F.when(over, F.lit(0.0)).otherwise(F.exp(logs))
    return at_risk.select(*by, "time", "n_risk", "n_events", "n_censored", survival.alias("survival"),
                          F.when(over, F.lit(0.0)).otherwise(F.exp(logs) * F.sqrt(spread)).alias("std_err"))


def concordance(df: DataFrame, time: str, event: str, score: str) -> DataFrame:
    """Harrell's index of a whole-number ``score`` (higher: earlier event), one row:
    comparable, concordant and tied pairs and their index.

    A pair is comparable if the earlier time is an event. Pairs are not formed:
    two scores differ first at one bit, so for each bit, among the scores equal
    above it, every event with the bit set counts the later rows without it. Each
    (time, score) gives one row a bit; what is ordered are distinct times within
    a bit's prefix, after partial aggregation. Rows with a NULL take no part."""
    hit = F.coalesce(F.col(event).cast("boolean"), F.lit(False))
    cells = (df.where(F.col(time).isNotNull() & F.col(score).isNotNull())
             .groupBy(F.col(time).alias("time"), F.col(score).cast("long").alias("score"))
             .agg(F.count_if(hit).alias("events"), F.count(F.lit(1)).alias("rows")))
    low, high = cells.agg(F.min("score"), F.max("score")).first()
    bits = 0 if low is None else (high - low).bit_length()
    cells = cells.withColumn("score", F.col("score") - F.lit(low or 0))

    def pairs(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        """(events at a time) x (others at later times), within ``keys``."""
        later = Window.partitionBy(*keys).orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, -1)
        per = rows.groupBy(*keys, "time").agg(F.sum("events").alias("events"), F.sum("others").alias("others"))
        found = F.col("events").cast("decimal(20,0)") * F.coalesce(F.sum("others").over(later), F.lit(0))
        return per.select(found.alias("pairs")).agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("decimal(38,0)").alias(name))

    everything = cells.withColumn("others", F.col("rows"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(bits - 1))) if bits else F.explode(F.array().cast("array<int>"))
    by_bit = cells.select("*", levels.alias("bit"))
    is_set = F.expr("(shiftright(score, bit) & 1L) = 1")
    split = by_bit.select("bit", "time", F.expr("shiftright(score, bit + 1)").alias("prefix"),
                          F.when(is_set, F.col("events")).otherwise(0).alias("events"),
                          F.when(is_set, 0).otherwise(F.col("rows")).alias("others"))
    counts = (pairs(everything, [], "comparable").withColumn("k", F.lit(1))
              .join(F.broadcast(pairs(split, ["bit", "prefix"], "concordant").withColumn("k", F.lit(1))), "k")
              .join(F.broadcast(pairs(everything, ["score"], "tied").withColumn("k", F.lit(1))), "k").drop("k"))
    index = (F.col("concordant").cast("double") + F.col("tied").cast("double") / 2) / F.col("comparable").cast("double")
    return counts.withColumn("c_index", F.when(F.col("comparable") > 0, index))
