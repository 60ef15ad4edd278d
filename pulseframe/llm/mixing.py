"""Mixing sources to target weights, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.common import WORD, whole_text

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def unit_draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_copies: int = MOST_COPIES
) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row per source.

    Weights repeat over the sources by code point, null last. The targets share all
    sizes by weight; one that would exceed ``most_copies`` times its source's size stops
    there and its excess is shared anew. In the order of size per weight, the share of a
    unit of weight left after stopping all earlier sources rises as long as sources have
    to stop, and falls after that; so the largest is the share of those that don't stop,
    and running sums settle all sources at once. Both windows hold one row per source,
    not per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    named = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight.cast("long"))
    cap = F.col("source_size") * F.lit(most_copies)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = named.withColumn("share", left.cast("double") / weights_left.cast("double"))
    stopped = F.col("share") * F.col("weight") > cap
    free = F.max("share").over(every)
    return ranked.select(
        "source", "source_size",
        F.when(stopped, cap.cast("double")).otherwise(free * F.col("weight")).alias("target"),
    )


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken.

    A document appears floor(rate) times, and once more where its draw is below the
    fraction of the rate; rate is target over size of its source. The draw depends on
    seed and doc_id alone, so reruns agree and rows that repeat a doc_id share it. Null
    text has size 0, a null source is a source of its own, and documents of size 0
    are emitted like the others of their source (a source of size 0 has rate 0).
    """
    rows = docs.select(
        "doc_id", "source", F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size")
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, most_copies).withColumnRenamed("source", "name")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    extra = (unit_draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("rate", rate)
        .withColumn("copies", whole + extra)
        .select("doc_id", "size", "source_size", "target", "copies",
                (F.col("size") * F.col("copies")).alias("taken"))
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED
) -> DataFrame:
    """The mixture itself: every row of docs as often as the plan says, columns unchanged.

    The rates are joined to the documents by source, a table with one row per source;
    texts do not move.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    place = {name: columns[i] for i, name in reversed(list(enumerate(docs.columns)))}
    plain = docs.toDF(*columns)
    size = F.regexp_count(whole_text(place["text"]), F.lit(WORD)).cast("long")
    totals = plain.select(F.col(place["source"]).alias("source"), size.alias("n")).groupBy("source").agg(
        F.sum("n").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = source_targets(totals, weights, most_copies).select("source", rate.alias("rate"))
    whole = F.floor("rate")
    copies = whole + (unit_draw(F.col(place["doc_id"]), seed) < F.col("rate") - whole).cast("long")
    return (
        plain.join(rates, F.col(place["source"]).eqNullSafe(F.col("source")))
        .withColumn("copies", copies)
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*columns).toDF(*docs.columns)
    )
