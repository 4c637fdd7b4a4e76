"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights and the most repeats allowed, and the rate of a
source is target / words. Each document is emitted floor(rate) times and once more with probability equal to
the fraction, by a hash of the seed and its id: a decision that needs no other row, so that a source with a
third of all rows costs what its rows cost.

Defined results: a null text has no words; a null source is a source of its own, the last; documents without
words are emitted like the rest of their source but take no words; sources without words have target 0 and
rate 0; repeated ids decide alike; an empty table gives no rows; columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import array_literal, fresh, save, seeded_unit, shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of the table of sources up to which it is broadcast.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(by: DataFrame) -> DataFrame:
    """by with number, from 0, of its sources by code point, null last: ranks in ranges and the rows of the ranges
    before, so that no task numbers them all."""
    spark = by.sparkSession
    ranges = by.repartitionByRange(shuffle_partitions(spark), F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    ranges = save(ranges, "source-ranges")  # the ranges are sampled: written, so that they stay the same
    counts = {r["range"]: r["count"] for r in ranges.groupBy("range").count().collect()}  # a row for each range
    before, n = [], 0
    for i in range(max(counts, default=-1) + 1):
        before.append(n)
        n += counts.get(i, 0)
    rank = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    return ranges.withColumn("number", rank + F.element_at(array_literal(before or [0], "bigint"), F.col("range") + 1)).drop("range")


def source_targets(sized: DataFrame, source_col: str, size_col: str, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: source, source_size, target.

    Targets fill like water: all sources stand at one level per unit of weight, except those whose level is
    capped at most * words. The level starts as if none were capped; those above their cap at it are, what they
    leave raises the level for the rest, and so on until no more are above. Sources are ordered by code point, null
    last, for their weights. Sums are of whole numbers, exact in any order up to 2 ** 53."""
    by = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    by = save(_numbered(by).withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(most))}).drop("number"), "source-weights")
    total, capped, level = None, -1, 0.0
    while True:
        over = F.col("cap") < F.lit(level) * F.col("weight")
        now = by.agg(F.sum("source_size").cast("double").alias("total"), F.count_if(over).alias("n"), F.sum(F.when(over, F.col("cap"))).alias("used"), F.sum(F.when(~over, F.col("weight"))).alias("left")).first()
        if total is None:
            total = now["total"] or 0.0
        if now["n"] == capped or not now["left"]:
            break
        capped, level = now["n"], (total - (now["used"] or 0.0)) / now["left"]
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap"), F.lit(level) * F.col("weight")))
    return by.withColumn("target", target).select("source", "source_size", "target")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """df with size, source_size, target, rate and copies (how often the mix has the document)."""
    key, = fresh(df, "mt_source")
    size, = fresh(df, "mt_size")
    narrow = save(df.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")).groupBy("source").agg(F.sum("size").alias("size")), "source-words")
    targets = source_targets(narrow, "source", "size", weights, most)
    # A source with a third of all rows is split by the join where its side is not broadcast: nothing above needs its
    # rows together.
    small = targets.count() <= BROADCAST_SOURCES
    # A null source joins by a key that no source has.
    as_key = lambda c: F.concat(F.when(c.isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce(c, F.lit("")))
    right = targets.select(as_key(F.col("source")).alias(key), F.struct("source_size", "target").alias(size))
    left = df.drop("size", "source_size", "target", "rate", "copies").withColumn(key, as_key(F.col(source_col)))
    joined = left.join(F.broadcast(right) if small else right, key)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = joined.withColumns({"source_size": F.col(size)["source_size"], "target": F.col(size)["target"]}).drop(key, size)
    out = out.withColumns({"size": word_count(F.col(text_col)), "rate": rate})
    one_more = seeded_unit(F.lit(seed), F.col(id_col)) < F.col("rate") - F.floor("rate")
    return out.withColumn("copies", (F.floor("rate") + F.when(one_more, 1).otherwise(0)).cast("int"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as copies says, numbered from 0 in copy."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
