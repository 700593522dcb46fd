"""Mixing sources to target weights by systematic sampling.

Every source gets a share of the budget in proportion to its weight; a target
stops at ``max_repeat`` times the source's size and the excess is reshared by
weight. Within a source, documents are put in order of size, then of a hash of
their id. Each adds its expected copies (target / source size) to a running sum
that begins at one random offset, and is taken once for every whole number the
sum passes. Ordering by size keeps the words taken within about one document of
the target.

The running sum needs only a rank: rows are range-partitioned by (source, size,
hash, id), which splits a hot source over many tasks, and a table of one row per
(partition, source) supplies what came before. Expected copies are whole numbers
of 2^-24 copies, so no rounding error can pile up and reruns agree.

Defined results: null text has size 0; null source is a source of its own, last
in order; a source of size 0 has target 0 and takes nothing; an empty table
gives an empty result; repeated rows count as documents of their own; extra
columns are kept, clashing ones replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from incidentlake.llm._stored import stored

# The weights repeat over the sources in code point order.
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
UNIT = 1 << 24
BROADCAST_ROWS = 200_000
SEED = "mix-1"
_ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """Targets from one row per source (``source``, ``source_size``): the level
    at which weight times level, capped, adds up to the budget. Capped sources
    are those of lowest cap per weight, so two running sums find the level."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(number, F.lit(len(weights))) + 1).cast("int"))
    capped = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_repeat)
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    up_to = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(up_to), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to), F.lit(0))
    )
    # the first source whose cap the level does not reach sets the level for all after it
    fits = capped.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"), F.col("source").alias("s"), F.col("level").alias("level")))).over(everything)["level"]
    target = F.when(level.isNull() | (level * F.col("weight") > F.col("cap")), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return fits.select("source", "source_size", target.alias("target"))


def random_offset(source: Column, seed: str) -> Column:
    """A number of units below one whole copy, from the seed and the source."""
    hex6 = F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(source, F.lit("<null>")))), 1, 6)
    return F.conv(hex6, 16, 10).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, max_repeat: int = 2, seed: str = SEED,
        text: str = "text", source: str = "source", doc_id: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) with ``size``, ``source_size``, ``target``, ``copies`` (how often
    the mix takes the row) and ``taken`` (``copies`` times ``size``)."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in _ADDED and (keep_text or c != text)]
    sized = docs.select(
        *(F.col(f"`{c}`") for c in names), word_count(F.col(text)).alias("size"), F.col(source).alias("__source"),
        F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("<null>")))).alias("__hash"),
        F.col(doc_id).alias("__id"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("__source").asc_nulls_last(), F.col("size"), F.col("__hash"), F.col("__id")]
    ranged = sized.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    # monotonically_increasing_id is (partition << 33) + row number in the partition
    rows = stored(ranged.withColumn("__row", F.monotonically_increasing_id()), "mix")
    pieces = rows.groupBy("__source", F.shiftright("__row", 33).alias("__part")).agg(
        F.min("__row").alias("__first"), F.count("*").alias("n"), F.sum("size").alias("words")
    )
    pieces = stored(pieces, "mix-pieces")
    sizes = pieces.groupBy(F.col("__source").alias("source")).agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, budget, max_repeat)
    before = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("__first"))
    step = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    table = offsets.join(targets, F.col("__source").eqNullSafe(F.col("source"))).select(
        F.col("__source").alias("__s"), F.col("__part").alias("__p"), "__before", "source_size", "target", step.alias("__step"), random_offset(F.col("source"), seed).alias("__start")
    )
    if pieces.count() <= BROADCAST_ROWS:  # one narrow row per task and source; larger tables are joined by shuffle
        table = F.broadcast(table)
    joined = rows.join(table, F.col("__source").eqNullSafe(F.col("__s")) & (F.shiftright("__row", 33) == F.col("__p")))
    rank = F.col("__row") + F.col("__before")
    passed = lambda k: F.shiftright((rank + k) * F.col("__step") + F.col("__start"), 24)
    copies = passed(1) - passed(0)
    return joined.select(
        *(F.col(f"`{c}`") for c in names), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each row of ``mix``'s result once per copy, ``copies`` dropped rows gone."""
    return mixed.where(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
