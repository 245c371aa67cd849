"""Exact medians of groups of any size: the middle is found by counting ranges of values, not by holding the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lineage import forget, lookup, stored

#: Ranges that a round counts in each group, and the values up to which what is left of a group is sorted at once.
RANGES, SORTED = 1024, 1000


def _range(value: Column) -> Column:
    """The value's range between ``lo`` and ``hi``; never falls as values rise.  Halves, so the width can't overflow."""
    share = (value / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    return F.least(F.floor(share * RANGES), F.lit(RANGES - 1)).cast("int")


def exact_median(rows: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """(keys, n, ``out``): the number of values and the median of each group, the mean of both middle ones of an even number.

    Each round counts the values of a group in RANGES ranges between the least and the greatest that are left, goes on with
    the range that holds the middle and takes its least and greatest value, until few values or one value are left.  Counts
    are summed before the shuffle, so a group with all rows costs what others do, and no buffer holds a group's values.
    Null and NaN values are left out; a group without others has n 0 and a null median; null keys are groups of their own.
    Infinite values sort as the greatest finite ones.
    """
    most = 1.7976931348623157e308
    names = [f"k{i}" for i in range(len(keys))]
    given = rows.select(F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).alias("g"), F.col(value).cast("double").alias("v"))
    sound = given.withColumn("v", F.when(F.col("v").isNotNull() & ~F.isnan("v"), F.greatest(F.lit(-most), F.least(F.lit(most), F.col("v")))))
    sizes = stored(sound.groupBy("g").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "median-sizes")
    values = sound.where("v IS NOT NULL")
    # A middle is (group, which), with the place among the values that are left.
    both = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.floor((F.col("n") - 1) / 2).alias("place")), F.struct(F.lit(1).alias("which"), F.floor(F.col("n") / 2).alias("place"))))
    open_ = sizes.where("n > 0").select("g", "n", "lo", "hi", both.alias("m")).select(F.struct("g", F.col("m.which").alias("which")).alias("m"), F.col("m.place").alias("place"), F.col("n").alias("left"), "lo", "hi")
    found, tables = [], []
    while True:
        open_ = stored(open_, "median-open")
        tables.append(open_)
        found.append(open_.where("lo = hi").select("m", F.col("lo").alias("v")))
        more = open_.where(F.col("lo") < F.col("hi"))
        if more.isEmpty():
            break
        # Two middles of a group in one range are looked for once.
        wanted = more.groupBy(F.col("m.g").alias("g"), "lo", "hi", "left").agg(F.collect_list(F.struct("m", "place")).alias("middles"))
        ranges = wanted.groupBy("g").agg(F.collect_list(F.struct("lo", "hi", "left", "middles")).alias("wanted"))
        held = lookup(values, ranges, "g").select("g", "v", F.explode("wanted").alias("w")).where((F.col("v") >= F.col("w.lo")) & (F.col("v") <= F.col("w.hi")))
        held = held.select("g", "v", "w.*")
        few = held.where(F.col("left") <= SORTED).groupBy("g", "lo", "hi").agg(F.first("middles").alias("middles"), F.sort_array(F.collect_list("v")).alias("sorted"))
        few = few.select("sorted", F.explode("middles").alias("x")).select("x.m", F.get("sorted", F.col("x.place").cast("int")).alias("v"))
        found.append(stored(few, "median-few"))
        tables.append(found[-1])
        counts = held.where(F.col("left") > SORTED).groupBy("g", "lo", "hi", _range(F.col("v")).alias("r")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("greatest"), F.first("middles").alias("middles"))
        before = F.sum("c").over(W.partitionBy("g", "lo", "hi").orderBy("r")) - F.col("c")  # RANGES rows at most
        each = counts.withColumn("before", before).select("before", "c", "least", "greatest", F.explode("middles").alias("x"))
        each = each.where((F.col("x.place") >= F.col("before")) & (F.col("x.place") < F.col("before") + F.col("c")))
        open_ = each.select("x.m", (F.col("x.place") - F.col("before")).alias("place"), F.col("c").alias("left"), F.col("least").alias("lo"), F.col("greatest").alias("hi"))
    middles = found[0]
    for other in found[1:]:
        middles = middles.unionByName(other)
    middles = stored(middles.groupBy(F.col("m.g").alias("g")).agg((F.sum(F.col("v") / 2)).alias("half"), F.min("v").alias("a"), F.max("v").alias("b")), "medians")
    forget(*tables)
    # The mean of two middles as the sum's half, unless the sum overflows.
    median = F.when(F.abs(F.col("a") + F.col("b")) < float("inf"), (F.col("a") + F.col("b")) / 2).otherwise(F.col("half"))
    joined = sizes.select("g", "n").join(middles.select(F.col("g").alias("h"), median.alias(out)), F.col("g").eqNullSafe(F.col("h")), "left")
    return joined.select(*[F.col(f"g.{n}").alias(k) for k, n in zip(keys, names, strict=True)], "n", out)
