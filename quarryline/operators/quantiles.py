"""Exact quantiles by narrowing: no task sorts or holds a group's values, whatever its size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.session import small_side, stored

BINS = 1024


def exact_quantiles(df: DataFrame, groups: list[str], value: str, shares: list[float]) -> DataFrame:
    """groups and (share, quantile): for each group and share the exact quantile, linear between neighbours. Nulls and NaN take no part.

    Each rank that is asked for has a range of values; a pass counts its values in BINS equal bins and goes on with the bin that
    holds the rank, between the smallest and the largest value in it. Sums of bins are all that is shuffled. Passes end when
    each range is one value; the ends of a range fall in different bins, so every pass narrows it.
    """
    own = df.select(*groups, F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    sizes = own.groupBy(*groups).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    asked = F.explode(F.array(*(F.lit(float(s)) for s in shares)))
    sizes = sizes.where("n > 0").withColumn("share", asked).withColumn("at", F.col("share") * (F.col("n") - 1))
    ends = F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))
    columns = [*groups, "share", "at", "rank"]
    ranges = stored(sizes.withColumn("rank", ends).select(*columns, "low", "high", F.lit(0).cast("long").alias("below")), "ranges")
    by = Window.partitionBy(*columns).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    while ranges.where("low < high").limit(1).count():
        side = small_side(ranges.where("low < high"))
        same = reduce(lambda a, b: a & b, (own[g].eqNullSafe(side[g]) for g in groups), F.lit(True))
        inside = own.join(side, same & (own["_v"] >= side["low"]) & (own["_v"] <= side["high"]))
        # differences are halved so that they stay finite
        place = F.floor((F.col("_v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * BINS)
        bins = inside.select(*(side[c].alias(c) for c in columns), "below", F.least(place, F.lit(BINS - 1)).alias("bin"), "_v")
        bins = bins.groupBy(*columns, "below", "bin").agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        upto = bins.withColumn("upto", F.sum("n").over(by) + F.col("below"))
        found = upto.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        narrowed = found.select(*columns, "low", "high", (F.col("upto") - F.col("n")).alias("below"))
        ranges = stored(narrowed.unionByName(ranges.where("low = high")), "ranges")
    part = F.col("at") - F.floor("at")
    pair = ranges.groupBy(*groups, "share", "at").agg(F.min("low").alias("a"), F.max("low").alias("b"))
    return pair.select(*groups, "share", (F.col("a") + (F.col("b") - F.col("a")) * part).alias("quantile"))
