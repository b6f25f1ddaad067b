"""Ranks and percentiles over groups of any size: values are counted, and ranges of values summed up, before anything is ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.chunks import same_join


def value_range(value: Column, digits: int = 4) -> Column:
    """A whole number that grows with value: its sign, its order of magnitude and its first digits; null for null.

    Equal values share one, whatever task asks. There are at most about 20,000 * orders of magnitude of them, and a
    range of amounts of m digits has at most 10^(m - digits) distinct values."""
    size = F.abs(value).cast("double")
    power = F.floor(F.log10(size)).cast("long")
    # The logarithm may be off by one at powers of ten; the first digits are then clipped into their place.
    lead = F.least(F.greatest(F.floor(size / F.pow(F.lit(10.0), power - (digits - 1))).cast("long"), F.lit(10 ** (digits - 1))), F.lit(10**digits - 1))
    place = F.when(size == 0, F.lit(0)).otherwise((power + 400) * 10**digits + lead)
    return F.when(value < 0, -place).otherwise(place)


def places(df: DataFrame, groups: list[str], value: str, digits: int = 4) -> DataFrame:
    """groups, value, _n, _below, _total: how often each value of a group occurs, how many rows have a smaller one (null
    being the smallest), and how many rows the group has.

    Values are counted by partial aggregates, so a hot value is one row; ranges of values are summed up by group, and
    only the distinct values of one range are ever ordered by one task."""
    counted = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")).withColumn("_range", value_range(F.col(value), digits))
    ranges = counted.groupBy(*groups, "_range").agg(F.sum("_n").alias("_in"))
    whole, earlier = Window.partitionBy(*groups), Window.partitionBy(*groups).orderBy(F.col("_range").asc_nulls_first())
    ranges = ranges.select(*groups, "_range", F.coalesce(F.sum("_in").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_in").over(whole).alias("_total"))
    inside = Window.partitionBy(*groups, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    own = counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = same_join(own, ranges, [*groups, "_range"], "inner")
    return joined.select(*groups, value, "_n", (F.col("_before") + F.col("_inside")).alias("_below"), "_total")


def row_numbers(df: DataFrame, groups: list[str], at: str, ties: list[str], name: str, bits: int = 15) -> DataFrame:
    """df with name: 1, 2, 3... along each group in order of at (a column of whole numbers), then of ties, nulls last.

    Equal to row_number() over a window of the group, without one: rows are counted by stretches of 2^bits numbers, the
    counts are summed up along the group, and one task orders the rows of one stretch. df is read twice, once for the
    columns groups and at alone."""
    cut = df.withColumn("_stretch", F.shiftright(at, bits))
    by = [*groups, "_stretch"]
    earlier = Window.partitionBy(*groups).orderBy(F.col("_stretch").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(*by, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_last() for c in (at, *ties)]))
    own = cut.withColumn("_inside", inside)
    return same_join(own, starts, by, "inner").withColumn(name, F.col("_before") + F.col("_inside")).drop("_stretch", "_inside", "_before")


def percent_rank(df: DataFrame, groups: list[str], value: str, name: str, digits: int = 4) -> DataFrame:
    """df with name: the share of the group's other rows that have a smaller value; 0 for a group of one row.

    Equal to percent_rank() over a window of the group, without one: the ranks of distinct values are joined back, and
    Spark splits the join where a value is hot. df is read twice, so it should be a table, or held."""
    ranked = places(df, groups, value, digits)
    share = F.when(F.col("_total") > 1, F.col("_below") / (F.col("_total") - 1)).otherwise(F.lit(0.0)).cast("double")
    return same_join(df, ranked.select(*groups, value, share.alias(name)), [*groups, value], "left")


def exact_percentiles(df: DataFrame, groups: list[str], value: str, shares: dict[str, float], digits: int = 4) -> DataFrame:
    """groups, n, and for each name the percentile of the group's values, interpolated between neighbours; nulls don't count.

    The two rows that a percentile lies between are found by how many rows have smaller values, so no task holds more
    than the distinct values of one range."""
    found = places(df.where(F.col(value).isNotNull()), groups, value, digits)
    out = [F.max("_total").alias("n")]
    for name, share in shares.items():
        at = F.lit(float(share)) * (F.col("_total") - 1)
        holds = lambda place: (F.col("_below") <= place) & (place < F.col("_below") + F.col("_n"))
        low, high = (F.max(F.when(holds(f(at)), F.col(value))) for f in (F.floor, F.ceil))
        part = F.max(at - F.floor(at))
        out.append((low + (high - low) * part).alias(name))
    return found.groupBy(*groups).agg(*out)
