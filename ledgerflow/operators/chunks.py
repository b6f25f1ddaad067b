"""Windows over keys that are too large for one task: their rows are cut in time, and what crosses a cut is carried over.

cut_hot() gives every row a chunk; keys of ordinary size have one. Windows then run inside (key, chunk). What a row needs of
earlier chunks is either carried as one value a chunk (a running sum, the last known state), or copied as halo rows (a
trailing window). Only keys above the limit are looked at more than once, so their number is at most rows / limit, and
so is that of all chunks; both are what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK, BOUNDS, HALO = "_chunk", "_bounds", "_halo"
#: Cells of time that a hot key's span is counted in to find balanced cuts.
CELLS = 10_000


def same_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """left joined with the other columns of right on keys, nulls being equal."""
    other = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(other, [left[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys], how).drop(*[f"_k_{k}" for k in keys])


def hot_bounds(df: DataFrame, keys: list[str], at: str, limit: int) -> DataFrame:
    """keys, _bounds: for keys of more than limit rows, the times at which their second, third, ... chunk begins.

    A chunk has about limit rows, and no more than a cell of the key's time span beyond that. Rows of one time are
    never parted, so peers stay together; rows without a time are in the first chunk."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_low"), F.max(at).alias("_high")).where(F.col("_n") > limit).drop("_n")
    hot = hot.withColumn("_width", F.floor((F.col("_high") - F.col("_low")) / CELLS) + 1)
    theirs = same_join(df.select(*keys, at), F.broadcast(hot), keys, "inner")
    cells = theirs.groupBy(*keys, (F.col("_low") + F.floor((F.col(at) - F.col("_low")) / F.col("_width")) * F.col("_width")).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*keys).orderBy(F.col("_cell").asc_nulls_first())
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = cells.withColumn("_part", F.floor(before / limit)).withColumn("_cut", F.col("_part") > F.lag("_part").over(order))
    return cut.groupBy(*keys).agg(F.array_sort(F.collect_set(F.when(F.col("_cut"), F.col("_cell")))).alias(BOUNDS))


def cut_hot(df: DataFrame, keys: list[str], at: str, limit: int | None) -> DataFrame:
    """df with _chunk (0 for keys of up to limit rows) and _bounds (null for those). at: a column of whole numbers.

    df is read three times, twice for the columns keys and at alone; without a limit it is read once, and nothing is cut."""
    if limit is None:
        return df.withColumns({BOUNDS: F.lit(None).cast("array<bigint>"), CHUNK: F.lit(0)})
    found = same_join(df, F.broadcast(hot_bounds(df, keys, at, limit)), keys, "left")
    return found.withColumn(CHUNK, F.coalesce(F.size(F.filter(BOUNDS, lambda b: b <= F.col(at))), F.lit(0)))


def running_last(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, before: bool = False, backwards: bool = False, hot: bool = True) -> DataFrame:
    """df (from cut_hot) with name: the last value that isn't null at or before each row, in any chunk of its key.

    before: the row's own value doesn't count. backwards: the next value at or after each row instead. hot: False if
    nothing was cut."""
    df = df.withColumn("_value", value)
    by = [F.col(c).desc() for c in order] if backwards else [F.col(c).asc() for c in order]
    frame = Window.partitionBy(*keys, CHUNK).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    near = F.last("_value", True).over(frame)
    if not hot:
        return df.withColumn(name, near).drop("_value")
    pick = F.min_by if backwards else F.max_by
    ends = df.where(F.col(BOUNDS).isNotNull() & F.col("_value").isNotNull()).groupBy(*keys, CHUNK).agg(pick("_value", F.struct(*order)).alias("v"))
    ends = ends.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(CHUNK).alias("chunk"), "v"))).alias("_ends"))
    found = same_join(df, F.broadcast(ends), keys, "left")
    other = F.filter("_ends", lambda e: e.chunk > F.col(CHUNK) if backwards else e.chunk < F.col(CHUNK))
    return found.withColumn(name, F.coalesce(near, F.try_element_at(other, F.lit(1 if backwards else -1))["v"])).drop("_value", "_ends")


def running_sum(df: DataFrame, keys: list[str], order: list[str], at: str, amount: str, name: str, limit: int | None = None) -> DataFrame:
    """df with name: the sum of amount over the key's rows up to each row, null where there is none yet. at: the first of order as a whole number."""
    cut = cut_hot(df, keys, at, limit)
    inside = F.sum(amount).over(Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    if limit is None:
        return cut.withColumn(name, inside).drop(CHUNK, BOUNDS)
    sums = cut.where(F.col(BOUNDS).isNotNull()).groupBy(*keys, CHUNK).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*keys, CHUNK, F.sum("_sum").over(earlier).alias("_carried"))
    total = F.when(inside.isNotNull() | F.col("_carried").isNotNull(), F.coalesce(inside, F.lit(0)) + F.coalesce("_carried", F.lit(0)))
    return same_join(cut, F.broadcast(carried), [*keys, CHUNK], "left").withColumn(name, total).drop(CHUNK, BOUNDS, "_carried")


def with_halo(cut: DataFrame, at: str, span: Column) -> DataFrame:
    """cut_hot()'s rows, and copies of them (_halo true) in each later chunk that begins less than span after them."""
    reach = F.size(F.filter(BOUNDS, lambda b: b < F.col(at) + span))  # -1 or less without bounds
    last = F.when(F.col(BOUNDS).isNotNull() & F.col(at).isNotNull(), F.greatest(reach, F.col(CHUNK))).otherwise(F.col(CHUNK))
    return cut.withColumn("_to", F.explode(F.sequence(CHUNK, last))).withColumns({HALO: F.col("_to") > F.col(CHUNK), CHUNK: F.col("_to")}).drop("_to")


def with_row_halo(cut: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """cut_hot()'s rows, and copies (_halo true) of the n rows before each chunk, from whichever chunks they are in."""
    own, hot = cut.withColumn(HALO, F.lit(False)), cut.where(F.col(BOUNDS).isNotNull())
    sizes = hot.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(CHUNK).alias("chunk"), "n"))).alias("_sizes"))
    nth = F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).desc() for c in order]))
    last = same_join(hot.withColumn("_nth", nth.cast("long")).where(F.col("_nth") <= n), F.broadcast(sizes), keys, "left")
    # A row goes into a later chunk if no more than n rows lie from it on before that chunk.
    later = F.filter("_sizes", lambda s: s.chunk > F.col(CHUNK))
    reach = F.aggregate(later, F.struct(F.col("_nth").alias("seen"), F.array().cast("array<int>").alias("to")), lambda a, s: F.struct((a.seen + s.n).alias("seen"), F.when(a.seen <= n, F.concat(a.to, F.array(s.chunk))).otherwise(a.to).alias("to")))
    copies = last.withColumn("_to", F.explode(reach["to"])).withColumns({CHUNK: F.col("_to"), HALO: F.lit(True)})
    return own.unionByName(copies.select(*own.columns))
