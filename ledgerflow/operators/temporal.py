"""Generic operators on keys and time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions.columns import epoch_micros
from ledgerflow.operators.chunks import BOUNDS, CHUNK, HALO, cut_hot, running_last, with_halo, with_row_halo

MINUTE = 60_000_000
#: How rows that are looked at several times are held: written and read back, or as they are.
Hold = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def latest_by(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row a key: the last by `order`, descending with nulls last. The group limit runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def as_of_join(left: DataFrame, versions: DataFrame, key: str, at: Column, mode: str = "instant", keep: tuple[str, ...] = (), hot_rows: int | None = None, hold: Hold = as_it_is) -> DataFrame:
    """left with the columns `keep` of the version of its key that was valid at `at`; nulls where there is none.

    versions: key, valid_from, valid_to (null: still valid), half-open; versions of a key don't overlap. mode "before":
    the last version valid before `at`, the state when a period ends. Rows and versions are put together, sorted by
    time within a key in one shuffle, and the last version begun is carried along: work is linear in both, however many
    versions a key has. With hot_rows, keys of more rows and versions than that are cut in time (read thrice then).
    Rows without a key or time have no version, and are spread over tasks."""
    if mode not in ("instant", "before"):
        raise ValueError(f"unknown mode {mode!r}")
    first = mode == "instant"  # a version that begins at `at` counts
    own = F.struct(*[left[c] for c in left.columns])
    rows = left.select(F.col(key).alias("_key"), epoch_micros(at).alias("_at"), F.lit(1 if first else 0).alias("_order"), own.alias("_row"))
    state = F.struct(epoch_micros(F.col("valid_to")).alias("to"), *keep)
    states = versions.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(F.col(key).alias("_key"), epoch_micros(F.col("valid_from")).alias("_at"), F.lit(0 if first else 1).alias("_order"), state.alias("_state"))
    both = rows.unionByName(states, allowMissingColumns=True)
    both = both.withColumn("_spread", F.when(F.col("_key").isNull() | F.col("_at").isNull(), F.pmod(F.xxhash64("_row"), F.lit(4096))))
    keys, hot = ["_key", "_spread"], hot_rows is not None
    cut = hold(cut_hot(hold(both), keys, "_at", hot_rows)) if hot else cut_hot(both, keys, "_at", None)
    found = running_last(cut, keys, ["_at", "_order"], F.col("_state"), "_found", hot=hot)
    to = F.col("_found.to")
    valid = F.col("_spread").isNull() & (to.isNull() | ((F.col("_at") < to) if first else (to >= F.col("_at"))))
    return found.where(F.col("_row").isNotNull()).select("_row.*", *[F.when(valid, F.col(f"_found.{c}")).alias(c) for c in keep])


def trailing_count(df: DataFrame, keys: list[str], ts: str, minutes: int) -> Column:
    """Rows of the same keys in (t - window, t], peers at t included: a range frame in place of a self join."""
    w = Window.partitionBy(*keys).orderBy(epoch_micros(F.col(ts))).rangeBetween(-(minutes * MINUTE - 1), Window.currentRow)
    return F.count(F.lit(1)).over(w)


def cut_by(df: DataFrame, keys: list[str], ts: str, hot_rows: int | None) -> DataFrame:
    """df with _at and cut_hot()'s columns; as it is if it has them."""
    return df if CHUNK in df.columns else cut_hot(df.withColumn("_at", epoch_micros(F.col(ts))), keys, "_at", hot_rows)


def trailing_counts(df: DataFrame, keys: list[str], ts: str, minutes: int, name: str, hot_rows: int | None = None) -> DataFrame:
    """df with trailing_count() as a column. With hot_rows, keys of more rows are cut in time, and each chunk gets copies
    of the rows before it that its first windows reach back to. df may be the result of cut_by()."""
    cut = cut_by(df, keys, ts, hot_rows)
    kept = [c for c in cut.columns if c in df.columns]
    counted = with_halo(cut, "_at", F.lit(minutes * MINUTE)).withColumn(name, trailing_count(cut, [*keys, CHUNK], ts, minutes))
    return counted.where(~F.col(HALO)).select(*kept, name)


def island_members(df: DataFrame, keys: list[str], ts: str, tie: str, anchor: str, minutes: Column | int, hot_rows: int | None = None, hold: Hold = as_it_is) -> DataFrame:
    """df with `island_anchor`: for rows in (t - window, t] of an anchor at t, the first anchor of its island, else null.

    anchor: a column that is true for anchors; anchors less than a window apart are one island. The windows of an island
    make one unbroken interval, so a row belongs to the island of the next anchor if that is less than a window away.
    One shuffle by key and running frames only: work grows with the rows, however many windows hold one. With hot_rows,
    keys of more rows are cut in time; the last anchor, its island and the next anchor are carried over the cuts. Each
    of these looks at the rows twice, so hold, if given, writes them in between. df may be the result of cut_by()."""
    hot, order = hot_rows is not None, ["_at", tie]
    found = cut_by(df, keys, ts, hot_rows).withColumn("_span", (minutes if isinstance(minutes, Column) else F.lit(minutes)).cast("long") * MINUTE)
    kept, at = [c for c in found.columns if c in df.columns], F.col("_at")
    found = running_last(hold(found), keys, order, F.when(F.col(anchor), at), "_previous", before=True, hot=hot)
    starts = F.col(anchor) & (F.col("_previous").isNull() | (at - F.col("_previous") >= F.col("_span")))
    found = running_last(hold(found), keys, order, F.when(starts, F.col(tie)), "_first", hot=hot)
    found = running_last(hold(found), keys, order, F.when(F.col(anchor), F.struct(at.alias("at"), F.col("_first").alias("first"))), "_next", backwards=True, hot=hot)
    return found.select(*kept, F.when(F.col("_next.at") - at < F.col("_span"), F.col("_next.first")).alias("island_anchor"))


def date_spine(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    """date_day from start to the day before end_exclusive."""
    last = end_exclusive - dt.timedelta(days=1)
    days = F.explode(F.sequence(F.lit(start), F.lit(last))) if last >= start else F.explode(F.array().cast("array<date>"))
    return spark.range(1).select(days.alias("date_day"))


def explode_days(df: DataFrame, start: str, end: str, name: str = "date_day") -> DataFrame:
    """A row for each day from start to end; none if end is before start or either is null."""
    return df.where(F.col(start) <= F.col(end)).withColumn(name, F.explode(F.sequence(start, end)))


def forward_fill(df: DataFrame, key: str, date: str, value: str, extend_days: int) -> DataFrame:
    """key, date, value, published: a row a day and key from the table's first date to its last plus extend_days.

    Missing days carry the last value and the date it was published on. Days before a key's first value stay null."""
    bounds = df.agg(F.min(date).alias("_first"), F.date_add(F.max(date), extend_days).alias("_last"))
    grid = explode_days(df.select(key).distinct().crossJoin(F.broadcast(bounds)), "_first", "_last", date).select(key, date)
    seen = df.select(key, date, value, F.col(date).alias("published"))
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(seen, [key, date], "left")
    return filled.select(key, date, F.last(value, True).over(w).alias(value), F.last("published", True).over(w).alias("published"))


def rolling_zscore(df: DataFrame, keys: list[str], order: list[str], value: Column, n: int = 50, hot_rows: int | None = None, hold: Hold = as_it_is) -> DataFrame:
    """df with history_count and zscore of value against the n rows before it; null where they don't vary.

    order: a time first. With hot_rows, keys of more rows are cut in time, and each chunk gets copies of the n rows
    before it, for which the rows are looked at three times. df may be the result of cut_by()."""
    cut = cut_by(df, keys, order[0], hot_rows).withColumn("_v", value)
    kept = [c for c in cut.columns if c in df.columns]
    cut = cut.withColumn(HALO, F.lit(False)) if hot_rows is None else with_row_halo(hold(cut), keys, order, n)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(-n, -1)
    z = (F.col("_v") - F.avg("_v").over(w)) / F.nullif(F.stddev_samp("_v").over(w), F.lit(0.0))
    return cut.withColumns({"history_count": F.count(F.lit(1)).over(w), "zscore": z}).where(~F.col(HALO)).select(*kept, "history_count", "zscore")
