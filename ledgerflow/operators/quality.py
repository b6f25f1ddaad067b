"""Data-quality checks: each returns the rows that fail, so an empty result is a pass."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df, [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values that occur more than once; keys with a null in a single column don't count."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with another value; nulls pass."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value has no parent; nulls pass."""
    known = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_parent"), "left_anti")


def expression_is_true(df: DataFrame, expression: str, where: str = "true") -> DataFrame:
    """Rows (that `where` selects) for which the expression is false; unknown passes."""
    return df.where(where).where(~F.expr(expression))


def within_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside of low ... high, either of which may be open; nulls pass."""
    fails = F.lit(False)
    if low is not None:
        fails = fails | (F.col(column) < low)
    if high is not None:
        fails = fails | (F.col(column) > high)
    return df.where(fails)


def freshness(tables: dict[str, DataFrame], now, warn_hours: int = 26, error_hours: int = 50, exempt: tuple[str, ...] = ()) -> DataFrame:
    """table, newest load, age in hours and status (pass, warn, error) for each table that isn't exempt."""
    parts = [df.agg(F.max("_loaded_at").alias("newest")).select(F.lit(name).alias("table"), "newest") for name, df in tables.items() if name not in exempt]
    if not parts:
        raise ValueError("no table to check")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    age = F.timestamp_diff("SECOND", F.col("newest"), F.lit(now).cast("timestamp_ntz")) / 3600
    late = F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass")
    return every.withColumn("age_hours", age).withColumn("status", late)


@dataclass(frozen=True)
class Check:
    """A named check; a failing one of severity warn doesn't fail the run."""

    name: str
    failing: DataFrame
    severity: str = "error"


@dataclass
class TableChecks:
    """What holds for a table: a key, conditions that rows must not meet, and parents that values must have.

    fails: name -> (condition of a failing row, severity). parents: name -> (column, parent table, severity), where the
    parent has a column of the same name."""

    df: DataFrame
    fails: dict[str, tuple[Column, str]] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    key_name: str = "unique"
    parents: dict[str, tuple[str, DataFrame, str]] = field(default_factory=dict)


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_other(column: str, values: list) -> Column:
    """Another value; null isn't one."""
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def is_false(expression: str) -> Column:
    """The expression is false; unknown isn't."""
    return ~F.expr(expression)


def is_outside(column: str, low=None, high=None) -> Column:
    """Outside of low ... high, either of which may be open; null isn't."""
    bounds = [F.col(column) < low] * (low is not None) + [F.col(column) > high] * (high is not None)
    return reduce(Column.__or__, bounds, F.lit(False))


def check_rows(checks: TableChecks) -> DataFrame:
    """check, severity and failing rows (or keys that occur more than once) of all checks of a table, from one scan.

    Rows meet their parents by joins with the parents' distinct values, are counted by key, so that the counts of
    conditions and repeats take the same shuffle, and summed up. A key with a null in its only column isn't one. Values
    without a parent table's column of that name are joined as they are, so a hot value costs what any join does."""
    rows, flags = checks.df, {}
    for n, (name, (column, parent, severity)) in enumerate(checks.parents.items()):
        known = parent.select(F.col(column).alias(f"_parent{n}")).distinct()
        rows = rows.join(known, F.col(column) == F.col(f"_parent{n}"), "left")
        flags[name] = (F.col(column).isNotNull() & F.col(f"_parent{n}").isNull(), severity)
    flags = {**checks.fails, **flags}
    failing = [F.count_if(condition).alias(f"_f{n}") for n, (condition, _) in enumerate(flags.values())]
    found = [(name, severity, f"_f{n}") for n, (name, (_, severity)) in enumerate(flags.items())]
    if checks.key:
        named = F.col(checks.key[0]).isNotNull() if len(checks.key) == 1 else F.lit(True)
        by_key = rows.groupBy(*checks.key).agg(F.count(F.lit(1)).alias("_n"), *failing)
        total = by_key.agg(F.count_if((F.col("_n") > 1) & named).alias("_repeats"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for _, _, c in found])
        found.append((checks.key_name, "error", "_repeats"))
    else:
        total = rows.agg(*failing)
    listed = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col(c).cast("long").alias("failing")) for name, severity, c in found]))
    return total.select(listed.alias("c")).select("c.*")


class ChecksFailed(RuntimeError):
    pass


def require_passed(results: list[tuple[str, str, int, str]]) -> None:
    """Raises if a check of severity error failed, naming all of those."""
    failed = [f"{name} ({n} rows)" for name, _, n, status in results if status == "error"]
    if failed:
        raise ChecksFailed("; ".join(failed))


def run_checks(checks: list[Check] | list[TableChecks]) -> list[tuple[str, str, int, str]]:
    """(name, severity, failing rows, status) of each check: a job for a table, or for a check that stands alone, a few at a time."""

    def count(c: Check | TableChecks) -> list[tuple[str, str, int]]:
        return [(c.name, c.severity, c.failing.count())] if isinstance(c, Check) else [tuple(r) for r in check_rows(c).collect()]

    with ThreadPoolExecutor(4) as pool:
        return [(name, severity, n, "pass" if not n else severity) for counted in pool.map(count, checks) for name, severity, n in counted]
