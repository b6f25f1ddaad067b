"""Windows, as-of joins and ranks that are split over tasks, against the plain ones."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.operators import chunks
from ledgerflow.operators.chunks import cut_hot, running_sum
from ledgerflow.operators.rank import exact_percentiles, percent_rank, row_numbers, value_range
from ledgerflow.operators.temporal import as_of_join, island_members, rolling_zscore, trailing_count, trailing_counts
from ledgerflow.plans import aml

START = dt.datetime(2025, 1, 1)


def held(df):
    return df.cache()


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def events(spark):
    """One account with nearly all rows, bunched in time; a few others; one without a name."""
    rng = random.Random(2)
    at = lambda: START + dt.timedelta(minutes=rng.choice([rng.randrange(3000), 700 + rng.randrange(20)]))
    rows = [("hot" if n % 10 else rng.choice(["a", "b", None]), f"e{n:04d}", at(), rng.randrange(-50, 50), rng.random() < 0.2) for n in range(900)]
    return spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz, v int, mark boolean").repartition(4).cache()


def test_hot_keys_are_cut_in_time_and_others_stay(spark, events):
    cut = cut_hot(events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))), ["k"], "at", 100)
    sizes = {(r["k"], r["_chunk"]): (r["n"], r["low"], r["high"]) for r in cut.groupBy("k", "_chunk").agg(F.count("*").alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).collect()}
    hot = [sizes[x] for x in sorted(x for x in sizes if x[0] == "hot")]
    assert len(hot) > 5 and sum(n for n, *_ in hot) == 810 and max(n for n, *_ in hot) <= 100 + 60
    assert all(a[2] < b[1] for a, b in zip(hot, hot[1:], strict=False))  # chunks follow each other, peers are together
    assert {k for k, c in sizes if c == 0} == {"hot", "a", "b", None} and {k for k, c in sizes if c > 0} == {"hot"}


@pytest.mark.parametrize("limit", [20, 100])
def test_windows_are_the_same_however_they_are_cut(events, limit):
    whole = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    e = events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    assert rows_of(running_sum(e, ["k"], ["at", "id"], "at", "v", "total", limit)) == rows_of(e.withColumn("total", F.sum("v").over(whole)))
    counted = trailing_counts(events, ["k"], "ts", 60, "n", limit)
    assert rows_of(counted) == rows_of(events.withColumn("n", trailing_count(events, ["k"], "ts", 60)))
    by_island = lambda n: island_members(events, ["k"], "ts", "id", "mark", 30, n, held)
    assert rows_of(by_island(limit)) == rows_of(by_island(None))
    scored = lambda n: rolling_zscore(events, ["k"], ["ts", "id"], F.col("v").cast("double"), 7, n, held).withColumn("zscore", F.round("zscore", 9))
    assert rows_of(scored(limit)) == rows_of(scored(None))


def test_a_hot_account_uses_several_tasks(spark, events):
    spread = cut_hot(events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))), ["k"], "at", 50)
    per_task = spread.where("k = 'hot'").repartition(8, "k", "_chunk").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 5 and max(r["count"] for r in per_task) < 500


def test_alerts_are_the_same_however_accounts_are_cut(spark):
    rng = random.Random(3)
    kinds = ["CARD_PAYMENT"] * 3 + ["CASH_DEPOSIT"]
    rows = [("A1" if n % 8 else "A2", f"t{n:04d}", START + dt.timedelta(minutes=rng.randrange(20_000)), rng.choice([30.0, 31.5, 60.0, 950.0]), rng.choice(kinds), rng.random() < 0.9) for n in range(700)]
    fct = spark.createDataFrame(rows, "account_id string, txn_id string, txn_ts timestamp_ntz, a double, txn_type string, is_posted boolean").withColumn("amount_eur", F.col("a").cast("decimal(18,2)")).drop("a").cache()
    p = Params(structuring_floor_eur=20, structuring_ceiling_eur=100, structuring_min_count=4, structuring_window_minutes=600, velocity_window_minutes=60, velocity_min_count=3, outlier_history=10, outlier_min_history=5, outlier_min_zscore=1.0, outlier_min_amount_eur=0)
    whole = aml.alert_members(fct, p)
    assert {r[0] for r in whole.select("rule_code").distinct().collect()} == {"STRUCTURING", "VELOCITY", "OUTLIER"}
    assert rows_of(aml.alert_members(fct, p, 60, held)) == rows_of(whole)


def versions_of(spark, rows):
    return spark.createDataFrame(rows, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, state string")


@pytest.mark.parametrize("mode", ["instant", "before"])
def test_as_of_join_equals_a_range_join(spark, events, mode):
    rng = random.Random(6)
    rows = []
    for k in ("hot", "a", "c"):
        at = sorted(rng.sample(range(3000), 60))
        spans = list(zip(at, [*at[1:], None], strict=True))
        rows += [(k, START + dt.timedelta(minutes=a), None if b is None else START + dt.timedelta(minutes=b - (a % 7 == 0)), f"s{a}") for a, b in spans]  # some end before the next begins
    versions = versions_of(spark, [*rows, (None, START, None, "nobody")])
    v = versions.select(F.col("k").alias("_k"), "valid_from", "valid_to", "state")
    at = F.col("ts")
    inside = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))) if mode == "instant" else (F.col("valid_from") < at) & (F.col("valid_to").isNull() | (F.col("valid_to") >= at))
    want = rows_of(events.join(v, (events.k == F.col("_k")) & inside, "left").drop("_k", "valid_from", "valid_to"))
    timeless = events.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz")).cache()
    for hot_rows in (None, 40):
        joined = as_of_join(events, versions, "k", at, mode, ("state",), hot_rows, held)
        assert rows_of(joined) == want
        assert [r["state"] for r in as_of_join(timeless, versions, "k", at, mode, ("state",), hot_rows, held).collect()] == [None] * 3
    plan = as_of_join(events, versions, "k", at, mode, ("state",))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    with pytest.raises(ValueError):
        as_of_join(events, versions, "k", at, "sometime")


def test_as_of_join_is_linear_in_versions(spark):
    """A customer of 100,000 versions and 20,000 rows: a range join would look at 2,000 million pairs."""
    second = lambda n: F.timestamp_seconds(n).cast("timestamp_ntz")
    versions = spark.range(100_000).select(F.lit("C").alias("k"), second(F.col("id") * 10).alias("valid_from"), second(F.col("id") * 10 + 10).alias("valid_to"), F.col("id").alias("state"))
    left = spark.range(20_000).select(F.lit("C").alias("k"), second(F.col("id") * 50 + 3).alias("ts"), "id")
    joined = as_of_join(left, versions, "k", F.col("ts"), keep=("state",), hot_rows=10_000, hold=held)
    assert joined.where(F.col("state") == F.col("id") * 5).count() == 20_000


def test_ranges_grow_with_values(spark):
    rng = random.Random(9)
    values = sorted({0.0, 1.0, 10.0, 99.999, 100.0, 999.9999999999999, 1000.0, 1e-7, -5.0, -1e12, 1e12} | {rng.choice([-1, 1]) * rng.random() * 10 ** rng.randrange(-6, 14) for _ in range(3000)})
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(value_range(F.col("v"))).collect()]
    assert got == sorted(got)


def test_row_numbers_equal_a_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "x", "x", "y", None]), at, f"{at}{t}") for at in [None, *range(-40, 300), 10**12, 2**62 + 1, 2**62 + 2] for t in "ab" if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "g string, at long, t string").cache()
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(F.col("at").asc_nulls_last(), F.col("t").asc_nulls_last())).cast("long"))
    for bits in (0, 3, 15):
        assert rows_of(row_numbers(df, ["g"], "at", ["t"], "n", bits)) == rows_of(want)


def test_percent_ranks_and_percentiles_equal_windows(spark):
    rng = random.Random(7)
    value = lambda: rng.choice([0, 0, 0, None, rng.randrange(-300, 9000), rng.randrange(100_000)])
    rows = [(rng.choice(["x", "x", "x", "y", None]), value(), n) for n in range(800)] + [("one", 5, 900)]
    df = spark.createDataFrame(rows, "g string, c int, id int").select("g", (F.col("c") / 100).cast("decimal(18,2)").alias("v"), "id").cache()
    want = df.withColumn("r", F.percent_rank().over(Window.partitionBy("g").orderBy("v")))
    got = percent_rank(df, ["g"], "v", "r")
    assert rows_of(got.select("id", F.round("r", 12))) == rows_of(want.select("id", F.round("r", 12)))
    assert "Window [percent_rank" not in got._jdf.queryExecution().executedPlan().toString()
    shares = {"low": 0.0, "mid": 0.5, "most": 0.95, "high": 1.0}
    for digits in (1, 4):
        got = exact_percentiles(df.withColumn("v", F.col("v").cast("double")), ["g"], "v", shares, digits)
        want = df.groupBy("g").agg(F.count("v").alias("n"), *[F.percentile(F.col("v").cast("double"), s).alias(n) for n, s in shares.items()])
        rounded = lambda x: rows_of(x.select("g", "n", *[F.round(n, 9) for n in shares]))
        assert rounded(got) == rounded(want)


def test_halo_rows_come_from_as_many_chunks_as_it_takes(spark):
    rows = [("k", n * 1000, n) for n in range(40)]
    cut = cut_hot(spark.createDataFrame(rows, "k string, at long, n long"), ["k"], "at", 3)
    with_halo = chunks.with_row_halo(cut, ["k"], ["at"], 10)
    got = {}
    for r in with_halo.where("_halo").collect():
        got.setdefault(r["_chunk"], set()).add(r["n"])
    first = {r["_chunk"]: r["first"] for r in cut.groupBy("_chunk").agg(F.min("n").alias("first")).collect()}
    assert got == {c: set(range(max(0, n - 10), n)) for c, n in first.items() if c > 0}
