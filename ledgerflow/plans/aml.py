"""Money-laundering rules: trailing-window counts merged into alerts, and rolling z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.functions.columns import surrogate_key
from ledgerflow.operators.temporal import Hold, as_it_is, as_of_join, cut_by, island_members, rolling_zscore, trailing_counts

MEMBER = ["rule_code", "account_id", "alert_anchor_txn_id", "txn_id", "txn_ts", "amount_eur"]
KEYS = ["account_id", "rule_code"]


def rule_events(fct: DataFrame, p: Params = Params()) -> DataFrame:
    """The events that each rule looks at, from one pass over the fact.

    STRUCTURING: posted cash deposits just below the reporting limit. VELOCITY: card attempts, posted or not. OUTLIER:
    posted card payments above 0."""
    card = F.col("txn_type") == "CARD_PAYMENT"
    band = (F.col("amount_eur") >= p.structuring_floor_eur) & (F.col("amount_eur") < p.structuring_ceiling_eur)
    tests = {"STRUCTURING": (F.col("txn_type") == "CASH_DEPOSIT") & F.col("is_posted") & band, "VELOCITY": card, "OUTLIER": card & F.col("is_posted") & (F.col("amount_eur") > 0)}
    rules = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, test in tests.items()]))
    return fct.select(F.explode(rules).alias("rule_code"), "account_id", "txn_id", "txn_ts", "amount_eur")


def rule_members(fct: DataFrame, p: Params = Params(), hot_rows: int | None = None, hold: Hold = as_it_is) -> DataFrame:
    """Members of all rules' alerts. The fact is read once and shuffled once, by account and rule.

    STRUCTURING and VELOCITY: an event is an anchor if its trailing window holds enough events; anchors less than a
    window apart are one alert, named after the first, whose members are the events in any of its windows. OUTLIER:
    payments far above the account's earlier ones, on a logarithmic scale; each is an alert of its own."""
    return event_members(rule_events(fct, p), F.lit(True), p, hot_rows, hold)


def event_members(events: DataFrame, counts: Column, p: Params, hot_rows: int | None = None, hold: Hold = as_it_is) -> DataFrame:
    """Members of the alerts of rule_events(). counts: whether an event may be an anchor or outlier; all events may be
    members and are part of windows and histories. hot_rows: accounts of more events are cut in time, once for all rules."""
    events = events.withColumn("_counts", counts)
    events = hold(cut_by(hold(events), KEYS, "txn_ts", hot_rows)) if hot_rows is not None else cut_by(events, KEYS, "txn_ts", None)
    structuring, velocity, outlier = (F.col("rule_code") == rule for rule in ("STRUCTURING", "VELOCITY", "OUTLIER"))
    counted = trailing_counts(events, KEYS, "txn_ts", p.structuring_window_minutes, "_day", hot_rows)
    counted = trailing_counts(counted, KEYS, "txn_ts", p.velocity_window_minutes, "_burst", hot_rows)
    anchor = F.when(structuring, F.col("_day") >= p.structuring_min_count).when(velocity, F.col("_burst") >= p.velocity_min_count).otherwise(False)
    minutes = F.when(structuring, p.structuring_window_minutes).otherwise(p.velocity_window_minutes)
    merged = island_members(counted.withColumn("_anchor", anchor & F.col("_counts")), KEYS, "txn_ts", "txn_id", "_anchor", minutes, hot_rows, hold)
    scored = rolling_zscore(merged, KEYS, ["txn_ts", "txn_id"], F.when(outlier, F.ln(F.col("amount_eur").cast("double"))), p.outlier_history, hot_rows, hold)
    far = F.col("_counts") & (F.col("history_count") >= p.outlier_min_history) & (F.col("amount_eur") >= p.outlier_min_amount_eur) & (F.col("zscore") >= p.outlier_min_zscore)
    named = scored.withColumn("alert_anchor_txn_id", F.when(outlier, F.when(far, F.col("txn_id"))).otherwise(F.col("island_anchor")))
    return named.where("alert_anchor_txn_id is not null").select(*MEMBER)


def outlier_months(fct: DataFrame, p: Params = Params()) -> DataFrame:
    """account_id, txn_month, n: payments that the outlier rule looks at; says how far back a history reaches."""
    return rule_events(fct.select("txn_type", "is_posted", "amount_eur", "account_id", "txn_id", "txn_ts"), p).where("rule_code = 'OUTLIER'").groupBy("account_id", F.date_format("txn_ts", "yyyy-MM").alias("txn_month")).agg(F.count(F.lit(1)).alias("n"))


def affected_spans(delta: DataFrame, alerts: DataFrame, months: DataFrame, p: Params = Params()) -> DataFrame:
    """account_id, rule_code, read_from, first, until: what changes of the fact make to be judged anew.

    delta: rows that left the fact or came. alerts: those found before (account_id, rule_code, alert_start_ts,
    alert_end_ts). months: outlier_months() of the changed fact. Alerts that end before `first` or begin at `until` or
    later stay as they are; all others of the account and rule are found again from the events from read_from on.
    A changed event moves trailing counts for one window; an anchor it makes can join alerts one window away, which are
    taken in whole. A changed payment moves the z-scores of the payments whose history it is part of: the months after
    it that surely hold as many, and its own history lies in the months before it that do."""
    at = rule_events(delta, p).groupBy(*KEYS).agg(F.min("txn_ts").alias("a"), F.max("txn_ts").alias("b"))
    minutes = F.when(F.col("rule_code") == "STRUCTURING", p.structuring_window_minutes).otherwise(p.velocity_window_minutes)
    w = F.make_dt_interval(mins=minutes.cast("int"))
    windows = at.where("rule_code <> 'OUTLIER'").withColumns({"low": F.col("a") - w, "end": F.col("b") + w, "reach": F.col("b") + w + w})
    near = alerts.select(*KEYS, F.col("alert_start_ts").alias("_start"), F.col("alert_end_ts").alias("_end"))
    tick = F.expr("interval 1 microsecond")
    hulls = windows.join(near, KEYS, "left").groupBy(*KEYS, "a", "low", "end", "reach").agg(
        F.min(F.when((F.col("_end") >= F.col("low")) & (F.col("_start") <= F.col("reach")), F.col("_start"))).alias("_start"),
        F.max(F.when((F.col("_end") >= F.col("low")) & (F.col("_start") <= F.col("reach")), F.col("_end"))).alias("_end"),
    )
    first = F.least("a", "_start")
    islands = hulls.select(*KEYS, F.least(first, F.col("low")).alias("read_from"), first.alias("first"), F.greatest(F.col("end"), F.col("_end") + tick).alias("until"))
    paid = at.where("rule_code = 'OUTLIER'")
    own = lambda c: F.date_format(c, "yyyy-MM")
    known = months.join(paid.select("account_id", own("a").alias("_a"), own("b").alias("_b")), "account_id")
    running = lambda order: F.sum("n").over(Window.partitionBy("account_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    reached = F.col("_sum") >= p.outlier_history
    before = known.where("txn_month < _a").withColumn("_sum", running(F.desc("txn_month"))).groupBy("account_id").agg(F.coalesce(F.max(F.when(reached, F.col("txn_month"))), F.min("txn_month")).alias("_low"))
    after = known.where("txn_month > _b").withColumn("_sum", running(F.col("txn_month"))).groupBy("account_id").agg(F.coalesce(F.min(F.when(reached, F.col("txn_month"))), F.max("txn_month")).alias("_high"))
    both = paid.join(before, "account_id", "left").join(after, "account_id", "left")
    opening = lambda month: F.to_timestamp_ntz(F.concat(month, F.lit("-01")), F.lit("yyyy-MM-dd"))
    outliers = both.select(*KEYS, opening(F.coalesce("_low", own("a"))).alias("read_from"), F.col("a").alias("first"), F.add_months(opening(F.coalesce("_high", own("b"))).cast("date"), 1).cast("timestamp_ntz").alias("until"))
    return islands.unionByName(outliers)


def members_within(fct: DataFrame, spans: DataFrame, p: Params = Params()) -> DataFrame:
    """alert_members() of the spans of affected_spans() alone."""
    inside = rule_events(fct, p).join(spans, KEYS).where((F.col("txn_ts") >= F.col("read_from")) & (F.col("txn_ts") < F.col("until")))
    return with_alert_id(event_members(inside, F.col("txn_ts") >= F.col("first"), p))


def structuring(fct: DataFrame, p: Params = Params()) -> DataFrame:
    return rule_members(fct.where("txn_type = 'CASH_DEPOSIT'"), p)


def velocity(fct: DataFrame, p: Params = Params()) -> DataFrame:
    return rule_members(fct.where("txn_type = 'CARD_PAYMENT'"), p).where("rule_code = 'VELOCITY'")


def outlier(fct: DataFrame, p: Params = Params()) -> DataFrame:
    return rule_members(fct.where("txn_type = 'CARD_PAYMENT'"), p).where("rule_code = 'OUTLIER'")


def alert_members(fct: DataFrame, p: Params = Params(), hot_rows: int | None = None, hold: Hold = as_it_is) -> DataFrame:
    """rule_members() with the alert's id. hot_rows: accounts of more events are cut in time, so that one account uses
    many tasks; hold writes what is then looked at several times."""
    return with_alert_id(rule_members(fct, p, hot_rows, hold))


def with_alert_id(members: DataFrame) -> DataFrame:
    return members.select(surrogate_key(F.col("rule_code"), F.col("account_id"), F.col("alert_anchor_txn_id")).alias("alert_id"), *MEMBER)


def alerts(members: DataFrame, dim_account: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """One row an alert, with the customer's segment and risk when it ended, and a severity."""
    grouped = members.groupBy("alert_id", "rule_code", "account_id").agg(
        F.min("txn_ts").alias("alert_start_ts"), F.max("txn_ts").alias("alert_end_ts"), F.count(F.lit(1)).alias("txn_count"), F.sum("amount_eur").cast("decimal(18,2)").alias("total_amount_eur")
    )
    owned = grouped.join(dim_account.select("account_id", "customer_id"), "account_id")
    known = as_of_join(owned, dim_customer, "customer_id", F.col("alert_end_ts"), keep=("segment", "risk_rating"))
    severity = F.when((F.col("rule_code") == "STRUCTURING") | (F.col("risk_rating") == "HIGH"), "HIGH").when(F.col("total_amount_eur") >= 5000, "MEDIUM").otherwise("LOW")
    return known.select(
        "alert_id", "rule_code", "account_id", "customer_id", F.col("segment").alias("customer_segment_at_alert"), F.col("risk_rating").alias("customer_risk_rating_at_alert"), "alert_start_ts", "alert_end_ts",
        F.col("alert_end_ts").cast("date").alias("alert_date"), "txn_count", "total_amount_eur", severity.alias("severity"),
    )
