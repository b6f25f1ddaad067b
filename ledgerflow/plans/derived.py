"""Tables derived from the fact, made anew only where a change of the fact, a dimension or a rate can reach.

A build hands over the fact's changed rows. From them follow the months, the days and the spans of accounts that each
derived table has to make again; all other months keep their files, and the fact is read for the affected months alone.
Two things look further: a reversal's payment is looked for by id in all months, and reports of a few rows for each
month (the spend report, the alert report) are put together whole from what was kept of each month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.plans import aml, core, finance
from ledgerflow.sources.tables import Warehouse, month_partition

DAY = dt.timedelta(days=1)


def build_derived(warehouse: Warehouse, out: dict[str, DataFrame], before: Callable[[str], DataFrame | None], delta: DataFrame | None, touched: list[str], p: Params) -> dict[str, DataFrame]:
    """Balances, alerts and finance reports. delta: fact_delta(), None if there was no fact before; touched: its months."""
    done: dict[str, DataFrame] = {}
    fct = out["fct_transactions"]
    since = first_changed_day(out, before, delta)
    done["fct_account_daily_balance"], since = balances(warehouse, out, before, since)
    # Small extracts of the fact by month, which say what lies outside of the changed months.
    extract = lambda name, df: keep_months(warehouse, name, before(name), df, touched)
    reversals = extract("int_reversals", lambda f: f.where("txn_type = 'REVERSAL' and is_posted and original_txn_id is not null").select("original_txn_id", "txn_month").distinct())
    counts = extract("int_outlier_months", lambda f: aml.outlier_months(f.drop("txn_month"), p))
    done["int_reversals"], done["int_outlier_months"] = reversals(fct), counts(fct)
    done |= alerts(warehouse, out, before, delta, done["int_outlier_months"], p)
    back = done["int_reversals"].select(F.col("original_txn_id").alias("_original")).distinct()
    months = None if delta is None else booked_months(fct, before("fct_transactions"), delta)
    done |= summary(warehouse, out | done, before, back, months, since)
    done |= spend(warehouse, out, before, back, months)
    return done


def own_month(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def names(df: DataFrame) -> list[str]:
    """The months of a table's rows, one name each."""
    return sorted(r[0] for r in df.distinct().collect() if r[0] is not None)


def keep_months(warehouse: Warehouse, name: str, old: DataFrame | None, make: Callable[[DataFrame], DataFrame], touched: list[str] | None):
    """A function of the fact that writes make(fact) by txn_month: whole, or for the touched months alone."""

    def write(fct: DataFrame) -> DataFrame:
        if old is None or touched is None:
            return warehouse.write(make(fct), name, "txn_month")
        if not touched:
            return old
        return warehouse.write(make(fct.where(F.col("txn_month").isin(touched))), name, "txn_month", touched)

    return write


def differing(new: DataFrame, old: DataFrame, columns: list[str]) -> DataFrame:
    return new.select(*columns).exceptAll(old.select(*columns)).unionByName(old.select(*columns).exceptAll(new.select(*columns)))


ACCOUNT = ["account_id", "customer_id", "currency", "opening_balance", "opened_date", "closed_date"]


def first_changed_day(out: dict[str, DataFrame], before: Callable[[str], DataFrame | None], delta: DataFrame | None) -> dt.date | None:
    """First day from which all balances are made anew; the day after the last if nothing changed, None without balances.

    Changes are transactions that came, went or moved, accounts known before, and rates."""
    old = {name: before(name) for name in ("fct_account_daily_balance", "dim_account", "fx_rates_daily")}
    last = None if old["fct_account_daily_balance"] is None else old["fct_account_daily_balance"].agg(F.max("balance_date")).first()[0]
    if delta is None or last is None or any(t is None for t in old.values()):
        return None
    start = out["fct_transactions"].agg(F.min("txn_date")).first()[0]
    moved = delta.select(F.col("txn_date").alias("d"))
    accounts = differing(out["dim_account"], old["dim_account"], ACCOUNT).join(old["dim_account"].select("account_id"), "account_id", "left_semi").select(account_start(start).alias("d"))
    rates = differing(out["fx_rates_daily"], old["fx_rates_daily"], ["rate_date", "currency", "rate_to_eur"]).select(F.col("rate_date").alias("d"))
    day = moved.unionByName(accounts).unionByName(rates).agg(F.min("d")).first()[0]
    return min(day or dt.date.max, last + DAY)  # days without any transaction count too


def account_start(start: dt.date | None) -> Column:
    return F.greatest(F.coalesce("opened_date", F.lit(start)), F.lit(start))


def balances(warehouse: Warehouse, out: dict[str, DataFrame], before: Callable[[str], DataFrame | None], since: dt.date | None) -> tuple[DataFrame, dt.date | None]:
    """Balances from the first changed day on, in whole months, and the first day that any of them differs.

    Earlier months keep their files; accounts that are new to the table have their earlier days added to them."""
    name, args = "fct_account_daily_balance", (out["fct_transactions"], out["dim_account"], out["fx_rates_daily"])
    if since is None:
        return warehouse.write(month_partition(core.daily_balance(*args), "balance_date"), name, "txn_month", None, "balance_date"), None
    old = before(name)
    start, end = out["fct_transactions"].agg(F.min("txn_date"), F.max("txn_date")).first()
    new = out["dim_account"].join(before("dim_account").select("account_id"), "account_id", "left_anti").where(account_start(start) < F.lit(since))
    first = new.agg(F.min(account_start(start))).first()[0]
    if first is None and (end is None or end < since):
        return old, since
    month = since.strftime("%Y-%m")
    rows = old.where((F.col("txn_month") == month) & (F.col("balance_date") < F.lit(since))).unionByName(month_partition(core.daily_balance(*args, since, old.drop("txn_month")), "balance_date"))
    if first is not None:
        late = core.daily_balance(out["fct_transactions"], new, out["fx_rates_daily"])
        # Days from `since` on are among the others, but begin at the opening balance there: a late account moved before.
        rows = rows.join(new.select("account_id"), "account_id", "left_anti").unionByName(month_partition(late, "balance_date"))
    had = names(old.where(F.col("txn_month") >= month).select("txn_month"))
    return warehouse.write(rows, name, "txn_month", sorted({*had, month}), "balance_date"), min(since, first or since)


def alerts(warehouse: Warehouse, out: dict[str, DataFrame], before: Callable[[str], DataFrame | None], delta: DataFrame | None, counts: DataFrame, p: Params) -> dict[str, DataFrame]:
    """Alert members, by the month of their transactions, and the alert report."""
    fct, name = out["fct_transactions"], "aml_alert_transactions"
    old, report = before(name), before("rpt_aml_alerts")
    if delta is None or old is None or report is None:
        members = warehouse.write(month_partition(aml.alert_members(fct, p), "txn_ts"), name, "txn_month")
    else:
        spans = warehouse.step(aml.affected_spans(delta, report, counts, p))
        reach = F.sequence(F.trunc("read_from", "month"), F.trunc(F.col("until") - F.expr("interval 1 microsecond"), "month"), F.expr("interval 1 month"))
        months = names(spans.select(F.explode(reach).alias("m")).select(own_month("m")))
        found = warehouse.step(month_partition(aml.members_within(fct.where(F.col("txn_month").isin(months)), spans, p), "txn_ts"))
        gone = report.join(spans, aml.KEYS).where((F.col("alert_end_ts") >= F.col("first")) & (F.col("alert_start_ts") < F.col("until"))).select("alert_id").distinct()
        gone = warehouse.step(gone)
        changed = names(old.join(gone, "alert_id", "left_semi").select("txn_month").unionByName(found.select("txn_month")))
        members = old
        if changed:
            kept = old.where(F.col("txn_month").isin(changed)).join(gone, "alert_id", "left_anti")
            members = warehouse.write(kept.unionByName(found), name, "txn_month", changed)
    return {name: members, "rpt_aml_alerts": warehouse.write(aml.alerts(members, out["dim_account"], out["dim_customer"]), "rpt_aml_alerts")}


def booked_months(fct: DataFrame, old: DataFrame, delta: DataFrame) -> list[str]:
    """Months in which a customer's bookings may differ: those of changed rows, and those of payments whose reversal changed."""
    own = names(delta.select("txn_month"))
    taken = delta.where("txn_type = 'REVERSAL' and original_txn_id is not null").select(F.col("original_txn_id").alias("txn_id")).distinct()
    if taken.isEmpty():
        return own
    held = fct.where("txn_type <> 'REVERSAL'").select("txn_id", "txn_month").join(taken, "txn_id", "left_semi").select("txn_month")
    return sorted({*own, *names(held)})


def summary(warehouse: Warehouse, out: dict[str, DataFrame], before: Callable[[str], DataFrame | None], back: DataFrame, months: list[str] | None, since: dt.date | None) -> dict[str, DataFrame]:
    """The monthly customer summary and its two parts, by month.

    Bookings are made anew for their changed months, holdings from the first changed balance on, and the summary from
    the first month that either reaches, or a customer's state at its end. Before that month, only the last row of each
    customer is read, for the spending before."""
    fct, account, customer = out["fct_transactions"], out["dim_account"], out["dim_customer"]
    monthly = lambda df: df.withColumn("txn_month", own_month("month_start"))
    old = {n: before(n) for n in ("int_customer_month_bookings", "int_customer_month_balances", "rpt_monthly_customer_summary", "dim_customer")}
    partial = months is not None and since is not None and all(t is not None for t in old.values())
    bookings = keep_months(warehouse, "int_customer_month_bookings", old["int_customer_month_bookings"] if partial else None, lambda f: monthly(finance.customer_month_bookings(f, back)), months)(fct)
    held, start = out["fct_account_daily_balance"], None
    if partial:
        start = since.strftime("%Y-%m")
        later = sorted({*names(held.where(F.col("txn_month") >= start).select("txn_month")), *names(old["int_customer_month_balances"].where(F.col("txn_month") >= start).select("txn_month"))})
        holdings = old["int_customer_month_balances"]
        if later:
            holdings = warehouse.write(monthly(finance.customer_month_balances(held.where(F.col("txn_month") >= start), account)), "int_customer_month_balances", "txn_month", later)
        states = ["customer_id", "valid_from", *core.CUSTOMER_STATE]
        moved = differing(customer, old["dim_customer"], states).agg(F.min(own_month("valid_from"))).first()[0]
        first = min([start, *months, *([moved] if moved else [])])
    else:
        holdings = warehouse.write(monthly(finance.customer_month_balances(held, account)), "int_customer_month_balances", "txn_month")
    name, parts = "rpt_monthly_customer_summary", {"int_customer_month_bookings": bookings, "int_customer_month_balances": holdings}
    args = (holdings.drop("txn_month"), bookings.drop("txn_month"))
    if not partial:
        return parts | {name: warehouse.write(monthly(finance.customer_months(*args, customer, None, warehouse.step)), name, "txn_month")}
    args = tuple(df.where(F.col("txn_month") >= first).drop("txn_month") for df in (holdings, bookings))
    earlier = old[name].where(F.col("txn_month") < first).select("customer_id", "month_start", "card_spend_eur")
    rows = finance.customer_months(*args, customer, last_rows(warehouse, earlier, args[0].select("customer_id").distinct(), first), warehouse.step)
    touched = sorted({*names(old[name].where(F.col("txn_month") >= first).select("txn_month")), *names(holdings.where(F.col("txn_month") >= first).select("txn_month"))})
    return parts | {name: warehouse.write(monthly(rows), name, "txn_month", touched) if touched else old[name]}


def last_rows(warehouse: Warehouse, earlier: DataFrame, customers: DataFrame, first: str) -> DataFrame:
    """The last earlier row of each customer: from the month before, and for those without one there, from all before it."""
    eve = F.add_months(F.to_date(F.lit(f"{first}-01")), -1)
    near = warehouse.step(earlier.where(F.col("month_start") == eve))
    apart = warehouse.step(customers.join(near, "customer_id", "left_anti"))
    if apart.isEmpty():
        return near
    far = earlier.where(F.col("month_start") < eve).join(apart, "customer_id", "left_semi")
    return near.unionByName(far.groupBy("customer_id").agg(F.max("month_start").alias("month_start"), F.max_by("card_spend_eur", "month_start").alias("card_spend_eur")))


def spend(warehouse: Warehouse, out: dict[str, DataFrame], before: Callable[[str], DataFrame | None], back: DataFrame, months: list[str] | None) -> dict[str, DataFrame]:
    """Monthly spend by category and country, kept by month, and the report on all months; a merchant that came or moved
    to another category or country makes all months anew."""
    old, merchants = before("int_monthly_spend"), before("dim_merchant")
    if old is not None and merchants is not None and not differing(out["dim_merchant"], merchants, ["merchant_id", "spend_category", "country_code"]).isEmpty():
        old = None
    make = lambda f: finance.monthly_spend(f, back, out["dim_merchant"]).withColumn("txn_month", own_month("month_start"))
    kept = keep_months(warehouse, "int_monthly_spend", old, make, months)(out["fct_transactions"])
    return {"int_monthly_spend": kept, "rpt_merchant_category_spend": warehouse.write(finance.spend_report(kept.drop("txn_month")), "rpt_merchant_category_spend")}
