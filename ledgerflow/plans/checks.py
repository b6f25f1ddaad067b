"""The checks that hold for built tables; a build runs them and fails on those of severity error."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerflow.config import Params
from ledgerflow.operators.quality import TableChecks, expression_is_true, is_false, is_missing, is_other, is_outside

# What columns may hold.
ACCEPTED = {
    ("dim_customer", "segment"): ["RETAIL", "PRIVATE", "BUSINESS"],
    ("dim_customer", "risk_rating"): ["LOW", "MEDIUM", "HIGH"],
    ("dim_account", "account_type"): ["CHECKING", "SAVINGS", "CREDIT_CARD"],
    ("fct_transactions", "warning_reason"): ["MISSING_MERCHANT"],
    ("rpt_aml_alerts", "severity"): ["HIGH", "MEDIUM", "LOW"],
}
# End of the fixed values.
UNIQUE = {"dim_date": ["date_day"], "dim_customer": ["customer_version_key"], "dim_account": ["account_id"], "dim_merchant": ["merchant_id"], "fct_transactions": ["txn_id"], "rpt_aml_alerts": ["alert_id"],
          "fct_account_daily_balance": ["account_id", "balance_date"], "rpt_monthly_customer_summary": ["customer_id", "month_start"], "rpt_merchant_category_spend": ["month_start", "spend_category", "merchant_country"],
          "dq_rejected_transactions": ["_source_file", "_source_row"], "dq_transaction_file_summary": ["source_file"]}
NOT_NULL = {"dim_account": ["customer_id"], "fct_transactions": ["amount", "txn_category"], "fct_account_daily_balance": ["closing_balance"], "rpt_aml_alerts": ["customer_risk_rating_at_alert"], "dq_rejected_transactions": ["rejection_reason"]}
PARENTS = {("fct_transactions", "account_id"): "dim_account", ("fct_transactions", "merchant_id"): "dim_merchant", ("dim_account", "customer_id"): "dim_customer"}
RULES = {("dim_customer", "valid_span", "valid_to"): "valid_to is null or valid_to > valid_from", ("fct_transactions", "future", "txn_ts"): "txn_ts <= _loaded_at", ("fct_transactions", "positive", "amount"): "amount > 0"}
#: Checks whose failures are reported but don't fail a build: they depend on what was delivered.
WARN = ("accepted", "relationships", "rate_age", "future", "rate_missing")


def fresh_rate(day: str, published: str, p: Params) -> str:
    return f"datediff({day}, {published}) <= {p.fx_max_staleness_days}"


def stale_rates(fct: DataFrame, p: Params = Params()) -> DataFrame:
    """Facts, or days of fx_rates_daily, whose carried rate is older than allowed."""
    day = "txn_date" if "txn_date" in fct.columns else "rate_date"
    published = "fx_rate_published_date" if "fx_rate_published_date" in fct.columns else "published_date"
    return expression_is_true(fct, fresh_rate(day, published, p))


def model_checks(tables: dict[str, DataFrame], p: Params = Params()) -> list[TableChecks]:
    """The checks of the tables that are there, named <table>.<check>.<column>: one scan for each table."""
    out = []
    for table, key in UNIQUE.items():
        if table not in tables:
            continue
        found = {("not_null", c): is_missing(c) for c in [*key, *NOT_NULL.get(table, [])]}
        found |= {("accepted", c): is_other(c, values) for (t, c), values in ACCEPTED.items() if t == table}
        found |= {(kind, c): is_false(rule) for (t, kind, c), rule in RULES.items() if t == table}
        if table == "fct_transactions":
            found |= {("rate_age", "fx_rate_published_date"): is_false(fresh_rate("txn_date", "fx_rate_published_date", p)), ("rate_missing", "fx_rate_to_eur"): is_missing("fx_rate_to_eur")}
        if table == "rpt_merchant_category_spend":
            found["share", "share_of_month_spend"] = is_outside("share_of_month_spend", 0, 1)
        severity = lambda kind: "warn" if kind in WARN else "error"
        parents = {f"{t}.relationships.{c}": (c, tables[parent], severity("relationships")) for (t, c), parent in PARENTS.items() if t == table and parent in tables}
        out.append(TableChecks(tables[table], {f"{table}.{kind}.{c}": (fails, severity(kind)) for (kind, c), fails in found.items()}, tuple(key), f"{table}.unique.{'+'.join(key)}", parents))
    return out
