"""Controls that prove the tables right: file summary, path comparison, reconciliation, accounting, ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.temporal import Hold, as_it_is, latest_by
from ledgerflow.plans.staging import BY_FILE

# Rejection reasons that the file summary counts.
REASONS = ("MISSING_TIMESTAMP", "INVALID_TIMESTAMP", "INVALID_AMOUNT", "NEGATIVE_AMOUNT", "ZERO_AMOUNT", "UNKNOWN_ACCOUNT", "INVALID_DIRECTION", "CURRENCY_MISMATCH")
# End of the fixed values.


def file_summary(validated: DataFrame) -> DataFrame:
    """What each file brought: rows, repeats of rows delivered before, rejections by reason, warnings, late rows.

    Rows without a txn_id are repeats of the first of them, which an aggregate finds: they never meet in one task."""
    file_date = F.try_to_date(F.left(F.right("_source_file", F.lit(15)), F.lit(8)), "yyyyMMdd")
    place = F.struct("_source_file", "_source_row")
    no_id = validated.where("txn_id is null").agg(F.min(place).alias("_first"))
    alone = F.when(F.col("txn_id").isNull(), F.xxhash64("_source_file", "_source_row"))
    nth = F.row_number().over(Window.partitionBy("txn_id", alone).orderBy("_source_file", "_source_row"))
    day = F.col("txn_ts").cast("date")
    rows = validated.withColumns({"file_date": file_date, "nth": nth}).crossJoin(F.broadcast(no_id))
    rows = rows.withColumn("occurrence", F.when(F.col("txn_id").isNotNull(), F.col("nth")).when(place == F.col("_first"), 1).otherwise(2))
    late = (F.col("occurrence") == 1) & F.col("rejection_reason").isNull() & (day < F.date_sub("file_date", 1))
    return rows.groupBy(F.col("_source_file").alias("source_file"), "file_date").agg(
        F.min("_loaded_at").alias("loaded_at"),
        F.count(F.lit(1)).alias("rows_received"),
        F.count_if(F.col("occurrence") > 1).alias("duplicate_rows"),
        F.count("rejection_reason").alias("rejected_rows"),
        *[F.count_if(F.col("rejection_reason") == r).alias(f"rejected_{r.lower()}") for r in REASONS],
        F.count("warning_reason").alias("warning_rows"),
        F.count_if(late).alias("late_arriving_rows"),
        F.min(day).alias("min_txn_date"),
        F.max(day).alias("max_txn_date"),
    )


def stream_vs_batch(stg_stream: DataFrame, stg_txns: DataFrame, hold: Hold = as_it_is) -> DataFrame:
    """Transactions of either path, by day, on the days that the stream saw.

    hold: how the stream's ids and days are held, as they say what is read of the other path, too; each message is
    decoded once then."""
    day = F.col("txn_ts").cast("date")
    streamed = hold(stg_stream.where("txn_id is not null").where(day.isNotNull()).groupBy("txn_id").agg(F.min(day).alias("s_date")))
    days = streamed.select(F.col("s_date").alias("_day")).distinct()
    batch = stg_txns.where("txn_id is not null").join(days, day == F.col("_day"), "left_semi").groupBy("txn_id").agg(F.min(day).alias("b_date"))
    both = streamed.join(batch, "txn_id", "full")
    s, b = F.col("s_date").isNotNull(), F.col("b_date").isNotNull()
    counted = both.groupBy(F.coalesce("s_date", "b_date").alias("txn_date")).agg(
        F.count_if(s).alias("streamed_txns"), F.count_if(b).alias("batch_txns"), F.count_if(s & b).alias("in_both"), F.count_if(s & ~b).alias("stream_only"), F.count_if(b & ~s).alias("batch_only")
    )
    return counted.withColumn("stream_coverage", (F.col("in_both") / F.nullif("batch_txns", F.lit(0))).cast("decimal(7,4)"))


def reconcile(raw: DataFrame, quarantined: DataFrame, fct: DataFrame, from_date=None, to_date=None) -> DataFrame:
    """Daily count and net amount from the landed text, parsed here and nowhere else, against the fact: PASS or FAIL.

    All days are compared, or those from from_date to to_date."""
    own_ts = F.coalesce(F.try_to_timestamp(F.trim("txn_ts"), F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(F.trim("txn_ts"), F.lit("dd/MM/yyyy HH:mm:ss")))
    parsed = raw.select(
        F.trim("txn_id").alias("txn_id"), F.replace(F.trim("amount"), F.lit(","), F.lit(".")).try_cast("decimal(18,2)").alias("amount"), F.upper(F.trim("direction")).alias("direction"), own_ts.cast("date").alias("txn_date"), *BY_FILE
    )
    accepted = latest_by(parsed.join(quarantined.select("_source_file", "_source_row"), ["_source_file", "_source_row"], "left_anti"), ["txn_id"], BY_FILE)
    inside = F.lit(True)
    if from_date is not None:
        inside = inside & (F.col("txn_date") >= F.lit(from_date))
    if to_date is not None:
        inside = inside & (F.col("txn_date") <= F.lit(to_date))
    signed = F.when(F.col("direction") == "DR", -F.col("amount")).otherwise(F.col("amount"))
    source = accepted.where(inside).groupBy("txn_date").agg(F.count(F.lit(1)).alias("source_rows"), F.sum(signed).cast("decimal(18,2)").alias("source_net_amount"))
    target = fct.where(inside).groupBy("txn_date").agg(F.count(F.lit(1)).alias("target_rows"), F.sum("signed_amount").cast("decimal(18,2)").alias("target_net_amount"))
    same = F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col("source_net_amount").eqNullSafe(F.col("target_net_amount"))
    joined = source.join(target, "txn_date", "full")
    return joined.select("txn_date", "source_rows", "target_rows", "source_net_amount", "target_net_amount", F.when(same, "PASS").otherwise("FAIL").alias("status"))


class ReconciliationFailed(RuntimeError):
    pass


def require_reconciled(results: DataFrame) -> None:
    failed = results.where("status = 'FAIL'").count()
    if failed:
        raise ReconciliationFailed(f"{failed} days disagree")


def row_accounting(raw: DataFrame, validated: DataFrame, quarantined: DataFrame, fct: DataFrame) -> DataFrame:
    """Every delivered row is accounted for: one row of counts, and whether they agree."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    valid = F.when(F.col("rejection_reason").isNull(), F.col("txn_id"))
    seen = validated.agg(F.count(F.lit(1)).alias("validated_rows"), F.count("rejection_reason").alias("rejected_rows"), F.countDistinct(valid).alias("valid_txns"))
    one = n(raw, "delivered_rows").crossJoin(seen).crossJoin(n(quarantined, "quarantined_rows")).crossJoin(n(fct, "fact_rows"))
    holds = (F.col("delivered_rows") == F.col("validated_rows")) & (F.col("rejected_rows") == F.col("quarantined_rows")) & (F.col("valid_txns") == F.col("fact_rows"))
    return one.withColumn("all_accounted_for", holds)


def balance_identity(fct: DataFrame, balances: DataFrame, accounts: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Accounts whose last balance isn't opening balance plus posted movements on their balance days."""
    last = latest_by(balances, ["account_id"], ["balance_date"]).select("account_id", "balance_date", "closing_balance")
    moved = fct.where("is_posted").join(balances.select("account_id", F.col("balance_date").alias("txn_date")), ["account_id", "txn_date"], "left_semi").groupBy("account_id").agg(F.sum("signed_amount").alias("moved"))
    both = last.join(accounts.select("account_id", "opening_balance"), "account_id").join(moved, "account_id", "left")
    expected = (F.col("opening_balance") + F.coalesce("moved", F.lit(0))).cast("decimal(18,2)")
    return both.withColumn("expected_balance", expected).where(F.abs(F.col("closing_balance") - F.col("expected_balance")) > tolerance).select("account_id", "balance_date", "closing_balance", "expected_balance")


def unmatched_reversals(fct: DataFrame) -> DataFrame:
    """Reversals without a card payment of the same account and amount."""
    card = fct.where("txn_type = 'CARD_PAYMENT'").select(F.col("txn_id").alias("original_txn_id"), "account_id", "amount")
    return fct.where("txn_type = 'REVERSAL'").join(card, ["original_txn_id", "account_id", "amount"], "left_anti").select("txn_id", "account_id", "original_txn_id", "amount")


def detection_report(injected: DataFrame, found: DataFrame, by: str, key: str) -> DataFrame:
    """For each group: injected and found keys, hits, recall and precision."""
    i = injected.select(by, key).distinct().withColumn("_i", F.lit(1))
    f = found.select(by, key).distinct().withColumn("_f", F.lit(1))
    both = i.join(f, [by, key], "full").groupBy(by).agg(F.count("_i").alias("injected"), F.count("_f").alias("found"), F.count(F.col("_i") + F.col("_f")).alias("hits"))
    return both.withColumns({"recall": F.try_divide("hits", "injected"), "precision": F.try_divide("hits", "found")})


def found_issues(validated: DataFrame, fct: DataFrame) -> DataFrame:
    """issue, txn_id, n: what the tables say is wrong with the rows of an id.

    A rejection, a late first delivery, a warning and a currency in small letters that is left in the fact count once an
    id, DUPLICATE_ROW once for each repeat. Rows without an id are in the quarantine and the file summary alone."""
    file_date = F.try_to_date(F.left(F.right("_source_file", F.lit(15)), F.lit(8)), "yyyyMMdd")
    late = F.col("rejection_reason").isNull() & (F.col("txn_ts").cast("date") < F.date_sub(file_date, 1))
    by_id = validated.where("txn_id is not null").groupBy("txn_id").agg(
        F.count(F.lit(1)).alias("rows"), F.collect_set("rejection_reason").alias("reasons"), F.min_by(late, F.struct("_source_file", "_source_row")).alias("late")
    )
    one = lambda issue, n=1: F.struct(F.lit(issue).alias("issue"), F.lit(n).cast("long").alias("n"))
    repeated = F.when(F.col("rows") > 1, F.struct(F.lit("DUPLICATE_ROW").alias("issue"), (F.col("rows") - 1).alias("n")))
    rejected = F.transform("reasons", lambda r: F.struct(r.alias("issue"), F.lit(1).cast("long").alias("n")))
    of_rows = by_id.select("txn_id", F.explode(F.array_compact(F.concat(rejected, F.array(repeated, F.when(F.col("late"), one("LATE_ARRIVAL")))))).alias("x"))
    of_fact = fct.select("txn_id", F.explode(F.array_compact(F.array(F.when(F.col("warning_reason").isNotNull(), F.struct(F.col("warning_reason").alias("issue"), F.lit(1).cast("long").alias("n"))), F.when(F.col("currency") != F.upper("currency"), one("LOWERCASE_CURRENCY"))))).alias("x"))
    return of_rows.unionByName(of_fact).select("x.issue", "txn_id", "x.n")


def ground_truth(injected: DataFrame, validated: DataFrame, fct: DataFrame) -> DataFrame:
    """What was injected (issue, txn_id; a row for each time) against what was found: a row for each issue.

    injected, found, missing and extra count ids, repeats for DUPLICATE_ROW; passed: nothing is missing or extra. Of
    several faults for which a row is rejected the first rule's is expected. Late rows and warnings are expected of rows
    that aren't rejected; currencies in small letters are expected to be gone."""
    rank = F.coalesce(*[F.when(F.col("issue") == r, F.lit(n)) for n, r in enumerate(REASONS)])
    known = injected.where("txn_id is not null")
    rejected = known.where(rank.isNotNull()).groupBy("txn_id").agg(F.min_by("issue", rank).alias("issue")).select("issue", "txn_id", F.lit(1).cast("long").alias("n"))
    others = known.where(rank.isNull() & (F.col("issue") != "LOWERCASE_CURRENCY")).groupBy("issue", "txn_id").agg(F.count(F.lit(1)).alias("n"))
    repeats = others.where("issue = 'DUPLICATE_ROW'")
    soft = others.where("issue <> 'DUPLICATE_ROW'").join(rejected.select("txn_id"), "txn_id", "left_anti").select("issue", "txn_id", F.lit(1).cast("long").alias("n"))
    zero = F.lit(0).cast("long")
    sides = [
        rejected.unionByName(repeats).unionByName(soft).select("issue", "txn_id", F.col("n").alias("i"), zero.alias("f")),
        found_issues(validated, fct).select("issue", "txn_id", zero.alias("i"), F.col("n").alias("f")),
        injected.select("issue").distinct().select("issue", F.lit(None).cast("string").alias("txn_id"), zero.alias("i"), zero.alias("f")),  # an issue that leaves no row on either side
    ]
    both = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("issue", "txn_id").agg(F.sum("i").alias("i"), F.sum("f").alias("f"))
    gap = F.col("i") - F.col("f")
    counted = both.groupBy("issue").agg(F.sum("i").alias("injected"), F.sum("f").alias("found"), F.sum(F.greatest(gap, zero)).alias("missing"), F.sum(F.greatest(-gap, zero)).alias("extra"))
    return counted.withColumn("passed", (F.col("missing") == 0) & (F.col("extra") == 0))


def case_recall(cases: DataFrame, members: DataFrame) -> DataFrame:
    """Injected cases (rule, case_id, txn_id) found by any of their transactions, and how many alerts hold such ones."""
    hit = cases.join(members.select("txn_id", "rule_code", "alert_id"), (cases.txn_id == members.txn_id) & (cases.rule == F.col("rule_code")), "left").drop(members.txn_id)
    recall = hit.groupBy("rule").agg(F.countDistinct("case_id").alias("cases"), F.countDistinct(F.when(F.col("alert_id").isNotNull(), F.col("case_id"))).alias("cases_found"), F.countDistinct("alert_id").alias("true_alerts"))
    total = members.groupBy(F.col("rule_code").alias("rule")).agg(F.countDistinct("alert_id").alias("alerts"))
    return recall.join(total, "rule", "full").withColumn("precision", F.try_divide("true_alerts", "alerts"))
