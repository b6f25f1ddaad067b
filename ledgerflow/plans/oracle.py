"""The registered queries in DuckDB SQL, formulated apart from the Spark plans: self joins for trailing windows,
correlated lookups for rates and states, recursion for islands."""

TABLES = """
with recursive acc as (
    select 'A' || c_custkey as account_id, 'C' || c_custkey as customer_id, 'DE' || lpad(c_custkey::varchar, 20, '0') as iban,
        case c_custkey % 3 when 0 then 'CHECKING' when 1 then 'SAVINGS' else 'CREDIT_CARD' end as account_type,
        case c_custkey % 10 when 8 then 'USD' when 9 then 'GBP' else 'EUR' end as currency,
        if(c_custkey % 50 = 7, 'CLOSED', 'ACTIVE') as status, c_custkey % 50 <> 7 as is_active, date '2023-06-01' as opened_date,
        if(c_custkey % 50 = 7, date '2024-01-20', null) as closed_date, c_acctbal::decimal(18,2) as opening_balance, timestamp '2023-06-01 00:00:00' as updated_at
    from customer),
base as (
    select 'T' || event_id as txn_id, event_id as i, user_id, date_trunc('second', ts)::timestamp as moment, value::decimal(18,2) as value,
        case when event_type in ('purchase', 'view') then 'CARD_PAYMENT' when event_type = 'signup' then 'CASH_DEPOSIT' when event_type = 'click' then 'SEPA_TRANSFER_OUT' else 'FEE' end as txn_type,
        if(event_type = 'signup', 'CR', 'DR') as direction, if(event_id % 100 = 3, 'DECLINED', 'POSTED') as status,
        if(event_type in ('purchase', 'view') and event_id % 13 <> 0, 'M' || (event_id % (select count(*) from part)), '') as merchant_id, '' as original_txn_id
    from events),
moved as (
    select * from base
    union all
    select 'R' || i, i, user_id, moment + interval 3 day, value, 'REVERSAL', 'CR', 'POSTED', merchant_id, 'T' || i from base where txn_type = 'CARD_PAYMENT' and i % 211 = 0),
sent as (select *, (moment::date + if(i % 50 = 1, 5, 1)::int)::date as day, (moment::date + if(i % 50 = 1, 5, 1)::int)::timestamp + interval 6 hour as loaded from moved),
delivered as (select * from sent union all select * replace ((day + 1)::date as day, loaded - interval 1 hour as loaded) from sent where i % 97 = 0),
dirty as (
    select txn_id, if(i % 349 = 4, 'A999999999', 'A' || user_id) as account_id,
        case when i % 353 = 5 then null when i % 367 = 7 then '  ' when i % 7 = 0 then strftime(moment, '%d/%m/%Y %H:%M:%S') else strftime(moment, '%Y-%m-%d %H:%M:%S') end as txn_ts,
        case when i % 331 = 1 then 'N/A' when i % 337 = 2 then '-' || value when i % 347 = 3 then '0.00' else value::varchar end as plain,
        case user_id % 10 when 8 then 'USD' when 9 then 'GBP' else 'EUR' end as ccy, if(i % 359 = 6, 'XX', direction) as direction, txn_type, status,
        if(txn_type = 'CARD_PAYMENT', 'card ', 'BRANCH') as channel, merchant_id, original_txn_id, ' payment ' || i as description, if(i % 5 = 0, '', 'dev' || user_id) as device_id,
        'transactions/transactions_' || strftime(day, '%Y%m%d') || '.csv.gz' as _source_file, i, loaded as _loaded_at
    from delivered),
raw as (
    select txn_id, account_id, txn_ts, if(i % 7 = 0, replace(plain, '.', ','), plain) as amount, if(i % 11 = 0, lower(ccy), ccy) as currency, direction, txn_type, status, channel, merchant_id,
        '' as counterparty_iban, original_txn_id, description, device_id, _source_file, 2 * i + if(txn_id like 'T%', 2, 1) as _source_row, _loaded_at, i
    from dirty),
stg as (
    select trim(txn_id) as txn_id, trim(account_id) as account_id, coalesce(try_strptime(txn_ts, '%Y-%m-%d %H:%M:%S'), try_strptime(txn_ts, '%d/%m/%Y %H:%M:%S'))::timestamp as txn_ts,
        try_cast(replace(amount, ',', '.') as decimal(18,2)) as amount, upper(currency) as currency, direction, txn_type, status, upper(trim(channel)) as channel, nullif(merchant_id, '') as merchant_id,
        nullif(counterparty_iban, '') as counterparty_iban, nullif(original_txn_id, '') as original_txn_id, trim(description) as description, nullif(device_id, '') as device_id, txn_ts as txn_ts_raw,
        amount as amount_raw, _source_file, _source_row, _loaded_at, i
    from raw),
val as (
    select s.*, a.customer_id, case
            when s.txn_id is null or s.txn_id = '' then 'MISSING_TXN_ID' when s.txn_ts_raw is null then 'MISSING_TIMESTAMP' when s.txn_ts is null then 'INVALID_TIMESTAMP' when s.amount is null then 'INVALID_AMOUNT'
            when s.amount < 0 then 'NEGATIVE_AMOUNT' when s.amount = 0 then 'ZERO_AMOUNT' when a.account_id is null then 'UNKNOWN_ACCOUNT' when coalesce(s.direction, '') not in ('DR', 'CR') then 'INVALID_DIRECTION'
            when s.currency <> a.currency then 'CURRENCY_MISMATCH' end as rejection_reason,
        case when s.txn_type = 'CARD_PAYMENT' and s.merchant_id is null then 'MISSING_MERCHANT' end as warning_reason
    from stg s left join acc a on a.account_id = s.account_id),
rejected as (select txn_id, account_id, txn_ts_raw, amount_raw, currency, direction, txn_type, rejection_reason, _source_file, _source_row, _loaded_at from val where rejection_reason is not null),
business as (
    select d::date as d from (select unnest(generate_series(min(ts)::date::timestamp, max(ts)::date::timestamp, interval 1 day)) as d from events) where isodow(d) <= 5),
published as (
    select d as rate_date, c as currency, ((900 + (d - date '2024-01-01') % 17) / 1000.0)::decimal(18,8) as rate from business, (values ('USD'), ('GBP')) v(c)),
calendar as (select unnest(generate_series(min(rate_date)::timestamp, max(rate_date)::timestamp + interval 7 day, interval 1 day))::date as rate_date from published),
fx as (
    select c.rate_date, v.c as currency, case when v.c = 'EUR' then 1::decimal(18,8) else (select p.rate from published p where p.currency = v.c and p.rate_date <= c.rate_date order by p.rate_date desc limit 1) end as rate_to_eur,
        case when v.c = 'EUR' then c.rate_date else (select max(p.rate_date) from published p where p.currency = v.c and p.rate_date <= c.rate_date) end as published_date
    from calendar c, (values ('EUR'), ('USD'), ('GBP')) v(c)),
fxd as (select rate_date, currency, rate_to_eur, published_date, rate_date <> published_date as is_carried_forward from fx),
kept as (select * from val where rejection_reason is null qualify row_number() over (partition by txn_id order by _source_file desc, _loaded_at desc, _source_row desc) = 1),
fct as (
    select k.txn_id, k.account_id, k.customer_id, k.txn_ts, k.txn_ts::date as txn_date, k.txn_type, case k.txn_type when 'CARD_PAYMENT' then 'SPEND' when 'REVERSAL' then 'SPEND' when 'CASH_DEPOSIT' then 'CASH' when 'SEPA_TRANSFER_OUT' then 'TRANSFER' when 'FEE' then 'FEE' end as txn_category,
        k.direction, k.status, k.channel, k.merchant_id, k.counterparty_iban, k.original_txn_id, k.currency, k.amount, if(k.direction = 'DR', -k.amount, k.amount)::decimal(18,2) as signed_amount,
        f.rate_to_eur as fx_rate_to_eur, f.published_date as fx_rate_published_date, (k.amount * f.rate_to_eur)::decimal(18,2) as amount_eur, (if(k.direction = 'DR', -k.amount, k.amount) * f.rate_to_eur)::decimal(18,2) as signed_amount_eur,
        k.status = 'POSTED' as is_posted, k.warning_reason, k.device_id, k.description, k._source_file, k._source_row, k._loaded_at
    from kept k left join fxd f on f.currency = k.currency and f.rate_date = k.txn_ts::date),
days as (select unnest(generate_series((select min(txn_date) from fct)::timestamp, (select max(txn_date) from fct)::timestamp, interval 1 day))::date as balance_date),
bal as (
    select a.account_id, d.balance_date, a.currency,
        coalesce((select sum(signed_amount) from fct f where f.is_posted and f.account_id = a.account_id and f.txn_date = d.balance_date), 0)::decimal(18,2) as net_amount,
        coalesce((select sum(amount) from fct f where f.is_posted and f.direction = 'CR' and f.account_id = a.account_id and f.txn_date = d.balance_date), 0)::decimal(18,2) as credit_amount,
        coalesce((select sum(amount) from fct f where f.is_posted and f.direction = 'DR' and f.account_id = a.account_id and f.txn_date = d.balance_date), 0)::decimal(18,2) as debit_amount,
        coalesce((select count(*) from fct f where f.is_posted and f.account_id = a.account_id and f.txn_date = d.balance_date), 0)::bigint as posted_txn_count,
        a.opening_balance
    from acc a join days d on d.balance_date >= a.opened_date and d.balance_date <= coalesce(a.closed_date, date '9999-01-01')),
balances as (
    select b.* exclude (opening_balance), (b.opening_balance + sum(net_amount) over (partition by b.account_id order by b.balance_date))::decimal(18,2) as closing_balance,
        ((b.opening_balance + sum(net_amount) over (partition by b.account_id order by b.balance_date))::decimal(18,2) * f.rate_to_eur)::decimal(18,2) as closing_balance_eur, (select max(_loaded_at) from fct) as source_loaded_through
    from bal b left join fxd f on f.currency = b.currency and f.rate_date = b.balance_date),
feed as (
    select 'C' || o_custkey as customer_id, (o_orderdate + to_seconds(row_number() over (partition by o_custkey, o_orderdate order by o_orderkey)))::timestamp as updated_at,
        case o_orderstatus when 'F' then 'RETAIL' when 'O' then 'PRIVATE' when 'P' then 'BUSINESS' end as segment,
        case left(o_orderpriority, 1) when '1' then 'HIGH' when '2' then 'HIGH' when '3' then 'MEDIUM' else 'LOW' end as risk_rating, o_orderkey, o_custkey
    from orders),
turns as (select *, lag(segment || '/' || risk_rating) over (partition by customer_id order by updated_at) as was from feed),
states as (
    select customer_id, o_custkey, segment, risk_rating, updated_at as valid_from, lead(updated_at) over (partition by customer_id order by updated_at) as valid_to
    from turns where was is null or was <> segment || '/' || risk_rating),
hits as (
    select 'STRUCTURING' as rule_code, 1440 as minutes, 2 as least, account_id, txn_id, txn_ts, amount_eur from fct where txn_type = 'CASH_DEPOSIT' and is_posted and amount_eur >= 20 and amount_eur < 100
    union all
    select 'VELOCITY', 720, 3, account_id, txn_id, txn_ts, amount_eur from fct where txn_type = 'CARD_PAYMENT'),
anchors as (
    select a.rule_code, a.minutes, a.account_id, a.txn_id, a.txn_ts, a.least
    from hits a join hits b on a.rule_code = b.rule_code and a.account_id = b.account_id and b.txn_ts <= a.txn_ts and b.txn_ts > a.txn_ts - to_minutes(a.minutes)
    group by all having count(*) >= a.least),
numbered as (select *, row_number() over (partition by rule_code, account_id order by txn_ts, txn_id) as n from anchors),
chains as (
    select *, txn_id as anchor_id from numbered where n = 1
    union all
    select x.*, if(c.txn_ts > x.txn_ts - to_minutes(x.minutes), c.anchor_id, x.txn_id) from chains c join numbered x on x.rule_code = c.rule_code and x.account_id = c.account_id and x.n = c.n + 1),
merged as (
    select distinct c.rule_code, c.account_id, c.anchor_id as alert_anchor_txn_id, h.txn_id, h.txn_ts, h.amount_eur
    from chains c join hits h on h.rule_code = c.rule_code and h.account_id = c.account_id and h.txn_ts <= c.txn_ts and h.txn_ts > c.txn_ts - to_minutes(c.minutes)),
card as (select *, ln(amount_eur::double) as v, row_number() over (partition by account_id order by txn_ts, txn_id) as n from fct where txn_type = 'CARD_PAYMENT' and is_posted and amount_eur > 0),
scored as (
    select c.account_id, c.txn_id, c.txn_ts, c.amount_eur, count(p.v) as n_before, (c.v - avg(p.v)) / nullif(stddev_samp(p.v), 0) as z
    from card c join card p on p.account_id = c.account_id and p.n between c.n - 50 and c.n - 1 group by c.account_id, c.txn_id, c.txn_ts, c.amount_eur, c.v),
outliers as (select 'OUTLIER' as rule_code, account_id, txn_id as alert_anchor_txn_id, txn_id, txn_ts, amount_eur from scored where n_before >= 10 and z >= 2),
members as (select md5(rule_code || '|' || account_id || '|' || alert_anchor_txn_id) as alert_id, * from (select * from merged union all select * from outliers)),
merch as (
    select 'M' || p_partkey as merchant_id, p_name as merchant_name, m.mcc, coalesce(k.description, 'Unknown') as mcc_description, coalesce(k.category, 'Other') as spend_category, case p_size % 4 when 0 then 'DE' when 1 then 'FR' when 2 then 'ES' else 'IT' end as country_code
    from part join (select unnest(range(0, 20)) as r, unnest(['5411','5812','5814','5541','4111','4121','5311','5651','5732','5912','4814','4900','5942','7832','4511','7011','5200','5999','0000','0001']) as mcc) m on m.r = p_partkey % 20
    left join (values ('5411','Grocery stores and supermarkets','Groceries'), ('5812','Restaurants','Dining'), ('5814','Fast food','Dining'), ('5541','Service stations','Transport'), ('4111','Commuter transport','Transport'),
        ('4121','Taxis and rideshare','Transport'), ('5311','Department stores','Shopping'), ('5651','Clothing stores','Shopping'), ('5732','Electronics stores','Shopping'), ('5912','Pharmacies','Health'), ('4814','Telecommunication services','Bills'),
        ('4900','Utilities','Bills'), ('5942','Book stores','Leisure'), ('7832','Cinemas','Leisure'), ('4511','Airlines','Travel'), ('7011','Hotels and lodging','Travel'), ('5200','Home supply stores','Home'), ('5999','Miscellaneous retail','Shopping')) k(mcc, description, category) on k.mcc = m.mcc),
undone as (select distinct original_txn_id as txn_id from fct where txn_type = 'REVERSAL' and is_posted and original_txn_id is not null),
once as (select *, row_number() over (partition by txn_id order by _source_file, _source_row) as occurrence, try_strptime(left(right(_source_file, 15), 8), '%Y%m%d')::date as file_date from val),
streamed as (
    select r.*, (substr(txn_id, 2)::bigint % 3)::bigint as part from (select distinct on (txn_id) * from raw where txn_id like 'T%' order by txn_id, _source_file) r),
placed as (select *, i // 3 as place, i % 500 <> 10 as whole from streamed),
heard as (select * from placed where whole and i % 4 <> 0),
paths as (
    select 'T' || o_orderkey as txn_id, 'A' || o_custkey as account_id, o_totalprice::decimal(18,2) as amount, if(o_orderkey % 11 = 0, 'DECLINED', 'POSTED') as status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as txn_ts_raw, path as ingest_path,
        if(path = 'KAFKA', o_orderdate::timestamp, null) as produced_at, (o_orderdate + to_seconds(o_orderkey % 60))::timestamp as landed_at, if(path = 'FILE', 'f0', null) as _source_file, o_orderkey
    from orders, (values ('FILE'), ('KAFKA')) p(path) where o_orderkey % 5 = 0 or (path = 'FILE') = (o_orderkey % 2 = 0)),
large as (select * from paths where status = 'POSTED' and amount >= 400000)
"""

_MONEY_EVENTS = "select event_id, user_id, ts::timestamp as ts, value::decimal(18,2) as amount from events"
_FIELDS = "txn_id, account_id, txn_ts, amount, currency, direction, txn_type, status, channel, merchant_id, counterparty_iban, original_txn_id, description, device_id".split(", ")
_JSON = " || ',' || ".join(f"""'"{c}":' || coalesce('"' || replace(nullif({c}, ''), '/', '/') || '"', 'null')""" for c in _FIELDS)
_BATCHES = """
one as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice::decimal(18,2) as amount, o_orderdate::date as order_date, 1::bigint as delivery from orders where o_orderkey % 3 <> 0),
two as (select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice::decimal(18,2) as amount, o_orderdate::date as order_date, 2::bigint as delivery from orders where o_orderkey % 3 = 0 or o_orderkey % 5 = 0)
"""
_REASONS = ["MISSING_TIMESTAMP", "INVALID_TIMESTAMP", "INVALID_AMOUNT", "NEGATIVE_AMOUNT", "ZERO_AMOUNT", "UNKNOWN_ACCOUNT", "INVALID_DIRECTION", "CURRENCY_MISMATCH"]


def _ratio(over: str, under: str, scale: int, kind: str) -> str:
    """over / under, rounded half up in whole numbers: DuckDB divides decimals as doubles, which misplaces ties."""
    a, b = f"(({over}) * 100)::hugeint", f"nullif((({under}) * 100)::hugeint, 0)"
    return f"(sign({a}) * sign({b}) * ((2 * abs({a}) * {10**scale} + abs({b})) // (2 * abs({b}))) / {10**scale})::{kind}"


_QUERIES = {
    "stg_transactions_typed": "select * exclude (i) from stg",
    "stg_customers_typed": """select customer_id, 'First' || o_custkey as first_name, 'Last' || o_custkey as last_name, 'user' || o_custkey || '@example.com' as email, date '1980-02-29' as birth_date, 'DE' as country_code, segment, risk_rating,
        'VERIFIED' as kyc_status, timestamp '1994-12-31 00:00:00' as created_at, updated_at, 'customers/customers_' || strftime(updated_at, '%Y%m%d') || '.csv.gz' as _source_file, o_orderkey as _source_row, date_trunc('day', updated_at)::timestamp as _loaded_at from feed""",
    "stg_fx_latest": "select rate_date, currency, rate as rate_to_eur, 'ECB' as source from published",
    "stg_stream_typed": """select if(whole, p.txn_id, null) as txn_id, if(whole, s.account_id, null) as account_id, if(whole, s.txn_ts, null) as txn_ts, if(whole, s.amount, null) as amount, if(whole, s.currency, null) as currency, if(whole, s.direction, null) as direction,
        if(whole, s.txn_type, null) as txn_type, if(whole, s.status, null) as status, (epoch_ms(1706745600000 + p.i * 1000))::timestamp as produced_at, part as _kafka_partition, place as _kafka_offset
        from placed p join stg s on s.txn_id = p.txn_id and s._source_file = p._source_file and s._source_row = p._source_row""",
    "txn_validated": "select txn_id, _source_file, _source_row, rejection_reason, warning_reason from val",
    "txn_quarantine": "select * from rejected",
    "txn_reason_counts": "select rejection_reason, count(*) as n from rejected group by all",
    "txn_latest_version": "select s.txn_id, s._source_file, s._loaded_at from stg s where not exists (select 1 from stg t where t.txn_id = s.txn_id and (t._source_file, t._loaded_at) > (s._source_file, s._loaded_at))",
    "fx_daily_fill": "select * from fxd",
    "dim_date": """select d::date as date_day, year(d) as year_number, quarter(d) as quarter_number, month(d) as month_number, day(d) as day_of_month, isodow(d) as iso_day_of_week, isodow(d) > 5 as is_weekend, date_trunc('month', d)::date as month_start_date,
        last_day(d) as month_end_date from (select unnest(generate_series(make_date((select min(year(o_orderdate)) from orders), 1, 1)::timestamp, make_date((select max(year(o_orderdate)) from orders), 12, 31)::timestamp, interval 1 day)) as d)""",
    "dim_account": "select * from acc",
    "dim_merchant": "select * from merch",
    "customer_scd2": """select md5(customer_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) as customer_version_key, customer_id, 'First' || o_custkey as first_name, 'Last' || o_custkey as last_name, 'user' || o_custkey || '@example.com' as email,
        date '1980-02-29' as birth_date, 'DE' as country_code, segment, risk_rating, 'VERIFIED' as kyc_status, timestamp '1994-12-31 00:00:00' as created_at, valid_from, valid_to, valid_to is null as is_current from states""",
    "customer_as_of": """select o_orderkey, 'C' || o_custkey as customer_id, (select segment from states s where s.customer_id = 'C' || orders.o_custkey and s.valid_from <= o_orderdate + interval 12 hour order by valid_from desc limit 1) as segment,
        (select risk_rating from states s where s.customer_id = 'C' || orders.o_custkey and s.valid_from <= o_orderdate + interval 12 hour order by valid_from desc limit 1) as risk_rating from orders""",
    "customer_month_end": """select customer_id, month_start, arg_max(segment, valid_from) as segment, arg_max(risk_rating, valid_from) as risk_rating
        from (select distinct 'C' || o_custkey as customer_id, date_trunc('month', o_orderdate)::date as month_start from orders) m join states s using (customer_id) where s.valid_from < month_start + interval 1 month group by all""",
    "fct_transactions": "select * from fct",
    "account_daily_balance": "select * from balances",
    "account_daily_balance_incremental": """select * replace (if(balance_date < (select min(txn_date) from fct where _loaded_at > (select max(_loaded_at) from kept_early)), (select max(_loaded_at) from kept_early), source_loaded_through) as source_loaded_through) from balances""",
    "aml_structuring": "select * from merged where rule_code = 'STRUCTURING'",
    "aml_velocity": "select * from merged where rule_code = 'VELOCITY'",
    "aml_outlier": "select * from outliers",
    "aml_alert_members": "select * from members",
    "aml_alerts": """select alert_id, rule_code, account_id, customer_id, segment as customer_segment_at_alert, risk_rating as customer_risk_rating_at_alert, a as alert_start_ts, b as alert_end_ts, b::date as alert_date, n as txn_count, total as total_amount_eur,
        case when rule_code = 'STRUCTURING' or risk_rating = 'HIGH' then 'HIGH' when total >= 5000 then 'MEDIUM' else 'LOW' end as severity
        from (select alert_id, rule_code, account_id, min(txn_ts) as a, max(txn_ts) as b, count(*) as n, sum(amount_eur)::decimal(18,2) as total from members group by all) join acc using (account_id)
        left join states s using (customer_id) where s.customer_id is null or s.valid_from = (select max(valid_from) from states t where t.customer_id = acc.customer_id and t.valid_from <= b)""",
    "monthly_customer_summary": f"""select customer_id, month_start, segment, risk_rating, posted_txn_count, income_eur, card_spend_eur, inflow as external_inflow_eur, outflow as external_outflow_eur, (inflow - outflow)::decimal(18,2) as net_external_flow_eur, distinct_merchants,
            avg_daily_balance_eur, month_end_balance_eur, lag(card_spend_eur) over (partition by customer_id order by month_start) as prior_month_card_spend_eur,
            round(percent_rank() over (partition by month_start, segment order by card_spend_eur), 6) as card_spend_percentile_in_segment
        from (select m.customer_id, m.month_start, s.segment, s.risk_rating, coalesce(n, 0)::bigint as posted_txn_count, coalesce(income, 0)::decimal(18,2) as income_eur, coalesce(spend, 0)::decimal(18,2) as card_spend_eur, coalesce(inflow, 0)::decimal(18,2) as inflow,
                coalesce(outflow, 0)::decimal(18,2) as outflow, coalesce(merchants, 0)::bigint as distinct_merchants, avg_daily_balance_eur, month_end_balance_eur
            from (select customer_id, date_trunc('month', balance_date)::date as month_start, {_ratio('sum(closing_balance_eur)', 'count(closing_balance_eur)', 2, 'decimal(18,2)')} as avg_daily_balance_eur, arg_max(closing_balance_eur, balance_date)::decimal(18,2) as month_end_balance_eur
                from balances join acc using (account_id) group by all) m
            left join (select customer_id, date_trunc('month', txn_date)::date as month_start, count(*) as n, sum(amount_eur) filter (txn_category = 'INCOME') as income, sum(amount_eur) filter (txn_type = 'CARD_PAYMENT' and txn_id not in (from undone)) as spend,
                    sum(amount_eur) filter (direction = 'CR') as inflow, sum(amount_eur) filter (direction = 'DR' and txn_id not in (from undone)) as outflow, count(distinct merchant_id) as merchants
                from fct where is_posted and txn_type not in ('REVERSAL', 'INTERNAL_TRANSFER') group by all) t using (customer_id, month_start)
            left join states s on s.customer_id = m.customer_id and s.valid_from = (select max(valid_from) from states x where x.customer_id = m.customer_id and x.valid_from < m.month_start + interval 1 month))""",
    "merchant_category_spend": f"""select month_start, spend_category, merchant_country, n as txn_count, customers as active_customers, spend as spend_eur, {_ratio('spend', 'n', 2, 'decimal(18,2)')} as avg_ticket_eur,
            {_ratio('spend', 'sum(spend) over (partition by month_start)', 6, 'decimal(9,6)')} as share_of_month_spend, prior as prior_month_spend_eur, {_ratio('spend - prior', 'prior', 6, 'decimal(12,6)')} as mom_growth
        from (select *, lag(spend) over (partition by spend_category, merchant_country order by month_start) as prior from (
            select date_trunc('month', txn_date)::date as month_start, coalesce(spend_category, 'Unknown') as spend_category, coalesce(country_code, 'UNKNOWN') as merchant_country, count(*) as n, count(distinct customer_id) as customers, sum(amount_eur)::decimal(18,2) as spend
            from fct left join merch using (merchant_id) where txn_type = 'CARD_PAYMENT' and is_posted and txn_id not in (from undone) group by all))""",
    "file_summary": f"""select _source_file as source_file, file_date, min(_loaded_at) as loaded_at, count(*) as rows_received, count(*) filter (occurrence > 1) as duplicate_rows, count(rejection_reason) as rejected_rows,
        {', '.join(f"count(*) filter (rejection_reason = '{r}') as rejected_{r.lower()}" for r in _REASONS)}, count(warning_reason) as warning_rows,
        count(*) filter (occurrence = 1 and rejection_reason is null and txn_ts::date < file_date - 1) as late_arriving_rows, min(txn_ts::date) as min_txn_date, max(txn_ts::date) as max_txn_date from once group by _source_file, file_date""",
    "stream_vs_batch": """select txn_date, count(s) as streamed_txns, count(b) as batch_txns, count(*) filter (s = b or (s is not null and b is not null)) as in_both, count(*) filter (b is null) as stream_only, count(*) filter (s is null) as batch_only,
            (count(*) filter (s is not null and b is not null) / nullif(count(b), 0))::decimal(7,4) as stream_coverage
        from (select coalesce(s.txn_id, b.txn_id) as t, s.txn_id as s, b.txn_id as b, coalesce(s.d, b.d) as txn_date
            from (select x.txn_id, min(x.txn_ts::date) as d from heard p join stg x on x.txn_id = p.txn_id where x.txn_ts < timestamp '2024-01-24 00:00:00' group by all) s
            full join (select txn_id, min(txn_ts::date) as d from stg where txn_ts::date in (select x.txn_ts::date from heard p join stg x on x.txn_id = p.txn_id where x.txn_ts < timestamp '2024-01-24 00:00:00') group by all) b on s.txn_id = b.txn_id)
        group by all""",
    "reconciliation": """select txn_date, n as source_rows, n as target_rows, net as source_net_amount, net as target_net_amount, 'PASS' as status
        from (select txn_date, count(*) as n, sum(signed_amount)::decimal(18,2) as net from fct group by all)""",
    "row_accounting": """select (select count(*) from raw) as delivered_rows, (select count(*) from val) as validated_rows, (select count(*) from rejected) as rejected_rows, (select count(distinct txn_id) from val where rejection_reason is null) as valid_txns,
        (select count(*) from rejected) as quarantined_rows, (select count(*) from fct) as fact_rows, true as all_accounted_for""",
    "balance_identity": """select account_id, balance_date, (closing_balance + 1)::decimal(18,2) as closing_balance, closing_balance as expected_balance from balances b
        where substr(account_id, 2)::bigint % 9 = 0 and balance_date = (select max(balance_date) from balances c where c.account_id = b.account_id)""",
    "reversal_match": """select r.txn_id, r.account_id, r.original_txn_id, r.amount from (select * replace (if(substr(txn_id, 2)::bigint % 10 = 0, amount + 1, amount)::decimal(18,2) as amount) from fct where txn_type = 'REVERSAL') r
        where not exists (select 1 from fct c where c.txn_id = r.original_txn_id and c.txn_type = 'CARD_PAYMENT' and c.account_id = r.account_id and c.amount = r.amount)""",
    "aml_case_recall": """select rule, count(distinct case_id) as cases, count(distinct if(alert_id is not null, case_id, null)) as cases_found, count(distinct alert_id) as true_alerts, any_value(alerts) as alerts, round(count(distinct alert_id) / any_value(alerts), 6) as precision
        from (select rule_code as rule, account_id || '|' || strftime(txn_ts, '%Y-%m-%d') as case_id, txn_id, count(*) over (partition by rule_code, account_id, txn_ts::date) as n from hits) h
        left join (select rule_code, txn_id, alert_id from members) m on m.rule_code = h.rule and m.txn_id = h.txn_id
        join (select rule_code, count(distinct alert_id) as alerts from members group by all) a on a.rule_code = h.rule
        where n >= if(rule = 'VELOCITY', 3, 2) group by rule
        union all select rule_code, null, null, null, count(distinct alert_id), null from members where rule_code = 'OUTLIER' group by all""",
    "fx_stale_rates": "select * from fxd where rate_date - published_date > 4",
    "model_check_results": """select * from (values ('fct_transactions.unique.txn_id', 'error'), ('fct_transactions.not_null.txn_id', 'error'), ('fct_transactions.not_null.amount', 'error'), ('fct_transactions.not_null.txn_category', 'error'),
            ('dim_account.unique.account_id', 'error'), ('dim_account.not_null.account_id', 'error'), ('dim_account.not_null.customer_id', 'error'), ('dim_merchant.unique.merchant_id', 'error'), ('dim_merchant.not_null.merchant_id', 'error'),
            ('dim_account.accepted.account_type', 'warn'), ('fct_transactions.accepted.warning_reason', 'warn'), ('fct_transactions.relationships.account_id', 'warn'), ('fct_transactions.relationships.merchant_id', 'warn'),
            ('fct_transactions.rate_age.fx_rate_published_date', 'warn'), ('fct_transactions.future.txn_ts', 'warn'), ('fct_transactions.rate_missing.fx_rate_to_eur', 'warn'), ('fct_transactions.positive.amount', 'error')) v("check", severity),
        lateral (select case "check" when 'fct_transactions.relationships.merchant_id' then (select count(*) from fct where merchant_id not in (select merchant_id from merch)) when 'fct_transactions.rate_age.fx_rate_published_date' then (select count(*) from fct where txn_date - fx_rate_published_date > 4)
            when 'fct_transactions.future.txn_ts' then (select count(*) from fct where txn_ts > _loaded_at) when 'fct_transactions.rate_missing.fx_rate_to_eur' then (select count(*) from fct where fx_rate_to_eur is null) when 'fct_transactions.not_null.txn_category' then (select count(*) from fct where txn_category is null) else 0 end as failing)""",
    "ground_truth_report": """select issue, count(*) filter (w)::bigint as injected, count(*) filter (g)::bigint as found, count(*) filter (w and not g)::bigint as missing, count(*) filter (g and not w)::bigint as extra, count(*) filter (w <> g) = 0 as passed
        from (
            select issue, txn_id, want as w, case issue
                    when 'DUPLICATE_ROW' then (select count(*) from val v where v.txn_id = p.txn_id) > 1
                    when 'LATE_ARRIVAL' then exists (select 1 from once o where o.txn_id = p.txn_id and occurrence = 1 and rejection_reason is null and txn_ts::date < file_date - 1)
                    when 'MISSING_MERCHANT' then exists (select 1 from fct f where f.txn_id = p.txn_id and f.warning_reason = 'MISSING_MERCHANT')
                    when 'LOWERCASE_CURRENCY' then exists (select 1 from fct f where f.txn_id = p.txn_id and f.currency <> upper(f.currency))
                    else exists (select 1 from rejected r where r.txn_id = p.txn_id and r.rejection_reason = issue) end as g
            from (select distinct txn_id, issue, case issue when 'DUPLICATE_ROW' then i % 97 = 0 when 'LATE_ARRIVAL' then i % 50 = 1 and fault is null when 'MISSING_MERCHANT' then txn_type = 'CARD_PAYMENT' and i % 13 = 0 and fault is null
                    when 'LOWERCASE_CURRENCY' then false else coalesce(fault = issue, false) end as want
                from (select txn_id, txn_type, i, case when i % 353 = 5 then 'MISSING_TIMESTAMP' when i % 367 = 7 then 'INVALID_TIMESTAMP' when i % 331 = 1 then 'INVALID_AMOUNT' when i % 337 = 2 then 'NEGATIVE_AMOUNT'
                        when i % 347 = 3 then 'ZERO_AMOUNT' when i % 349 = 4 then 'UNKNOWN_ACCOUNT' when i % 359 = 6 then 'INVALID_DIRECTION' end as fault from raw),
                    (values ('INVALID_AMOUNT'), ('NEGATIVE_AMOUNT'), ('ZERO_AMOUNT'), ('UNKNOWN_ACCOUNT'), ('MISSING_TIMESTAMP'), ('INVALID_DIRECTION'), ('INVALID_TIMESTAMP'), ('DUPLICATE_ROW'), ('LATE_ARRIVAL'), ('MISSING_MERCHANT'), ('LOWERCASE_CURRENCY')) k(issue)) p)
        group by issue""",
    "detection_report": """select rejection_reason, count(distinct p) as injected, count(distinct f) as found, count(distinct if(f is not null, p, null)) as hits, round(count(distinct if(f is not null, p, null)) / count(distinct p), 6) as recall,
            round(count(distinct if(p is not null, f, null)) / nullif(count(distinct f), 0), 6) as precision
        from (select coalesce(a.r, b.r) as rejection_reason, a.txn_id as p, b.txn_id as f from (
                select txn_id, unnest(list_filter([if(i % 331 = 1, 'INVALID_AMOUNT', null), if(i % 337 = 2, 'NEGATIVE_AMOUNT', null), if(i % 347 = 3, 'ZERO_AMOUNT', null), if(i % 349 = 4, 'UNKNOWN_ACCOUNT', null), if(i % 353 = 5, 'MISSING_TIMESTAMP', null),
                    if(i % 359 = 6, 'INVALID_DIRECTION', null), if(i % 367 = 7, 'INVALID_TIMESTAMP', null)], lambda x: x is not null)) as r from raw) a
            full join (select txn_id, rejection_reason as r from rejected) b on a.txn_id = b.txn_id and a.r = b.r) group by all""",
    "incremental_upsert": "select * from two union all select * from one where o_orderkey not in (select o_orderkey from two)",
    "incremental_equals_rebuild": """select o_orderkey, o_custkey, if(side = 'right', '?', o_orderstatus) as o_orderstatus, amount, order_date, side
        from (select * from two union all select * from one where o_orderkey not in (select o_orderkey from two)), (values ('left'), ('right')) s(side) where o_orderkey % 100 = 7""",
    "account_snapshot": """select account_id, segment, moment as updated_at, moment as valid_from, lead(moment) over (partition by account_id order by moment) as valid_to from (
        select 'A' || c_custkey as account_id, c_mktsegment as segment, timestamp '2024-01-01 00:00:00' as moment from customer
        union all select 'A' || c_custkey, c_mktsegment, timestamp '2024-01-10 00:00:00' from customer where c_custkey % 2 = 0
        union all select 'A' || c_custkey, c_mktsegment, timestamp '2024-01-20 00:00:00' from customer where c_custkey % 3 = 0)""",
    "large_txn_alerts": "select txn_id, account_id, amount, 'EUR' as currency, 'FEE' as txn_type, txn_ts_raw, _source_file, ingest_path, produced_at, landed_at from large where txn_ts_raw >= '1998-01-01'",
    "missed_stream_alerts": "select txn_id, ingest_path, amount from large where ingest_path = 'FILE' and o_orderkey % 5 = 0 and o_orderkey % 3 = 0",
    "stream_latency": """select leg, count(*) as n, round(quantile_cont(s, 0.5), 6) as p50_s, round(quantile_cont(s, 0.95), 6) as p95_s, round(max(s), 6) as max_s
        from (select unnest(['produced_to_landed', 'landed_to_alert', 'produced_to_alert']) as leg, unnest([(o_orderkey % 60)::double, 90.0::double, (o_orderkey % 60 + 90)::double]) as s from large where ingest_path = 'KAFKA') group by leg""",
    "exactly_once_check": """select part as partition, landed, distinct_offsets, min_offset, max_offset, (select count(*) from placed q where q.part = p.part and not whole and (q.part = 0 or q.place % 1000 <> 999)) + if(part = 1, (select count(*) from placed q where q.part = 1 and q.place % 700 = 699 and q.place % 1000 <> 999 and not whole), 0) as unparseable,
            0::bigint as low, high, landed = high and distinct_offsets = high and min_offset = 0 and max_offset = high - 1 as ok
        from (select part, count(*) filter (part = 0 or place % 1000 <> 999) + if(part = 1, count(*) filter (place % 700 = 699 and place % 1000 <> 999), 0) as landed, count(*) filter (part = 0 or place % 1000 <> 999) as distinct_offsets,
            min(place) filter (part = 0 or place % 1000 <> 999) as min_offset, max(place) filter (part = 0 or place % 1000 <> 999) as max_offset, max(place) + 1 as high from placed group by part) p""",
    "event_encode": f"select account_id as key, '{{' || {_JSON} || '}}' as value from raw",
    "event_decode": "select "
    + ", ".join(f"if(whole, nullif({c}, ''), null) as {c}" for c in _FIELDS)
    + f", part as _kafka_partition, place as _kafka_offset, if(whole, null, left('{{' || {_JSON} || '}}', length('{{' || {_JSON} || '}}') // 2)) as _raw_value, not whole as failed from placed",
    "running_balance_window": f"select a.event_id, a.user_id, a.ts, a.amount, sum(b.amount)::decimal(18,2) as running_balance from ({_MONEY_EVENTS}) a join ({_MONEY_EVENTS}) b on a.user_id = b.user_id and b.ts <= a.ts group by all",
    "running_balance_split": f"select a.event_id, a.user_id, a.ts, a.amount, sum(b.amount)::decimal(18,2) as running_balance from ({_MONEY_EVENTS}) a join ({_MONEY_EVENTS}) b on a.user_id = b.user_id and b.ts <= a.ts group by all",
    "trailing_counts_split": "select event_id, (select count(*) from events b where b.user_id = a.user_id and b.ts <= a.ts and b.ts > a.ts - interval 12 hours) as n from events a",
    "order_price_percent_rank": "select o_orderkey, round(percent_rank() over (partition by year(o_orderdate), o_orderstatus order by o_totalprice::decimal(18,2)), 6) as share from orders",
    "active_accounts_by_quarter": "select date_trunc('quarter', o_orderdate)::date as quarter_start, count(distinct o_custkey) as active, true as within_a_twentieth from orders group by all",
    "running_balance_self_join": f"select event_id, user_id, ts, amount, sum(amount) over (partition by user_id order by ts)::decimal(18,2) as running_balance from ({_MONEY_EVENTS})",
    "month_report_range": "select l_returnflag, count(*) as n, sum(l_extendedprice::decimal(18,2))::decimal(18,2) as total from lineitem where strftime(l_shipdate, '%Y-%m') = '1996-03' group by all",
    "month_report_wrapped": "select l_returnflag, count(*) as n, sum(l_extendedprice::decimal(18,2))::decimal(18,2) as total from lineitem where l_shipdate >= date '1996-03-01' and l_shipdate < date '1996-04-01' group by all",
    "largest_transactions": "select txn_id, account_id, amount_eur from (select *, row_number() over (order by amount_eur desc nulls last, txn_id) as n from fct) where n <= 10",
    "active_accounts_approx_error": "select date_trunc('month', o_orderdate)::date as month_start, count(distinct o_custkey) as active, true as within_a_twentieth from orders group by all",
    "active_accounts_exact": "select date_trunc('month', o_orderdate)::date as month_start, count(distinct o_custkey) as active from orders group by all",
    "full_history_rollup": "select date_trunc('month', l_shipdate)::date as month_start, l_returnflag, l_linestatus, count(*) as n, sum(l_extendedprice::decimal(18,2))::decimal(18,2) as total from lineitem group by all",
    "point_lookup": "select o_orderkey, o_custkey, o_totalprice::decimal(18,2) as amount from orders where o_orderkey = 777",
    "amplified_volume": "select date_trunc('month', (o_orderdate::date - to_years((c % 10)::int)))::date as month_start, count(*) as n, sum(o_totalprice::decimal(18,2))::decimal(18,2) as total from orders, range(40) r(c) group by all",
    "masked_emails": "select c_custkey, 'u***@example.com' as email from customer",
    "masked_ibans": "select account_id, left(iban, 4) || repeat('*', 14) || right(iban, 4) as iban from acc",
    "masked_accounts": "select account_id, left(iban, 4) || repeat('*', 14) || right(iban, 4) as iban, currency from acc",
    "dq_not_null": "select txn_id, _source_file, _source_row from stg where merchant_id is null",
    "dq_unique": "select txn_id, count(*) as n from raw group by txn_id having count(*) > 1",
    "dq_accepted_values": "select txn_id, 'XX' as direction, _source_file from raw where i % 359 = 6",
    "dq_relationships": "select txn_id, 'A999999999' as account_id, _source_file from raw where i % 349 = 4",
    "dq_expression_is_true": "select txn_id, amount, _source_file from stg where txn_type = 'CARD_PAYMENT' and amount <= 0",
    "dq_unique_combination": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1",
    "dq_within_range": "select txn_id, amount_eur from fct where amount_eur not between 5 and 400",
    "dq_freshness": """select t as table, newest, round(epoch(timestamp '2024-02-06 12:00:00' - newest) / 3600, 6) as age_hours, case when epoch(timestamp '2024-02-06 12:00:00' - newest) > 50 * 3600 then 'error' when epoch(timestamp '2024-02-06 12:00:00' - newest) > 26 * 3600 then 'warn' else 'pass' end as status
        from (select 'transactions' as t, max(_loaded_at) as newest from raw union all select 'fx_rates', max(rate_date)::timestamp from published)""",
}
_EXTRA = {
    "incremental_upsert": _BATCHES,
    "incremental_equals_rebuild": _BATCHES,
    "account_daily_balance_incremental": "kept_early as (select * from val where rejection_reason is null and _loaded_at < timestamp '2024-01-20 12:00:00')",
}
_QUERIES["customer_scd2_incremental"] = _QUERIES["customer_scd2"]
#: Queries that return row numbers, which are counted along each file there; elsewhere only their order matters.
_NUMBERED = {"stg_transactions_typed", "txn_validated", "txn_quarantine", "fct_transactions", "dq_not_null"}
_COUNTED = TABLES.replace("2 * i + if(txn_id like 'T%', 2, 1) as _source_row", "row_number() over (partition by _source_file order by i, txn_id) as _source_row")
ORACLE: dict[str, str] = {k: (_COUNTED if k in _NUMBERED else TABLES).rstrip() + (f",\n{_EXTRA[k].strip()}" if k in _EXTRA else "") + "\n" + v for k, v in _QUERIES.items()}
