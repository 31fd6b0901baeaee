"""SQL text for the checks: the stand-in feeds and models as common table expressions.

Rounding is done on integers (hundredths and finer), because the checking engine divides
decimals as doubles.
"""

from __future__ import annotations

import re

from bankspark.sources import standin as S

AS_OF = "DATE '2001-12-31'"
AS_OF_TS = "TIMESTAMP '2001-12-31 00:00:00'"


def rdiv(num: str, den: str) -> str:
    """num / den rounded half away from zero, on integers; null when den is zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(sign({n}) * sign({d}) * ((abs({n}) * 2 + abs({d})) // nullif(2 * abs({d}), 0)))"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def dbl(x: str, scale: int = 0) -> str:
    """An integer of `scale` decimals as a double."""
    return f"(CAST({x} AS DOUBLE) / {10 ** scale})" if scale else f"CAST({x} AS DOUBLE)"


def ratio_pct(part: str, whole: str, scale: int = 2) -> str:
    q8 = rdiv(f"{cents(part)} * 100000000", cents(whole))
    return dbl(rdiv(q8, str(10 ** (6 - scale))), scale)


def share_pct(count: str, total: str) -> str:
    q7 = rdiv(f"CAST({count} AS HUGEINT) * 1000000000", total)
    return dbl(rdiv(q7, "100000"), 2)


def mean2(total: str, n: str) -> str:
    """Mean of a scale-2 total, kept to 8 digits, then rounded to 2."""
    return dbl(rdiv(rdiv(f"{cents(total)} * 1000000", n), "1000000"), 2)


def pick(values: tuple[str, ...], index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST({index} AS INT) + 1]"


def title(x: str) -> str:
    marks = r"""([\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>])"""
    return (
        f"array_to_string(list_transform(string_split(regexp_replace(lower(trim({x})), '{marks}',"
        f" '\\1' || chr(1), 'g'), chr(1)), lambda w: upper(w[1]) || w[2:]), '')"
    )


def code(x: str) -> str:
    return f"upper(trim({x}))"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def quarter(d: str) -> str:
    return f"CAST(date_trunc('quarter', {d}) AS DATE)"


def months_on(start: str, end: str) -> str:
    return f"CAST((year({end}) * 12 + month({end})) - (year({start}) * 12 + month({start})) AS INT)"


REVENUE = "transaction_type IN ('CREDIT', 'FEE', 'INTEREST')"
ZERO = "CAST(0 AS DECIMAL(18, 2))"


def sum_if(cond: str, x: str = "amount_usd") -> str:
    return f"sum(CASE WHEN {cond} THEN {x} ELSE {ZERO} END)"


def _copies(has_older: str) -> str:
    return f"unnest(CASE WHEN {has_older} THEN [0, 1] ELSE [0] END) AS copy"


def _latest(rows: str, key: str, cols: str, sk: str) -> str:
    return f"""
      SELECT md5({key}) AS {sk}, {cols} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC NULLS FIRST) AS rn
        FROM ({rows})) WHERE rn = 1"""


_CC = "'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')"
_AC = "'A' || lpad(CAST(n AS VARCHAR), 9, '0')"
_TC = "'T' || lpad(CAST(n AS VARCHAR), 10, '0')"

CTES: dict[str, str] = {}

CTES["geo"] = "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey"

CTES["raw_branches"] = f"""
  SELECT ' br' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS branch_id,
    'main-branch ' || n_name AS branch_name, ' CITY ' || CAST(n_nationkey AS VARCHAR) AS city,
    's' || lpad(CAST(n_nationkey % 10 AS VARCHAR), 2, '0') AS state, r_name AS region,
    {AS_OF_TS} - to_minutes(n_nationkey) AS _synced, n_nationkey = 24 AS _deleted FROM geo"""

CTES["raw_customers"] = f"""
  SELECT CASE WHEN c_custkey % 17 = 0 THEN '  ' || lower({_CC}) || ' ' ELSE {_CC} END AS customer_id,
    CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE ' ' || lower(c_name) || ' ' || upper(n_name) || ' ' END AS customer_name,
    CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS customer_segment,
    CASE WHEN copy = 1 THEN 'HIGH' WHEN c_custkey % 29 = 0 THEN 'n/a' WHEN c_acctbal < 0 THEN 'high'
      WHEN c_acctbal < 3000 THEN ' MEDIUM' ELSE 'LOW' END AS risk_category,
    r_name AS region, DATE '1993-01-01' + CAST(c_custkey % 700 AS INT) AS onboarding_date,
    {AS_OF_TS} - to_minutes(CAST(c_custkey % 1440 + copy * 1440 AS INT)) AS _synced,
    c_custkey % 101 = 0 AS _deleted
  FROM (SELECT *, {_copies('c_custkey % 97 = 0')} FROM customer JOIN geo ON c_nationkey = n_nationkey)"""

CTES["raw_accounts"] = f"""
  SELECT CASE WHEN n % 13 = 0 THEN lower({_AC}) ELSE {_AC} END AS account_id,
    CASE WHEN n % 211 = 0 THEN 'C99999999' ELSE {_CC} END AS customer_id,
    {pick(S.ACCOUNT_TYPES, 'n % 5')} AS account_type,
    'BR' || lpad(CAST((c_nationkey + k) % 25 AS VARCHAR), 3, '0') AS branch_id,
    CASE WHEN copy = 1 THEN 'FROZEN' WHEN n % 20 = 0 THEN 'DORMANT' WHEN n % 20 = 1 THEN 'CLOSED'
      WHEN n % 20 = 2 THEN NULL WHEN n % 20 = 3 THEN 'frozen' ELSE 'ACTIVE' END AS account_status,
    DATE '1994-01-01' + CAST(n % 2500 AS INT) AS open_date,
    {AS_OF_TS} - to_minutes(CAST(n % 1440 + copy * 1440 AS INT)) AS _synced, n % 101 = 0 AS _deleted
  FROM (SELECT *, {_copies('n % 97 = 0')} FROM (
    SELECT *, c_custkey * 2 + k AS n FROM (SELECT *, unnest([0, 1]) AS k FROM customer)))"""

CTES["raw_transactions"] = f"""
  SELECT CASE WHEN n % 7 = 0 THEN ' ' || lower({_TC}) ELSE {_TC} END AS transaction_id,
    'A' || lpad(CAST(o_custkey * 2 + n % 2 AS VARCHAR), 9, '0') AS account_id,
    {pick(S.TXN_TYPES, 'n % 6')} AS transaction_type,
    CAST(CASE WHEN n % 113 = 0 THEN NULL
      WHEN n % 50 = 0 THEN CAST(floor(o_totalprice / 1000) * 1000 AS DECIMAL(18, 0))
      ELSE CAST(floor(o_totalprice * 5) AS DECIMAL(18, 0)) * 0.01 END AS DECIMAL(18, 2)) AS amount,
    {pick(S.CURRENCIES, 'o_custkey % 4')} AS currency,
    {pick(S.MERCHANT_CATEGORIES, 'n % 10')} AS merchant_category, occurred AS transaction_timestamp,
    CASE WHEN copy = 1 THEN 'PENDING' WHEN n % 20 = 0 THEN 'blocked' WHEN n % 20 = 1 THEN 'FAILED'
      WHEN n % 20 = 2 THEN 'PENDING' WHEN n % 20 = 3 THEN 'REVERSED' WHEN n % 37 = 0 THEN NULL
      ELSE 'COMPLETED' END AS transaction_status,
    occurred + to_seconds(CAST(60 + n % 600 - copy * 50 AS INT)) AS _synced, n % 101 = 0 AS _deleted
  FROM (SELECT *, {_copies('n % 97 = 0')} FROM (
    SELECT o_orderkey + CAST(burst AS BIGINT) * 1000000100 AS n, o_custkey, o_totalprice,
      o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS INT) + burst * 600) AS occurred
    FROM (SELECT *, unnest(CASE WHEN o_orderkey % 250 = 7 THEN [0, 1, 2, 3] ELSE [0] END) AS burst FROM orders)))"""

CTES["raw_loans"] = f"""
  SELECT 'L' || lpad(CAST(n AS VARCHAR), 9, '0') AS loan_id,
    'c' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS customer_id,
    {pick(S.LOAN_TYPES, 'n % 6')} AS loan_type, CAST(o_totalprice AS DECIMAL(18, 2)) AS loan_amount,
    CAST((CASE WHEN n % 401 = 0 THEN 3500 ELSE 450 + n % 1350 END) * 0.01 AS DECIMAL(6, 2)) AS interest_rate,
    CAST(CASE WHEN n % 70 = 3 THEN NULL WHEN n % 80 = 3 THEN 0 ELSE 500 + n % 9000 END AS DECIMAL(18, 2)) AS emi_amount,
    CASE WHEN copy = 1 THEN 'ACTIVE' WHEN n % 25 = 3 THEN 'DEFAULTED' WHEN n % 25 = 13 THEN 'delinquent'
      WHEN n % 50 = 23 THEN 'WRITTEN_OFF' WHEN n % 50 = 33 THEN 'CLOSED' ELSE 'ACTIVE' END AS loan_status,
    day + CASE WHEN n % 307 = 0 THEN 3000 ELSE 0 END AS disbursement_date,
    {AS_OF_TS} - to_minutes(CAST(n % 1440 + copy * 1440 AS INT)) AS _synced, n % 101 = 0 AS _deleted
  FROM (SELECT *, {_copies('n % 97 = 0')} FROM (
    SELECT o_orderkey AS n, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders))"""

CTES["raw_calendar"] = f"""
  SELECT date_key, CAST(month(date_key) AS INT) AS month, CAST(quarter(date_key) AS INT) AS quarter,
    CAST(year(date_key) AS INT) AS year,
    'FY' || CAST(year(date_key) - CASE WHEN month(date_key) < 4 THEN 1 ELSE 0 END AS VARCHAR) || '-Q' ||
      CAST((month(date_key) + 8) % 12 // 3 + 1 AS VARCHAR) AS fiscal_period,
    {AS_OF_TS} AS _synced, false AS _deleted
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_key FROM (
    SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))"""

CTES["fx"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', CAST({r} AS DECIMAL(18, 6)), DATE '{d}')" for c, r, d in S.rate_rows()
) + ") t(currency, rate_to_usd, effective_month)"

CTES["stg_customers"] = _latest(
    f"""SELECT {code('customer_id')} AS customer_id, {title('customer_name')} AS customer_name,
      coalesce({code('customer_segment')}, 'UNKNOWN') AS customer_segment,
      CASE WHEN {code('risk_category')} IN ('LOW', 'MEDIUM', 'HIGH') THEN {code('risk_category')} ELSE 'UNKNOWN' END AS risk_category,
      {title('region')} AS region, onboarding_date, _synced AS loaded_at
      FROM raw_customers WHERE NOT _deleted AND customer_id IS NOT NULL""",
    "customer_id",
    "customer_id, customer_name, customer_segment, risk_category, region, onboarding_date, loaded_at",
    "customer_sk",
)
CTES["stg_accounts"] = _latest(
    f"""SELECT {code('account_id')} AS account_id, {code('customer_id')} AS customer_id,
      {code('account_type')} AS account_type, {code('branch_id')} AS branch_id,
      coalesce({code('account_status')}, 'UNKNOWN') AS account_status, open_date, _synced AS loaded_at
      FROM raw_accounts WHERE NOT _deleted AND account_id IS NOT NULL""",
    "account_id",
    "account_id, customer_id, account_type, branch_id, account_status, open_date, loaded_at",
    "account_sk",
)
CTES["stg_transactions"] = _latest(
    f"""SELECT {code('transaction_id')} AS transaction_id, {code('account_id')} AS account_id,
      {code('transaction_type')} AS transaction_type, amount, {code('currency')} AS currency,
      {code('merchant_category')} AS merchant_category, transaction_timestamp,
      CAST(transaction_timestamp AS DATE) AS transaction_date,
      coalesce({code('transaction_status')}, 'UNKNOWN') AS transaction_status, _synced AS loaded_at
      FROM raw_transactions WHERE NOT _deleted AND transaction_id IS NOT NULL AND amount IS NOT NULL""",
    "transaction_id",
    "transaction_id, account_id, transaction_type, amount, currency, merchant_category, "
    "transaction_timestamp, transaction_date, transaction_status, loaded_at",
    "transaction_sk",
)
_LOAN_ROWS = f"""SELECT {code('loan_id')} AS loan_id, {code('customer_id')} AS customer_id,
      {code('loan_type')} AS loan_type, loan_amount, interest_rate, emi_amount,
      {code('loan_status')} AS loan_status, disbursement_date, _synced AS loaded_at
      FROM raw_loans WHERE NOT _deleted AND loan_id IS NOT NULL"""
_DEFAULT = "CAST(loan_status IN ('DEFAULTED', 'WRITTEN_OFF') AS INT) AS is_default_flag"
_DELINQ = "CAST(loan_status = 'DELINQUENT' AS INT) AS is_delinquent_flag"
_ACTIVE = "CAST(loan_status IN ('ACTIVE', 'DELINQUENT') AS INT) AS is_active_flag"
CTES["stg_loans"] = _latest(
    _LOAN_ROWS, "loan_id",
    "loan_id, customer_id, loan_type, loan_amount, interest_rate, emi_amount, loan_status, "
    f"{_DEFAULT}, {_DELINQ}, {_ACTIVE}, disbursement_date, loaded_at",
    "loan_sk",
)
CTES["stg_branches"] = f"""
  SELECT md5({code('branch_id')}) AS branch_sk, {code('branch_id')} AS branch_id,
    {title('branch_name')} AS branch_name, {title('city')} AS city, {code('state')} AS state,
    {title('region')} AS region, _synced AS loaded_at
  FROM raw_branches WHERE NOT _deleted AND branch_id IS NOT NULL"""
CTES["stg_calendar"] = """
  SELECT md5(CAST(date_key AS VARCHAR)) AS date_sk, date_key, month, quarter, year, fiscal_period,
    CAST(dayofweek(date_key) AS INT) AS day_of_week, strftime(date_key, '%a') AS day_name,
    strftime(date_key, '%b') AS month_name, CAST(dayofweek(date_key) IN (0, 6) AS INT) AS is_weekend,
    last_day(date_key) AS month_end_date,
    CAST(date_trunc('quarter', date_key) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date
  FROM raw_calendar WHERE NOT _deleted"""

CTES["rates"] = f"""
  SELECT upper(currency) AS ccy, {month('effective_month')} AS fx_month, max(rate_to_usd) AS rate
  FROM fx GROUP BY 1, 2"""
CTES["rated"] = f"""
  SELECT t.*, coalesce(r.rate, 1.0) AS rate_to_usd, r.rate IS NULL AS is_fx_defaulted,
    CAST(round(t.amount * coalesce(r.rate, CAST(1 AS DECIMAL(18, 6))), 2) AS DECIMAL(18, 2)) AS amount_usd
  FROM stg_transactions t LEFT JOIN rates r
    ON r.ccy = t.currency AND r.fx_month = {month('t.transaction_date')}"""
CTES["enriched"] = f"""
  SELECT t.transaction_sk, t.transaction_id, t.transaction_timestamp, t.transaction_date,
    t.transaction_type, t.transaction_status, t.merchant_category, t.amount AS amount_local,
    t.currency, t.amount_usd, a.account_sk, a.account_id, a.account_type, a.account_status,
    c.customer_sk, c.customer_id, c.customer_segment, c.risk_category AS customer_risk_category,
    b.branch_sk, b.branch_id, b.branch_name, b.region AS branch_region, b.state AS branch_state,
    c.region AS customer_region,
    CAST(t.transaction_status = 'BLOCKED' AS INT) AS is_blocked_flag,
    CAST(t.transaction_status IN ('FAILED', 'REVERSED', 'BLOCKED') AS INT) AS is_failed_flag,
    CAST(t.amount_usd >= 50000 AND CAST(round(t.amount_usd, 0) AS BIGINT) % 1000 = 0 AS INT) AS is_round_high_value_flag,
    CAST(t.amount_usd >= 25000 AS INT) AS is_high_value_flag
  FROM rated t LEFT JOIN stg_accounts a ON a.account_id = t.account_id
    LEFT JOIN stg_customers c ON c.customer_id = a.customer_id
    LEFT JOIN stg_branches b ON b.branch_id = a.branch_id"""
CTES["fct"] = "SELECT * FROM enriched"

_NET = "(inflow_usd - refund_usd)"
CTES["revenue_raw"] = f"""
  SELECT {month('transaction_date')} AS revenue_month, customer_segment, customer_risk_category,
    branch_region, {sum_if(REVENUE)} AS inflow_usd, {sum_if("transaction_type = 'REFUND'")} AS refund_usd,
    {sum_if("transaction_type IN ('DEBIT', 'TRANSFER')")} AS outflow_usd,
    count(CASE WHEN {REVENUE} THEN 1 END) AS inflow_txn_count,
    count(DISTINCT customer_id) AS active_customers
  FROM fct WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2, 3, 4"""
CTES["revenue"] = f"SELECT *, {_NET} AS net_revenue_usd FROM revenue_raw"
CTES["performance"] = f"""
  SELECT {month('t.transaction_date')} AS performance_month, b.branch_id, b.branch_name, b.city,
    b.state, b.region, count(DISTINCT t.account_id) AS active_accounts,
    count(DISTINCT t.customer_id) AS active_customers, count(*) AS transaction_count,
    sum(amount_usd) AS total_volume_usd, {sum_if(REVENUE)} AS revenue_usd,
    CAST(sum(is_failed_flag) AS BIGINT) AS failed_count,
    CAST(sum(is_high_value_flag) AS BIGINT) AS high_value_count
  FROM fct t JOIN stg_branches b ON b.branch_id = t.branch_id
  WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2, 3, 4, 5, 6"""

_TENURE = f"greatest({rdiv(rdiv(cents('loan_amount') + ' * 100000000', cents('emi_amount')), '100000000')}, 0)"
CTES["amortized"] = f"""
  SELECT *, CASE WHEN paid IS NULL THEN NULL ELSE CAST(emi_amount * paid AS DECIMAL(18, 2)) END AS repaid,
    CASE WHEN paid IS NULL THEN NULL
      ELSE greatest(CAST(loan_amount - emi_amount * paid AS DECIMAL(18, 2)), {ZERO}) END AS outstanding
  FROM (SELECT *, CASE WHEN tenure IS NULL THEN NULL ELSE least(since, tenure) END AS paid
    FROM (SELECT *, {months_on('disbursement_date', AS_OF)} AS since,
      CASE WHEN emi_amount IS NULL OR emi_amount = 0 THEN NULL ELSE CAST({_TENURE} AS INT) END AS tenure
      FROM stg_loans))"""
CTES["loans"] = """
  SELECT l.*, c.customer_sk, c.customer_segment, c.risk_category AS customer_risk_category,
    c.region AS customer_region
  FROM amortized l LEFT JOIN stg_customers c ON c.customer_id = l.customer_id"""

CTES["burst"] = """
  SELECT transaction_sk, count(*) OVER (PARTITION BY account_id ORDER BY transaction_timestamp
    RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS txn_count_60min FROM fct"""
CTES["fraud"] = """
  SELECT * FROM (
    SELECT t.*, CAST(r.txn_count_60min >= 3 AS INT) AS is_rapid_fire_flag,
      list_filter([CASE WHEN is_blocked_flag = 1 THEN 'STATUS_BLOCKED' END,
        CASE WHEN is_round_high_value_flag = 1 THEN 'ROUND_NUMBER_HIGH_VALUE' END,
        CASE WHEN is_high_value_flag = 1 THEN 'HIGH_VALUE' END,
        CASE WHEN r.txn_count_60min >= 3 THEN 'RAPID_FIRE' END], lambda x: x IS NOT NULL) AS reasons
    FROM fct t JOIN burst r USING (transaction_sk)) WHERE len(reasons) > 0"""

CTES["txn_agg"] = f"""
  SELECT customer_id, {sum_if(REVENUE + " AND transaction_status = 'COMPLETED'")} AS rev,
    {sum_if("transaction_type = 'REFUND' AND transaction_status = 'COMPLETED'")} AS ref,
    count(*) AS n, sum(is_failed_flag) AS failed, sum(is_high_value_flag) AS high,
    min(transaction_date) AS first_txn_date, max(transaction_date) AS last_txn_date
  FROM fct GROUP BY 1"""
CTES["loan_agg"] = f"""
  SELECT customer_id, count(*) AS n, sum(loan_amount) AS principal, sum(outstanding) AS owed,
    sum(is_default_flag) AS defaulted,
    {rdiv(f"{cents('sum(interest_rate)')} * 1000000", 'count(interest_rate)')} AS rate8
  FROM amortized GROUP BY 1"""
_COST = (
    "(" + rdiv("(" + rdiv("CAST(coalesce(l.owed, 0) * 100 AS HUGEINT) * (coalesce(l.rate8, 0) * 100)", "100") + ")", "12")
    + " * greatest(" + rdiv("CAST(date_diff('day', c.onboarding_date, " + AS_OF + ") AS HUGEINT) * 1000000", "30") + ", 1000000))"
)
CTES["profit"] = f"""
  SELECT *, {rdiv('cost18', '10000000000000000')} AS cost2,
    {rdiv("CAST(net * 100 AS HUGEINT) * 10000000000000000 - cost18", '10000000000000000')} AS profit2,
    CASE WHEN risk_category = 'HIGH' AND net > 10000 THEN 'HIGH_RISK_HIGH_VALUE'
      WHEN risk_category = 'HIGH' THEN 'HIGH_RISK_LOW_VALUE'
      WHEN risk_category = 'LOW' AND net > 10000 THEN 'LOW_RISK_HIGH_VALUE'
      WHEN risk_category = 'LOW' THEN 'LOW_RISK_LOW_VALUE' ELSE 'MEDIUM_RISK' END AS risk_value_segment
  FROM (SELECT c.*, CAST(date_diff('day', c.onboarding_date, {AS_OF}) AS INT) AS tenure_days,
    coalesce(t.rev, 0) AS rev, coalesce(t.ref, 0) AS ref,
    CAST(coalesce(t.rev, 0) - coalesce(t.ref, 0) AS DECIMAL(18, 2)) AS net,
    coalesce(t.n, 0) AS txns, CAST(coalesce(t.failed, 0) AS BIGINT) AS failed,
    CAST(coalesce(t.high, 0) AS BIGINT) AS high, t.first_txn_date, t.last_txn_date,
    coalesce(l.n, 0) AS loan_count, coalesce(l.principal, 0) AS principal, coalesce(l.owed, 0) AS owed,
    CAST(coalesce(l.defaulted, 0) AS BIGINT) AS defaulted, coalesce(l.rate8, 0) AS rate8, {_COST} AS cost18
    FROM stg_customers c LEFT JOIN txn_agg t ON t.customer_id = c.customer_id
      LEFT JOIN loan_agg l ON l.customer_id = c.customer_id)"""

CTES["exec_view"] = """
  SELECT revenue_month, customer_segment, branch_region, sum(net_revenue_usd) AS revenue_usd,
    CAST(sum(inflow_txn_count) AS BIGINT) AS txn_count,
    CAST(sum(active_customers) AS BIGINT) AS active_customers
  FROM revenue GROUP BY 1, 2, 3"""
CTES["branch_rev"] = """
  SELECT branch_id, branch_name, region, sum(revenue_usd) AS revenue_usd FROM performance GROUP BY 1, 2, 3"""
CTES["home"] = """
  SELECT customer_id, arg_min(branch_id, account_id) AS branch_id FROM stg_accounts GROUP BY 1"""

# The customer master before and after a change, and its two-run history.
_N = "CAST(substr(customer_id, 2) AS BIGINT)"
CTES["cust_before"] = f"""
  SELECT customer_sk, customer_id,
    CASE WHEN {_N} % 11 = 0 THEN upper(customer_name) ELSE customer_name END AS customer_name,
    CASE WHEN {_N} % 10 = 0 THEN 'LEGACY' ELSE customer_segment END AS customer_segment, risk_category,
    CASE WHEN {_N} % 13 = 0 THEN NULL ELSE region END AS region, onboarding_date, loaded_at
  FROM stg_customers WHERE {_N} % 60 <> 7"""
CTES["cust_after"] = f"""
  SELECT customer_sk, customer_id, customer_name, customer_segment, risk_category,
    CASE WHEN {_N} % 26 = 0 THEN NULL ELSE region END AS region, onboarding_date, loaded_at
  FROM stg_customers WHERE {_N} % 50 <> 49"""
_CHANGED = (
    "(a.customer_segment IS DISTINCT FROM b.customer_segment OR a.risk_category IS DISTINCT FROM"
    " b.risk_category OR a.region IS DISTINCT FROM b.region)"
)
T1, T2 = "TIMESTAMP '2000-06-30 00:00:00'", "TIMESTAMP '2001-06-30 00:00:00'"
CTES["cust_history"] = f"""
  SELECT b.*, {T1} AS valid_from,
    CASE WHEN a.customer_id IS NULL OR {_CHANGED} THEN {T2} END AS valid_to
  FROM cust_before b LEFT JOIN cust_after a ON a.customer_id = b.customer_id
  UNION ALL
  SELECT a.*, {T2} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM cust_after a LEFT JOIN cust_before b ON a.customer_id = b.customer_id
  WHERE b.customer_id IS NULL OR {_CHANGED}"""

CTES["payments"] = f"""
  SELECT 'E' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS transaction_id,
    'A' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS account_id, upper(event_type) AS transaction_type,
    CAST(CASE WHEN event_id % 40 = 0 THEN floor(value) * 1000 ELSE floor(value * 100) END AS DECIMAL(18, 2)) AS amount,
    {pick(S.CURRENCIES, 'user_id % 4')} AS currency,
    {pick(S.MERCHANT_CATEGORIES, 'event_id % 10')} AS merchant_category, ts AS transaction_timestamp,
    CASE event_type WHEN 'signup' THEN 'COMPLETED' WHEN 'view' THEN 'COMPLETED' WHEN 'click' THEN 'PENDING'
      WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'BLOCKED' END AS transaction_status, event_id
  FROM events"""
CTES["query_log"] = f"""
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_name,
    {pick(('FIN_ADMIN', 'DBT_TRANSFORMER', 'BI_READER'), 'user_id % 3')} AS role_name,
    'create table t as select 1 ' || CASE WHEN event_id % 3 = 0 THEN 'insert into' ELSE 'INSERT  INTO' END
      || ' MART_' || CAST(event_id % 5 AS VARCHAR) || ' values' AS query_text,
    CASE WHEN event_id % 5 = 0 THEN 'OTHER' ELSE 'BANK' END AS database_name,
    'SCHEMA_' || CAST(event_id % 4 AS VARCHAR) AS schema_name,
    {pick(('SELECT', 'CREATE_TABLE_AS_SELECT', 'MERGE', 'UPDATE', 'DELETE', 'INSERT', 'GRANT'), 'event_id % 7')} AS query_type,
    ts AS start_time, CASE WHEN event_id % 11 = 0 THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
    CAST(floor(value * 100) AS BIGINT) AS total_elapsed_time,
    CAST(floor(value * 80) AS BIGINT) AS execution_time,
    CASE WHEN event_id % 2 = 0 THEN 'project=bank' ELSE 'project=other' END || ';run=' ||
      CAST(event_id % 20 AS VARCHAR) AS query_tag,
    CAST(event_id % 100 AS DECIMAL(18, 4)) AS credits_used,
    CAST((event_id % 10) * 0.25 AS DECIMAL(18, 4)) AS credits_used_cloud_services
  FROM events"""

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def with_models(select: str, extra: dict[str, str] | None = None) -> str:
    """The select with the common table expressions it needs, in definition order."""
    known = {**CTES, **(extra or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(_WORD.findall(text)) & known.keys() - needed:
            needed.add(name)
            visit(known[name])

    visit(select)
    parts = [f"{name} AS ({body})" for name, body in known.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select
