"""DuckDB SQL for the registered queries, written from the metrics' definitions and not from the plans."""

from __future__ import annotations

STAR = """
WITH t AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id, 'A' || o_custkey AS account_id, 'C' || o_custkey AS customer_id, 'P' || l_partkey AS product_id, 'B' || l_suppkey AS branch_id,
         o_orderdate AS txn_ts, o_orderdate::DATE AS txn_date, date_trunc('month', o_orderdate)::DATE AS month_start, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter,
         CASE WHEN l_tax > 0.07 THEN NULL ELSE l_extendedprice::DECIMAL(15,2) END AS amount_inr,
         CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Pending' ELSE 'Failed' END AS status, (l_returnflag = 'R')::INT AS is_refund,
         CASE WHEN l_tax > 0.07 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice::DECIMAL(15,2) ELSE l_extendedprice::DECIMAL(15,2) END AS net_inr,
         CASE WHEN o_orderkey % 20 = 0 THEN 'day2' ELSE 'day1' END AS source_batch_id,
         c_name AS customer_name, (['Verified', 'Pending', 'Rejected'])[(c_custkey % 3 + 1)::INT] AS kyc_status, p_name AS product_name,
         (['Savings Account', 'Loan', 'Credit Card', 'Fixed Deposit'])[(p_size % 4 + 1)::INT] AS product_type, p_brand AS category, s_name AS branch_name, r_name AS region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
v AS (SELECT * FROM t WHERE status = 'Success' AND amount_inr IS NOT NULL)
"""


def pct(a: str, b: str, places: int) -> str:
    return f"round(100 * ({a})::DOUBLE / nullif(({b})::DOUBLE, 0), {places})"


def totals(keys: str, source: str = "v") -> str:
    return f"SELECT {keys}, count(*) AS txn_count, sum(net_inr)::DECIMAL(18,2) AS net FROM {source} GROUP BY {keys}"


def top(source: str) -> str:
    return f"""SELECT rank() OVER (ORDER BY net DESC, txn_count DESC) AS rank_no, customer_id, c_name AS customer_name, 'A' || c_custkey AS account_id, net AS net_value_inr, txn_count
FROM ({totals('customer_id', source)}) JOIN customer ON customer_id = 'C' || c_custkey ORDER BY net DESC, txn_count DESC, customer_id LIMIT 5"""


def ranking(source: str) -> str:
    return f"""SELECT region, branch_id, branch_name, net AS revenue_inr, txn_count, rank() OVER (PARTITION BY region ORDER BY net DESC) AS rank_in_region,
  dense_rank() OVER (PARTITION BY region ORDER BY net DESC) AS dense_rank_in_region,
  CASE WHEN rank() OVER (PARTITION BY region ORDER BY net DESC) = 1 THEN 'Top performer' WHEN rank() OVER (PARTITION BY region ORDER BY net) = 1 THEN 'Bottom performer' END AS performer
FROM ({totals('region, branch_id, branch_name', source)})"""


def snapshot(source: str, batch: str) -> str:
    return f"""SELECT 'kpi01_top_customers' AS kpi_name, row_number() OVER (ORDER BY rank_no, customer_id) AS rank_no, customer_id AS item_key, customer_name AS item_label, net_value_inr AS metric_value, '{batch}' AS batch_id FROM ({top(source)})
UNION ALL SELECT 'kpi07_branch_ranking', row_number() OVER (ORDER BY region, rank_in_region, branch_id), branch_id, region || ' #' || rank_in_region, revenue_inr, '{batch}' FROM ({ranking(source)})"""


def growth(window: str) -> str:
    return pct(f"net - lag(net) OVER ({window})", f"lag(net) OVER ({window})", 1)


def suspicious(minutes: int) -> str:
    return f"""
SELECT event_id AS transaction_id, 'A' || user_id AS account_id, 'C' || user_id AS customer_id, event_type AS customer_name, ts AS txn_ts, amount, 'INR' AS currency, 'Success' AS status, n AS txns_in_{minutes}_min,
       concat_ws(' | ', CASE WHEN amount > 300 THEN 'HIGH_VALUE' END, CASE WHEN n >= 3 THEN 'VELOCITY_3_IN_{minutes}_MIN' END, CASE WHEN hour(ts) < 5 THEN 'ODD_HOURS' END) AS risk_reason
FROM (SELECT *, value::DECIMAL(15,2) AS amount, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {minutes} MINUTE PRECEDING AND CURRENT ROW) AS n FROM events)
WHERE amount > 300 OR n >= 3 OR hour(ts) < 5"""


SEGMENTS = f"""{STAR}, rfm AS (
  SELECT customer_id, date_diff('day', max(txn_date), (SELECT max(txn_date) FROM t)) AS recency_days, count(*) AS frequency, sum(net_inr)::DECIMAL(18,2) AS monetary_inr FROM v GROUP BY customer_id),
scored AS (SELECT *, ntile(3) OVER (ORDER BY recency_days DESC, customer_id) AS r_score, ntile(3) OVER (ORDER BY frequency, customer_id) AS f_score, ntile(3) OVER (ORDER BY monetary_inr, customer_id) AS m_score FROM rfm),
seg AS (SELECT s.customer_id, c_name AS customer_name, recency_days, frequency, monetary_inr, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total,
  CASE WHEN r_score + f_score + m_score >= 8 THEN 'Platinum' WHEN r_score + f_score + m_score >= 6 THEN 'Gold' WHEN r_score + f_score + m_score >= 4 THEN 'Silver' ELSE 'Bronze' END AS segment
  FROM scored s JOIN customer ON s.customer_id = 'C' || c_custkey)
"""

LINES = """
WITH l AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber) AS key, CASE WHEN l_orderkey % 20 = 0 THEN 'day2' ELSE 'day1' END AS batch_id, l_linestatus || '.csv' AS source_file,
  list_filter([CASE WHEN l_quantity < 3 THEN 'LOW_QUANTITY' END, CASE WHEN l_discount > 0.09 THEN 'HIGH_DISCOUNT' END, CASE WHEN l_partkey % 97 = 0 THEN 'ORPHAN_PRODUCT' END], lambda x: x IS NOT NULL) AS rejects,
  list_filter([CASE WHEN l_tax > 0.07 THEN 'NON_INR_CURRENCY' END, CASE WHEN l_returnflag = 'N' THEN 'MISSING_REFUND_FLAG' END], lambda x: x IS NOT NULL) AS flags FROM lineitem),
card AS (SELECT batch_id, source_file, count(*) AS records_received, count(*) FILTER (len(rejects) = 0) AS records_passed, count(*) FILTER (len(rejects) > 0) AS records_rejected, 0::BIGINT AS duplicates_removed FROM l GROUP BY ALL),
issues AS (SELECT batch_id, source_file, severity, reason_code, count(*) AS record_count
  FROM (SELECT batch_id, source_file, 'REJECT' AS severity, unnest(rejects) AS reason_code FROM l UNION ALL SELECT batch_id, source_file, 'FLAG', unnest(flags) FROM l) GROUP BY ALL)
"""

VERSIONS = """
WITH base AS (SELECT c_custkey AS k, 'C' || c_custkey AS customer_id, c_name, 'A' || c_custkey AS account_id, c_mktsegment AS seg, c_custkey % 13 <> 0 AS had, c_custkey % 3 <> 0 AS comes,
   CASE WHEN c_custkey % 11 = 0 THEN c_name || ' II' ELSE c_name END AS name2, CASE WHEN c_custkey % 7 = 0 THEN 'NEW ' || c_mktsegment ELSE c_mktsegment END AS seg2 FROM customer),
x AS (SELECT *, CASE WHEN NOT had AND comes THEN 'inserted' WHEN NOT comes THEN 'kept' WHEN k % 7 = 0 THEN 'new_version' WHEN k % 11 = 0 THEN 'updated_in_place' ELSE 'unchanged' END AS action FROM base WHERE had OR comes),
dim AS (
  SELECT customer_id, CASE WHEN action IN ('inserted', 'updated_in_place') THEN name2 ELSE c_name END AS customer_name, account_id, CASE WHEN action = 'inserted' THEN seg2 ELSE seg END AS kyc_status,
         DATE '1900-01-01' AS valid_from, CASE WHEN action = 'new_version' THEN DATE '2026-10-01' ELSE DATE '9999-12-31' END AS valid_to, CASE WHEN action = 'new_version' THEN 0 ELSE 1 END AS is_current,
         CASE WHEN action IN ('inserted', 'updated_in_place') THEN 'day2' ELSE 'day1' END AS batch_id FROM x
  UNION ALL SELECT customer_id, name2, account_id, seg2, DATE '2026-10-01', DATE '9999-12-31', 1, 'day2' FROM x WHERE action = 'new_version')
"""

FACTS = """
WITH base AS (SELECT o_orderkey AS transaction_id, 'A' || o_custkey AS account_id, o_orderdate::DATE AS txn_date, o_totalprice::DECIMAL(15,2) AS amount, o_orderstatus AS status,
   CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS remarks, o_custkey AS customer_sk FROM orders),
n AS (SELECT *, CASE WHEN transaction_id % 10 = 0 THEN amount + 1 ELSE amount END::DECIMAL(15,2) AS amount2, CASE WHEN transaction_id % 15 = 0 THEN 'F' ELSE status END AS status2,
   CASE WHEN transaction_id % 25 = 0 THEN NULL ELSE remarks END AS remarks2, transaction_id % 6 <> 0 AS had, (transaction_id % 2 = 0 OR transaction_id % 15 = 0) AS comes FROM base),
x AS (SELECT *, CASE WHEN NOT comes THEN 'kept' WHEN NOT had THEN 'inserted' WHEN amount2 <> amount OR status2 <> status OR remarks2 IS DISTINCT FROM remarks THEN 'corrected' ELSE 'unchanged' END AS action FROM n WHERE had OR comes)
"""

MESSY = """
WITH m AS (SELECT c_custkey, c_custkey AS k, c_custkey::VARCHAR AS n, lower(c_name) AS name FROM customer),
messy AS (SELECT c_custkey,
  (['  ', 'Rs.', '₹ ', 'INR ', 'rs '])[(k % 5 + 1)::INT] || (['', '-', '1,'])[(k % 3 + 1)::INT] || n || (['.125', '.5', '', '.375', 'x', 'e2'])[(k % 6 + 1)::INT] AS amount,
  (['01/02/', '13-02-', '2020/1/', '31/04/', '2021-12-', 'x'])[(k % 6 + 1)::INT] || (['2001', '7', '31', '1999'])[(k % 4 + 1)::INT] AS day,
  ([' Succes', 'FAILD ', 'pending', 'Sucess', 'none', ''])[(k % 6 + 1)::INT] || (['', ' ', chr(9)])[(k % 3 + 1)::INT] AS status,
  (['  Main', 'park', '5th'])[(k % 3 + 1)::INT] || ([' ave-', '  o''neil ', '  '])[(k % 3 + 1)::INT] || name AS address,
  (['A.b', 'x y', ''])[(k % 3 + 1)::INT] || (['@Mail.org', '@mail', 'mail.org'])[(k % 3 + 1)::INT] AS email,
  (['+91 ', '91', '', '0'])[(k % 4 + 1)::INT] || lpad(n, 10, '7') || (['', '-', '1'])[(k % 3 + 1)::INT] AS phone FROM m)
"""

READINGS = f"""{MESSY}, r AS (SELECT c_custkey, list_distinct(list_filter([
   CASE WHEN regexp_full_match(day, '\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}') THEN try_cast(replace(day, '/', '-') AS DATE) END,
   CASE WHEN regexp_full_match(day, '\\d{{1,2}}[-/]\\d{{1,2}}[-/]\\d{{4}}') THEN try_strptime(replace(day, '/', '-'), '%d-%m-%Y')::DATE END,
   CASE WHEN regexp_full_match(day, '\\d{{1,2}}[-/]\\d{{1,2}}[-/]\\d{{4}}') THEN try_strptime(replace(day, '/', '-'), '%m-%d-%Y')::DATE END], lambda x: x IS NOT NULL)) AS c,
   CASE WHEN regexp_full_match(day, '\\d{{1,2}}[-/]\\d{{1,2}}[-/]\\d{{4}}') THEN try_strptime(replace(day, '/', '-'), '%d-%m-%Y')::DATE END AS day_first FROM messy)
"""

def settled(table: str, k: str, key: str, rejects: dict, flags: dict, values: dict, conflicts: bool = False) -> str:
    """Records that _file makes of a table, settled. rejects, flags: code -> condition; values: clean column -> expression; k is the record's number."""
    codes = lambda of: "concat_ws(';', " + ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in of.items()) + ")"
    listed = ", ".join(f"{v} AS {c}" for c, v in values.items())
    lost = "many > 1" if conflicts else "FALSE"
    return f"""WITH t AS (SELECT *, {k}::BIGINT AS k FROM {table}), r AS (SELECT k, CASE WHEN k % 17 <> 0 THEN '{key}' || CASE WHEN k % 10 = 1 THEN k - 1 ELSE k END END AS id, {codes(rejects)} AS bad, {codes(flags)} AS said, {listed} FROM t),
 n AS (SELECT *, count(*) OVER (PARTITION BY id) AS many FROM r), best AS (SELECT k, row_number() OVER (PARTITION BY id ORDER BY len(string_split(nullif(said, ''), ';')) NULLS FIRST, k DESC) AS place FROM r WHERE bad = ''),
 j AS (SELECT n.*, coalesce(place, 1) > 1 AND {not conflicts} AS beaten, {lost} AS conflict FROM n LEFT JOIN best USING (k)),
 o AS (SELECT *, CASE WHEN conflict OR bad <> '' THEN 'rejected' WHEN beaten THEN 'duplicate' ELSE 'passed' END AS disposition FROM j)
SELECT k AS pos, id AS record_key, disposition, CASE WHEN conflict THEN 'CONFLICTING_DUPLICATE' ELSE bad END AS reasons, CASE WHEN conflict THEN '' WHEN beaten THEN 'NEAR_DUPLICATE_RESOLVED' ELSE said END AS flags,
  {", ".join(f"CASE disposition WHEN 'passed' THEN {c} END AS {c}" for c in values)} FROM o
UNION ALL SELECT k + 1000000000000, id, 'duplicate', '', 'EXACT_DUPLICATE', {", ".join("NULL" for _ in values)} FROM r WHERE k % 50 = 0"""


ORACLES = {
    "star_txn": f"{STAR} SELECT transaction_id, account_id, txn_date, month_start, quarter, amount_inr, net_inr, status, customer_name, kyc_status, product_type, category, branch_name, region FROM t",
    "kpi01_top_customers": f"{STAR} {top('v')}",
    "kpi02_branch_monthly": f"{STAR} SELECT region, branch_id, branch_name, month_start, txn_count, net AS net_value_inr, lag(net) OVER (PARTITION BY branch_id ORDER BY month_start) AS prev_month_value_inr, {growth('PARTITION BY branch_id ORDER BY month_start')} AS mom_growth_pct FROM ({totals('region, branch_id, branch_name, month_start')})",
    "kpi02_region_monthly": f"{STAR} SELECT region, month_start, txn_count, net AS net_value_inr, {growth('PARTITION BY region ORDER BY month_start')} AS mom_growth_pct FROM ({totals('region, month_start')})",
    "kpi03_product_revenue": f"{STAR} SELECT quarter, product_type, net AS revenue_inr, txn_count, {pct('net', 'sum(net) OVER (PARTITION BY quarter)', 1)} AS share_of_quarter_pct, lag(net) OVER (PARTITION BY product_type ORDER BY quarter) AS prev_quarter_revenue_inr, {growth('PARTITION BY product_type ORDER BY quarter')} AS qoq_growth_pct FROM ({totals('quarter, product_type')})",
    "kpi03_product_share": f"{STAR} SELECT product_id, product_name, product_type, category, net AS revenue_inr, {pct('net', 'sum(net) OVER ()', 2)} AS share_pct FROM ({totals('product_id, product_name, product_type, category')})",
    "kpi04_dormant_accounts": f"""{STAR}, f AS (SELECT * FROM t),
 last AS (SELECT account_id, txn_date, product_id FROM f QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY txn_ts DESC, transaction_id DESC, product_id DESC) = 1), a AS (SELECT max(txn_date) AS d FROM f)
SELECT 'A' || c_custkey AS account_id, 'C' || c_custkey AS customer_id, c_name AS customer_name, txn_date AS last_txn_date, date_diff('day', txn_date, d) AS days_inactive, (['Savings Account', 'Loan', 'Credit Card', 'Fixed Deposit'])[(p_size % 4 + 1)::INT] AS product_type,
  CASE WHEN p_size % 4 IN (1, 2) THEN 'High-risk dormant' ELSE 'Dormant' END AS dormancy_class
FROM customer CROSS JOIN a LEFT JOIN last ON account_id = 'A' || c_custkey LEFT JOIN part ON product_id = 'P' || p_partkey WHERE txn_date IS NULL OR txn_date < d - 90""",
    "kpi05_suspicious_10min": suspicious(10),
    "kpi05_suspicious_60min": suspicious(60),
    "kpi06_customer_segments": f"{SEGMENTS} SELECT * FROM seg",
    "kpi07_branch_ranking": f"{STAR} {ranking('v')}",
    "kpi08_kyc_exposure": f"{STAR} SELECT kyc_status, txn_count, net AS value_inr, {pct('txn_count', 'sum(txn_count) OVER ()', 1)} AS share_of_count_pct, {pct('net', 'sum(net) OVER ()', 1)} AS share_of_value_pct, kyc_status <> 'Verified' AS at_risk FROM ({totals('kyc_status')})",
    "kpi09_refund_by_product": f"{STAR} SELECT product_type, count(*) AS txn_count, sum(is_refund)::BIGINT AS refund_count, sum(CASE WHEN is_refund = 1 THEN amount_inr ELSE 0 END)::DECIMAL(18,2) AS refund_value_inr, {pct('sum(is_refund)', 'count(*)', 1)} AS refund_rate_pct, {pct('sum(CASE WHEN is_refund = 1 THEN amount_inr ELSE 0 END)', 'sum(amount_inr)', 1)} AS refund_value_pct FROM v GROUP BY product_type",
    "kpi09_refund_by_branch": f"{STAR} SELECT region, branch_id, branch_name, count(*) AS txn_count, sum(is_refund)::BIGINT AS refund_count, sum(CASE WHEN is_refund = 1 THEN amount_inr ELSE 0 END)::DECIMAL(18,2) AS refund_value_inr, {pct('sum(is_refund)', 'count(*)', 1)} AS refund_rate_pct FROM v GROUP BY ALL",
    "kpi10_dq_scorecard": f"""{LINES}, r AS (SELECT *, row_number() OVER (PARTITION BY batch_id, source_file ORDER BY record_count DESC, reason_code) AS rn FROM issues WHERE severity = 'REJECT')
SELECT c.batch_id, c.source_file, records_received, records_passed, records_rejected, duplicates_removed, {pct('records_passed', 'records_received', 1)} AS pass_rate_pct, string_agg(reason_code || ' (' || record_count || ')', ', ' ORDER BY rn) AS top_3_reject_reasons
FROM card c LEFT JOIN r ON r.batch_id = c.batch_id AND r.source_file = c.source_file AND rn <= 3 GROUP BY ALL""",
    "branch_trend": f"{STAR} SELECT * FROM (SELECT region, branch_id, branch_name, month_start, txn_count, net AS net_value_inr, lag(net) OVER (PARTITION BY branch_id ORDER BY month_start) AS prev_month_value_inr, {growth('PARTITION BY branch_id ORDER BY month_start')} AS mom_growth_pct FROM ({totals('region, branch_id, branch_name, month_start')})) WHERE branch_id = 'B7'",
    "at_risk_exposure": f"{STAR}, e AS (SELECT kyc_status, net, {pct('txn_count', 'sum(txn_count) OVER ()', 1)} AS c, {pct('net', 'sum(net) OVER ()', 1)} AS w FROM ({totals('kyc_status')})) SELECT round(sum(c), 1) AS count_pct, round(sum(w), 1) AS value_pct, sum(net)::DECIMAL(18,2) AS value_inr FROM e WHERE kyc_status <> 'Verified'",
    "dormant_listing": f"""{STAR}, last AS (SELECT account_id, txn_date, product_id FROM t QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY txn_ts DESC, transaction_id DESC, product_id DESC) = 1), a AS (SELECT max(txn_date) AS d FROM t),
 idle AS (SELECT 'A' || c_custkey AS account_id, date_diff('day', txn_date, d) AS days_inactive, CASE WHEN p_size % 4 IN (1, 2) THEN 'High-risk dormant' ELSE 'Dormant' END AS dormancy_class
  FROM customer CROSS JOIN a LEFT JOIN last ON account_id = 'A' || c_custkey LEFT JOIN part ON product_id = 'P' || p_partkey WHERE txn_date IS NULL OR txn_date < d - 90)
SELECT *, row_number() OVER (ORDER BY dormancy_class DESC NULLS LAST, days_inactive DESC NULLS LAST, account_id) AS place FROM idle""",
    "value_listing": """SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 HAVING (SELECT count(DISTINCT o_orderstatus) FROM orders) <= 15
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2 HAVING (SELECT count(DISTINCT o_orderpriority) FROM orders) <= 15
UNION ALL SELECT 'o_orderkey', o_orderkey::VARCHAR, count(*) FROM orders GROUP BY 2 HAVING (SELECT count(DISTINCT o_orderkey) FROM orders) <= 15""",
    "repeated_keys": "SELECT l_orderkey || '-' || l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "row_hashes": """SELECT c_custkey, sha256('{"v":[' || coalesce('"' || nullif(right(c_name, 1), '3') || '"', 'null') || ',"' || c_nationkey || '"]}') AS row_hash FROM customer""",
    "parse_flags": """WITH m AS (SELECT c_custkey, (['yes', 'true', 'n', 'false', '1', 'maybe', ''])[(c_custkey % 7 + 1)::INT] AS said, (['paid', ' ', 'late '])[(c_custkey % 3 + 1)::INT] || ([' ', '', '  twice'])[(c_nationkey % 3 + 1)::INT] AS remark FROM customer)
SELECT c_custkey, CASE said WHEN 'true' THEN true WHEN 'false' THEN false END AS said, nullif(trim(regexp_replace(remark, '\\s+', ' ', 'g')), '') AS remarks, CASE WHEN c_custkey % 3 = 2 THEN 'x' END AS blank FROM m""",
    "parse_timestamp": """SELECT c_custkey, try_cast(CASE WHEN c_custkey % 5 IN (0, 2, 3) AND c_nationkey % 5 IN (0, 1, 2) THEN (['2020-01-05', '', '2019-12-31', '2020-02-29', ''])[(c_custkey % 5 + 1)::INT] || ([' 01:02:03', ' 23:59:59', ' 00:00:00', '', ''])[(c_nationkey % 5 + 1)::INT] END AS TIMESTAMP) AS at FROM customer""",
    "settle_customers": """WITH raw AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS key, DATE '2020-01-01' + (c_custkey % 28)::INT AS day, c_custkey % 3 = 0 AS no_mail FROM customer),
 r AS (SELECT *, CASE WHEN k % 17 = 0 THEN NULL ELSE 'C' || key END AS id, CASE WHEN k % 23 <> 0 THEN 'A' || key % 700 END AS account, concat_ws(';', CASE WHEN k % 17 = 0 THEN 'MISSING_CUSTOMER_ID' END, CASE WHEN k % 23 = 0 THEN 'MISSING_ACCOUNT_ID' END, CASE WHEN k % 7 = 3 THEN 'INVALID_KYC_STATUS' END) AS bad FROM raw),
 best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY no_mail, k DESC) AS rank FROM r WHERE bad = ''),
 own AS (SELECT k, row_number() OVER (PARTITION BY account ORDER BY day, id) AS place FROM best WHERE rank = 1),
 said AS (SELECT r.*, CASE WHEN r.bad <> '' THEN 'rejected' WHEN best.rank > 1 THEN 'duplicate' WHEN own.place > 1 THEN 'rejected' ELSE 'passed' END AS disposition,
   CASE WHEN r.bad <> '' THEN r.bad WHEN best.rank = 1 AND own.place > 1 THEN 'SHARED_ACCOUNT_ID' ELSE '' END AS reasons,
   CASE WHEN best.rank > 1 THEN 'NEAR_DUPLICATE_RESOLVED' WHEN best.rank = 1 AND own.place > 1 THEN '' WHEN r.no_mail THEN 'MISSING_EMAIL' ELSE '' END AS flags
   FROM r LEFT JOIN best ON best.k = r.k LEFT JOIN own ON own.k = r.k)
SELECT k AS pos, id AS record_key, disposition, reasons, flags, CASE disposition WHEN 'passed' THEN id END AS customer_id, CASE WHEN disposition = 'passed' AND NOT no_mail THEN 'x' || k || '@mail.org' END AS email,
  CASE disposition WHEN 'passed' THEN '+91-9876543210' END AS phone, CASE disposition WHEN 'passed' THEN account END AS account_id, CASE disposition WHEN 'passed' THEN '1 X St' END AS address,
  CASE disposition WHEN 'passed' THEN CASE WHEN k % 2 = 0 THEN 'Verified' ELSE 'Pending' END END AS kyc_status, CASE disposition WHEN 'passed' THEN day END AS registration_date FROM said
UNION ALL SELECT k + 10000000, id, 'duplicate', '', 'EXACT_DUPLICATE', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM r WHERE k % 50 = 0""",
    "settle_products": settled(
        "part", "p_partkey", "P", {"MISSING_PRODUCT_ID": "k % 17 = 0", "INVALID_PRODUCT_TYPE": "k % 13 = 0", "INVALID_CATEGORY": "k % 11 = 0", "INVALID_PRICE": "k % 19 = 0"},
        {"NEGATIVE_PRICE_CORRECTED": "k % 19 <> 0 AND k % 8 = 0", "MISSING_IS_ACTIVE": "k % 3 = 2", "MISSING_PRODUCT_NAME": "k % 5 = 0"},
        {
            "product_name": "CASE WHEN k % 5 <> 0 THEN 'name ' || k END", "product_type": "CASE WHEN k % 2 = 0 THEN 'Loan' ELSE 'Savings Account' END", "launch_date": "DATE '2020-01-31'", "vendor_name": "CASE WHEN k % 4 <> 0 THEN 'v' END",
            "price": "(CASE WHEN k % 8 = 0 THEN k + 0.5 ELSE 1000 + k % 1000 END)::DOUBLE", "is_active": "(k % 3 = 0)::BIGINT",
        },
    ),
    "settle_branches": settled(
        "supplier", "s_suppkey", "B", {"MISSING_BRANCH_ID": "k % 17 = 0", "INVALID_REGION": "k % 7 = 3", "INVALID_BRANCH_TYPE": "k % 9 = 0"}, {"MISSING_MANAGER": "k % 4 = 0", "INVALID_CONTACT": "k % 6 = 0", "AMBIGUOUS_DATE": "k % 3 = 0"},
        {
            "branch_name": "'branch ' || k", "location": "'New Delhi-O''Neil'", "manager_name": "CASE WHEN k % 4 = 0 THEN 'UNKNOWN' ELSE 'm' || k END", "opened_date": "DATE '2022-08-07'", "region": "'South'", "branch_type": "'Rural'",
            "contact_number": "CASE WHEN k % 6 = 0 THEN '1' ELSE '+91-9876543210' END",
        },
    ),
    "settle_transactions": settled(
        "orders", "o_orderkey", "T",
        {
            "MISSING_KEY": "k % 17 = 0 OR k % 23 = 0", "INVALID_TIMESTAMP": "k % 29 = 0", "FUTURE_DATED": "k % 29 <> 0 AND o_orderdate::DATE > DATE '1998-01-01'", "INVALID_REFUND_FLAG": "k % 41 = 0", "MISSING_AMOUNT": "k % 44 = 0",
            "INVALID_AMOUNT": "k % 44 = 3", "ZERO_AMOUNT": "k % 44 = 2", "NEGATIVE_AMOUNT": "k % 44 = 1", "INVALID_STATUS": "k % 31 = 0", "INVALID_PAYMENT_METHOD": "k % 19 = 0", "INVALID_CURRENCY": "k % 37 = 0",
        },
        {"DATE_MISMATCH": "k % 29 <> 0 AND k % 4 = 0", "MISSING_REFUND_FLAG": "k % 41 <> 0 AND k % 5 = 0", "NON_INR_CURRENCY": "k % 37 = 0 OR k % 13 = 0"},
        {
            "account_id": "'A' || o_custkey", "txn_date": "o_orderdate::DATE", "currency": "CASE WHEN k % 13 = 0 THEN 'USD' ELSE 'INR' END", "payment_method": "'UPI'", "status": "CASE WHEN k % 2 = 0 THEN 'Failed' ELSE 'Success' END",
            "remarks": "CASE WHEN k % 3 <> 0 THEN 'note ' || k END", "amount": "(1000.5 + k % 1000)::DOUBLE", "amount_inr": "(CASE WHEN k % 13 <> 0 THEN 1000.5 + k % 1000 END)::DOUBLE",
            "is_refund": "(k % 5 <> 0 AND k % 2 = 0)::BIGINT", "date_mismatch": "(k % 4 = 0)::BIGINT", "needs_review": "(k % 13 = 0)::BIGINT",
        },
        conflicts=True,
    ),
    "touched_days": """WITH m AS (SELECT o_orderkey AS k, o_orderdate::DATE - 1000 AS day FROM orders WHERE (o_orderkey % 2 = 0 OR o_orderkey % 15 = 0) AND o_orderkey % 10 = 0)
SELECT strftime(day, '%Y-%m-%d') AS part FROM m UNION SELECT strftime(o_orderdate::DATE, '%Y-%m-%d') FROM orders JOIN m ON k = o_orderkey WHERE o_orderkey % 6 <> 0""",
    "issue_counts": f"{LINES} SELECT * FROM issues",
    "scd2_merge": f"{VERSIONS} SELECT * FROM dim",
    "scd_actions": f"{VERSIONS} SELECT action, count(*) AS n FROM x WHERE action <> 'kept' GROUP BY action",
    "scd1_update": f"{VERSIONS} SELECT customer_id, customer_name, kyc_status, is_current FROM dim WHERE batch_id = 'day2' AND valid_from = DATE '1900-01-01' AND customer_name LIKE '% II'",
    "scd_replay_protected": f"{VERSIONS} SELECT CASE WHEN k % 7 = 0 AND comes OR k % 11 = 0 AND comes THEN 'skipped_newer_exists' ELSE 'unchanged' END AS action, count(*) AS n FROM x WHERE had GROUP BY ALL",
    "kpi12_kyc_transitions": f"{VERSIONS} SELECT n.customer_id, n.customer_name, o.kyc_status AS from_status, n.kyc_status AS to_status, n.valid_from AS changed_on, n.batch_id FROM dim n JOIN dim o ON o.customer_id = n.customer_id AND o.valid_to = n.valid_from WHERE o.kyc_status <> n.kyc_status",
    "asof_join": f"""{VERSIONS}, o AS (SELECT o_orderkey, 'A' || o_custkey AS account_id, CASE WHEN o_orderkey % 5 = 0 THEN DATE '2026-10-01' ELSE o_orderdate::DATE END AS day FROM orders)
SELECT o.*, customer_id, kyc_status, (customer_id IS NOT NULL)::BIGINT AS matches FROM o LEFT JOIN dim ON dim.account_id = o.account_id AND valid_from <= day AND day < valid_to""",
    "fact_upsert": f"""{FACTS} SELECT transaction_id, account_id, txn_date, CASE WHEN action IN ('inserted', 'corrected') THEN amount2 ELSE amount END AS amount, CASE WHEN action IN ('inserted', 'corrected') THEN status2 ELSE status END AS status,
  CASE WHEN action IN ('inserted', 'corrected') THEN remarks2 ELSE remarks END AS remarks, customer_sk, CASE WHEN action = 'inserted' THEN 'day2' ELSE 'day1' END AS source_batch_id, CASE WHEN action IN ('inserted', 'corrected') THEN 'day2' ELSE 'day1' END AS last_updated_batch_id FROM x""",
    "fact_actions": f"{FACTS} SELECT action, count(*) AS n FROM x WHERE action <> 'kept' GROUP BY action",
    "correction_diff": f"""{FACTS}, c AS (SELECT * FROM x WHERE action = 'corrected') SELECT transaction_id, 'amount' AS column_name, amount::VARCHAR AS old_value, amount2::VARCHAR AS new_value FROM c WHERE amount <> amount2
UNION ALL SELECT transaction_id, 'status', status, status2 FROM c WHERE status <> status2 UNION ALL SELECT transaction_id, 'remarks', remarks, remarks2 FROM c WHERE remarks IS DISTINCT FROM remarks2""",
    "kpi11_incremental_counts": f"""SELECT 'New transactions' AS metric, count(*) AS record_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 20 = 0
UNION ALL SELECT 'Corrected transactions', count(*) FROM ({FACTS} SELECT * FROM x WHERE action = 'corrected')
UNION ALL SELECT 'New customers', count(*) FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT 'Customers with new version', 0 UNION ALL SELECT 'New products', count(*) FROM part WHERE p_partkey % 50 = 0
UNION ALL SELECT 'Products with new version', 0 UNION ALL SELECT 'New branches', count(*) FROM supplier WHERE s_suppkey % 25 = 0 UNION ALL SELECT 'Branches with new version', 0""",
    "kpi_snapshot": f"{STAR} {snapshot('v', 'day2')}",
    "kpi11_kpi_deltas": f"""{STAR}, v1 AS (SELECT * FROM v WHERE source_batch_id = 'day1'), a AS ({snapshot('v1', 'day1')}), b AS ({snapshot('v', 'day2')})
SELECT b.kpi_name, b.item_key, b.item_label, a.rank_no AS day1_rank, b.rank_no AS day2_rank, a.metric_value AS day1_value, b.metric_value AS day2_value, (b.metric_value - coalesce(a.metric_value, 0))::DECIMAL(18,2) AS value_change
FROM b LEFT JOIN a USING (kpi_name, item_key)""",
    "kpi13_new_activations": f"""{STAR}, f AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY txn_ts, transaction_id) = 1)
SELECT account_id, customer_id, customer_name, transaction_id AS first_transaction_id, txn_ts AS first_txn_ts, substr(customer_id, 2)::BIGINT % 10 = 0 AS newly_onboarded FROM f WHERE source_batch_id = 'day2'""",
    "range_self_join": "SELECT a.event_id, count(*) AS n FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 60 MINUTE AND a.ts GROUP BY a.event_id HAVING count(*) >= 3",
    "exact_dedupe": "SELECT doc_id, row_number() OVER w AS copy, row_number() OVER w > 1 AS duplicate FROM documents WINDOW w AS (PARTITION BY text ORDER BY doc_id)",
    "conflict_quarantine": "SELECT concat_ws('-', l_orderkey, l_linenumber) AS key, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1",
    "best_copy": """WITH l AS (SELECT *, (l_tax > 0.04)::BIGINT + (l_returnflag = 'N')::BIGINT + (l_discount > 0.05)::BIGINT AS n_flags FROM lineitem)
SELECT concat_ws('-', l_orderkey, l_linenumber) AS key, l_partkey, l_suppkey, n_flags FROM l QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY n_flags, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_shipdate DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "account_owner": """WITH c AS (SELECT c_custkey % 500 AS account, c_custkey AS customer, min(o_orderdate)::DATE AS d FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT account, customer, row_number() OVER (PARTITION BY account ORDER BY d NULLS LAST, customer) = 1 AS is_owner FROM c""",
    "referential_check": """WITH l AS (SELECT *, l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45) AS a, l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(';', CASE WHEN a THEN 'ORPHAN_PRODUCT' END, CASE WHEN b THEN 'ORPHAN_BRANCH' END) AS reasons FROM l WHERE a OR b""",
    "parse_amount": f"""{MESSY}, bare AS (SELECT c_custkey, replace(regexp_replace(trim(amount), '^(rs\\.?|inr|₹)\\s*', '', 'i'), ',', '') AS b FROM messy), num AS (SELECT c_custkey, try_cast(b AS DECIMAL(38,10)) AS x FROM bare)
SELECT c_custkey, (CASE WHEN abs(x * 100 - trunc(x * 100)) = 0.5 THEN trunc(x * 100) + CASE WHEN trunc(x * 100)::BIGINT % 2 = 0 THEN 0 ELSE sign(x) END ELSE round(x * 100) END / 100)::DECIMAL(15,2) AS amount FROM num""",
    "date_candidates": f"{READINGS} SELECT c_custkey, CASE WHEN day_first IS NOT NULL THEN day_first ELSE c[1] END AS first, CASE WHEN len(c) = 2 THEN list_filter(c, lambda x: x <> day_first)[1] END AS second, len(c)::BIGINT AS readings FROM r",
    "lookup_codes": f"{MESSY} SELECT c_custkey, CASE lower(trim(replace(status, chr(9), ' '))) WHEN 'succes' THEN 'Success' WHEN 'sucess' THEN 'Success' WHEN 'faild' THEN 'Failed' WHEN 'pending' THEN 'Pending' END AS status FROM messy",
    "clean_text": f"{MESSY} SELECT c_custkey, trim(regexp_replace(address, '\\s+', ' ', 'g')) AS address FROM messy",
    "title_case": f"{MESSY} SELECT c_custkey, list_aggregate(list_transform(regexp_extract_all(trim(regexp_replace(address, '\\s+', ' ', 'g')), '[a-zA-Z]+|[^a-zA-Z]+'), lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') AS address FROM messy",
    "email_phone": f"""{MESSY}, p AS (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS dg, lower(trim(email)) AS e FROM messy), q AS (SELECT *, CASE WHEN starts_with(trim(phone), '+91') OR length(dg) = 12 AND starts_with(dg, '91') THEN substr(dg, 3) ELSE dg END AS local FROM p)
SELECT c_custkey, e AS email, regexp_matches(e, '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$') AS email_valid, CASE WHEN length(local) = 10 THEN '+91-' || local ELSE trim(phone) END AS phone, length(local) = 10 AS phone_valid FROM q""",
    "shape_profile": """WITH c AS (SELECT 'event_type' AS column_name, event_type AS v FROM events UNION ALL SELECT 'props', props FROM events),
s AS (SELECT column_name, CASE WHEN trim(coalesce(v, '')) = '' THEN '<blank>' ELSE regexp_replace(regexp_replace(v, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') END AS shape, count(*) AS shape_n FROM c GROUP BY ALL),
a AS (SELECT column_name, count(*) AS n_rows, count(*) FILTER (trim(coalesce(v, '')) = '') AS blanks, count(DISTINCT v) FILTER (trim(v) <> '') AS n_distinct FROM c GROUP BY ALL)
SELECT s.column_name, shape, shape_n, row_number() OVER (PARTITION BY s.column_name ORDER BY shape_n DESC, shape) AS shape_rank, n_rows, blanks, n_distinct FROM s JOIN a USING (column_name) QUALIFY shape_rank <= 5""",
    "duplicate_profile": "SELECT count(*) AS n_rows, count(*) - count(DISTINCT (text, lang, source)) AS repeated_rows, count(text) - count(DISTINCT text) AS repeated_keys FROM documents",
    "pivot_month_region": f"{STAR} SELECT month_start, " + ", ".join(f"(sum(net_inr) FILTER (region = '{r}'))::DECIMAL(18,2) AS \"{r}\"" for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + " FROM v GROUP BY month_start",
    "pivot_quarter_product": f"{STAR} SELECT quarter, " + ", ".join(f"(sum(net_inr) FILTER (product_type = '{p}'))::DECIMAL(18,2) AS \"{p}\"" for p in ("Credit Card", "Fixed Deposit", "Loan", "Savings Account")) + " FROM v GROUP BY quarter",
    "dashboard_totals": f"""SELECT * FROM ({STAR} SELECT (SELECT count(*) FROM t) AS facts, count(*) AS valued, sum(net_inr)::DECIMAL(18,2) AS net_value_inr FROM v)
CROSS JOIN ({LINES} SELECT sum(records_received)::BIGINT AS records_received, sum(records_passed)::BIGINT AS records_passed, sum(records_rejected)::BIGINT AS records_rejected, sum(duplicates_removed)::BIGINT AS duplicates_removed, {pct('sum(records_passed)', 'sum(records_received)', 1)} AS pass_rate_pct FROM card)""",
    "segment_counts": f"{SEGMENTS} SELECT segment, count(*) AS n FROM seg GROUP BY segment",
    "reason_counts": f"SELECT reason, count(*) FILTER (contains(risk_reason, reason)) AS n FROM ({suspicious(60)}), (VALUES ('HIGH_VALUE'), ('VELOCITY_3_IN_60_MIN'), ('ODD_HOURS')) r(reason) GROUP BY reason",
    "reason_filter": f"SELECT transaction_id, risk_reason FROM ({suspicious(60)}) WHERE contains(risk_reason, 'HIGH_VALUE') OR contains(risk_reason, 'VELOCITY_3_IN_60_MIN')",
    "quarantine_search": f"{LINES} SELECT key, array_to_string(rejects, ';') AS reasons FROM l WHERE contains(lower(array_to_string(rejects, ';')), 'orphan')",
    "safe_csv": "SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 5 < 4 THEN '''' ELSE '' END || (['=', '+', '-', '@', ''])[(c_custkey % 5 + 1)::INT] || c_name AS c_name FROM customer",
}

#: Columns of exact decimals, which the results hold as doubles.
MONEY = {
    "star_txn": ("amount_inr", "net_inr"),
    "branch_trend": ("net_value_inr", "prev_month_value_inr"),
    "at_risk_exposure": ("value_inr",),
    "kpi01_top_customers": ("net_value_inr",),
    "kpi02_branch_monthly": ("net_value_inr", "prev_month_value_inr"),
    "kpi02_region_monthly": ("net_value_inr",),
    "kpi03_product_revenue": ("revenue_inr", "prev_quarter_revenue_inr"),
    "kpi03_product_share": ("revenue_inr",),
    "kpi05_suspicious_10min": ("amount",),
    "kpi05_suspicious_60min": ("amount",),
    "kpi06_customer_segments": ("monetary_inr",),
    "kpi07_branch_ranking": ("revenue_inr",),
    "kpi08_kyc_exposure": ("value_inr",),
    "kpi09_refund_by_product": ("refund_value_inr",),
    "kpi09_refund_by_branch": ("refund_value_inr",),
    "fact_upsert": ("amount",),
    "kpi_snapshot": ("metric_value",),
    "kpi11_kpi_deltas": ("day1_value", "day2_value", "value_change"),
    "parse_amount": ("amount",),
    "pivot_month_region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "pivot_quarter_product": ("Credit Card", "Fixed Deposit", "Loan", "Savings Account"),
    "dashboard_totals": ("net_value_inr",),
}
for _name, _columns in MONEY.items():
    _casts = ", ".join(f'"{c}"::DOUBLE AS "{c}"' for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]})"
ORACLES["kpi02_monthly_levels"] = f"""SELECT 'branch' AS level, * FROM ({ORACLES["kpi02_branch_monthly"]})
UNION ALL BY NAME SELECT 'region' AS level, *, lag(net_value_inr) OVER (PARTITION BY region ORDER BY month_start) AS prev_month_value_inr FROM ({ORACLES["kpi02_region_monthly"]})"""
# what daily sums add up to is what the facts do
for _name, _same in {
    "kpi01_from_daily_sums": "kpi01_top_customers", "kpi02_from_daily_sums": "kpi02_branch_monthly", "kpi03_from_daily_sums": "kpi03_product_share", "kpi06_from_daily_sums": "kpi06_customer_segments",
    "kpi07_from_daily_sums": "kpi07_branch_ranking", "touched_days_by_key_index": "touched_days", "kpi09_from_daily_sums": "kpi09_refund_by_product",
}.items():
    ORACLES[_name] = ORACLES[_same]

_FILES = "SELECT event_type, event_id % 64 AS part, count(*) AS n FROM events GROUP BY ALL"
ORACLES["json_file_state"] = f"""
SELECT event_type, part, n AS rows_read, (part % 3 = 2)::BIGINT AS fragments_lost, part % 3 = 2 OR (part % 3 = 1 AND n > 1) AS broken FROM ({_FILES})"""
ORACLES["json_salvage"] = f"""
SELECT props AS record, NULL AS fragment, count(*) AS n FROM events GROUP BY props
UNION ALL SELECT NULL, '{{cut', count(*) FROM ({_FILES})"""
