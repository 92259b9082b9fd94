"""The role views written independently as ANSI SQL (DuckDB dialect) CTEs.

The driver's correctness check runs these on the same parquet tables that the
Spark queries read.  ``with_roles(body)`` prefixes a query with every role CTE;
unused CTEs cost nothing.
"""

from __future__ import annotations

ROLE_CTES = """
cust_base AS (
  SELECT
    c.c_custkey AS customer_id,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
    (c.c_nationkey % 5 = 0) AS senior_citizen,
    (c.c_custkey % 3 = 0) AS has_partner,
    (c.c_custkey % 4 = 0) AS has_dependents,
    CAST(c.c_custkey % 73 AS BIGINT) AS tenure_months,
    (c.c_nationkey % 10 <> 0) AS phone_service,
    CASE WHEN c.c_nationkey % 10 = 0 THEN 'no_phone_service'
         WHEN c.c_custkey % 2 = 1 THEN 'yes' ELSE 'no' END AS multiple_lines,
    CASE WHEN n.n_regionkey IN (0, 1) THEN 'fiber_optic'
         WHEN n.n_regionkey IN (2, 3) THEN 'dsl' ELSE 'no' END AS internet_service,
    c.c_mktsegment,
    CAST(floor(greatest(c.c_acctbal, 0.0) + 0.5) / 100 AS DECIMAL(10, 2)) AS monthly_charges,
    ((c.c_acctbal < 1500) <> (substr(md5(CAST(c.c_custkey AS VARCHAR)), 1, 1) IN ('0', '1'))) AS churned
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
customers AS (
  SELECT
    customer_id, gender, senior_citizen, has_partner, has_dependents, tenure_months,
    phone_service, multiple_lines, internet_service,
    CASE WHEN internet_service = 'no' THEN 'no_internet_service'
         WHEN customer_id % 5 < 2 THEN 'yes' ELSE 'no' END AS online_security,
    CASE WHEN internet_service = 'no' THEN 'no_internet_service'
         WHEN customer_id % 7 < 3 THEN 'yes' ELSE 'no' END AS online_backup,
    CASE WHEN internet_service = 'no' THEN 'no_internet_service'
         WHEN customer_id % 11 < 5 THEN 'yes' ELSE 'no' END AS device_protection,
    CASE WHEN internet_service = 'no' THEN 'no_internet_service'
         WHEN customer_id % 13 < 4 THEN 'yes' ELSE 'no' END AS tech_support,
    CASE WHEN internet_service = 'no' THEN 'no_internet_service'
         WHEN customer_id % 2 < 1 THEN 'yes' ELSE 'no' END AS streaming_tv,
    CASE WHEN internet_service = 'no' THEN 'no_internet_service'
         WHEN customer_id % 3 < 1 THEN 'yes' ELSE 'no' END AS streaming_movies,
    CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'month_to_month'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'one_year' ELSE 'two_year' END AS contract_type,
    (customer_id % 5 <> 0) AS paperless_billing,
    CASE customer_id % 4 WHEN 0 THEN 'electronic_check' WHEN 1 THEN 'mailed_check'
         WHEN 2 THEN 'bank_transfer_automatic' ELSE 'credit_card_automatic' END AS payment_method,
    monthly_charges,
    CAST(monthly_charges * tenure_months AS DECIMAL(12, 2)) AS total_charges,
    churned,
    'tpch_customer' AS source_system,
    false AS is_synthetic
  FROM cust_base
),
fixed_subscriptions AS (
  SELECT
    printf('fix_%06d', customer_id + 1) AS fixed_subscription_id,
    customer_id,
    'fixed_broadband' AS service_type,
    CASE WHEN internet_service = 'fiber_optic' THEN 'Fiber Max'
         WHEN internet_service = 'dsl' THEN 'DSL Essential' ELSE 'Voice Only' END AS plan_name,
    CAST(CASE WHEN internet_service = 'fiber_optic' THEN 500
         WHEN internet_service = 'dsl' THEN 100 ELSE 0 END AS INTEGER) AS download_speed_mbps,
    contract_type,
    monthly_charges AS monthly_recurring_revenue,
    CASE WHEN churned THEN 'cancelled' ELSE 'active' END AS subscription_status,
    true AS is_synthetic
  FROM customers
),
mobile_subscriptions AS (
  SELECT
    o_orderkey AS mobile_subscription_id,
    o_custkey AS customer_id,
    'mobile' AS service_type,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Premium 5G' WHEN '2' THEN 'Family Share'
         WHEN '3' THEN 'Mobile Unlimited' ELSE 'Mobile Starter' END AS plan_name,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS line_count,
    o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_5g_enabled,
    CAST(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 85 WHEN '2' THEN 95
         WHEN '3' THEN 65 ELSE 35 END AS DECIMAL(10, 2)) AS monthly_recurring_revenue,
    'active' AS subscription_status,
    true AS is_synthetic
  FROM orders WHERE o_orderstatus = 'P'
),
byod_devices AS (
  SELECT
    event_id AS device_id,
    user_id AS customer_id,
    CASE WHEN event_id % 4 <> 0 THEN event_id END AS mobile_subscription_id,
    'byod' AS device_ownership,
    CASE WHEN event_id % 2 = 0 THEN 'ios' ELSE 'android' END AS device_os,
    CAST(1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 48 AS INTEGER)
      AS device_age_months,
    true AS is_synthetic
  FROM events WHERE event_type = 'view'
),
monthly_usage AS (
  SELECT
    l.l_orderkey * 8 + l.l_linenumber AS usage_id,
    o.o_custkey AS customer_id,
    l.l_orderkey AS subscription_id,
    'fixed_broadband' AS service_type,
    strftime(l.l_shipdate, '%Y-%m') AS usage_month,
    CAST(l.l_quantity AS DECIMAL(10, 2)) AS data_gb,
    CAST(l.l_partkey % 1500 AS INTEGER) AS voice_minutes,
    CAST(l.l_suppkey % 500 AS INTEGER) AS sms_count,
    true AS is_synthetic
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
billing_history AS (
  SELECT
    o_orderkey AS invoice_id,
    o_custkey AS customer_id,
    strftime(o_orderdate, '%Y-%m') AS billing_month,
    CAST(o_totalprice AS DECIMAL(10, 2)) AS invoice_amount,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'late' ELSE 'paid' END AS payment_status,
    CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 1 + o_orderkey % 30 ELSE 0 END AS INTEGER)
      AS days_late,
    true AS is_synthetic
  FROM orders
),
network_incidents AS (
  SELECT
    event_id AS incident_id,
    user_id AS customer_id,
    strftime(ts, '%Y-%m') AS incident_month,
    CASE event_id % 3 WHEN 0 THEN 'outage' WHEN 1 THEN 'degraded_service'
         ELSE 'maintenance' END AS incident_type,
    CAST(floor(value) AS INTEGER) AS duration_minutes,
    CASE WHEN event_id % 2 = 0 THEN 'fixed_broadband' ELSE 'mobile' END AS service_affected,
    true AS is_synthetic
  FROM events WHERE event_type = 'error'
),
support_tickets AS (
  SELECT
    event_id AS ticket_id,
    user_id AS customer_id,
    strftime(ts, '%Y-%m') AS ticket_month,
    CASE event_id % 7 WHEN 0 THEN 'billing' WHEN 1 THEN 'network_outage'
         WHEN 2 THEN 'slow_internet' WHEN 3 THEN 'device_problem'
         WHEN 4 THEN 'activation_issue' WHEN 5 THEN 'pricing_complaint'
         ELSE 'cancellation_request' END AS complaint_category_seed,
    props AS ticket_text,
    CASE WHEN value >= 300 THEN 'high' WHEN value >= 100 THEN 'medium' ELSE 'low' END AS priority,
    CAST(value AS DECIMAL(10, 2)) AS resolution_hours,
    true AS is_synthetic
  FROM events WHERE event_type = 'click'
),
retention_campaigns AS (
  SELECT
    event_id AS campaign_id,
    user_id AS customer_id,
    strftime(ts, '%Y-%m') AS campaign_month,
    CASE event_id % 3 WHEN 0 THEN 'discount' WHEN 1 THEN 'bill_credit'
         ELSE 'device_upgrade' END AS offer_type,
    CAST(10 + 5 * (event_id % 5) AS DECIMAL(10, 2)) AS offer_value,
    (value > 50) AS accepted_offer,
    true AS is_synthetic
  FROM events WHERE event_type = 'signup'
),
ticket_texts AS (
  SELECT
    d.doc_id AS ticket_id,
    d.doc_id % 1500 AS customer_id,
    d.text AS ticket_text,
    CASE WHEN lb.toxic = 1 THEN 'cancellation_request'
         WHEN lb.quality = 0 THEN 'billing'
         WHEN lb.quality = 1 THEN 'slow_internet' END AS complaint_category_seed
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id
)
"""


def with_roles(*ctes: str, body: str) -> str:
    """``WITH <roles>, <ctes...> <body>``."""
    parts = [ROLE_CTES.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
