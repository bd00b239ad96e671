"""Mapping of the TPC-H-like test tables to the five raw sources.

Each text is in the common subset of Spark SQL and DuckDB SQL: ``{name}`` stands for a test
table, so the same mapping serves the engine and the SQL it is checked against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _email(k: str) -> str:
    return (
        f"CASE WHEN {k} % 5 = 0 THEN ' User' || CAST({k} AS STRING) || '_at_Mail.com ' "
        f"ELSE 'USER' || CAST({k} AS STRING) || '@mail.com' END"
    )


USERS = f"""
SELECT 'user_' || CAST(c_custkey AS STRING) AS user_id,
 CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'n/a' WHEN c_custkey % 10 = 2 THEN '  mary   ANN ' WHEN c_custkey % 10 = 3 THEN ' null ' ELSE 'nAME' || CAST(c_custkey % 7 AS STRING) END AS first_name,
 CASE WHEN c_custkey % 12 = 0 THEN 'NULL' ELSE lower(c_mktsegment) END AS last_name,
 CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'None' ELSE NULL END AS gender,
 CASE WHEN c_custkey % 100 = 99 THEN {_email("(c_custkey - 1)")} ELSE {_email("c_custkey")} END AS email,
 n_name AS country,
 CASE WHEN c_custkey % 37 = 0 THEN 'bad' ELSE CAST(DATE '2023-12-20' + CAST(c_custkey % 20 AS INT) AS STRING) END AS signup_date,
 CASE WHEN c_custkey % 6 = 0 THEN 'nan' WHEN c_custkey % 6 = 1 THEN NULL ELSE c_mktsegment END AS lead_source,
 CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE '+1 (555) ' || CAST(c_custkey AS STRING) || '-77' END AS phone,
 CAST(DATE '2023-12-20' + CAST(c_custkey % 20 AS INT) AS STRING) || ' 08:30:00' AS created_date
 FROM {{customer}} LEFT JOIN {{nation}} ON c_nationkey = n_nationkey"""

PRODUCT_USAGE = f"""
SELECT 'ev_' || CAST(event_id AS STRING) AS event_id,
 CASE event_id % 20 WHEN 0 THEN 'user_unknown' WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN NULL WHEN 4 THEN 'ano_' || CAST(event_id AS STRING) ELSE 'user_' || CAST(user_id AS STRING) END AS user_id,
 CASE WHEN event_id % 20 IN (4, 5, 6) THEN NULL ELSE {_email("user_id")} END AS user_email,
 CASE event_type WHEN 'purchase' THEN 'Feature A' WHEN 'click' THEN 'Feature B' ELSE event_type END AS feature_name,
 CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(ts AS STRING) END AS event_timestamp,
 's_' || CAST(user_id AS STRING) || '_' || CAST(event_id % 11 AS STRING) AS session_id,
 '{{{{"device":"' || CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END || '","os":"os' || CAST(event_id % 4 AS STRING) || '","browser":"b' || CAST(event_id % 5 AS STRING) || '"' || CASE WHEN event_id % 8 = 0 THEN '' ELSE ',"country":"C' || CAST(event_id % 6 AS STRING) || '"' END || ',"session_duration":' || CASE event_id % 7 WHEN 0 THEN '"12.6"' WHEN 1 THEN '"abc"' WHEN 2 THEN '30.4' ELSE CAST(event_id % 600 AS STRING) END || '}}}}' AS properties
 FROM {{events}}"""

SUBSCRIPTIONS = f"""
SELECT 'sub_' || CAST(o_custkey AS STRING) AS subscription_id, 'txn_' || CAST(o_orderkey AS STRING) AS transaction_id,
 'user_' || CAST(o_custkey AS STRING) AS customer_id, {_email("o_custkey")} AS customer_email,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'premium' WHEN '2-HIGH' THEN 'STANDARD' WHEN '3-MEDIUM' THEN 'basic' WHEN '4-NOT SPECIFIED' THEN 'n/a' ELSE NULL END AS plan_name,
 CASE o_orderkey % 4 WHEN 0 THEN 'annual' WHEN 1 THEN 'N/A' WHEN 2 THEN ' monthly' ELSE NULL END AS billing_cycle,
 CASE o_orderkey % 15 WHEN 0 THEN 'canceled' WHEN 3 THEN ' ACTIVE' WHEN 6 THEN NULL ELSE 'active' END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS STRING) ELSE CAST(CAST(o_orderdate AS DATE) + 1 AS STRING) END AS current_period_start,
 CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) AS current_period_end,
 CAST(o_orderdate AS STRING) AS created,
 CASE WHEN o_orderkey % 15 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 200 AS STRING) ELSE NULL END AS canceled_at,
 CASE WHEN o_orderkey % 30 = 0 THEN 'Too expensive' ELSE NULL END AS churn_reason,
 CAST(o_orderdate AS STRING) AS valid_from,
 CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 365 AS STRING) END AS valid_to,
 o_orderkey % 2 = 0 AS is_current
 FROM {{orders}}"""

TRANSACTIONS = f"""
SELECT CASE WHEN o_orderkey % 25 = 24 THEN 're_' ELSE 'txn_' END || CAST(o_orderkey AS STRING) AS transaction_id,
 'user_' || CAST(o_custkey AS STRING) AS customer_id, {_email("o_custkey")} AS cust_email,
 CASE o_orderkey % 8 WHEN 0 THEN 'subscription_payment_new' WHEN 1 THEN 'Subscription_Payment_Upgrade' WHEN 2 THEN 'subscription_payment_downgrade' WHEN 3 THEN ' subscription_payment_renewal ' WHEN 4 THEN 'N/A' WHEN 5 THEN NULL WHEN 6 THEN 'none' ELSE 'refund' END AS transaction_type,
 CAST(1 + o_orderkey % 3 AS INT) AS quantity,
 CAST(o_orderkey % 400 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS price,
 CAST(o_custkey % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS discount,
 CASE o_orderkey % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'US Dollar' WHEN 2 THEN '$' WHEN 3 THEN ' eur ' ELSE 'EUR' END AS currency,
 CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'succeeded' ELSE 'SUCCEEDED ' END AS status,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'card' ELSE 'paypal' END AS payment_method,
 CASE WHEN o_orderstatus = 'F' THEN 'card_declined' ELSE NULL END AS failure_code,
 CAST(CAST(o_orderdate AS DATE) AS STRING) AS transaction_date, CAST(o_orderdate AS STRING) AS created_at,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 10 = 0 END AS refunded,
 CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderkey % 400 AS DOUBLE) * CAST(0.25 AS DOUBLE) ELSE NULL END AS refund_amount,
 CASE o_orderkey % 7 WHEN 0 THEN 'Basic Monthly new' WHEN 1 THEN 'Standard Annual upgrade' WHEN 2 THEN 'Premium Monthly downgrade' WHEN 3 THEN 'Ultimate Annual renewal' WHEN 4 THEN 'misc' WHEN 5 THEN 'Basic Annual renewal' ELSE NULL END AS description
 FROM {{orders}}"""

SUPPORT_TICKETS = f"""
SELECT 'tk_' || CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING) AS ticket_id, CASE WHEN conv_id % 13 = 12 THEN 'ghost@mail.com' ELSE {_email("conv_id")} END AS requester_email,
 'Name ' || CAST(conv_id AS STRING) AS requester_name,
 CASE conv_id % 3 WHEN 0 THEN 'bug' WHEN 1 THEN 'billing' ELSE 'question' END AS ticket_type, 'subject ' || CAST(turn AS STRING) AS subject, text AS description,
 CASE conv_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'normal' WHEN 2 THEN 'high' ELSE NULL END AS priority,
 CASE (conv_id + turn) % 5 WHEN 0 THEN 'Solved' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Open' WHEN 3 THEN 'Pending' ELSE 'New' END AS status,
 CASE role WHEN 'user' THEN CASE turn % 2 WHEN 0 THEN 'email' ELSE 'chat' END ELSE role END AS channel,
 CAST(DATE '2024-01-01' + CAST(conv_id % 45 AS INT) AS STRING) || ' 09:00:00' AS created_at,
 CASE WHEN conv_id % 6 = 0 THEN NULL ELSE CAST(DATE '2024-01-01' + CAST(conv_id % 45 AS INT) AS STRING) || ' 11:15:00' END AS first_response_at,
 CAST(DATE '2024-01-02' + CAST(conv_id % 45 AS INT) AS STRING) AS updated_at,
 CASE WHEN (conv_id + turn) % 5 < 2 THEN CAST(DATE '2024-01-03' + CAST(conv_id % 45 AS INT) AS STRING) ELSE '' END AS solved_at,
 CASE turn % 4 WHEN 0 THEN '1.5' WHEN 1 THEN '2.25' WHEN 2 THEN 'n/a' ELSE NULL END AS first_reply_time,
 CASE WHEN (conv_id + turn) % 5 < 2 THEN '24.5' ELSE NULL END AS full_resolution_time,
 CASE WHEN conv_id % 7 = 6 THEN NULL ELSE CAST(conv_id % 7 AS INT) END AS satisfaction_rating
 FROM {{conversations}}"""

# source -> (mapping, test tables it reads)
ADAPTERS = {
    "users": (USERS, ("customer", "nation")),
    "product_usage": (PRODUCT_USAGE, ("events",)),
    "subscriptions": (SUBSCRIPTIONS, ("orders",)),
    "transactions": (TRANSACTIONS, ("orders",)),
    "support_tickets": (SUPPORT_TICKETS, ("conversations",)),
}


class AdaptedSources:
    """The five sources, each mapped from the test tables of a folder on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ADAPTERS:
            raise AttributeError(name)
        text, tables = ADAPTERS[name]
        inputs = {t: self._spark.read.parquet(f"{self._folder}/{t}.parquet") for t in tables}
        source = self._spark.sql(text, **inputs)
        setattr(self, name, source)
        return source
