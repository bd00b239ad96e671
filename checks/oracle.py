"""DuckDB SQL for every query, written from the meaning of each model.

The formulations differ from the engine's on purpose: dates are looked up by joining a
calendar, months come from a cross join with an inequality, a group's MRR is joined back to
its detail rows and summed again, and look backs are plain window functions.
"""

from __future__ import annotations

import re

from custarc.functions.keys import NULL_PART
from custarc.sources.adapters import ADAPTERS

TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
    "nation", "orders", "pages", "part", "region", "supplier",
)
SPINE_START, SPINE_LAST, HORIZON, MAX_MONTHS = "1996-01-01", "2024-01-31", "2001-06-30", 12


def title(e: str) -> str:
    words = f"string_split_regex(lower({e}), '\\s+')"
    return f"array_to_string([upper(w[1]) || w[2:] for w in {words}], ' ')"


def cleaned(e: str, fill: str = "") -> str:
    known = f"coalesce(lower({e}), 'null') NOT IN ('null', 'n/a', 'na', 'nan', 'none')"
    return title(f"if({known}, trim({e}), '{fill}')")


def mail(e: str) -> str:
    return f"lower(replace(trim({e}), '_at_', '@'))"


def key(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_PART}')" for c in cols]
    return f"md5({" || '-' || ".join(parts)})"


def prop(name: str) -> str:
    return f"replace(properties ->> '$.{name}', '\"', '')"


def plan_of(e: str) -> str:
    return (
        f"CASE WHEN {e} LIKE '%Basic%' THEN 'Basic' WHEN {e} LIKE '%Standard%' THEN 'Standard' "
        f"WHEN {e} LIKE '%Premium%' THEN 'Premium' ELSE 'Ultimate' END"
    )


def cycle_of(e: str) -> str:
    return f"if(coalesce({e}, '') LIKE '%Monthly%', 'Monthly', 'Annual')"


def type_of(order: tuple[str, ...]) -> str:
    tests = " ".join(
        f"WHEN strpos(description, '{w}') > 0 THEN 'subscription_payment_{w}'" for w in order
    )
    return (
        f"CASE WHEN cleaned_type <> '' THEN lower(trim(cleaned_type)) {tests} "
        "WHEN strpos(transaction_id, 're') > 0 THEN 'refund' END"
    )


def ordered(*cols: str) -> str:
    return ", ".join(f"{c} NULLS LAST" for c in cols)


def movements(kind: str, weight: str, cancellation: str) -> str:
    def total(when: str, amount: str, name: str) -> str:
        return f"sum(CASE {kind} WHEN '{when}' THEN {amount} ELSE 0 END) AS {name}"

    return ", ".join(
        [
            total("subscription_payment_new", weight, "new_mrr"),
            total("subscription_payment_upgrade", f"{weight} - old_price", "expansion_mrr"),
            total("subscription_payment_downgrade", f"old_price - {weight}", "contraction_mrr"),
            total("subscription_cancellation", cancellation, "cancellation_mrr"),
            total("subscription_payment_renewal", weight, "renewal_mrr"),
        ]
    )


MRR = ("new_mrr", "expansion_mrr", "contraction_mrr", "cancellation_mrr", "renewal_mrr")
SUM_AGAIN = ", ".join(f"coalesce(sum(m.{c}), 0.0) AS {c}" for c in MRR)
ONCE = ", ".join(f"coalesce(any_value(m.{c}), 0.0) AS {c}" for c in MRR)

STAGED_TXN = """SELECT transaction_id, customer_id, {mail} AS cust_email, {kind} AS transaction_type,
 quantity, price, discount,
 if(lower(currency) LIKE 'us%' OR strpos(currency, '$') > 0, 'USD', trim(currency)) AS currency,
 {status} AS status, payment_method, failure_code,
 TRY_CAST(transaction_date AS DATE) AS transaction_date, created_at,
 CAST(coalesce(refunded, false) AS INT) AS refunded, coalesce(refund_amount, 0.0) AS refund_amount, description
 FROM (SELECT *, {cleaned_type} AS cleaned_type FROM transactions)"""


def latest(field: str) -> str:
    """A person's latest known value."""
    known = f"FILTER (WHERE {field} NOT IN ('', 'Others'))"
    return f"coalesce(arg_max({field}, {{'c': coalesce(created_at, TIMESTAMP '0001-01-01'), 'u': coalesce(user_id, ''), 'f': {field}}}) {known}, max({field})) AS {field}"


def staged_txn(*words: str) -> str:
    return STAGED_TXN.format(
        mail=mail("cust_email"),
        kind=type_of(words),
        status=cleaned("status"),
        cleaned_type=cleaned("transaction_type"),
    )


def as_of(rows: str, day: str) -> str:
    """Join of ``rows`` with the version of their user that was the latest to start by ``day``."""
    return f"ASOF LEFT JOIN ver_started v ON v.user_sk = {rows}.user_sk AND {day} >= v.start_day"


def if_valid(column: str, day: str) -> str:
    return f"CASE WHEN v.best.until > {day} THEN v.best.{column} END"


RETENTION_KEYS = ("current_month", "months_since_start", "plan_name", "billing_cycle", "churn_reason")
REVENUE_KEYS = (
    "transaction_month", "plan_name", "billing_cycle", "transaction_type", "payment_method", "failure_code",
)


COHORT_KEYS = ("cohort_month", *RETENTION_KEYS[1:])


def retention_final(mrr: str, equal: str, rows: str = "ret_ranked", sums: str = "ret_mrr", columns: tuple[str, ...] = RETENTION_KEYS) -> str:
    keys = ", ".join(f"r.{k}" for k in columns)
    match = " AND ".join(f"r.{k} {equal} m.{k}" for k in columns)
    return f"""SELECT {keys},
 count(DISTINCT r.subscription_id) FILTER (WHERE r.status = 'Active') AS cohort_size,
 count(DISTINCT r.subscription_id) FILTER (WHERE r.status = 'Canceled') AS churned_users, {mrr}
 FROM {rows} r LEFT JOIN {sums} m ON {match} GROUP BY {keys}"""


def revenue_final(mrr: str, equal: str) -> str:
    keys = ", ".join(f"r.{k}" for k in REVENUE_KEYS)
    match = " AND ".join(f"r.{k} {equal} m.{k}" for k in REVENUE_KEYS)
    return f"""SELECT {keys},
 count(DISTINCT r.transaction_id) AS transaction_count, count(DISTINCT r.user_sk) AS paying_users, {mrr},
 sum(if(r.refunded = 1, r.refund_amount, 0.0)) AS total_refund_amount,
 count(r.transaction_id) FILTER (WHERE r.refunded = 1) AS refund_count,
 count(r.transaction_id) FILTER (WHERE r.status = 'Succeeded') AS success_count,
 count(r.transaction_id) FILTER (WHERE r.status = 'Failed') AS failed_count
 FROM (SELECT *, month(transaction_date) AS transaction_month FROM rev_rows) r
 LEFT JOIN rev_mrr m ON {match} GROUP BY {keys}"""


CTES = {name: text.format(**{t: t for t in tables}) for name, (text, tables) in ADAPTERS.items()}
CTES |= {
    "cal": f"""SELECT CAST(d AS DATE) AS day, CAST(strftime(d, '%Y%m%d') AS INT) AS id
 FROM generate_series(TIMESTAMP '{SPINE_START}', TIMESTAMP '{SPINE_LAST}', INTERVAL 1 DAY) g(d)""",
    "stg_user": f"""SELECT user_id, {cleaned("first_name")} AS first_name, {cleaned("last_name")} AS last_name,
 {cleaned("gender", "Others")} AS gender, {mail("email")} AS email, country, TRY_CAST(signup_date AS DATE) AS signup_date,
 {cleaned("lead_source", "Others")} AS lead_source, regexp_replace(phone, '\\D', '', 'g') AS phone,
 TRY_CAST(created_date AS TIMESTAMP) AS created_at FROM users""",
    "stg_subscription": f"""SELECT subscription_id, transaction_id, customer_id, {mail("customer_email")} AS customer_email,
 {cleaned("plan_name")} AS plan_name, {cleaned("billing_cycle")} AS billing_cycle, {cleaned("status")} AS status,
 TRY_CAST(current_period_start AS TIMESTAMP) AS current_period_start, TRY_CAST(current_period_end AS TIMESTAMP) AS current_period_end,
 TRY_CAST(created AS TIMESTAMP) AS created_at, TRY_CAST(canceled_at AS TIMESTAMP) AS canceled_at, churn_reason,
 TRY_CAST(valid_from AS TIMESTAMP) AS valid_from, TRY_CAST(valid_to AS TIMESTAMP) AS valid_to,
 CAST(coalesce(is_current, false) AS INT) AS is_current FROM subscriptions""",
    "stg_transaction": staged_txn("upgrade", "new", "downgrade", "renewal"),
    "stg_transaction_renewal_first": staged_txn("renewal", "upgrade", "new", "downgrade"),
    "stg_support_ticket": f"""SELECT ticket_id, {mail("requester_email")} AS requester_email, requester_name, ticket_type, subject,
 description, priority, status, channel, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
 TRY_CAST(first_response_at AS TIMESTAMP) AS first_response_at, TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
 TRY_CAST(solved_at AS TIMESTAMP) AS solved_at, TRY_CAST(first_reply_time AS FLOAT) AS first_reply_time,
 TRY_CAST(full_resolution_time AS FLOAT) AS full_resolution_time, satisfaction_rating FROM support_tickets""",
    "stg_product_usage": f"""SELECT event_id, nullif(nullif(nullif(user_id, 'user_unknown'), ''), 'null') AS user_id, feature_name,
 TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, {mail("user_email")} AS user_email, session_id, properties,
 {prop("device")} AS device, {prop("os")} AS os, {prop("browser")} AS browser, {prop("country")} AS country,
 TRY_CAST({prop("session_duration")} AS INT) AS session_duration FROM product_usage""",
    "int_product_usage": """SELECT p.event_id, coalesce(p.user_id, e.user_id) AS user_id,
 coalesce(p.user_email, if(p.user_id LIKE '%ano%', NULL, i.email)) AS user_email, p.properties, p.feature_name,
 p.event_timestamp, p.session_id, p.session_duration, p.device, p.browser, p.os, p.country
 FROM stg_product_usage p LEFT JOIN stg_user e ON e.email = p.user_email LEFT JOIN stg_user i ON i.user_id = p.user_id""",
    "int_subscription": f"""SELECT b.subscription_id, b.transaction_id, b.customer_id, b.customer_email,
 if(b.plan_name = '', {plan_of("t.description")}, b.plan_name) AS plan_name,
 if(b.billing_cycle = '', {cycle_of("t.description")}, b.billing_cycle) AS billing_cycle,
 b.* EXCLUDE (subscription_id, transaction_id, customer_id, customer_email, plan_name, billing_cycle)
 FROM stg_subscription b LEFT JOIN stg_transaction t USING (transaction_id)""",
    "dim_user": f"""SELECT {key("user_id")} AS user_sk, user_id, email, first_name, last_name, gender, country, lead_source,
 cal.id AS signup_date_id FROM stg_user LEFT JOIN cal ON cal.day = signup_date""",
    "dim_subscription": f"""SELECT {key("subscription_id", "valid_from")} AS subscription_sk, subscription_id, user_sk, plan_name,
 billing_cycle, status, current_period_start, cs.id AS current_period_start_id, current_period_end,
 ce.id AS current_period_end_id, canceled_at, cc.id AS canceled_at_id, churn_reason, valid_from, valid_to, is_current
 FROM int_subscription LEFT JOIN dim_user ON email = customer_email
 LEFT JOIN cal cs ON cs.day = CAST(current_period_start AS DATE)
 LEFT JOIN cal ce ON ce.day = CAST(current_period_end AS DATE)
 LEFT JOIN cal cc ON cc.day = CAST(canceled_at AS DATE)""",
    "fact_transaction": f"""SELECT {key("t.transaction_id")} AS transaction_sk, t.transaction_id, v.subscription_sk, u.user_sk,
 t.transaction_type, t.quantity, t.price, t.discount, round(t.price * t.quantity * (1 - t.discount), 2) AS total_amount,
 t.currency, t.status, t.payment_method, t.failure_code, cal.id AS transaction_date_id, t.refunded, t.refund_amount, t.description
 FROM stg_transaction t LEFT JOIN dim_user u ON u.email = t.cust_email LEFT JOIN cal ON cal.day = t.transaction_date
 LEFT JOIN dim_subscription v ON v.user_sk = u.user_sk AND CAST(v.current_period_start AS DATE) = t.transaction_date""",
    "fact_support": f"""SELECT {key("ticket_id")} AS ticket_sk, ticket_id, user_sk, ticket_type, subject, description, priority, status,
 channel, created_at, c1.id AS created_at_id, first_response_at, c2.id AS first_response_at_id, solved_at, c3.id AS solved_at_id,
 updated_at, c4.id AS updated_at_id, first_reply_time, full_resolution_time, satisfaction_rating
 FROM stg_support_ticket LEFT JOIN dim_user ON email = requester_email
 LEFT JOIN cal c1 ON c1.day = CAST(created_at AS DATE) LEFT JOIN cal c2 ON c2.day = CAST(first_response_at AS DATE)
 LEFT JOIN cal c3 ON c3.day = CAST(solved_at AS DATE) LEFT JOIN cal c4 ON c4.day = CAST(updated_at AS DATE)""",
    "fact_product_usage": f"""SELECT {key("event_id")} AS event_sk, event_id, user_sk, feature_name, event_timestamp,
 cal.id AS event_timestamp_id, session_id, session_duration, device, browser, os, p.country
 FROM int_product_usage p LEFT JOIN dim_user ON email = user_email LEFT JOIN cal ON cal.day = CAST(event_timestamp AS DATE)""",
    "fact_product_usage_weighted": "SELECT *, count(*) AS copies FROM fact_product_usage GROUP BY ALL",
    "per_links": """SELECT 'email:' || email AS a, 'id:' || user_id AS b FROM stg_user WHERE email IS NOT NULL AND user_id IS NOT NULL
 UNION SELECT 'id:' || user_id, 'email:' || email FROM stg_user WHERE email IS NOT NULL AND user_id IS NOT NULL""",
    "per_reach": """SELECT a AS node, a AS other FROM per_links UNION SELECT per_reach.node, b FROM per_reach JOIN per_links ON a = other""",
    "per_rows": """SELECT u.*, coalesce(root, node) AS person FROM (SELECT *, coalesce('id:' || user_id, 'email:' || email) AS node FROM stg_user) u
 LEFT JOIN (SELECT node, min(other) AS root FROM per_reach GROUP BY node) USING (node)""",
    "per_user": f"""SELECT person, arg_min(user_id, {{'c': coalesce(created_at, TIMESTAMP '9999-12-31'), 'u': user_id}}) AS user_id,
 {", ".join(latest(f) for f in ("email", "first_name", "last_name", "gender", "country", "lead_source", "phone"))},
 min(signup_date) AS signup_date, min(created_at) AS created_at FROM per_rows GROUP BY person""",
    "per_mail": f"""SELECT DISTINCT r.email, p.user_id, {key("coalesce(p.user_id, p.email)")} AS user_sk FROM per_rows r JOIN per_user p USING (person) WHERE r.email IS NOT NULL""",
    "per_id": f"""SELECT DISTINCT r.user_id, p.email, {key("coalesce(p.user_id, p.email)")} AS user_sk FROM per_rows r JOIN per_user p USING (person)
 WHERE r.user_id IS NOT NULL""",
    "first_event": """SELECT user_sk, min(event_timestamp) FILTER (WHERE feature_name LIKE 'Feature%') AS first_event_ts
 FROM fact_product_usage WHERE user_sk IS NOT NULL GROUP BY user_sk""",
    "activation": """SELECT user_id, u.user_sk, lead_source, gender, cal.day AS signup_date,
 CAST(first_event_ts AS DATE) - cal.day AS days_to_first_action
 FROM dim_user u LEFT JOIN cal ON cal.id = signup_date_id LEFT JOIN first_event f ON f.user_sk = u.user_sk""",
    "bucketed": """SELECT *, CASE WHEN days_to_first_action = 0 THEN 'Day 0' WHEN days_to_first_action <= 3 THEN 'Day 1-3'
 WHEN days_to_first_action <= 7 THEN 'Day 4-7' WHEN days_to_first_action > 7 THEN 'After Day 7' ELSE 'Never Activated' END AS activated_bucket,
 CAST(coalesce(days_to_first_action <= 7, false) AS INT) AS is_activated FROM activation""",
    "mart_acquisition": """SELECT signup_date, lead_source, gender, activated_bucket, count(DISTINCT user_id) AS sum_new_signups,
 count(DISTINCT user_id) FILTER (WHERE is_activated = 1) AS sum_activated_users,
 CAST(coalesce(sum(days_to_first_action), 0) AS BIGINT) AS sum_days_to_first_action,
 count(user_id) FILTER (WHERE days_to_first_action IS NOT NULL) AS count_users_with_first_action FROM bucketed GROUP BY ALL""",
    "mart_engagement": """SELECT user_sk, cal.day AS event_date, feature_name, count(event_id) AS total_events,
 count(DISTINCT session_id) AS distinct_sessions, CAST(sum(coalesce(session_duration, 0)) AS BIGINT) AS sum_session_duration
 FROM fact_product_usage LEFT JOIN cal ON cal.id = event_timestamp_id WHERE user_sk IS NOT NULL GROUP BY ALL""",
    "mart_support": """SELECT cal.day AS created_date, ticket_type, priority, channel, coalesce(f.satisfaction_rating, 0) AS satisfaction_rating,
 count(ticket_id) AS ticket_count, count(DISTINCT user_sk) AS users_with_ticket,
 count(ticket_id) FILTER (WHERE status = 'Solved' OR status = 'Closed') AS solved_count,
 count(ticket_id) FILTER (WHERE status = 'Open') AS open_count, count(ticket_id) FILTER (WHERE status = 'Pending') AS pending_count,
 coalesce(sum(first_reply_time), 0.0) AS sum_first_reply_time,
 count(ticket_id) FILTER (WHERE first_reply_time IS NOT NULL) AS count_tickets_with_reply,
 coalesce(sum(full_resolution_time), 0.0) AS sum_resolution_time,
 count(ticket_id) FILTER (WHERE full_resolution_time IS NOT NULL) AS count_tickets_resolved,
 CAST(coalesce(sum(f.satisfaction_rating), 0) AS BIGINT) AS sum_satisfaction_rating,
 count(ticket_id) FILTER (WHERE f.satisfaction_rating IS NOT NULL) AS count_tickets_rated
 FROM fact_support f LEFT JOIN cal ON cal.id = created_at_id
 GROUP BY cal.day, ticket_type, priority, channel, f.satisfaction_rating""",
    "ret_paid": """SELECT subscription_sk, transaction_type, price * (1 - discount) AS price FROM fact_transaction
 WHERE status = 'Succeeded'""",
    "ret_months": f"""SELECT subscription_sk, m FROM dim_subscription CROSS JOIN range(0, {MAX_MONTHS}) r(m)
 WHERE billing_cycle = 'Annual' AND m < date_diff('month', valid_from, coalesce(canceled_at, TIMESTAMP '{HORIZON}'))""",
    "ret_rows": """SELECT v.subscription_id, v.plan_name, v.billing_cycle, v.status, coalesce(v.churn_reason, 'N/A') AS churn_reason,
 p.transaction_type, p.price, coalesce(v.valid_from + to_months(CAST(x.m AS INT)), v.valid_from) AS valid_from
 FROM dim_subscription v
 LEFT JOIN ret_months x ON x.subscription_sk = v.subscription_sk AND v.status <> 'Canceled'
 LEFT JOIN ret_paid p ON p.subscription_sk = v.subscription_sk AND v.status <> 'Canceled'""",
    "ret_ranked": """SELECT *, CAST(date_trunc('month', valid_from) AS DATE) AS current_month,
 dense_rank() OVER (PARTITION BY subscription_id ORDER BY month(valid_from) NULLS LAST) - 1 AS months_since_start FROM ret_rows""",
    "ret_state": f"""SELECT *, lag(price) OVER (PARTITION BY subscription_id ORDER BY
 {ordered("valid_from", "price", "transaction_type", "status", "plan_name", "billing_cycle", "churn_reason")}) AS old_price,
 if(coalesce(status, '') = 'Canceled', 'subscription_cancellation', transaction_type) AS event_type FROM ret_ranked""",
    "ret_mrr": f"SELECT {', '.join(RETENTION_KEYS)}, {movements('event_type', 'price', 'old_price')} FROM ret_state GROUP BY ALL",
    "mart_retention": retention_final(SUM_AGAIN, "="),
    "mart_retention_corrected": retention_final(ONCE, "IS NOT DISTINCT FROM"),
    "ret_cohort": """SELECT * EXCLUDE (months_since_start), date_diff('month', cohort_month, valid_from) AS months_since_start
 FROM (SELECT *, CAST(date_trunc('month', min(valid_from) OVER (PARTITION BY subscription_id)) AS DATE) AS cohort_month FROM ret_state)""",
    "ret_cohort_mrr": f"SELECT {', '.join(COHORT_KEYS)}, {movements('event_type', 'price', 'old_price')} FROM ret_cohort GROUP BY ALL",
    "mart_retention_cohort": retention_final(SUM_AGAIN, "=", "ret_cohort", "ret_cohort_mrr", COHORT_KEYS),
    "ver_started": """SELECT user_sk, CAST(valid_from AS DATE) AS start_day, max({'valid_from': valid_from,
 'until': coalesce(CAST(valid_to AS DATE), DATE '9999-12-31'), 'subscription_sk': subscription_sk, 'plan_name': plan_name, 'status': status}) AS best
 FROM dim_subscription WHERE valid_from IS NOT NULL GROUP BY ALL""",
    "fact_transaction_as_of": f"""SELECT {key("p.transaction_id")} AS transaction_sk, p.transaction_id,
 {if_valid("subscription_sk", "p.transaction_date")} AS subscription_sk, p.user_sk, p.transaction_type, p.quantity, p.price, p.discount,
 round(p.price * p.quantity * (1 - p.discount), 2) AS total_amount, p.currency, p.status, p.payment_method, p.failure_code,
 cal.id AS transaction_date_id, p.refunded, p.refund_amount, p.description
 FROM (SELECT t.*, user_sk FROM stg_transaction t LEFT JOIN dim_user ON email = cust_email) p
 {as_of("p", "p.transaction_date")} LEFT JOIN cal ON cal.day = p.transaction_date""",
    "rev_txn": """SELECT t.*, coalesce(v.canceled_at, CAST(cal.day AS TIMESTAMP)) AS paid_at, v.subscription_id, v.plan_name, v.billing_cycle,
 v.canceled_at FROM fact_transaction t LEFT JOIN cal ON cal.id = t.transaction_date_id
 LEFT JOIN dim_subscription v ON v.subscription_sk = t.subscription_sk""",
    "rev_months": f"""SELECT transaction_sk, m FROM rev_txn CROSS JOIN range(0, {MAX_MONTHS}) r(m)
 WHERE billing_cycle = 'Annual' AND m < date_diff('month', paid_at, coalesce(canceled_at, TIMESTAMP '{HORIZON}'))""",
    "rev_rows": f"""SELECT t.transaction_id, t.subscription_id, coalesce(t.paid_at + to_months(CAST(x.m AS INT)), t.paid_at) AS transaction_date,
 t.user_sk, CASE WHEN t.canceled_at IS NOT NULL THEN 'subscription_cancellation' WHEN x.m > 0 THEN 'subscription_payment_renewal'
 ELSE t.transaction_type END AS transaction_type, t.payment_method, t.status, t.price * (1 - t.discount) AS price, t.refunded,
 t.refund_amount, coalesce(t.plan_name, {plan_of("t.description")}) AS plan_name,
 coalesce(t.billing_cycle, {cycle_of("t.description")}) AS billing_cycle, coalesce(t.failure_code, 'N/A') AS failure_code
 FROM rev_txn t LEFT JOIN rev_months x ON x.transaction_sk = t.transaction_sk AND t.canceled_at IS NULL""",
    "rev_state": f"""SELECT *, lag(price) OVER (PARTITION BY subscription_id ORDER BY
 {ordered("transaction_date", "price", "transaction_type", "plan_name", "billing_cycle", "payment_method", "failure_code")}) AS old_price
 FROM rev_rows WHERE status = 'Succeeded' AND transaction_type LIKE 'subscription%'""",
    "rev_mrr": f"""SELECT month(transaction_date) AS transaction_month, plan_name, billing_cycle, transaction_type, payment_method,
 failure_code, {movements('transaction_type', 'price', 'price')} FROM rev_state GROUP BY ALL""",
    "mart_revenue": revenue_final(SUM_AGAIN, "="),
    "mart_revenue_corrected": revenue_final(ONCE, "IS NOT DISTINCT FROM"),
}


def chain(final: str, given: frozenset[str] = frozenset(), instead: dict[str, str] | None = None) -> str:
    """WITH chain of the CTEs a statement needs, directly or through others, but not of those
    that are ``given`` as tables. ``instead`` replaces the text of some of them."""
    texts = CTES | (instead or {})
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_]+", text)):
            if word in CTES and word not in given and word not in needed:
                # A recursive statement also reads itself.
                if texts[word] is not text and re.search(rf"\b(FROM|JOIN)\s+{word}\b", text):
                    visit(texts[word])
                    needed[word] = None

    visit(final)
    if not needed:
        return final
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({texts[n]})" for n in needed) + "\n" + final


MODELS = (
    "stg_user", "stg_subscription", "stg_transaction", "stg_transaction_renewal_first",
    "stg_support_ticket", "stg_product_usage", "int_product_usage", "int_subscription",
    "dim_user", "dim_subscription", "fact_transaction", "fact_support", "fact_product_usage",
    "mart_acquisition", "mart_engagement", "mart_support", "mart_retention",
    "mart_retention_corrected", "mart_revenue", "mart_revenue_corrected", "mart_retention_cohort", "fact_transaction_as_of",
    "fact_product_usage_weighted",
)


def ratio(a: str, b: str) -> str:
    return f"round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 6)"


FINALS = {name: f"SELECT * FROM {name}" for name in MODELS}
FINALS |= {
    # spines and calendar
    "date_spine": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
 FROM (SELECT date_trunc('day', min(o_orderdate)) AS lo, date_trunc('day', max(o_orderdate)) AS hi FROM orders)""",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS full_date, year(d) AS year, quarter(d) AS quarter,
 month(d) AS month, weekofyear(d) AS week, day(d) AS day_of_month, dayofweek(d) AS day_of_week, dayofweek(d) = 1 AS is_weekend
 FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM
 (SELECT CAST(min(o_orderdate) AS DATE)::TIMESTAMP AS lo, CAST(max(o_orderdate) AS DATE)::TIMESTAMP AS hi FROM orders))""",
    "month_spine": """SELECT m AS months_since_start, count(*) AS subscriptions FROM ret_months x(sk, m) GROUP BY m""",
    # text
    "capitalize_words": f"""SELECT transaction_id, {title("transaction_type")} AS type_title, {title("description")} AS description_title
 FROM transactions""",
    "handle_issue": f"""SELECT user_id, {cleaned("first_name")} AS first_name, {cleaned("gender", "Others")} AS gender,
 {cleaned("lead_source", "Others")} AS lead_source FROM users""",
    "clean_email": f"SELECT transaction_id, {mail('cust_email')} AS cust_email FROM transactions",
    "clean_phone": "SELECT user_id, regexp_replace(phone, '[^0-9]', '', 'g') AS phone FROM users",
    "null_sentinel": """SELECT event_id, if(user_id NOT IN ('user_unknown', '', 'null'), user_id, NULL) AS user_id FROM product_usage""",
    "clean_currency": "SELECT transaction_id, currency FROM stg_transaction",
    "repair_txn_type": """SELECT a.transaction_id, a.transaction_type, b.transaction_type AS renewal_first_type
 FROM stg_transaction a JOIN stg_transaction_renewal_first b USING (transaction_id)""",
    "flags": "SELECT transaction_id, refunded, refund_amount FROM stg_transaction",
    "infer_plan": f"SELECT transaction_id, {plan_of('description')} AS plan_name FROM transactions",
    "infer_cycle": f"SELECT transaction_id, {cycle_of('description')} AS billing_cycle FROM transactions",
    "fill_plan_cycle": f"""SELECT transaction_id, subscription_id, coalesce(plan_name, {plan_of("description")}) AS plan_name,
 coalesce(billing_cycle, {cycle_of("description")}) AS billing_cycle FROM rev_txn""",
    "default_labels": """SELECT subscription_id, valid_from, coalesce(churn_reason, 'N/A') AS churn_reason FROM stg_subscription""",
    # casts, dates and json
    "try_dates": "SELECT user_id, TRY_CAST(signup_date AS DATE) AS signup_date FROM users",
    "try_timestamps": "SELECT event_id, TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp FROM product_usage",
    "try_floats": """SELECT ticket_id, TRY_CAST(first_reply_time AS FLOAT) AS first_reply_time,
 TRY_CAST(full_resolution_time AS FLOAT) AS full_resolution_time FROM support_tickets""",
    "json_fields": f"""SELECT event_id, {prop("device")} AS device, {prop("os")} AS os, {prop("browser")} AS browser,
 {prop("country")} AS country FROM product_usage""",
    "json_int": f"SELECT event_id, TRY_CAST({prop('session_duration')} AS INT) AS session_duration FROM product_usage",
    "date_key": """SELECT transaction_id, CAST(strftime(transaction_date, '%Y%m%d') AS INT) AS date_key FROM stg_transaction""",
    "calendar_parts": """SELECT DISTINCT transaction_date, year(transaction_date) AS year, quarter(transaction_date) AS quarter,
 month(transaction_date) AS month, weekofyear(transaction_date) AS week, day(transaction_date) AS day_of_month,
 dayofweek(transaction_date) AS day_of_week, dayofweek(transaction_date) IN (1, 7) AS is_weekend FROM stg_transaction""",
    "month_boundaries": f"""SELECT subscription_id, valid_from,
 date_diff('month', valid_from, coalesce(canceled_at, TIMESTAMP '{HORIZON}')) AS months FROM stg_subscription""",
    "day_difference": """SELECT subscription_id, valid_from,
 date_diff('day', CAST(valid_from AS DATE), CAST(valid_to AS DATE)) AS days FROM stg_subscription""",
    "add_months_ts": """SELECT event_id, event_timestamp + to_months(CAST(month(event_timestamp) AS INT)) AS a_month_on,
 event_timestamp + to_months(CAST(day(event_timestamp) AS INT)) AS months_on FROM stg_product_usage""",
    "month_trunc": """SELECT event_id, CAST(date_trunc('month', event_timestamp) AS DATE) AS month_start,
 month(event_timestamp) AS month_number FROM stg_product_usage""",
    # keys and measures
    "surrogate_key": f"""SELECT subscription_id, valid_from, valid_to, {key("subscription_id", "valid_from")} AS subscription_sk,
 {key("subscription_id", "valid_to")} AS closing_sk FROM stg_subscription""",
    "line_total": """SELECT l_orderkey, l_linenumber,
 round(l_extendedprice * l_quantity * (1 - l_discount), 2) AS total_amount FROM lineitem""",
    "net_price": "SELECT transaction_id, price * (1 - discount) AS net_price FROM stg_transaction",
    "activation_bucket": """SELECT user_id, signup_date, CAST(days_to_first_action AS BIGINT) AS days_to_first_action, activated_bucket,
 is_activated FROM bucketed""",
    "revenue_event_type": """SELECT transaction_id, subscription_id, transaction_date, transaction_type, count(*) AS n
 FROM rev_rows GROUP BY ALL""",
    "retention_event_type": """SELECT subscription_id, valid_from, event_type, count(*) AS n FROM ret_state GROUP BY ALL""",
    # filters
    "known_users": "SELECT event_id, user_sk FROM fact_product_usage WHERE user_sk IS NOT NULL",
    "succeeded_txn": "SELECT transaction_id, user_sk, price FROM fact_transaction WHERE status = 'Succeeded'",
    "subscription_events": """SELECT transaction_id, transaction_date, transaction_type, count(*) AS n FROM rev_rows
 WHERE transaction_type LIKE 'subscription%' GROUP BY ALL""",
    "annual_subscriptions": "SELECT subscription_sk, user_sk, valid_from, canceled_at FROM dim_subscription WHERE billing_cycle = 'Annual'",
    # joins
    "date_role_join": """SELECT subscription_id, valid_from, s.id AS current_period_start_id, e.id AS current_period_end_id,
 c.id AS canceled_at_id FROM stg_subscription LEFT JOIN cal s ON s.day = CAST(current_period_start AS DATE)
 LEFT JOIN cal e ON e.day = CAST(current_period_end AS DATE) LEFT JOIN cal c ON c.day = CAST(canceled_at AS DATE)""",
    "full_date_lookup": """SELECT user_id, signup_date_id, cal.day AS signup_date FROM dim_user LEFT JOIN cal ON cal.id = signup_date_id""",
    "user_sk_lookup": """SELECT ticket_id, requester_email, user_sk FROM stg_support_ticket LEFT JOIN dim_user ON email = requester_email""",
    "identity_repair": "SELECT event_id, user_id, user_email FROM int_product_usage",
    "txn_description_join": "SELECT subscription_id, transaction_id, valid_from, plan_name, billing_cycle FROM int_subscription",
    "txn_subscription_join": "SELECT transaction_id, user_sk, subscription_sk FROM fact_transaction",
    "subscription_lookup": "SELECT transaction_id, subscription_id, plan_name, billing_cycle, canceled_at FROM rev_txn",
    "conditional_left_join": """SELECT v.subscription_id, v.valid_from, v.status, p.transaction_type, p.price FROM dim_subscription v
 LEFT JOIN ret_paid p ON p.subscription_sk = v.subscription_sk AND v.status <> 'Canceled'""",
    "expand_months": f"""SELECT subscription_sk, valid_from, CAST(m AS INT) AS months_since_start FROM dim_subscription
 CROSS JOIN range(0, {MAX_MONTHS}) r(m) WHERE billing_cycle = 'Annual'
 AND m < date_diff('month', valid_from, coalesce(canceled_at, TIMESTAMP '{HORIZON}'))""",
    "first_event_join": """SELECT user_id, signup_date, CAST(days_to_first_action AS BIGINT) AS days_to_first_action FROM activation""",
    # aggregations
    "distinct_counts": """SELECT transaction_type, count(transaction_id) AS n, count(DISTINCT transaction_id) AS transactions,
 count(DISTINCT user_sk) AS users FROM fact_transaction GROUP BY transaction_type""",
    "conditional_counts": """SELECT ticket_type, count(ticket_id) FILTER (WHERE status IN ('Solved', 'Closed')) AS solved_count,
 count(ticket_id) FILTER (WHERE status = 'Open') AS open_count, count(ticket_id) FILTER (WHERE first_reply_time IS NOT NULL) AS replied
 FROM fact_support GROUP BY ticket_type""",
    "conditional_distinct": """SELECT plan_name, billing_cycle, count(DISTINCT subscription_id) FILTER (WHERE status = 'Active') AS active,
 count(DISTINCT subscription_id) FILTER (WHERE status = 'Canceled') AS canceled FROM dim_subscription GROUP BY ALL""",
    "defaulted_sums": """SELECT ticket_type, priority, coalesce(sum(first_reply_time), 0.0) AS sum_first_reply_time,
 CAST(coalesce(sum(satisfaction_rating), 0) AS BIGINT) AS sum_satisfaction_rating FROM fact_support GROUP BY ALL""",
    "first_event": "SELECT * FROM first_event",
    "mrr_movements": "SELECT * FROM rev_mrr",
    "retention_movements": "SELECT * FROM ret_mrr",
    # windows
    "lag_price": """SELECT subscription_id, transaction_date, price, transaction_type, plan_name, billing_cycle, payment_method,
 failure_code, old_price, count(*) AS n FROM rev_state GROUP BY ALL""",
    "retention_lag_price": """SELECT subscription_id, valid_from, price, transaction_type, status, plan_name, billing_cycle, churn_reason,
 old_price, count(*) AS n FROM ret_state GROUP BY ALL""",
    "cohort_month_rank": "SELECT DISTINCT subscription_id, valid_from, months_since_start FROM ret_ranked",
    # checks and export
    "grain_check": "SELECT subscription_sk, count(*) AS n FROM dim_subscription GROUP BY subscription_sk HAVING count(*) > 1",
    "load_report": " UNION ALL ".join(f"""SELECT 'raw' AS schema, '{t}' AS "table", count(*) AS rows FROM {t}""" for t in TABLES),
    "repeated_keys": """SELECT 'dim_subscription' AS "table", '{"subscription_sk":"' || subscription_sk || '"}' AS key, count(*) AS n
 FROM dim_subscription GROUP BY subscription_sk HAVING count(*) > 1
 UNION ALL SELECT 'dim_user', '{"user_sk":"' || user_sk || '"}', count(*) FROM dim_user GROUP BY user_sk HAVING count(*) > 1""",
    "dim_subscription_order": """SELECT CAST(0 AS BIGINT) AS files_out_of_order, CAST(0 AS BIGINT) AS rows_out_of_order, count(*) AS rows
 FROM dim_subscription""",
    "export_shape": """SELECT ticket_id, user_sk, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
 strftime(solved_at, '%Y-%m-%d %H:%M:%S') AS solved_at, strftime(CAST(cal.day AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created_date,
 first_reply_time, satisfaction_rating FROM fact_support LEFT JOIN cal ON cal.id = created_at_id""",
    # figures
    "kpi_acquisition": f"""SELECT lead_source, CAST(sum(sum_new_signups) AS BIGINT) AS new_signups,
 {ratio("sum(sum_activated_users)", "sum(sum_new_signups)")} AS activation_rate,
 {ratio("sum(sum_days_to_first_action)", "sum(count_users_with_first_action)")} AS days_to_first_action
 FROM mart_acquisition GROUP BY lead_source""",
    "kpi_top_lead_source": """SELECT lead_source, CAST(sum(sum_new_signups) AS BIGINT) AS new_signups FROM mart_acquisition
 GROUP BY lead_source ORDER BY new_signups DESC, lead_source NULLS LAST LIMIT 3""",
    "kpi_daily_active_users": "SELECT event_date, count(DISTINCT user_sk) AS dau FROM mart_engagement GROUP BY event_date",
    "kpi_engagement": f"""SELECT CAST(date_trunc('month', day) AS DATE) AS month,
 {ratio("count(DISTINCT (user_sk, day)) FILTER (WHERE day IS NOT NULL)", "count(DISTINCT day)")} AS dau,
 count(DISTINCT user_sk) AS mau,
 round(CAST(count(DISTINCT (user_sk, day)) FILTER (WHERE day IS NOT NULL) AS DOUBLE)
 / nullif(count(DISTINCT day), 0) / count(DISTINCT user_sk), 6) AS stickiness,
 {ratio("sum(coalesce(session_duration, 0))", "count(DISTINCT (user_sk, session_id)) FILTER (WHERE session_id IS NOT NULL)")} AS avg_session_duration,
 {ratio("count(event_id)", "count(DISTINCT (user_sk, session_id)) FILTER (WHERE session_id IS NOT NULL)")} AS avg_events_per_session
 FROM fact_product_usage LEFT JOIN cal ON cal.id = event_timestamp_id WHERE user_sk IS NOT NULL GROUP BY 1""",
    "kpi_retention": f"""SELECT current_month, {ratio("sum(cohort_size)", "sum(cohort_size + churned_users)")} AS retention_rate,
 {ratio("sum(churned_users)", "sum(cohort_size + churned_users)")} AS user_churn_rate,
 {ratio("sum(cancellation_mrr + contraction_mrr)", "sum(new_mrr + renewal_mrr)")} AS revenue_churn,
 {ratio("sum(cohort_size + churned_users)", "sum(churned_users)")} AS customer_lifespan
 FROM mart_retention_corrected GROUP BY current_month""",
    "kpi_revenue": f"""SELECT transaction_month,
 round(sum(new_mrr + expansion_mrr + renewal_mrr - contraction_mrr - cancellation_mrr), 6) AS mrr,
 {ratio("sum(new_mrr + expansion_mrr + renewal_mrr - contraction_mrr - cancellation_mrr)", "any_value(payers)")} AS arpu,
 {ratio("sum(refund_count)", "sum(transaction_count)")} AS refund_rate,
 {ratio("sum(failed_count)", "sum(failed_count + success_count)")} AS payment_failure_rate
 FROM mart_revenue_corrected LEFT JOIN (SELECT month(transaction_date) AS m, count(DISTINCT user_sk) AS payers
 FROM rev_rows WHERE status = 'Succeeded' GROUP BY 1) ON m IS NOT DISTINCT FROM transaction_month GROUP BY transaction_month""",
    "kpi_plan_mix": f"""SELECT plan_name, count(DISTINCT transaction_id) AS transactions,
 {ratio("count(DISTINCT transaction_id)", "sum(count(DISTINCT transaction_id)) OVER ()")} AS share FROM rev_rows GROUP BY plan_name""",
    "kpi_support": f"""SELECT channel, {ratio("sum(sum_satisfaction_rating)", "sum(count_tickets_rated)")} AS csat,
 CAST(sum(ticket_count) AS BIGINT) AS total_tickets,
 {ratio("sum(sum_first_reply_time)", "sum(count_tickets_with_reply)")} AS first_reply_time,
 {ratio("sum(sum_resolution_time)", "sum(count_tickets_resolved)")} AS full_resolution_time,
 {ratio("sum(solved_count)", "sum(ticket_count)")} AS resolved_rate FROM mart_support GROUP BY channel""",
}
FINALS["fact_product_usage_of_repaired"] = FINALS["fact_product_usage"]
FINALS["mart_revenue_as_of"] = FINALS["mart_revenue"]
FINALS["ticket_version_as_of"] = f"""SELECT t.ticket_id, t.user_sk, t.created_date, {if_valid("subscription_sk", "t.created_date")} AS subscription_sk,
 {if_valid("plan_name", "t.created_date")} AS plan_name, {if_valid("status", "t.created_date")} AS status
 FROM (SELECT ticket_id, user_sk, CAST(created_at AS DATE) AS created_date FROM fact_support) t {as_of("t", "t.created_date")}"""

# Queries under other settings: the texts that these replace.
AS_OF = CTES["fact_transaction_as_of"]
INSTEAD = {"mart_revenue_as_of": {"fact_transaction": AS_OF}}
PEOPLE = {name: re.sub(r"\bdim_user\b", "per_mail", CTES[name]) for name in ("dim_subscription", "fact_transaction", "fact_support", "fact_product_usage")}
PEOPLE["int_product_usage"] = CTES["int_product_usage"].replace("stg_user e", "per_mail e").replace("stg_user i", "per_id i")
PEOPLE["dim_user"] = CTES["dim_user"].replace("FROM stg_user", "FROM per_user").replace(key("user_id"), key("coalesce(user_id, email)"))
for name in ("dim_user", "int_product_usage", "fact_support", "fact_transaction", "fact_product_usage", "mart_engagement"):
    FINALS[f"{name}_one_per_email"] = f"SELECT * FROM {name}"
    INSTEAD[f"{name}_one_per_email"] = PEOPLE

ORACLE = {name: chain(final, instead=INSTEAD.get(name)) for name, final in FINALS.items()}
