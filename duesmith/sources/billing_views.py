"""Billing tables derived from the TPC-H-like test tables.

Each view is one SELECT in the SQL subset that Spark and DuckDB share, so the
Spark queries and the DuckDB checks read the same rows.  ``{name}`` refers to
another view or a test table.  Three markers differ by dialect:

``@TS``          timestamp without time zone
``@EACH(n)``     one output row per integer 0..n
``@IDIV(a, n)``  integer quotient of non-negative numbers

FIXTURES.md describes the defects that the CASE expressions plant.
"""

from __future__ import annotations

import re
from functools import cache

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The payment that settles order k: three orders in twelve share one payment.
_PAYMENT = "CASE WHEN {k} % 12 < 3 THEN {k} - {k} % 12 ELSE {k} END"
_ORDER_PAYMENT = _PAYMENT.replace("{k}", "o_orderkey")
_LINE_PAYMENT = _PAYMENT.replace("{k}", "l_orderkey")
_AGREEMENT = "o_custkey * 2 + CASE WHEN o_custkey % 4 = 0 THEN o_orderkey % 2 ELSE 0 END"
_MONTH = "o_orderdate - INTERVAL '1' DAY * (day(o_orderdate) - 1)"

VIEWS: dict[str, str] = {}

# --- parties, accounts, units -------------------------------------------------

VIEWS["business_unit"] = """
SELECT n_nationkey AS business_unit_id, n_name AS name,
       CASE n_nationkey % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
            WHEN 2 THEN 'America/Los_Angeles' WHEN 3 THEN 'America/Phoenix' ELSE 'UTC' END AS time_zone_name,
       n_regionkey AS division_id, r_name AS division_name
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

VIEWS["party_role"] = """
SELECT c_custkey * 2 AS party_role_id, c_custkey * 2 AS party_id, c_name AS role_id, 1 AS party_role_type_id,
       c_nationkey AS business_unit_id,
       CAST('1994-01-01 00:00:00' AS @TS) + INTERVAL '1' DAY * CAST(c_custkey % 300 AS INT) AS created_date
FROM {customer}
UNION ALL
SELECT s_suppkey * 2 + 1, s_suppkey * 2 + 1, s_name, 7, s_nationkey,
       CAST('1994-06-01 00:00:00' AS @TS) + INTERVAL '1' DAY * CAST(s_suppkey % 300 AS INT)
FROM {supplier}"""

VIEWS["party_role_status"] = """
SELECT c_custkey * 2 AS party_role_id, CAST(c_custkey % 3 AS INT) AS account_status FROM {customer}"""

VIEWS["member_list"] = """
SELECT c_custkey * 2 AS party_role_id, c_custkey * 2 AS party_id, c_name AS role_id,
       c_mktsegment AS first_name, c_name AS last_name
FROM {customer}"""

VIEWS["organization_list"] = """
SELECT s_suppkey * 2 + 1 AS party_role_id, s_suppkey * 2 + 1 AS party_id, s_name AS role_id,
       s_name AS organization_name
FROM {supplier}"""

VIEWS["party_property"] = """
SELECT c_custkey * 2 AS party_role_id, 1 AS type_id, c_mktsegment AS value FROM {customer}
UNION ALL
SELECT c_custkey * 2, 2, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) FROM {customer}
UNION ALL
SELECT c_custkey * 2, 3, CAST(CAST(CAST('2013-01-01 00:00:00' AS @TS)
       + INTERVAL '1' DAY * CAST(c_custkey % 300 AS INT) AS DATE) AS STRING) FROM {customer}"""

VIEWS["client_account"] = "SELECT c_custkey AS client_account_id FROM {customer}"

VIEWS["client_account_party"] = """
SELECT c_custkey AS client_account_id, c_custkey * 2 AS party_id, c_custkey % 10 <> 3 AS primary_party
FROM {customer}
UNION ALL
SELECT s_suppkey * 10 + 3, s_suppkey * 2 + 1, true FROM {supplier}"""

# --- lookups ------------------------------------------------------------------

VIEWS["item"] = "SELECT p_partkey AS item_id, p_brand AS upc, p_name AS name FROM {part}"

VIEWS["tender_type"] = """
SELECT r_regionkey + 1 AS tender_type_id, r_name AS name,
       CASE r_regionkey WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 11 ELSE 4 END AS tender_interface_id
FROM {region}"""

VIEWS["credit_card_type"] = """
SELECT r_regionkey AS credit_card_type_id,
       CASE r_regionkey WHEN 0 THEN 'VISA' WHEN 1 THEN 'AMEX' WHEN 2 THEN 'MC' WHEN 3 THEN 'DISC'
            ELSE 'OTHER' END AS description
FROM {region}"""

VIEWS["decline_reason"] = """
SELECT r_regionkey AS decline_reason_id,
       CASE r_regionkey WHEN 0 THEN true WHEN 4 THEN true WHEN 2 THEN NULL ELSE false END AS do_not_reprocess
FROM {region}"""

VIEWS["general_ledger_code"] = """
SELECT n_nationkey AS general_ledger_code_id, 'GL' || CAST(1000 + n_nationkey AS STRING) AS code,
       n_name AS description
FROM {nation}"""

# --- agreements and their schedule --------------------------------------------

VIEWS["member_agreement"] = """
SELECT c_custkey * 2 + nth AS member_agreement_id, c_custkey * 2 AS party_role_id,
       c_nationkey AS business_unit_id,
       CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey % 13 ELSE 5 END AS INT) AS status,
       CAST('1994-02-01 00:00:00' AS @TS) + INTERVAL '1' DAY * CAST(c_custkey % 300 AS INT) AS start_date
FROM (SELECT c_custkey, c_nationkey, c_mktsegment,
             @EACH(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END) AS nth FROM {customer}) c"""

VIEWS["member_agreement_item"] = """
SELECT member_agreement_id * 2 + nth AS member_agreement_item_id, member_agreement_id,
       (member_agreement_id * 7 + nth) % 200 AS item_id
FROM (SELECT member_agreement_id, @EACH(1) AS nth FROM {member_agreement}) a"""

VIEWS["member_agreement_item_perpetual"] = """
SELECT member_agreement_item_id AS member_agreement_item_perpetual_id, member_agreement_item_id,
       CAST(CASE WHEN member_agreement_item_id % 18 = 5 THEN 0 ELSE 20 + member_agreement_item_id % 80 END
            AS DECIMAL(12,2)) AS price,
       CAST(CASE WHEN member_agreement_item_id % 3 = 0 THEN member_agreement_item_id % 12 END AS INT) AS bill_count
FROM {member_agreement_item}"""

VIEWS["member_agreement_item_pay_source"] = """
SELECT member_agreement_item_id AS member_agreement_item_pay_source_id, member_agreement_item_id,
       member_agreement_item_id % 14 = 3 AS from_foreign,
       CAST(CASE WHEN member_agreement_item_id % 28 = 3 THEN 1 ELSE 0.5 END AS DECIMAL(12,2)) AS payment_value,
       CASE CAST(member_agreement_item_id % 4 AS INT) WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 END
           AS payment_installments
FROM {member_agreement_item}"""

VIEWS["member_agreement_item_perpetual_pay_source"] = """
SELECT member_agreement_item_perpetual_id AS member_agreement_item_perpetual_pay_source_id,
       member_agreement_item_perpetual_id
FROM {member_agreement_item_perpetual}"""

VIEWS["invoice_request"] = f"""
SELECT o_orderkey AS invoice_request_id, {_AGREEMENT} AS member_agreement_id,
       CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 23 = 7 THEN o_orderkey - 1
            ELSE o_orderkey END AS tx_invoice_id,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS primary_tx_invoice_id,
       {_MONTH} AS bill_date, {_MONTH} + INTERVAL '5' HOUR AS bill_date_utc,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS status,
       CASE WHEN o_orderkey % 11 = 4 THEN 1 WHEN o_orderkey % 7 = 3 THEN 0 END AS process_type
FROM {{orders}}"""

VIEWS["invoice_request_item"] = f"""
SELECT o_orderkey * 4 + nth AS invoice_request_item_id, o_orderkey AS invoice_request_id,
       agreement * 2 + nth AS member_agreement_item_id, CAST(1 AS DECIMAL(16,7)) AS quantity,
       CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 29 = 11 THEN o_orderkey * 10 + 2
            ELSE o_orderkey * 10 + 1 + nth * 5 END AS tx_transaction_id
FROM (SELECT o_orderkey, o_orderstatus, {_AGREEMENT} AS agreement,
             @EACH(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS nth FROM {{orders}}) o"""

VIEWS["payment_request"] = f"""
SELECT o_orderkey * 8 + nth AS payment_request_id, o_orderkey AS invoice_request_id,
       due AS due_date, due + INTERVAL '5' HOUR AS due_date_utc,
       CASE WHEN nth = 0 AND o_orderstatus <> 'O' THEN {_ORDER_PAYMENT} END AS tx_payment_id,
       CAST((o_orderkey + nth) % 3 AS INT) AS status,
       CASE WHEN o_orderkey % 17 = 4 THEN 1 WHEN (o_orderkey + nth) % 19 = 5 THEN 0 END AS process_type
FROM (SELECT o_orderkey, o_orderstatus, nth,
             CASE WHEN o_orderkey % 10 = 7 THEN NULL
                  ELSE {_MONTH} + INTERVAL '30' DAY * CAST(CASE WHEN o_orderkey % 5 = 2 THEN 0 ELSE nth END AS INT) END AS due
      FROM (SELECT o_orderkey, o_orderstatus, o_orderdate, @EACH(CAST(o_orderkey % 4 AS INT)) AS nth
            FROM {{orders}}) e) o"""

VIEWS["payment_request_item"] = """
SELECT o_orderkey * 8 + nth AS payment_request_item_id, o_orderkey * 8 + nth AS payment_request_id,
       o_orderkey * 4 + CASE WHEN (o_orderkey + nth) % 31 = 9 THEN 3 ELSE 0 END AS invoice_request_item_id,
       CAST(CASE WHEN o_orderkey % 27 = 2 THEN NULL ELSE o_totalprice END AS DECIMAL(15,3)) AS fixed_amount,
       CASE WHEN o_orderstatus = 'O' OR nth > 0 THEN NULL WHEN o_orderkey % 41 = 3 THEN -1 - o_orderkey
            ELSE o_orderkey * 10 + 4 END AS tx_transaction_id
FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, @EACH(CAST(o_orderkey % 4 AS INT)) AS nth
      FROM {orders}) o"""

# --- ledger -------------------------------------------------------------------

VIEWS["tx_invoice"] = """
SELECT o_orderkey AS tx_invoice_id, o_custkey AS client_account_id,
       CASE WHEN o_orderkey % 15 = 1 THEN (o_orderkey % 10) * 2 + 1 ELSE o_custkey * 2 END AS party_role_id,
       CAST(o_custkey % 26 AS INT) AS target_business_unit_id,
       o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS target_date,
       o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 + 5 AS INT) AS target_date_utc,
       CASE WHEN o_orderkey % 33 <> 8 THEN o_orderdate + INTERVAL '30' DAY END AS payment_due_date,
       CASE WHEN o_orderkey % 33 <> 8 THEN o_orderdate + INTERVAL '725' HOUR END AS payment_due_date_utc,
       CAST(o_orderkey % 4 AS INT) AS tx_invoice_status_id, CAST(o_orderkey % 3 AS INT) AS billing_status,
       CASE WHEN o_orderkey % 6 <> 5 THEN 4 END AS link_type_id,
       CASE WHEN o_orderkey % 6 = 5 THEN NULL WHEN o_orderkey % 10 = 1 THEN o_orderkey - 1
            ELSE o_orderkey END AS link_id
FROM {orders}"""

VIEWS["tx_transaction"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS tx_transaction_id, l_orderkey AS tx_invoice_id,
       CASE l_linenumber WHEN 6 THEN 1 WHEN 7 THEN 4 ELSE l_linenumber END AS tx_type_id,
       CAST(CASE WHEN l_linenumber IN (1, 2, 3) THEN 1 ELSE 1 + l_orderkey % 2 END AS INT) AS group_id,
       CASE WHEN l_linenumber IN (4, 5, 7) THEN {_LINE_PAYMENT} ELSE part_key END AS item_id,
       CAST(CAST(cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS amount,
       l_linenumber IN (4, 5) OR (l_linenumber = 7 AND returned = 0) AS is_accounting_credit,
       CASE WHEN l_linenumber IN (1, 2, 3, 6) THEN 2 WHEN l_orderkey % 13 = 0 THEN 8
            WHEN l_linenumber = 4 AND l_orderkey % 5 = 2 THEN NULL ELSE 3 END AS link_type_id,
       CASE WHEN l_linenumber = 6 THEN l_orderkey * 4 + 1 WHEN l_linenumber < 4 THEN l_orderkey * 4
            ELSE l_orderkey * 8 END AS link_id,
       CASE WHEN l_linenumber IN (1, 2, 3, 6) THEN 'Item ' || CAST(part_key AS STRING)
            ELSE CASE WHEN l_orderkey % 13 = 0 THEN 'Sponsor ' ELSE 'ID: ' END
                 || CAST({_LINE_PAYMENT} AS STRING) || ' | '
                 || CASE CAST(l_orderkey % 5 AS INT) WHEN 0 THEN 'VISA' WHEN 1 THEN 'AMEX' WHEN 2 THEN 'MC'
                         WHEN 3 THEN 'DISC' ELSE 'Bank Draft(US)' END || ' | Payment request due'
            END AS description,
       CAST(l_linenumber AS INT) AS display_order, ship AS target_date, ship + INTERVAL '5' HOUR AS target_date_utc,
       CAST(l_orderkey % 26 AS INT) AS target_business_unit_id,
       CASE WHEN l_orderkey % 2 = 0 THEN 'EST' ELSE 'CST' END AS target_date_zone_format,
       CAST(CASE WHEN l_linenumber IN (1, 6) THEN 1 END AS DECIMAL(16,7)) AS quantity,
       CAST(CASE WHEN l_linenumber IN (1, 6) THEN CAST(cents AS DECIMAL(18,0)) * 0.01 END AS DECIMAL(12,3)) AS unit_price,
       CASE WHEN l_linenumber = 7 THEN 'declined or paid late' ELSE '' END AS comments,
       CAST(0 AS BIGINT) AS work_unit_id, CAST(l_orderkey % 9 AS INT) AS price_id
FROM (SELECT l_orderkey, l_linenumber, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents,
             max(l_partkey) AS part_key, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned, min(l_shipdate) AS ship
      FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber) l"""

VIEWS["tx_payment"] = """
SELECT o_orderkey AS tx_payment_id, o_custkey AS client_account_id, o_custkey * 2 AS party_role_id,
       CAST(o_custkey % 26 AS INT) AS target_business_unit_id,
       o_orderdate + INTERVAL '10' DAY AS target_date, o_orderdate + INTERVAL '245' HOUR AS target_date_utc,
       '-0500' AS target_date_zone_format, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       CAST(left(o_orderpriority, 1) AS INT) AS tender_type_id, o_orderkey % 12 = 0 AS is_multi_invoice,
       o_orderkey % 6 = 1 AS is_declined, false AS is_reversal,
       CAST(CASE WHEN o_orderkey % 6 = 1 AND o_orderkey % 7 <> 0 THEN o_orderkey % 5 END AS INT) AS decline_reason_id,
       CAST(CASE WHEN o_orderkey % 3 <> 2 THEN o_orderkey % 5 END AS INT) AS credit_card_type_id,
       4 AS link_type_id, o_orderkey AS link_id
FROM {orders}"""

# --- payment gateway ----------------------------------------------------------

VIEWS["payment_process_batch"] = """
SELECT batch AS payment_process_batch_id, CAST(min(o_custkey) % 25 AS INT) AS business_unit_id
FROM (SELECT @IDIV(o_orderkey, 2) AS batch, o_custkey FROM {orders}) o GROUP BY batch"""

VIEWS["payment_process_request"] = """
SELECT o_orderkey AS payment_process_request_id, @IDIV(o_orderkey, 2) AS payment_process_batch_id,
       CASE WHEN o_orderkey % 12 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS tx_payment_id,
       CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'VC' WHEN 1 THEN 'AC' WHEN 2 THEN 'MC' WHEN 3 THEN 'DC'
            WHEN 4 THEN 'VD' ELSE 'BC' END || CAST(100000 + o_orderkey % 900000 AS STRING) AS token,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
FROM {orders}"""

VIEWS["payment_process_response"] = """
SELECT o_orderkey AS payment_process_response_id, o_orderkey AS payment_process_request_id,
       CASE WHEN o_orderkey % 9 = 4 THEN o_orderkey + 1 END AS rebill_payment_process_request_id,
       CASE WHEN o_orderkey % 6 = 1 AND o_orderkey % 5 <> 2 THEN o_orderkey END AS decline_tx_payment_id,
       'R' || CAST(o_orderkey AS STRING) AS reference_id,
       CASE WHEN o_orderkey % 6 = 1 THEN '05' ELSE '00' END AS response_code,
       CASE WHEN o_orderkey % 6 = 1 THEN 'Declined' ELSE 'Approved' END AS response_message
FROM {orders}"""

VIEWS["payment_process_validation"] = """
SELECT o_orderkey AS payment_process_validation_id, o_orderkey AS payment_process_request_id FROM {orders}"""

VIEWS["payment_process_error"] = """
SELECT payment_process_batch_id AS payment_process_error_id, payment_process_batch_id
FROM {payment_process_batch}"""

VIEWS["billing_service_tx"] = """
SELECT i.client_account_id * 2 AS member_agreement_id, i.party_role_id, i.client_account_id,
       t.tx_transaction_id, t.tx_invoice_id, t.group_id, t.tx_type_id,
       i.target_business_unit_id AS business_unit_id, i.target_date, i.target_date_utc,
       t.link_type_id, t.link_id, t.description, t.amount,
       CASE WHEN t.tx_type_id IN (4, 5) THEN NULL ELSE t.item_id END AS sale_item_id,
       p.tx_payment_id, coalesce(p.is_declined, false) AS is_payment_declined,
       p.tender_type_id, tt.name AS tender_type_name, tt.tender_interface_id, p.credit_card_type_id,
       CAST(t.tx_invoice_id % 27 AS INT) AS gl_id,
       i.payment_due_date AS due_date, i.payment_due_date_utc AS due_date_utc,
       CASE WHEN p.tx_payment_id IS NOT NULL THEN @IDIV(p.tx_payment_id, 2) END AS payment_process_batch_id,
       CASE WHEN p.tx_payment_id % 4 = 0 THEN @IDIV(p.tx_payment_id, 200) END AS gateway_batch_id,
       CASE WHEN p.is_declined AND p.tx_payment_id % 5 = 3 THEN p.tx_payment_id END AS decline_tx_payment_id
FROM {tx_transaction} t
JOIN {tx_invoice} i ON t.tx_invoice_id = i.tx_invoice_id
LEFT JOIN {tx_payment} p ON t.tx_type_id IN (4, 5) AND t.item_id = p.tx_payment_id
LEFT JOIN {tender_type} tt ON p.tender_type_id = tt.tender_type_id"""

# --- entitlements and satellites of agreements, invoices and payments ----------

VIEWS["activity"] = """
SELECT tx_transaction_id AS activity_id, tx_transaction_id, item_id, target_date_utc AS start_time_utc
FROM {tx_transaction} WHERE tx_type_id = 1"""

VIEWS["activity_transaction"] = """
SELECT activity_id * 2 + nth AS activity_transaction_id, activity_id
FROM (SELECT activity_id, @EACH(1) AS nth FROM {activity}) a"""

VIEWS["activity_time_log"] = """
SELECT activity_transaction_id AS activity_time_log_id, activity_transaction_id FROM {activity_transaction}"""

VIEWS["member_rental"] = """
SELECT tx_transaction_id AS member_rental_id, tx_transaction_id FROM {tx_transaction} WHERE tx_type_id = 3"""

VIEWS["cancellation"] = """
SELECT c_custkey * 2 AS cancellation_id, c_custkey * 2 AS entity_id, 1 AS entity_id_type,
       CAST('1999-01-01 00:00:00' AS @TS) + INTERVAL '1' DAY * CAST(c_custkey % 700 AS INT) AS cancel_date
FROM {customer} WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL
SELECT o_orderkey * 2 + 1, o_orderkey, 2, o_orderdate + INTERVAL '60' DAY
FROM {orders} WHERE o_orderstatus = 'P'"""

VIEWS["cancellation_detail"] = """
SELECT cancellation_id AS cancellation_detail_id, cancellation_id FROM {cancellation}"""

VIEWS["suspension"] = """
SELECT c_custkey AS suspension_id, c_custkey * 2 AS target_entity_id,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 8 ELSE 4 END AS target_entity_id_type
FROM {customer}"""

VIEWS["suspension_end_date"] = """
SELECT suspension_id AS suspension_end_date_id, suspension_id FROM {suspension}"""

VIEWS["member_agreement_sales_adviser"] = """
SELECT member_agreement_id AS member_agreement_sales_adviser_id, member_agreement_id FROM {member_agreement}"""

VIEWS["member_agreement_group_role"] = """
SELECT member_agreement_id AS member_agreement_group_role_id, member_agreement_id,
       @IDIV(member_agreement_id, 8) AS member_agreement_group_id,
       CASE WHEN member_agreement_id % 8 = 0 THEN 1 ELSE 2 END AS role_type
FROM {member_agreement}"""

VIEWS["member_agreement_group"] = """
SELECT DISTINCT member_agreement_group_id FROM {member_agreement_group_role}"""

VIEWS["member_agreement_group_rule"] = """
SELECT member_agreement_group_id AS member_agreement_group_rule_id, member_agreement_group_id
FROM {member_agreement_group}"""

VIEWS["member_agreement_group_restriction"] = """
SELECT member_agreement_group_id * 2 + nth AS member_agreement_group_restriction_id, member_agreement_group_id
FROM (SELECT member_agreement_group_id, @EACH(1) AS nth FROM {member_agreement_group}) g"""

VIEWS["member_agreement_group_restriction_agreements"] = """
SELECT member_agreement_group_restriction_id AS member_agreement_group_restriction_agreements_id,
       member_agreement_group_restriction_id
FROM {member_agreement_group_restriction}"""

VIEWS["member_agreement_group_restriction_promotions"] = """
SELECT member_agreement_group_restriction_id AS member_agreement_group_restriction_promotions_id,
       member_agreement_group_restriction_id
FROM {member_agreement_group_restriction}"""

VIEWS["member_agreement_payment_plan"] = """
SELECT member_agreement_id AS member_agreement_payment_plan_id, member_agreement_id FROM {member_agreement}"""

VIEWS["member_agreement_payment_plan_item"] = """
SELECT member_agreement_payment_plan_id * 2 + nth AS member_agreement_payment_plan_item_id,
       member_agreement_payment_plan_id
FROM (SELECT member_agreement_payment_plan_id, @EACH(1) AS nth FROM {member_agreement_payment_plan}) p"""

VIEWS["member_agreement_promotion"] = """
SELECT member_agreement_id AS member_agreement_promotion_id, member_agreement_id FROM {member_agreement}"""

VIEWS["promotion_effect"] = """
SELECT member_agreement_promotion_id * 2 + nth AS promotion_effect_id, member_agreement_promotion_id
FROM (SELECT member_agreement_promotion_id, @EACH(1) AS nth FROM {member_agreement_promotion}) p"""

VIEWS["promotion_effect_application"] = """
SELECT promotion_effect_id AS promotion_effect_application_id, promotion_effect_id FROM {promotion_effect}"""

VIEWS["fc_tx_invoice"] = """
SELECT o_orderkey AS fc_tx_invoice_id, o_orderkey AS original_tx_invoice_id
FROM {orders} WHERE o_orderstatus = 'F'"""

VIEWS["fc_tx_transaction"] = """
SELECT tx_transaction_id AS fc_tx_transaction_id, tx_invoice_id AS fc_tx_invoice_id FROM {tx_transaction}"""

VIEWS["fc_tx_payment"] = """
SELECT o_orderkey AS fc_tx_payment_id, o_orderkey AS original_tx_payment_id
FROM {orders} WHERE o_orderstatus = 'F'"""

# --- application error log ----------------------------------------------------

VIEWS["error_log"] = """
SELECT event_id AS error_id, ts AS time_utc,
       CASE event_type WHEN 'click' THEN 'AccessDenied' WHEN 'signup' THEN 'UserNotice'
            WHEN 'view' THEN 'ScheduleDate' WHEN 'purchase' THEN 'NullReference' ELSE 'Timeout' END AS type,
       CASE WHEN user_id % 9 = 0 THEN 'PdfWriter' ELSE 'Billing' END AS source,
       CASE WHEN user_id % 4 = 1 THEN 'Payment is missing client account id.'
            WHEN user_id % 4 = 2 THEN 'failure in Web.LoginController handler'
            ELSE 'user ' || CAST(user_id AS STRING) END AS message
FROM {events}"""


def _references(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def render(sql: str, dialect: str) -> str:
    """Replace the dialect markers; ``{name}`` references stay."""
    if dialect == "spark":
        ts, each, idiv = "TIMESTAMP_NTZ", "explode(sequence(0, ", r"(\1 div \2)"
    else:
        ts, each, idiv = "TIMESTAMP", "unnest(generate_series(0, ", r"(\1 // \2)"
    sql = sql.replace("@TS", ts)
    sql = re.sub(r"@IDIV\(([\w.]+), (\d+)\)", idiv, sql)
    while (start := sql.find("@EACH(")) >= 0:
        depth, end = 1, start + len("@EACH(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:start] + each + sql[start + len("@EACH("):end] + ")" + sql[end:]
    return sql


@cache
def _closure(names: tuple[str, ...]) -> tuple[str, ...]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TEST_TABLES or name in ordered:
            return
        for parent in _references(VIEWS[name]):
            visit(parent)
        ordered.append(name)

    for name in names:
        visit(name)
    return tuple(ordered)


def with_views(sql: str) -> str:
    """Prefix a DuckDB query with the CTEs of every view it names as ``{view}``."""
    ctes = ",\n".join(
        f"{name} AS ({re.sub(r'[{}]', '', render(VIEWS[name], 'duckdb')).strip()})"
        for name in _closure(tuple(_references(sql)))
    )
    body = re.sub(r"\{(\w+)\}", r"\1", sql).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
