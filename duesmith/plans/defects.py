"""Queries that search for billing defects."""

from __future__ import annotations

from pyspark.sql import DataFrame

from duesmith.operators import aging, error_log, link_defects, payment_defects, schedule_defects
from duesmith.plans import Query
from duesmith.plans.receivables import AGING, AS_OF, NETS
from duesmith.schema import CASH_INTERFACES
from duesmith.sources.tables import Tables

FROM, TO = "1997-01-01 00:00:00", "1999-01-01 00:00:00"
CUTOFF = "1999-06-01 00:00:00"
BILLING_DATE = "1999-12-01 00:00:00"
BILLING_UNITS = tuple(range(0, 25, 2))
SYNC_COMMAND = "sync --unit {unit} --agreement {agreement}"

# --- schedule -----------------------------------------------------------------

DOUBLED = f"""
SELECT pr.role_id, mair.member_agreement_id, ma.business_unit_id, ma.start_date, mair.bill_date,
       mairi.member_agreement_item_id, count(*) AS times_billed
FROM {{invoice_request}} mair
JOIN {{invoice_request_item}} mairi ON mairi.invoice_request_id = mair.invoice_request_id
JOIN {{member_agreement}} ma ON ma.member_agreement_id = mair.member_agreement_id
JOIN {{party_role}} pr ON pr.party_role_id = ma.party_role_id
WHERE mair.bill_date >= '{FROM}' AND mair.bill_date < '{TO}' AND coalesce(mair.process_type, 0) <> 1
GROUP BY ALL HAVING count(*) > 1"""

SURPLUS = f"""
SELECT * FROM (
  SELECT member_agreement_id, invoice_request_id, bill_date,
         row_number() OVER (PARTITION BY member_agreement_id ORDER BY bill_date, invoice_request_id) AS row
  FROM {{invoice_request}}
  WHERE coalesce(process_type, 0) <> 1 AND tx_invoice_id IS NULL
    AND bill_date >= '{FROM}' AND bill_date < '{TO}'
    AND member_agreement_id IN (SELECT member_agreement_id FROM ({DOUBLED}) d)) r
WHERE row > 1"""

DUPLICATED = """
SELECT invoice_request_id, due_date_utc, process_type, count(invoice_request_id) AS copies
FROM {payment_request} GROUP BY invoice_request_id, due_date_utc, process_type
HAVING count(invoice_request_id) <> 1 AND process_type IS NULL"""

RANKED = f"""
SELECT rank() OVER (PARTITION BY mapr.invoice_request_id, mapr.due_date_utc
                    ORDER BY mapr.status, mapr.payment_request_id) AS position,
       mapr.payment_request_id, mapr.invoice_request_id, mapr.due_date_utc, mapr.status, mapr.tx_payment_id
FROM {{payment_request}} mapr
JOIN ({DUPLICATED}) d ON d.invoice_request_id = mapr.invoice_request_id AND d.due_date_utc IS NOT DISTINCT FROM mapr.due_date_utc
WHERE mapr.process_type IS NULL"""

# As it was written, every request of an invoice request stands once for each of its duplicate groups,
# so a position counts each earlier request that many times.
RANKED_AS_WRITTEN = f"""
SELECT (numbered.nth - 1) * repeated.times + 1 AS position,
       payment_request_id, invoice_request_id, due_date_utc, status, tx_payment_id
FROM (SELECT *, row_number() OVER (PARTITION BY invoice_request_id ORDER BY status, payment_request_id) AS nth
      FROM {{payment_request}}) numbered
JOIN (SELECT invoice_request_id, count(*) AS times FROM ({DUPLICATED}) found GROUP BY invoice_request_id) repeated
  USING (invoice_request_id)"""

ORPHANS = """
SELECT mapri.* FROM {payment_request_item} mapri
JOIN {payment_request} mapr ON mapr.payment_request_id = mapri.payment_request_id
WHERE coalesce(mapr.process_type, 0) <> 1
EXCEPT
SELECT mapri.* FROM {payment_request_item} mapri
JOIN {invoice_request_item} mairi ON mairi.invoice_request_item_id = mapri.invoice_request_item_id
JOIN {payment_request} mapr ON mapr.payment_request_id = mapri.payment_request_id
WHERE coalesce(mapr.process_type, 0) <> 1"""

INSTALLMENTS = """
SELECT mai.member_agreement_id, CAST(s.payment_installments + 1 AS BIGINT) AS installment_count, x.n AS calc_count
FROM {invoice_request} mair
JOIN {invoice_request_item} mairi ON mairi.invoice_request_id = mair.invoice_request_id
JOIN {member_agreement_item} mai ON mai.member_agreement_item_id = mairi.member_agreement_item_id
JOIN {member_agreement_item_pay_source} s ON s.member_agreement_item_id = mai.member_agreement_item_id
JOIN (SELECT invoice_request_id, count(*) AS n FROM {payment_request} WHERE process_type IS NULL
      GROUP BY invoice_request_id) x ON x.invoice_request_id = mair.invoice_request_id
WHERE s.payment_installments IS NOT NULL AND s.payment_installments > 1 AND s.payment_installments + 1 < x.n"""

MISSING = f"""
SELECT r.role_id, ma.member_agreement_id, ma.start_date, mair.bill_date, mair.invoice_request_id,
       mair.tx_invoice_id, mair.primary_tx_invoice_id
FROM {{member_agreement}} ma, {{party_role}} r, {{invoice_request}} mair
WHERE ma.party_role_id = r.party_role_id AND mair.member_agreement_id = ma.member_agreement_id
  AND mair.bill_date >= '{FROM}' AND mair.bill_date <= '{TO}' AND coalesce(mair.process_type, 0) <> 1
  AND ma.status = 5
  AND NOT EXISTS (SELECT 1 FROM {{payment_request}} mapr
                  WHERE mapr.invoice_request_id = mair.invoice_request_id AND coalesce(mapr.process_type, 0) <> 1)"""

UNEXCUSED = f"""
SELECT m.* FROM ({MISSING}) m
WHERE m.member_agreement_id NOT IN (
  SELECT mai.member_agreement_id FROM {{member_agreement_item}} mai
  JOIN {{member_agreement_item_perpetual}} p ON p.member_agreement_item_id = mai.member_agreement_item_id
  WHERE p.price = 0
  UNION
  SELECT mai.member_agreement_id FROM {{member_agreement_item}} mai
  JOIN {{member_agreement_item_pay_source}} s ON s.member_agreement_item_id = mai.member_agreement_item_id
  WHERE s.from_foreign AND s.payment_value = 1
  UNION
  SELECT entity_id FROM {{cancellation}} WHERE entity_id_type = 1 AND cancel_date < '{CUTOFF}'
  UNION
  SELECT z.member_agreement_id FROM ({MISSING}) z
  JOIN (SELECT tx_invoice_id FROM {{tx_transaction}} GROUP BY tx_invoice_id HAVING sum(amount) = 0) t
    ON t.tx_invoice_id = z.tx_invoice_id)"""

WORKLIST = f"""
SELECT DISTINCT ma.business_unit_id, ma.member_agreement_id,
       'sync --unit ' || CAST(ma.business_unit_id AS VARCHAR) || ' --agreement '
         || CAST(ma.member_agreement_id AS VARCHAR) AS command
FROM ({UNEXCUSED}) m JOIN {{member_agreement}} ma ON ma.member_agreement_id = m.member_agreement_id
WHERE ma.member_agreement_id NOT IN (
  SELECT entity_id FROM {{cancellation}} WHERE entity_id_type = 1 AND cancel_date < '{CUTOFF}')"""

# --- links --------------------------------------------------------------------

MISSING_TX = """
SELECT maipri.payment_request_item_id, maipri.payment_request_id, maipri.tx_transaction_id,
       mapr.invoice_request_id, mapr.tx_payment_id,
       p.target_date, p.target_date_utc, p.target_date_zone_format,
       p.amount AS payment_amount, p.target_business_unit_id,
       ppr.payment_process_request_id, ppr.token, mair.tx_invoice_id,
       t.tx_transaction_id AS sale_transaction_id, t.group_id
FROM {payment_request_item} maipri
JOIN {payment_request} mapr ON mapr.payment_request_id = maipri.payment_request_id
JOIN {tx_payment} p ON p.tx_payment_id = mapr.tx_payment_id
JOIN {payment_process_request} ppr ON ppr.tx_payment_id = p.tx_payment_id
JOIN {invoice_request} mair ON mair.invoice_request_id = mapr.invoice_request_id
JOIN {tx_transaction} t ON t.tx_invoice_id = mair.tx_invoice_id AND t.tx_type_id = 1
WHERE maipri.tx_transaction_id NOT IN (SELECT tx_transaction_id FROM {tx_transaction})"""

MISSING_TX_ITEMS = f"""
SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY payment_request_item_id
                               ORDER BY sale_transaction_id, payment_process_request_id) AS nth,
         count(DISTINCT payment_process_request_id) OVER (PARTITION BY payment_request_item_id) AS gateway_requests,
         count(DISTINCT sale_transaction_id) OVER (PARTITION BY payment_request_item_id) AS sales
  FROM ({MISSING_TX}) m) r
WHERE nth = 1"""

MULTI = f"""
SELECT pr.role_id, invreq.invoice_request_id, invreq.member_agreement_id, count(*) AS invoice_count
FROM {{tx_invoice}} inv
JOIN {{invoice_request}} invreq ON invreq.invoice_request_id = inv.link_id
JOIN {{member_agreement}} ma ON ma.member_agreement_id = invreq.member_agreement_id
JOIN {{party_role}} pr ON pr.party_role_id = ma.party_role_id
WHERE inv.link_type_id IN (4) AND inv.target_date BETWEEN '{FROM}' AND '{TO}'
GROUP BY pr.role_id, invreq.invoice_request_id, invreq.member_agreement_id HAVING count(*) > 1"""

LINKED = f"""
SELECT inv.tx_invoice_id FROM {{tx_invoice}} inv
JOIN ({MULTI}) m ON m.invoice_request_id = inv.link_id AND inv.link_type_id = 4"""

SPONSOR = f"""
SELECT * FROM {{tx_transaction}}
WHERE tx_invoice_id IN ({LINKED}) AND tx_type_id = 4 AND link_type_id = 8"""

MISPOINTED = f"""
SELECT mair.invoice_request_id, mair.member_agreement_id, mair.tx_invoice_id, mapri.tx_transaction_id,
       t.tx_invoice_id AS paying_invoice_id
FROM {{invoice_request}} mair
JOIN ({LINKED}) i ON i.tx_invoice_id = mair.tx_invoice_id
JOIN {{payment_request}} mapr ON mapr.invoice_request_id = mair.invoice_request_id
JOIN {{payment_request_item}} mapri ON mapri.payment_request_id = mapr.payment_request_id
JOIN {{tx_transaction}} t ON t.tx_transaction_id = mapri.tx_transaction_id
WHERE mapri.tx_transaction_id IS NOT NULL AND t.link_type_id <> 8
  AND i.tx_invoice_id NOT IN (SELECT tx_invoice_id FROM ({SPONSOR}) s)"""

MISPOINTED_ITEMS = f"""
SELECT mairi.invoice_request_item_id, mairi.invoice_request_id, mair.tx_invoice_id, mairi.tx_transaction_id,
       min(t.tx_transaction_id) AS sale_transaction_id, count(*) AS differing_sales
FROM {{invoice_request}} mair
JOIN {{invoice_request_item}} mairi ON mairi.invoice_request_id = mair.invoice_request_id
JOIN (SELECT DISTINCT tx_invoice_id FROM ({LINKED}) l) i ON i.tx_invoice_id = mair.tx_invoice_id
JOIN {{tx_transaction}} t ON t.tx_invoice_id = i.tx_invoice_id
WHERE t.tx_type_id = 1 AND t.tx_transaction_id <> mairi.tx_transaction_id
  AND i.tx_invoice_id NOT IN (SELECT tx_invoice_id FROM ({SPONSOR}) s)
GROUP BY ALL"""

REMOVABLE = f"""
SELECT DISTINCT tx_invoice_id FROM ({LINKED}) l
WHERE tx_invoice_id NOT IN (SELECT tx_invoice_id FROM {{invoice_request}} WHERE tx_invoice_id IN ({LINKED}))
  AND tx_invoice_id NOT IN (SELECT tx_invoice_id FROM ({SPONSOR}) s)"""

EXPOSURE = f"""
SELECT x.tx_invoice_id, x.party_role_id, x.role_id, x.created_date, x.payment_amount,
       CAST(n.net AS DECIMAL(18,2)) AS balance,
       CASE WHEN i.link_type_id = 4 THEN i.link_id END AS invoice_request_id
FROM (SELECT DISTINCT i.tx_invoice_id, i.party_role_id, pr.role_id, pr.created_date, p.amount AS payment_amount
      FROM {{tx_payment}} p
      JOIN {{tx_transaction}} t ON t.item_id = p.tx_payment_id AND t.tx_type_id = 4
      JOIN {{tx_invoice}} i ON i.tx_invoice_id = t.tx_invoice_id
      JOIN {{party_role}} pr ON pr.party_role_id = i.party_role_id
      WHERE p.is_multi_invoice) x
JOIN {{tx_invoice}} i ON i.tx_invoice_id = x.tx_invoice_id
LEFT JOIN ({NETS}) n ON n.tx_invoice_id = x.tx_invoice_id"""

EXPOSED_REQUESTS = f"""
SELECT DISTINCT mair.invoice_request_id, mair.process_type FROM ({EXPOSURE}) e
JOIN {{tx_invoice}} tx ON tx.tx_invoice_id = e.tx_invoice_id
JOIN {{invoice_request}} mair ON mair.invoice_request_id = tx.link_id AND tx.link_type_id = 4"""

EXPOSED_PAYMENTS = f"""
SELECT DISTINCT mapr.payment_request_id, mapr.invoice_request_id, mapr.process_type FROM ({EXPOSURE}) e
JOIN {{tx_invoice}} tx ON tx.tx_invoice_id = e.tx_invoice_id
JOIN {{invoice_request}} mair ON mair.invoice_request_id = tx.link_id AND tx.link_type_id = 4
JOIN {{payment_request}} mapr ON mapr.invoice_request_id = mair.invoice_request_id
WHERE mapr.process_type IS NULL"""

# --- payments -----------------------------------------------------------------

_OVERPAID_CTE = """
flags AS (SELECT tx_invoice_id,
                 bool_or(tx_type_id = 4 AND link_type_id IS NULL AND is_accounting_credit) AS unlinked,
                 bool_or(tx_type_id = 4 AND link_type_id IS NOT NULL) AS linked,
                 sum(amount) FILTER (WHERE NOT is_accounting_credit) AS charged,
                 sum(amount) FILTER (WHERE is_accounting_credit) AS credited
          FROM {tx_transaction} GROUP BY tx_invoice_id),
over AS (SELECT t.* FROM flags JOIN {tx_invoice} t USING (tx_invoice_id)
         WHERE unlinked AND linked AND charged < credited)"""

OVERPAID = f"""WITH {_OVERPAID_CTE}
SELECT pr.role_id, c.first_name, c.last_name, t.tx_invoice_id, t.target_date, bu.name AS unit_name
FROM over t
JOIN {{client_account}} ca ON ca.client_account_id = t.client_account_id
JOIN {{client_account_party}} cap ON cap.client_account_id = ca.client_account_id
JOIN {{member_list}} c ON c.party_id = cap.party_id
JOIN {{business_unit}} bu ON bu.business_unit_id = t.target_business_unit_id
JOIN {{party_role}} pr ON pr.party_role_id = c.party_role_id
WHERE cap.primary_party"""

OVERPAID_ORGS = f"""WITH {_OVERPAID_CTE}
SELECT pr.role_id, coalesce(c.first_name, o.organization_name) AS first_name, c.last_name, t.tx_invoice_id,
       t.target_date, bu.name AS unit_name
FROM over t
JOIN {{client_account}} ca ON ca.client_account_id = t.client_account_id
JOIN {{client_account_party}} cap ON cap.client_account_id = ca.client_account_id
LEFT JOIN {{member_list}} c ON c.party_id = cap.party_id
LEFT JOIN {{organization_list}} o ON o.party_id = cap.party_id
JOIN {{business_unit}} bu ON bu.business_unit_id = t.target_business_unit_id
LEFT JOIN {{party_role}} pr ON pr.party_id = cap.party_id
WHERE cap.primary_party"""

OVERPAID_COUNT = f"""WITH {_OVERPAID_CTE}
SELECT ca.client_account_id, count(*) AS invoices
FROM over t JOIN {{client_account}} ca ON ca.client_account_id = t.client_account_id GROUP BY ca.client_account_id"""

OVERCREDITED = """
SELECT pr.role_id, i.tx_invoice_id, CAST(a.amt AS DECIMAL(18,2)) AS amt
FROM (SELECT tx_invoice_id, sum(amount * (CAST(is_accounting_credit AS INT) * 2 - 1)) AS amt
      FROM {tx_transaction} WHERE tx_invoice_id IN (
        SELECT t.tx_invoice_id FROM {tx_transaction} t
        JOIN {tx_payment} p ON p.tx_payment_id = t.item_id
        JOIN {tender_type} tt ON tt.tender_type_id = p.tender_type_id
        WHERE tt.tender_interface_id IN (1, 2) AND t.tx_type_id = 4 AND t.link_type_id IS NOT NULL)
      GROUP BY tx_invoice_id) a
JOIN {tx_invoice} i ON i.tx_invoice_id = a.tx_invoice_id
JOIN {party_role} pr ON pr.party_role_id = i.party_role_id
WHERE a.amt > 0"""

DECLINES = f"""WITH first_pass AS (
  SELECT tx_invoice_id, party_role_id, billing_status, tx_invoice_status_id FROM {{tx_invoice}}
  WHERE tx_invoice_id IN (SELECT tx_invoice_id FROM {{tx_transaction}}
                          WHERE tx_type_id = 4 AND NOT is_accounting_credit AND description LIKE '%VISA%')),
second_pass AS (
  SELECT f.party_role_id FROM first_pass f JOIN {{tx_transaction}} t ON t.tx_invoice_id = f.tx_invoice_id
  WHERE t.tx_type_id = 4 AND NOT t.is_accounting_credit GROUP BY f.party_role_id HAVING count(*) > 1),
third_pass AS (
  SELECT pr.role_id, t.tx_invoice_id, f.billing_status, f.tx_invoice_status_id, t.description, t.link_type_id
  FROM first_pass f
  JOIN {{tx_transaction}} t ON t.tx_invoice_id = f.tx_invoice_id
  JOIN second_pass s ON s.party_role_id = f.party_role_id
  JOIN {{party_role}} pr ON pr.party_role_id = s.party_role_id
  JOIN {{member_agreement}} ma ON ma.party_role_id = pr.party_role_id
  WHERE t.tx_type_id = 4 AND NOT t.is_accounting_credit AND t.description NOT LIKE '%Sponsor%' AND ma.status = 5),
fourth_pass AS (SELECT role_id FROM third_pass GROUP BY role_id HAVING count(*) > 1)
SELECT DISTINCT t.* FROM third_pass t
JOIN fourth_pass f ON f.role_id = t.role_id
JOIN {{party_role}} pr ON pr.role_id = t.role_id
JOIN ({AGING}) c ON c.party_role_id = pr.party_role_id
WHERE pr.party_role_type_id = 1 AND c.total_past_due > 1"""

REBILLS = f"""
SELECT req.payment_process_request_id, req.payment_process_batch_id, pay.tx_payment_id, pay.client_account_id,
       pay.party_role_id, pay.target_date, pay.target_date_utc, pay.target_date_zone_format, pay.tender_type_id,
       pay.link_type_id, pay.link_id, dr.decline_reason_id, rsp.reference_id, rsp.rebill_payment_process_request_id
FROM {{payment_process_response}} rsp
JOIN {{payment_process_request}} req ON req.payment_process_request_id = rsp.payment_process_request_id
JOIN {{payment_process_batch}} batch ON batch.payment_process_batch_id = req.payment_process_batch_id
JOIN {{tx_payment}} pay ON pay.tx_payment_id = req.tx_payment_id
LEFT JOIN {{decline_reason}} dr ON dr.decline_reason_id = pay.decline_reason_id
WHERE rsp.rebill_payment_process_request_id IS NULL AND batch.business_unit_id IN {BILLING_UNITS}
  AND pay.is_declined AND (dr.do_not_reprocess IS NULL OR dr.do_not_reprocess = false)
  AND pay.target_date_utc >= TIMESTAMP '{BILLING_DATE}' - INTERVAL 700 DAY
  AND TIMESTAMP '{BILLING_DATE}' > pay.target_date + INTERVAL 7 DAY"""

# --- error log ----------------------------------------------------------------

WINDOWS = (
    ("2024-01-02 23:27:00", "2024-01-05 23:50:00"),
    ("2024-01-05 00:00:00", "2024-01-06 00:10:00"),
    ("2024-01-20 16:40:00", "2024-01-25 17:00:00"),
)
NOISE = ("AccessDenied", "UserNotice", "ScheduleDate")

ERRORS = " UNION ALL ".join(
    f"""SELECT {n} AS window_no, * FROM {{error_log}}
WHERE time_utc BETWEEN '{start}' AND '{end}' AND type <> 'AccessDenied' AND type <> 'UserNotice'
  AND type <> 'ScheduleDate' AND source <> 'PdfWriter' AND message NOT LIKE '%Web.LoginController%'"""
    for n, (start, end) in enumerate(WINDOWS)
)
# A window of minutes around every hundredth error, and one of days around every thousandth.
_AROUND = """
SELECT error_id AS window_no,
       CASE WHEN error_id % 1000 = 7 THEN time_utc - INTERVAL '2' DAY ELSE time_utc - INTERVAL '3' MINUTE END AS {start},
       CASE WHEN error_id % 1000 = 7 THEN time_utc + INTERVAL '1' DAY ELSE time_utc + INTERVAL '7' MINUTE END AS {end}
FROM {log} WHERE error_id % 100 = 7"""
AROUND = _AROUND.format(start="begins", end="ends", log="{error_log}")
ERRORS_AROUND = f"""
SELECT w.window_no, e.* FROM {{error_log}} e JOIN ({AROUND}) w ON e.time_utc BETWEEN w.begins AND w.ends
WHERE e.type <> 'AccessDenied' AND e.type <> 'UserNotice' AND e.type <> 'ScheduleDate'"""


def _windows_around(T: Tables) -> DataFrame:
    return T.error_log.sparkSession.sql(_AROUND.format(start="start", end="end", log="{log}"), log=T.error_log)


NO_ACCOUNT = "Payment is missing client account id."


def _doubled(T: Tables) -> DataFrame:
    return schedule_defects.double_billed(T, FROM, TO)


def surplus(T: Tables) -> DataFrame:
    return schedule_defects.surplus_requests(T, _doubled(T), FROM, TO)


def _missing(T: Tables) -> DataFrame:
    return schedule_defects.missing_payment_requests(T, FROM, TO)


def unexcused(T: Tables) -> DataFrame:
    return schedule_defects.exclude_legitimate(_missing(T), T, CUTOFF)


def multi(T: Tables) -> DataFrame:
    return link_defects.multi_linked(T, FROM, TO)


def duplicates(T: Tables) -> DataFrame:
    return schedule_defects.dup_payment_requests(T.payment_request)


def exposure(T: Tables) -> DataFrame:
    return link_defects.multi_invoice_exposure(T)


QUERIES: dict[str, Query] = {
    "double_billed_items": Query(_doubled, DOUBLED),
    "double_bill_ranked_requests": Query(surplus, SURPLUS),
    "surplus_unpaid_payment_requests": Query(
        lambda T: schedule_defects.unpaid_payment_requests(T, surplus(T)),
        f"""SELECT * FROM {{payment_request}}
WHERE tx_payment_id IS NULL AND invoice_request_id IN (SELECT invoice_request_id FROM ({SURPLUS}) s)""",
    ),
    "duplicate_payment_requests": Query(duplicates, DUPLICATED),
    "rank_duplicate_requests": Query(
        lambda T: schedule_defects.rank_duplicates(T.payment_request, duplicates(T)), RANKED
    ),
    "rank_duplicate_requests_reference_mode": Query(
        lambda T: schedule_defects.rank_duplicates(T.payment_request, duplicates(T), reference_mode=True),
        RANKED_AS_WRITTEN,
    ),
    "orphan_payment_request_items": Query(schedule_defects.orphan_items, ORPHANS),
    "bad_installments": Query(schedule_defects.bad_installments, INSTALLMENTS),
    "missing_payment_requests": Query(_missing, MISSING),
    "missing_request_exclusions": Query(unexcused, UNEXCUSED),
    "sync_worklist": Query(
        lambda T: schedule_defects.sync_worklist(unexcused(T), T, CUTOFF, SYNC_COMMAND), WORKLIST
    ),
    "sync_worklist_in_order": Query(
        lambda T: schedule_defects.sync_worklist(unexcused(T), T, CUTOFF, SYNC_COMMAND, ordered=True), WORKLIST
    ),
    "missing_payment_transactions": Query(link_defects.missing_payment_tx, MISSING_TX_ITEMS),
    "missing_payment_transactions_reference_mode": Query(
        lambda T: link_defects.missing_payment_tx(T, reference_mode=True), MISSING_TX
    ),
    "multi_linked_requests": Query(multi, MULTI),
    "sponsor_transactions": Query(lambda T: link_defects.sponsor_tx(T, multi(T)), SPONSOR),
    "mispointed_requests": Query(lambda T: link_defects.mispointed_requests(T, multi(T)), MISPOINTED),
    "mispointed_request_items": Query(lambda T: link_defects.mispointed_items(T, multi(T)), MISPOINTED_ITEMS),
    "removable_invoices": Query(lambda T: link_defects.removable_invoices(T, multi(T)), REMOVABLE),
    "multi_invoice_payment_invoices": Query(exposure, EXPOSURE),
    "multi_invoice_payment_requests": Query(
        lambda T: link_defects.exposed_requests(T, exposure(T)), EXPOSED_REQUESTS
    ),
    "multi_invoice_unmarked_payment_requests": Query(
        lambda T: link_defects.exposed_payment_requests(T, exposure(T)), EXPOSED_PAYMENTS
    ),
    "overpaid_invoices": Query(payment_defects.overpaid, OVERPAID),
    "overpaid_in_order": Query(lambda T: payment_defects.overpaid(T, ordered=True), OVERPAID),
    "overpaid_with_org": Query(lambda T: payment_defects.overpaid(T, include_orgs=True), OVERPAID_ORGS),
    "overpaid_by_account": Query(payment_defects.overpaid_by_account, OVERPAID_COUNT),
    "cash_overcredited_invoices": Query(
        lambda T: payment_defects.cash_overcredited(T, CASH_INTERFACES), OVERCREDITED
    ),
    "repeat_card_declines": Query(
        lambda T: payment_defects.repeat_declines(T, lambda roles: aging.ar_aging(T, AS_OF, party_roles=roles)),
        DECLINES,
    ),
    "rebill_candidates": Query(
        lambda T: payment_defects.rebill_candidates(T, BILLING_UNITS, BILLING_DATE, 7, 700), REBILLS
    ),
    "error_log_window": Query(
        lambda T: error_log.error_window(T.error_log, WINDOWS, NOISE, "PdfWriter", "%Web.LoginController%"), ERRORS
    ),
    "error_log_windows_of_table": Query(
        lambda T: error_log.errors_in_windows(T.dated("error_log"), _windows_around(T), NOISE), ERRORS_AROUND
    ),
    "error_log_exact_message": Query(
        lambda T: error_log.error_by_message(
            T.error_log, NO_ACCOUNT, ("2024-01-01 12:00:00", "2024-01-20 01:00:00"), -4
        ),
        f"""SELECT time_utc - INTERVAL 4 HOUR AS local_time, * FROM {{error_log}}
WHERE time_utc BETWEEN '2024-01-01 12:00:00' AND '2024-01-20 01:00:00' AND message = '{NO_ACCOUNT}'""",
    ),
}
