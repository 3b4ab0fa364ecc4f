"""Queries over balances, aging, the billing summary and agreements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money
from duesmith.functions.times import to_utc, ts
from duesmith.operators import aging_state, agreements, aging, ledger, summary
from duesmith.plans import Query
from duesmith.schema import ACTIVE, ACTIVE_STATUSES, ROLE_MEMBER, TX_FEE, TX_SALE
from duesmith.sources import snapshots
from duesmith.sources.book import Book
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import new_folder, stored

AS_OF = "2000-01-01 00:00:00"
FROM, TO, ZONE = "1998-01-01 00:00:00", "1999-01-01 00:00:00", "America/New_York"
UNITS = (1, 5, 6, 12, 15, 20)

MEMBER_ACCOUNTS = """
SELECT DISTINCT client_account_id FROM {client_account_party}
WHERE party_id IN (SELECT party_id FROM {party_role} WHERE party_role_type_id = 1)"""

LEDGER = """
SELECT i.client_account_id, i.target_date_utc, i.payment_due_date, i.target_business_unit_id,
       t.amount, t.is_accounting_credit AS credit
FROM {tx_transaction} t JOIN {tx_invoice} i ON t.tx_invoice_id = i.tx_invoice_id"""

_SIDES = """
       CAST(sum(l.amount) FILTER (WHERE NOT l.credit) AS DECIMAL(18,2)) AS charges,
       CAST(sum(l.amount) FILTER (WHERE l.credit) AS DECIMAL(18,2)) AS payments,
       CAST(sum(l.amount) FILTER (WHERE NOT l.credit) - sum(l.amount) FILTER (WHERE l.credit)
            AS DECIMAL(18,2)) AS balance"""


def _range(label: str, recent: str | None, older: str | None, test: str, ledger_name: str) -> str:
    def edge(value: str | None) -> str:
        return f"CAST({'NULL' if value is None else repr(value)} AS TIMESTAMP)"

    return f"""
SELECT '{label}' AS range, {edge(recent)} AS from_date, {edge(older)} AS to_date,
       a.client_account_id AS account_id, {_SIDES}
FROM accounts a LEFT JOIN {ledger_name} l ON l.client_account_id = a.client_account_id AND {test}
GROUP BY a.client_account_id"""


B30, B60, B90 = "1999-12-02 00:00:00", "1999-11-02 00:00:00", "1999-10-03 00:00:00"

TARGET_AGING = f"""WITH accounts AS ({MEMBER_ACCOUNTS}), every AS ({LEDGER}),
in_unit AS (
  SELECT e.*, timezone(b.time_zone_name, TIMESTAMP '{AS_OF}') AT TIME ZONE 'UTC' AS cutoff
  FROM every e JOIN {{business_unit}} b ON b.business_unit_id = e.target_business_unit_id)
{" UNION ALL ".join([
    _range("30 Day", None, B30, f"l.target_date_utc > '{B30}' AND l.target_date_utc < l.cutoff", "in_unit"),
    _range("60 Day", B30 + ".001", B60,
           f"l.target_date_utc > '{B60}' AND l.target_date_utc < TIMESTAMP '{B30}.001'", "in_unit"),
    _range("90 Day", B60 + ".001", B90,
           f"l.target_date_utc > '{B90}' AND l.target_date_utc < TIMESTAMP '{B60}.001'", "in_unit"),
    _range("90+", B90 + ".001", None, f"l.target_date_utc < TIMESTAMP '{B90}.001'", "in_unit"),
    _range("Total", None, None, "true", "every"),
])}"""

DUE_AGING = f"""WITH accounts AS ({MEMBER_ACCOUNTS}), every AS ({LEDGER})
{" UNION ALL ".join([
    _range("30 Day", None, B30, f"l.payment_due_date > '{B30}'", "every"),
    _range("60 Day", "1999-12-02 00:01:00", B60,
           f"l.payment_due_date BETWEEN '{B60}' AND '1999-12-02 00:01:00'", "every"),
    _range("90 Day", "1999-11-02 00:01:00", B90,
           f"l.payment_due_date BETWEEN '{B90}' AND '1999-11-02 00:01:00'", "every"),
    _range("90+", "1999-10-03 00:01:00", None, "l.payment_due_date < '1999-10-03 00:01:00'", "every"),
    _range("Total", None, None, "true", "every"),
])}"""

ACCOUNT_TOTAL = f"""WITH accounts AS ({MEMBER_ACCOUNTS}), every AS ({LEDGER})
SELECT a.client_account_id AS account_id, {_SIDES}
FROM accounts a LEFT JOIN every l ON l.client_account_id = a.client_account_id
GROUP BY a.client_account_id"""

NETS = """
SELECT tx_invoice_id, sum(CASE WHEN is_accounting_credit THEN -amount ELSE amount END) AS net
FROM {tx_transaction} GROUP BY tx_invoice_id"""

AGING = f"""
SELECT i.target_business_unit_id AS business_unit_id, i.client_account_id, pr.party_id,
       r.member_agreement_id, i.party_role_id,
       {", ".join(
           f"CAST(coalesce(sum(n.net) FILTER (WHERE n.net > 0 AND {test}), 0) AS DECIMAL(18,2)) AS {name}"
           for name, test in [
               ("aging_current", "age <= 0"), ("aging_30", "age BETWEEN 1 AND 30"),
               ("aging_60", "age BETWEEN 31 AND 60"), ("aging_90", "age BETWEEN 61 AND 90"),
               ("aging_120", "age BETWEEN 91 AND 120"), ("aging_over_120", "age > 120"),
               ("total_due", "true"), ("total_past_due", "age > 0")])},
       CAST(-sum(n.net) FILTER (WHERE n.net < 0) AS DECIMAL(18,2)) AS acct_credit
FROM (SELECT *, date_diff('day', coalesce(payment_due_date, target_date), TIMESTAMP '{AS_OF}') AS age
      FROM {{tx_invoice}} WHERE target_date < '{AS_OF}') i
JOIN ({NETS}) n ON n.tx_invoice_id = i.tx_invoice_id
JOIN {{party_role}} pr ON pr.party_role_id = i.party_role_id
LEFT JOIN {{invoice_request}} r ON i.link_type_id = 4 AND r.invoice_request_id = i.link_id
GROUP BY 1, 2, 3, 4, 5"""

_ZERO = ", ".join(f"CAST(0 AS DECIMAL(18,2)) AS {name}" for name in aging.BUCKETS)
ZERO_ROWS = f"""
SELECT pr.business_unit_id, cap.client_account_id, pr.party_id, ma.member_agreement_id, pr.party_role_id,
       {_ZERO}, CAST(NULL AS DECIMAL(18,2)) AS acct_credit
FROM {{party_role}} pr
JOIN {{client_account_party}} cap ON cap.party_id = pr.party_id
JOIN {{member_agreement}} ma ON ma.party_role_id = pr.party_role_id
WHERE pr.party_role_type_id = 1
  AND (pr.party_role_id, pr.business_unit_id) NOT IN (SELECT party_role_id, business_unit_id FROM aging)"""
FILLED = f"WITH aging AS ({AGING}) SELECT * FROM aging UNION ALL {ZERO_ROWS}"

DUE = f"""
SELECT cap.party_id, t.tx_transaction_id,
       CASE WHEN t.is_accounting_credit THEN -t.amount ELSE t.amount END AS due_amount,
       i.target_date_utc, t.link_type_id, t.link_id, i.target_business_unit_id AS business_unit_id, t.tx_invoice_id
FROM {{tx_transaction}} t
JOIN {{tx_invoice}} i ON i.tx_invoice_id = t.tx_invoice_id AND i.target_date < '{AS_OF}'
JOIN {{client_account_party}} cap ON cap.client_account_id = i.client_account_id AND cap.primary_party"""

# The due table after its update: what the schedule says for units that exist, else the row itself.
REBASED_ROWS = """
SELECT d.party_id, d.tx_transaction_id, coalesce(u.new_amount, d.due_amount) AS due_amount,
       CASE WHEN u.tx_transaction_id IS NULL THEN d.target_date_utc ELSE u.new_date END AS target_date_utc,
       d.link_type_id, d.link_id, d.business_unit_id, d.tx_invoice_id
FROM due d
LEFT JOIN (
  SELECT party_id, tx_transaction_id, new_date, sum(piece) AS new_amount
  FROM (SELECT o.party_id, o.tx_transaction_id, coalesce(s.due_date_utc, o.target_date_utc) AS new_date,
               coalesce(s.planned, o.due_amount) AS piece
        FROM due o
        LEFT JOIN (SELECT ir.tx_invoice_id, pr.due_date_utc,
                          item.fixed_amount + coalesce(sum(CASE WHEN t.is_accounting_credit THEN -t.amount ELSE t.amount END), 0) AS planned
                   FROM {invoice_request} ir
                   LEFT JOIN {payment_request} pr USING (invoice_request_id)
                   LEFT JOIN {payment_request_item} item USING (payment_request_id)
                   LEFT JOIN {tx_transaction} t
                     ON t.link_id = item.payment_request_item_id AND t.link_type_id = 3 AND t.tx_type_id IN (4, 5)
                   GROUP BY ir.invoice_request_id, ir.tx_invoice_id, pr.payment_request_id, pr.due_date_utc,
                            item.payment_request_item_id, item.fixed_amount) s
          ON s.tx_invoice_id = o.tx_invoice_id
        WHERE o.business_unit_id IN (SELECT business_unit_id FROM {business_unit})) pieces
  GROUP BY party_id, tx_transaction_id, new_date) u
  ON u.party_id = d.party_id AND u.tx_transaction_id = d.tx_transaction_id"""

REBASED = f"""WITH due AS ({DUE}), rebased AS ({REBASED_ROWS})
SELECT * REPLACE (CAST(due_amount AS DECIMAL(18,2)) AS due_amount) FROM rebased"""

BUCKETS = f"""WITH due AS ({DUE}), rebased AS ({REBASED_ROWS})
SELECT party_id,
       {", ".join(f"CAST(sum(due_amount) FILTER (WHERE {test}) AS DECIMAL(18,2)) AS {name}" for name, test in [
           ("zero_to_thirty", f"target_date_utc < '{AS_OF}' AND target_date_utc > '{B30}'"),
           ("thirty_one_to_sixty",
            f"target_date_utc < TIMESTAMP '1999-12-01 23:59:59.999' AND target_date_utc > '{B60}'"),
           ("sixty_one_to_ninety", f"target_date_utc < TIMESTAMP '{B60}.001' AND target_date_utc > '{B90}'"),
           ("older", f"target_date_utc < TIMESTAMP '{B90}.001'"),
           ("balance", f"target_date_utc < '{AS_OF}'")])}
FROM rebased GROUP BY party_id"""

# --- billing summary ----------------------------------------------------------

UTC_FROM = f"(timezone('{ZONE}', TIMESTAMP '{FROM}') AT TIME ZONE 'UTC')"
UTC_TO = f"(timezone('{ZONE}', TIMESTAMP '{TO}') AT TIME ZONE 'UTC')"

BASE = f"""
SELECT * FROM {{billing_service_tx}} WHERE target_date_utc >= {UTC_FROM} AND target_date_utc < {UTC_TO}"""

# Kept are rows that were not declined, whose decline is booked, or whose payment a response of the
# window's payments declines.
REPORTABLE = f"""
(NOT b.is_payment_declined OR b.decline_tx_payment_id IS NOT NULL OR b.tx_payment_id IN (
   SELECT answer.decline_tx_payment_id FROM {{tx_payment}} paid
   JOIN {{payment_process_request}} asked USING (tx_payment_id)
   JOIN {{payment_process_response}} answer USING (payment_process_request_id)
   WHERE paid.target_date_utc >= {UTC_FROM} AND paid.target_date_utc < {UTC_TO}))"""

_NEAR = f"abs(date_diff('day', b.due_date_utc, {UTC_TO})) <= 30"
_FAR = f"abs(date_diff('day', b.due_date_utc, {UTC_TO})) > 30"
SPLIT_COLUMNS = f"""
       CAST(count(CASE WHEN b.tx_type_id = 4 AND {_NEAR} THEN b.tx_payment_id END) AS BIGINT) AS count_current_payments,
       CAST(sum(CASE WHEN b.tx_type_id = 4 AND {_NEAR} THEN b.amount ELSE 0 END) AS DECIMAL(18,2))
         AS sum_current_payments,
       CAST(count(CASE WHEN b.tx_type_id = 4 AND {_FAR} THEN b.tx_payment_id END) AS BIGINT) AS count_past_due_payments,
       CAST(sum(CASE WHEN b.tx_type_id = 4 AND {_FAR} THEN b.amount ELSE 0 END) AS DECIMAL(18,2))
         AS sum_past_due_payments"""


def _summary_sql(sales: str, fees: str) -> str:
    return f"""WITH base AS ({BASE}),
sale AS ({sales}), fee AS ({fees}),
first_tx AS (
  SELECT t.tx_invoice_id, t.group_id, t.item_id, it.upc, it.name FROM (
    SELECT *, row_number() OVER (PARTITION BY tx_invoice_id, group_id ORDER BY tx_transaction_id) AS nth
    FROM {{tx_transaction}} WHERE tx_type_id = 1) t
  LEFT JOIN {{item}} it ON it.item_id = t.item_id WHERE nth = 1)
SELECT b.tx_transaction_id, b.tx_invoice_id, b.group_id,
       max(bu.division_id) AS division_id, max(bu.division_name) AS division_name,
       max(bu.business_unit_id) AS business_unit_id, max(bu.name) AS bu_name,
       max(CASE WHEN ml.party_role_id IS NULL THEN ol.role_id ELSE ml.role_id END) AS member_id,
       max(CASE WHEN ml.party_role_id IS NULL THEN ol.organization_name ELSE ml.first_name END) AS first_name,
       max(CASE WHEN ml.party_role_id IS NULL THEN '' ELSE ml.last_name END) AS last_name,
       max(b.member_agreement_id) AS member_agreement_id, max(b.target_date_utc) AS bill_date,
       max(b.due_date) AS due_date, max(f.item_id) AS sale_item_id, max(f.upc) AS sale_item_code,
       max(f.name) AS sale_item, max(b.description) AS line_item,
       max(CASE WHEN b.tx_type_id = 4 OR b.tx_type_id = 5 THEN b.target_date END) AS payment_date,
       max(b.gl_id) AS gl_id, max(gl.code) AS gl_code, max(gl.description) AS gl_description,
       CAST(sum(CASE WHEN b.tx_type_id IN (1, 3) AND b.amount IS NOT NULL THEN b.amount
                     ELSE coalesce(s.amount, 0) END) AS DECIMAL(18,2)) AS sales,
       CAST(sum(CASE WHEN b.tx_type_id = 2 AND b.amount IS NOT NULL THEN b.amount
                     ELSE coalesce(t.amount, 0) END) AS DECIMAL(18,2)) AS tax,
       CAST(sum(CASE WHEN b.tx_type_id IN (1, 2, 3) AND b.amount IS NOT NULL THEN b.amount
                     ELSE coalesce(s.amount, 0) + coalesce(t.amount, 0) END) AS DECIMAL(18,2)) AS sales_tax_total,
       max(b.tender_type_id) AS tender_type_id,
       coalesce(max(CASE WHEN b.tender_interface_id IN (3, 11) THEN cc.description
                         ELSE b.tender_type_name END), 'Cash') AS tender_type,
       max(b.tender_interface_id) AS tender_type_interface_id,
       max(b.credit_card_type_id) AS credit_card_type_id,
       max(CASE WHEN b.is_payment_declined THEN 1 ELSE 0 END) AS is_declined,
       CAST(sum(CASE WHEN b.tx_type_id IN (4, 5) THEN b.amount ELSE 0 END) AS DECIMAL(18,2)) AS payment,
       {SPLIT_COLUMNS}
FROM base b
JOIN {{party_role}} pr ON pr.party_role_id = b.party_role_id
LEFT JOIN {{general_ledger_code}} gl ON gl.general_ledger_code_id = b.gl_id
LEFT JOIN {{business_unit}} bu ON bu.business_unit_id = b.business_unit_id
LEFT JOIN {{member_list}} ml ON ml.party_role_id = pr.party_role_id AND pr.party_role_type_id = 1
LEFT JOIN {{organization_list}} ol ON ol.party_role_id = pr.party_role_id AND pr.party_role_type_id = 7
LEFT JOIN {{credit_card_type}} cc ON cc.credit_card_type_id = b.credit_card_type_id
LEFT JOIN sale s ON s.tx_invoice_id = b.tx_invoice_id AND s.group_id = b.group_id
LEFT JOIN fee t ON t.tx_invoice_id = b.tx_invoice_id AND t.group_id = b.group_id
LEFT JOIN first_tx f ON f.tx_invoice_id = b.tx_invoice_id AND f.group_id = b.group_id
WHERE {REPORTABLE} AND $FILTERS
GROUP BY b.tx_transaction_id, b.tx_invoice_id, b.group_id"""


def _distinct_amounts(tx_type: int) -> str:
    return f"SELECT DISTINCT tx_invoice_id, amount, group_id FROM base WHERE tx_type_id = {tx_type}"


def _summed(tx_type: int) -> str:
    return (
        f"SELECT tx_invoice_id, group_id, sum(amount) AS amount FROM ({_distinct_amounts(tx_type)}) d "
        "GROUP BY tx_invoice_id, group_id"
    )


SUMMARY = _summary_sql(_summed(1), _summed(3)).replace("$FILTERS", "true")
FANNED_SUMMARY = _summary_sql(_distinct_amounts(1), _distinct_amounts(3)).replace("$FILTERS", "true")
FILTERED_SUMMARY = _summary_sql(_summed(1), _summed(3)).replace(
    "$FILTERS",
    f"""bu.business_unit_id IN {UNITS} AND b.tender_type_id IN (3, 4)
  AND (ml.first_name LIKE '%BUILD%' OR ml.last_name LIKE '%BUILD%' OR ml.role_id = '%BUILD%')
  AND ml.party_role_id IN (SELECT party_role_id FROM {{party_property}}
                           WHERE type_id = 2 AND TRY_CAST(value AS DECIMAL(12,2)) > 0)""",
)


# Each unit's own local time, from the day on which some zones change their clocks.
CHANGE, CHANGE_BACK = "1998-04-05 00:00:00", "1998-10-25 12:00:00"
_UNIT_FROM = f"(timezone(u.time_zone_name, TIMESTAMP '{CHANGE}') AT TIME ZONE 'UTC')"
_UNIT_TO = f"(timezone(u.time_zone_name, TIMESTAMP '{CHANGE_BACK}') AT TIME ZONE 'UTC')"
UNITS_BASE = f"""
SELECT x.*, {_UNIT_FROM} AS window_start, {_UNIT_TO} AS window_end
FROM {{billing_service_tx}} x JOIN {{business_unit}} u ON u.business_unit_id = x.business_unit_id
WHERE x.target_date_utc >= {_UNIT_FROM} AND x.target_date_utc < {_UNIT_TO}"""
UNITS_SUMMARY = (
    SUMMARY.replace(BASE, UNITS_BASE).replace(UTC_FROM, "b.window_start").replace(UTC_TO, "b.window_end")
)


def _base(T: Tables) -> DataFrame:
    return summary.billing_base(T.dated("billing_service_tx"), ZONE, FROM, TO)


def _from_to():
    return to_utc(ts(FROM), ZONE), to_utc(ts(TO), ZONE)


def _amounts(T: Tables, tx_type: int) -> DataFrame:
    return ledger.amounts_by_group(_base(T), tx_type)


def _amounts_sql(tx_type: int) -> str:
    return f"WITH base AS ({BASE}) {_distinct_amounts(tx_type)}"


def _filtered_summary(T: Tables) -> DataFrame:
    return summary.billing_summary(
        T, FROM, TO, ZONE, units=UNITS, tenders=(3, 4), name_like="%BUILD%",
        holders=summary.property_holders(T, 2, positive=True),
    )


# --- agreements ---------------------------------------------------------------

_ROW_KEYS = {
    "agreement": "member_agreement_id",
    "items": "member_agreement_item_id",
    "invoice_requests": "invoice_request_id",
    "invoice_request_items": "invoice_request_item_id",
    "payment_requests": "payment_request_id",
    "payment_request_items": "payment_request_item_id",
}


def _billing_details(T: Tables) -> DataFrame:
    parts = agreements.billing_details(T, T.member_agreement)
    stacked = None
    for part, rows in parts.items():
        keyed = rows.select(
            F.lit(part).alias("part"), "member_agreement_id", F.col(_ROW_KEYS[part]).alias("row_id")
        )
        stacked = keyed if stacked is None else stacked.unionByName(keyed)
    return stacked


BILLING_DETAILS = """WITH live AS (SELECT * FROM {invoice_request} WHERE coalesce(process_type, 0) <> 1)
SELECT 'agreement' AS part, member_agreement_id, member_agreement_id AS row_id FROM {member_agreement}
UNION ALL SELECT 'items', member_agreement_id, member_agreement_item_id FROM {member_agreement_item}
UNION ALL SELECT 'invoice_requests', member_agreement_id, invoice_request_id FROM live
UNION ALL SELECT 'invoice_request_items', l.member_agreement_id, i.invoice_request_item_id
  FROM live l JOIN {invoice_request_item} i ON i.invoice_request_id = l.invoice_request_id
UNION ALL SELECT 'payment_requests', l.member_agreement_id, p.payment_request_id
  FROM live l JOIN {payment_request} p ON p.invoice_request_id = l.invoice_request_id
UNION ALL SELECT 'payment_request_items', l.member_agreement_id, pi.payment_request_item_id
  FROM live l JOIN {payment_request} p ON p.invoice_request_id = l.invoice_request_id
  JOIN {payment_request_item} pi ON pi.payment_request_id = p.payment_request_id"""


def _detail(part: str):
    return lambda T: agreements.billing_details(T, T.member_agreement, [part])[part]


_LIVE = "SELECT * FROM {invoice_request} WHERE coalesce(process_type, 0) <> 1"
_OF_LIVE = f"(SELECT invoice_request_id, member_agreement_id FROM ({_LIVE}) r) l"
DETAILS = {
    "invoice_requests": _LIVE,
    "invoice_request_items": f"SELECT i.*, l.member_agreement_id FROM {{invoice_request_item}} i JOIN {_OF_LIVE} USING (invoice_request_id)",
    "payment_requests": f"SELECT p.*, l.member_agreement_id FROM {{payment_request}} p JOIN {_OF_LIVE} USING (invoice_request_id)",
    "payment_request_items": f"""SELECT i.*, l.member_agreement_id FROM {{payment_request_item}} i
JOIN {{payment_request}} p USING (payment_request_id) JOIN {_OF_LIVE} ON l.invoice_request_id = p.invoice_request_id""",
}


def _filled(T: Tables) -> DataFrame:
    return aging.zero_fill(stored(aging.ar_aging(T, AS_OF), "aging"), T)


def _refreshed(T: Tables) -> DataFrame:
    filled = snapshots.of_known_units(_filled(T), T)
    return snapshots.refresh_snapshot(new_folder(filled.sparkSession, "ar-aging"), filled, AS_OF)


def _published_rows(T: Tables) -> DataFrame:
    """Row count of a fresh version, which its list of units tells without a look at its rows."""
    filled = snapshots.of_known_units(_filled(T), T)
    path = new_folder(filled.sparkSession, "ar-aging")
    snapshots.refresh_snapshot(path, filled, AS_OF)
    return snapshots.listed_count(filled.sparkSession, path)


LATER, SOME_UNITS, ONE_ACCOUNT = "2000-02-01 00:00:00", (1, 3, 5), 40


def _partly_refreshed(T: Tables) -> DataFrame:
    """A full version, then a later one of three units only."""
    spark = T.tx_invoice.sparkSession
    first, second = new_folder(spark, "ar-aging"), new_folder(spark, "ar-aging")
    snapshots.refresh_snapshot(first, snapshots.of_known_units(_filled(T), T), AS_OF)
    later = aging.zero_fill(stored(aging.ar_aging(T, LATER), "aging"), T)
    later = snapshots.of_known_units(later, T)
    return snapshots.refresh_snapshot(second, later, LATER, previous=first, units=SOME_UNITS)


# Two cutoffs a day apart, and one some days later by which part of the ledger has changed.
DAY, NEXT_DAY, SOME_DAYS_ON = "1996-05-01 00:00:00", "1996-05-02 00:00:00", "1996-05-09 12:00:00"
_GONE = "tx_invoice_id % 17 = 3 AND tx_type_id IN (2, 4)"
_POSTPONED = "tx_invoice_id % 29 = 5"


def _state(T: Tables) -> Book:
    spark = T.tx_invoice.sparkSession
    book = Book(spark, new_folder(spark, "aging-state"))
    aging_state.begin(book, T, DAY, "first")
    return book


def _next_day(T: Tables) -> DataFrame:
    book = _state(T)
    aging_state.refresh(book, T, NEXT_DAY, "next")
    return aging_state.snapshot(book)


def _after_changes(T: Tables) -> DataFrame:
    """Lines of some invoices removed and due dates of others moved, between two cutoffs."""
    book = _state(T)
    later = T.replace(
        tx_transaction=T.tx_transaction.where(f"NOT ({_GONE})"),
        tx_invoice=T.tx_invoice.withColumn(
            "payment_due_date", F.expr(f"CASE WHEN {_POSTPONED} THEN target_date + INTERVAL '45' DAY ELSE payment_due_date END")
        ),
    )
    changed = T.tx_invoice.where("tx_invoice_id % 17 = 3 OR tx_invoice_id % 29 = 5")
    aging_state.refresh(book, later, SOME_DAYS_ON, "later", changed)
    return aging_state.snapshot(book)


KNOWN = f"SELECT * FROM ({FILLED}) f WHERE business_unit_id IN (SELECT business_unit_id FROM {{business_unit}})"


# No table says which accounts are external; callers name them.
_EXTERNAL = "client_account_id % 11 = 4"


def _some_parties(T: Tables) -> DataFrame:
    """Every seventh member."""
    return T.party_role.where((F.col("party_role_type_id") == ROLE_MEMBER) & (F.col("party_id") % 7 == 0))


def _of_some(sql: str, column: str) -> str:
    return f"""SELECT r.* FROM ({sql}) r WHERE {column} IN (
  SELECT client_account_id FROM {{client_account_party}} WHERE party_id IN (
    SELECT party_id FROM {{party_role}} WHERE party_role_type_id = 1 AND party_id % 7 = 0))"""


QUERIES: dict[str, Query] = {
    "account_aging_target_date": Query(lambda T: aging.account_aging(T, None, AS_OF), TARGET_AGING),
    "account_aging_due_date": Query(
        lambda T: aging.account_aging(T, None, AS_OF, date_col="payment_due_date", bounds="inclusive_1m"),
        DUE_AGING,
    ),
    "account_total_balance": Query(lambda T: ledger.account_total(T), ACCOUNT_TOTAL),
    "ar_aging_snapshot": Query(lambda T: aging.ar_aging(T, AS_OF), AGING),
    "ar_aging_zero_fill": Query(_filled, FILLED),
    "ar_aging_refresh": Query(
        _refreshed, f"SELECT DATE '2000-01-01' AS aged_date, f.* FROM ({KNOWN}) f"
    ),
    "ar_aging_partial_refresh": Query(
        _partly_refreshed,
        f"""SELECT DATE '2000-01-01' AS aged_date, f.* FROM ({KNOWN}) f WHERE business_unit_id NOT IN {SOME_UNITS}
UNION ALL SELECT DATE '{LATER[:10]}', f.* FROM ({KNOWN.replace(AS_OF, LATER)}) f WHERE business_unit_id IN {SOME_UNITS}""",
    ),
    "account_aging_of_parties": Query(
        lambda T: aging.account_aging(T, _some_parties(T), AS_OF), _of_some(TARGET_AGING, "account_id")
    ),
    "account_total_of_parties": Query(
        lambda T: ledger.account_total(T, _some_parties(T)), _of_some(ACCOUNT_TOTAL, "account_id")
    ),
    "ar_aging_of_account": Query(
        lambda T: aging.ar_aging(T, AS_OF, account=ONE_ACCOUNT),
        f"SELECT * FROM ({AGING}) a WHERE client_account_id = {ONE_ACCOUNT}",
    ),
    "ar_aging_next_day": Query(_next_day, AGING.replace(AS_OF, NEXT_DAY)),
    "ar_aging_after_changes": Query(
        _after_changes,
        AGING.replace(AS_OF, SOME_DAYS_ON)
        .replace("{tx_transaction}", f"(SELECT * FROM {{tx_transaction}} WHERE NOT ({_GONE}))")
        .replace(
            "{tx_invoice}",
            f"""(SELECT * REPLACE (CASE WHEN {_POSTPONED} THEN target_date + INTERVAL '45' DAY
                                        ELSE payment_due_date END AS payment_due_date) FROM {{tx_invoice}})""",
        ),
    ),
    "ar_aging_row_count": Query(
        lambda T: _published_rows(T), f"SELECT count(*) AS row_count FROM ({KNOWN}) f"
    ),
    "transactions_due": Query(
        lambda T: aging.transactions_due(T, AS_OF),
        f"SELECT * REPLACE (CAST(due_amount AS DECIMAL(18,2)) AS due_amount) FROM ({DUE}) d",
    ),
    "refresh_due_amounts": Query(
        lambda T: aging.rebase_due(aging.transactions_due(T, AS_OF), T), REBASED
    ),
    "party_due_buckets": Query(
        lambda T: aging.party_due_buckets(aging.transactions_due(T, AS_OF), T, AS_OF), BUCKETS
    ),
    "party_due_buckets_of_parties": Query(
        lambda T: aging.buckets_of_parties(T, AS_OF, _some_parties(T)),
        f"""SELECT b.* FROM ({BUCKETS}) b WHERE party_id IN (
  SELECT party_id FROM {{party_role}} WHERE party_role_type_id = 1 AND party_id % 7 = 0)""",
    ),
    "party_due_buckets_without_external": Query(
        lambda T: aging.buckets_of_parties(
            T, AS_OF, _some_parties(T), T.client_account_party.where(_EXTERNAL)
        ),
        f"""SELECT b.* FROM ({BUCKETS.replace("AND cap.primary_party", f"AND cap.primary_party AND NOT (cap.{_EXTERNAL})")}) b
WHERE party_id IN (SELECT party_id FROM {{party_role}} WHERE party_role_type_id = 1 AND party_id % 7 = 0)""",
    ),
    "billing_base": Query(_base, BASE),
    "sale_amount_by_group": Query(lambda T: _amounts(T, TX_SALE), _amounts_sql(1)),
    "tax_amount_by_group": Query(lambda T: _amounts(T, TX_FEE), _amounts_sql(3)),
    "first_sale_item": Query(
        ledger.first_sale_item,
        """SELECT t.tx_invoice_id, t.group_id, t.item_id AS sale_item_id, it.upc AS sale_item_code, it.name AS sale_item
FROM (SELECT *, row_number() OVER (PARTITION BY tx_invoice_id, group_id ORDER BY tx_transaction_id) AS nth
      FROM {tx_transaction} WHERE tx_type_id = 1) t
LEFT JOIN {item} it ON it.item_id = t.item_id WHERE nth = 1""",
    ),
    "decline_window_filter": Query(
        lambda T: summary.keep_reportable(_base(T), T, *_from_to()),
        f"WITH base AS ({BASE}) SELECT b.* FROM base b WHERE {REPORTABLE}",
    ),
    "payment_currency_split": Query(
        lambda T: summary.payment_currency_split(_base(T), _from_to()[1]),
        f"WITH base AS ({BASE}) SELECT tx_invoice_id, {SPLIT_COLUMNS} FROM base b GROUP BY tx_invoice_id",
    ),
    "billing_summary": Query(lambda T: summary.billing_summary(T, FROM, TO, ZONE), SUMMARY),
    "billing_base_of_units": Query(lambda T: summary.billing_base_of_units(T, CHANGE, CHANGE_BACK), UNITS_BASE),
    "billing_summary_of_units": Query(
        lambda T: summary.billing_summary(T, CHANGE, CHANGE_BACK, zone=None), UNITS_SUMMARY
    ),
    "billing_summary_in_order": Query(
        lambda T: summary.billing_summary(T, FROM, TO, ZONE, ordered=True), SUMMARY
    ),
    "billing_summary_reference_mode": Query(
        lambda T: summary.billing_summary(T, FROM, TO, ZONE, reference_mode=True), FANNED_SUMMARY
    ),
    "billing_summary_filtered": Query(_filtered_summary, FILTERED_SUMMARY),
    "invoice_balance": Query(
        lambda T: ledger.invoice_balance(T.tx_transaction),
        f"SELECT tx_invoice_id, CAST(net AS DECIMAL(18,2)) AS balance FROM ({NETS}) n",
    ),
    "active_agreement_count": Query(
        lambda T: ledger.active_agreement_count(T.member_agreement, ACTIVE_STATUSES),
        "SELECT count(*) AS active FROM {member_agreement} WHERE status IN (5, 8, 9, 11, 10, 4)",
    ),
    "agreement_billing_details": Query(_billing_details, BILLING_DETAILS),
    **{f"agreement_billing_{part}": Query(_detail(part), sql) for part, sql in DETAILS.items()},
    "agreement_items_perpetual": Query(
        lambda T: agreements.agreement_items(T, T.member_agreement).withColumn("price", money("price")),
        """SELECT mai.member_agreement_item_id, mai.member_agreement_id, mai.item_id,
       p.member_agreement_item_perpetual_id, CAST(p.price AS DECIMAL(18,2)) AS price, p.bill_count
FROM {member_agreement_item} mai
LEFT JOIN {member_agreement_item_perpetual} p ON p.member_agreement_item_id = mai.member_agreement_item_id""",
    ),
    "counted_perpetual_agreements": Query(
        lambda T: agreements.counted_perpetual_agreements(T, ACTIVE),
        """SELECT ma.member_agreement_id, p.bill_count, ma.status, pr.role_id
FROM {member_agreement} ma
JOIN {member_agreement_item} mai ON mai.member_agreement_id = ma.member_agreement_id
JOIN {member_agreement_item_perpetual} p ON p.member_agreement_item_id = mai.member_agreement_item_id
JOIN {party_role} pr ON pr.party_role_id = ma.party_role_id
WHERE ma.status = 5 AND p.bill_count IS NOT NULL""",
    ),
    "billed_requests": Query(
        lambda T: agreements.billed_requests(T, T.member_agreement).select(
            "invoice_request_id", "member_agreement_id", "tx_invoice_id", "bill_date", "status", "process_type"
        ),
        """SELECT invoice_request_id, member_agreement_id, tx_invoice_id, bill_date, status, process_type
FROM {invoice_request} WHERE tx_invoice_id IS NOT NULL AND status = 2
  AND member_agreement_id IN (SELECT member_agreement_id FROM {member_agreement})""",
    ),
    "agreement_activities": Query(
        lambda T: agreements.agreement_activities(T, T.member_agreement),
        """SELECT ma.member_agreement_id, ma.start_date, a.activity_id, a.tx_transaction_id, a.item_id, a.start_time_utc
FROM {activity} a
JOIN {tx_transaction} t ON t.tx_transaction_id = a.tx_transaction_id
JOIN (SELECT DISTINCT member_agreement_id, tx_invoice_id FROM {invoice_request}
      WHERE tx_invoice_id IS NOT NULL AND status = 2) r ON r.tx_invoice_id = t.tx_invoice_id
JOIN {member_agreement} ma ON ma.member_agreement_id = r.member_agreement_id""",
    ),
}
