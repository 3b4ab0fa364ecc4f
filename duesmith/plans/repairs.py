"""Queries that preview or apply repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.operators import changes, link_defects, repairs, schedule_defects
from duesmith.plans import Query
from duesmith.plans import defects as found
from duesmith.sources.book import Book, Layout
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import new_folder, stored


def _preview_sql(table: str, key: str, columns: dict[str, str], rows: str) -> str:
    """Old and new values of the rows that ``rows`` (key, new values) would change."""
    pairs = ", ".join(f"o.{name} AS old_{name}, n.{new} AS new_{name}" for name, new in columns.items())
    return f"SELECT o.{key}, {pairs} FROM {{{table}}} o JOIN ({rows}) n ON n.{key} = o.{key}"


# --- soft deletes -------------------------------------------------------------

SURPLUS_MARKS = _preview_sql(
    "invoice_request", "invoice_request_id", {"process_type": "mark"},
    f"SELECT DISTINCT invoice_request_id, 1 AS mark FROM ({found.SURPLUS}) s",
)
SURPLUS_PAYMENT_MARKS = _preview_sql(
    "payment_request", "payment_request_id", {"process_type": "mark"},
    f"""SELECT payment_request_id, 1 AS mark FROM {{payment_request}} WHERE tx_payment_id IS NULL
        AND invoice_request_id IN (SELECT invoice_request_id FROM ({found.SURPLUS}) s)""",
)
SURPLUS_APPLIED = f"""
SELECT * REPLACE (CASE WHEN invoice_request_id IN (SELECT invoice_request_id FROM ({found.SURPLUS}) s)
                       THEN 1 ELSE process_type END AS process_type)
FROM {{invoice_request}}"""


def _stop_ranked(ranked: str, place: str) -> str:
    return _preview_sql(
        "payment_request", "payment_request_id", {"process_type": "mark"},
        f"SELECT payment_request_id, 1 AS mark FROM ({ranked}) r WHERE {place} AND tx_payment_id IS NULL",
    )


INSTALLMENT_MARKS = _preview_sql(
    "payment_request", "payment_request_id", {"process_type": "mark"},
    f"""SELECT payment_request_id, 1 AS mark FROM {{payment_request}}
        WHERE process_type IS NULL AND tx_payment_id IS NULL AND invoice_request_id IN (
          SELECT invoice_request_id FROM {{invoice_request}} WHERE member_agreement_id IN (
            SELECT member_agreement_id FROM ({found.INSTALLMENTS}) p))""",
)
VOID_REQUEST_MARKS = _preview_sql(
    "invoice_request", "invoice_request_id", {"process_type": "mark"},
    f"SELECT invoice_request_id, 1 AS mark FROM ({found.EXPOSED_REQUESTS}) e",
)
VOID_PAYMENT_MARKS = _preview_sql(
    "payment_request", "payment_request_id", {"process_type": "mark"},
    f"SELECT payment_request_id, 1 AS mark FROM ({found.EXPOSED_PAYMENTS}) e",
)

# --- detach, re-sync, relink --------------------------------------------------

DETACHED_ROWS = f"""
SELECT r.invoice_request_id FROM {{invoice_request}} r
WHERE coalesce(r.process_type, 0) <> 1 AND EXISTS (
  SELECT 1 FROM ({found.UNEXCUSED}) m
  WHERE m.member_agreement_id = r.member_agreement_id AND CAST(m.bill_date AS DATE) = CAST(r.bill_date AS DATE))"""

DETACHED = _preview_sql(
    "invoice_request", "invoice_request_id",
    {"tx_invoice_id": "nothing", "primary_tx_invoice_id": "nothing", "process_type": "mark"},
    f"SELECT invoice_request_id, CAST(NULL AS BIGINT) AS nothing, 1 AS mark FROM ({DETACHED_ROWS}) d",
)

# The schedule program that runs between detaching and relinking lies outside; the queries
# stand in for it with a copy of every detached request and its items under negative ids.
_RESYNCED = f"""
missing AS ({found.UNEXCUSED}), detached AS ({DETACHED_ROWS}),
requests AS (
  SELECT r.invoice_request_id, r.member_agreement_id, r.bill_date,
         CASE WHEN d.invoice_request_id IS NULL THEN r.tx_invoice_id END AS tx_invoice_id,
         CASE WHEN d.invoice_request_id IS NULL THEN r.primary_tx_invoice_id END AS primary_tx_invoice_id,
         CASE WHEN d.invoice_request_id IS NULL THEN r.process_type ELSE 1 END AS process_type
  FROM {{invoice_request}} r LEFT JOIN detached d ON d.invoice_request_id = r.invoice_request_id
  UNION ALL
  SELECT -1 - r.invoice_request_id, r.member_agreement_id, r.bill_date, NULL, NULL, NULL
  FROM {{invoice_request}} r JOIN detached d ON d.invoice_request_id = r.invoice_request_id),
items AS (
  SELECT invoice_request_item_id, invoice_request_id, member_agreement_item_id, tx_transaction_id
  FROM {{invoice_request_item}}
  UNION ALL
  SELECT -1 - i.invoice_request_item_id, -1 - i.invoice_request_id, i.member_agreement_item_id, NULL
  FROM {{invoice_request_item}} i JOIN detached d ON d.invoice_request_id = i.invoice_request_id),
old AS (
  SELECT m.invoice_request_id AS old_id, m.tx_invoice_id AS old_invoice, m.member_agreement_id, m.bill_date,
         row_number() OVER (PARTITION BY m.member_agreement_id, CAST(m.bill_date AS DATE)
                            ORDER BY m.bill_date, m.invoice_request_id) AS place
  FROM missing m JOIN requests r ON r.invoice_request_id = m.invoice_request_id WHERE r.process_type = 1),
fresh AS (
  SELECT r.invoice_request_id AS new_id, r.member_agreement_id, r.bill_date,
         row_number() OVER (PARTITION BY r.member_agreement_id, CAST(r.bill_date AS DATE)
                            ORDER BY r.bill_date, r.invoice_request_id) AS place
  FROM requests r WHERE coalesce(r.process_type, 0) <> 1 AND EXISTS (
    SELECT 1 FROM missing m WHERE m.member_agreement_id = r.member_agreement_id
      AND CAST(m.bill_date AS DATE) = CAST(r.bill_date AS DATE))),
pairs AS (
  SELECT o.old_id, f.new_id, o.old_invoice FROM old o JOIN fresh f
    ON f.member_agreement_id = o.member_agreement_id AND CAST(f.bill_date AS DATE) = CAST(o.bill_date AS DATE)
   AND f.place = o.place),
item_pairs AS (
  SELECT oi.invoice_request_item_id AS old_item, oi.tx_transaction_id AS old_tx, ni.invoice_request_item_id AS new_item
  FROM pairs p JOIN items oi ON oi.invoice_request_id = p.old_id
  JOIN items ni ON ni.invoice_request_id = p.new_id AND ni.member_agreement_item_id = oi.member_agreement_item_id)"""

RELINKED_REQUESTS = f"""WITH {_RESYNCED}
SELECT r.invoice_request_id, r.tx_invoice_id AS old_tx_invoice_id, p.old_invoice AS new_tx_invoice_id,
       r.primary_tx_invoice_id AS old_primary_tx_invoice_id, p.old_invoice AS new_primary_tx_invoice_id
FROM requests r JOIN pairs p ON p.new_id = r.invoice_request_id"""
RELINKED_ITEMS = f"""WITH {_RESYNCED}
SELECT i.invoice_request_item_id, i.tx_transaction_id AS old_tx_transaction_id, p.old_tx AS new_tx_transaction_id
FROM items i JOIN (SELECT new_item, arg_min(old_tx, old_item) AS old_tx FROM item_pairs GROUP BY new_item) p
  ON p.new_item = i.invoice_request_item_id"""
RELINKED_INVOICES = f"""WITH {_RESYNCED}
SELECT i.tx_invoice_id, i.link_id AS old_link_id, p.new_id AS new_link_id
FROM {{tx_invoice}} i JOIN pairs p ON p.old_id = i.link_id AND i.link_type_id = 4"""
RELINKED_TRANSACTIONS = f"""WITH {_RESYNCED}
SELECT t.tx_transaction_id, t.link_id AS old_link_id, p.new_item AS new_link_id
FROM {{tx_transaction}} t
JOIN (SELECT old_item, min(new_item) AS new_item FROM item_pairs GROUP BY old_item) p
  ON p.old_item = t.link_id AND t.link_type_id = 2"""


def _resynced(T: Tables) -> tuple[Tables, DataFrame]:
    # The defect list is a working table: it outlives the detaching that removes the defect.
    missing = stored(found.unexcused(T), "missing-requests")
    detached = repairs.detach_requests(T, missing)
    keys = detached.rows.select("invoice_request_id")
    fresh_id = (-1 - F.col("invoice_request_id")).alias("invoice_request_id")
    copies = T.invoice_request.join(keys, "invoice_request_id", "left_semi")
    blank = ("tx_invoice_id", "primary_tx_invoice_id", "process_type")
    fresh = copies.select(
        *[
            fresh_id if f.name == "invoice_request_id"
            else F.lit(None).cast(f.dataType).alias(f.name) if f.name in blank else F.col(f.name)
            for f in copies.schema
        ]
    )
    item_copies = T.invoice_request_item.join(keys, "invoice_request_id", "left_semi")
    fresh_items = item_copies.withColumns({
        "invoice_request_id": fresh_id,
        "invoice_request_item_id": -1 - F.col("invoice_request_item_id"),
        "tx_transaction_id": F.lit(None).cast("bigint"),
    })
    return (
        T.replace(
            invoice_request=detached.apply(T).unionByName(fresh),
            invoice_request_item=T.invoice_request_item.unionByName(fresh_items),
        ),
        missing,
    )


def _relink(part: str):
    def run(T: Tables) -> DataFrame:
        after, missing = _resynced(T)
        pairs = stored(repairs.request_pairs(after, missing), "request-pairs")
        return getattr(repairs.relink(after, missing, pairs), part).preview(after)

    return run


# --- missing payment transactions ---------------------------------------------

_CHOSEN = f"""
missing AS ({found.MISSING_TX}),
chosen AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY payment_request_item_id ORDER BY sale_transaction_id, payment_process_request_id) AS nth
    FROM missing) r WHERE nth = 1)"""

_LABEL = """'ID: ' || CAST(c.tx_payment_id AS VARCHAR) || ' | '
  || CASE left(c.token, 2) WHEN 'AC' THEN 'AMEX' WHEN 'VC' THEN 'VISA' WHEN 'VD' THEN 'VISA' WHEN 'MC' THEN 'MC'
       WHEN 'MD' THEN 'MC' WHEN 'BC' THEN 'Bank Draft(US)' WHEN 'DC' THEN 'DISC' END || ':'
  || CASE left(c.token, 2) WHEN 'BC' THEN right(c.token, 3) ELSE right(c.token, 4) END
  || ' | Payment request due:' || strftime(c.target_date, '%m/%d/%Y')"""
_PLAIN = """'ID: ' || CAST(c.tx_payment_id AS VARCHAR) || '| Payment request due: '
  || strftime(c.target_date, '%Y-%m-%d')"""


def _inserts_sql(description: str) -> str:
    return f"""WITH {_CHOSEN}
SELECT (SELECT max(tx_transaction_id) FROM {{tx_transaction}}) + 1 + c.payment_request_item_id AS tx_transaction_id,
       c.tx_invoice_id, 4 AS tx_type_id, c.group_id, c.tx_payment_id AS item_id, c.payment_amount AS amount,
       true AS is_accounting_credit, 3 AS link_type_id, c.payment_request_item_id AS link_id,
       {description} AS description,
       CAST((SELECT count(*) + 1 FROM {{tx_transaction}} t WHERE t.tx_invoice_id = c.tx_invoice_id) AS INT)
         AS display_order,
       c.target_date, c.target_date_utc, c.target_business_unit_id,
       (SELECT p.target_date_zone_format FROM {{tx_payment}} p WHERE p.tx_payment_id = c.tx_payment_id)
         AS target_date_zone_format,
       CAST(NULL AS DECIMAL(16,7)) AS quantity, CAST(NULL AS DECIMAL(12,3)) AS unit_price, '' AS comments,
       CAST(0 AS BIGINT) AS work_unit_id, 0 AS price_id
FROM chosen c"""


CREATED_ITEMS = f"""WITH {_CHOSEN}
SELECT i.payment_request_item_id, i.tx_transaction_id AS old_tx_transaction_id,
       (SELECT max(tx_transaction_id) FROM {{tx_transaction}}) + 1 + i.payment_request_item_id AS new_tx_transaction_id
FROM {{payment_request_item}} i JOIN chosen c ON c.payment_request_item_id = i.payment_request_item_id"""
CREATED_STATUSES = f"""WITH {_CHOSEN}
SELECT s.party_role_id, s.account_status AS old_account_status, 1 AS new_account_status
FROM {{party_role_status}} s WHERE s.party_role_id IN (
  SELECT i.party_role_id FROM {{tx_invoice}} i JOIN chosen c ON c.tx_invoice_id = i.tx_invoice_id)"""


def _created(T: Tables, style: str = "card") -> repairs.CreatedTransactions:
    return repairs.create_missing_tx(T, link_defects.missing_payment_tx(T), style)


# --- repointing ---------------------------------------------------------------

REPOINTED = _preview_sql(
    "invoice_request", "invoice_request_id", {"tx_invoice_id": "paying"},
    f"""SELECT invoice_request_id, min(paying_invoice_id) AS paying FROM ({found.MISPOINTED}) m
        GROUP BY invoice_request_id""",
)
REPOINTED_ITEMS = _preview_sql(
    "invoice_request_item", "invoice_request_item_id", {"tx_transaction_id": "sale"},
    f"""SELECT invoice_request_item_id, min(sale_transaction_id) AS sale FROM ({found.MISPOINTED_ITEMS}) m
        GROUP BY invoice_request_item_id""",
)


def _surplus_marks(T: Tables) -> changes.ChangeSet:
    return repairs.mark_do_not_process(T, "invoice_request", found.surplus(T))


# --- the same in a stored book, of which only the units with changed rows are written ---------------

def _book(T: Tables, layouts: dict[str, Layout]) -> Book:
    spark = T.tx_invoice.sparkSession
    book = Book(spark, new_folder(spark, "book"))
    book.create("first", T, layouts)
    return book


def _marked_in_place(T: Tables) -> DataFrame:
    book = _book(T, {"invoice_request": Layout.monthly("bill_date")})
    edit = book.edit("mark-surplus")
    edit.update(_surplus_marks(T))
    edit.publish()
    return book.tables().invoice_request


def _orphans_gone_in_place(T: Tables) -> DataFrame:
    book = _book(T, {"payment_request_item": Layout.bucketed("payment_request_id", 32)})
    edit = book.edit("delete-orphans")
    edit.delete("payment_request_item", schedule_defects.orphan_items(T), "payment_request_item_id")
    edit.publish()
    return book.tables().payment_request_item


def _created_in_place(T: Tables) -> DataFrame:
    """Payment items and whether their transaction is booked, after the missing ones were published."""
    book = _book(T, {
        "tx_transaction": Layout.bucketed("tx_invoice_id", 32),
        "payment_request_item": Layout.bucketed("payment_request_item_id", 32),
        "party_role_status": Layout.bucketed("party_role_id", 32),
    })
    created = _created(T)
    edit = book.edit("create-missing")
    edit.insert("tx_transaction", created.inserts)
    edit.update(created.items)
    edit.update(created.statuses)
    edit.publish()
    after = book.tables()
    booked = after.tx_transaction.select("tx_transaction_id", F.lit(True).alias("booked"))
    return after.payment_request_item.join(booked, "tx_transaction_id", "left").select(
        "payment_request_item_id", "tx_transaction_id", F.coalesce("booked", F.lit(False)).alias("booked")
    )


CREATED_LINKS = f"""WITH created AS ({CREATED_ITEMS})
SELECT i.payment_request_item_id, coalesce(c.new_tx_transaction_id, i.tx_transaction_id) AS tx_transaction_id,
       c.new_tx_transaction_id IS NOT NULL OR t.tx_transaction_id IS NOT NULL AS booked
FROM {{payment_request_item}} i
LEFT JOIN created c ON c.payment_request_item_id = i.payment_request_item_id
LEFT JOIN {{tx_transaction}} t ON t.tx_transaction_id = i.tx_transaction_id"""

QUERIES: dict[str, Query] = {
    "mark_do_not_process_in_place": Query(_marked_in_place, SURPLUS_APPLIED),
    "create_missing_payment_tx_in_place": Query(_created_in_place, CREATED_LINKS),
    "delete_orphan_items_in_place": Query(
        _orphans_gone_in_place,
        f"""SELECT * FROM {{payment_request_item}} WHERE payment_request_item_id NOT IN (
              SELECT payment_request_item_id FROM ({found.ORPHANS}) o)""",
    ),
    "mark_do_not_process": Query(lambda T: _surplus_marks(T).preview(T), SURPLUS_MARKS),
    "mark_do_not_process_applied": Query(lambda T: _surplus_marks(T).apply(T), SURPLUS_APPLIED),
    "mark_surplus_payment_requests": Query(
        lambda T: repairs.mark_do_not_process(
            T, "payment_request", found.surplus(T), key="invoice_request_id", unpaid_only=True
        ).preview(T),
        SURPLUS_PAYMENT_MARKS,
    ),
    "stop_duplicate_payment_requests": Query(
        lambda T: repairs.stop_duplicates(
            T, schedule_defects.rank_duplicates(T.payment_request, found.duplicates(T))
        ).preview(T),
        _stop_ranked(found.RANKED, "position > 1"),
    ),
    "stop_duplicate_payment_requests_reference_mode": Query(
        lambda T: repairs.stop_duplicates(
            T, schedule_defects.rank_duplicates(T.payment_request, found.duplicates(T), True), True
        ).preview(T),
        _stop_ranked(found.RANKED_AS_WRITTEN, "position = 1"),
    ),
    "stop_bad_installments": Query(
        lambda T: repairs.stop_bad_installments(T, schedule_defects.bad_installments(T)).preview(T),
        INSTALLMENT_MARKS,
    ),
    "stop_void_billing_requests": Query(
        lambda T: repairs.mark_do_not_process(T, "invoice_request", found.exposure(T)).preview(T),
        VOID_REQUEST_MARKS,
    ),
    "stop_void_billing_payment_requests": Query(
        lambda T: repairs.mark_do_not_process(
            T, "payment_request", link_defects.exposed_requests(T, found.exposure(T)),
            key="invoice_request_id", unmarked_only=True,
        ).preview(T),
        VOID_PAYMENT_MARKS,
    ),
    "null_out_and_stop": Query(
        lambda T: repairs.detach_requests(T, found.unexcused(T)).preview(T), DETACHED
    ),
    "relink_requests": Query(_relink("requests"), RELINKED_REQUESTS),
    "relink_request_items": Query(_relink("request_items"), RELINKED_ITEMS),
    "relink_invoices": Query(_relink("invoices"), RELINKED_INVOICES),
    "relink_transactions": Query(_relink("transactions"), RELINKED_TRANSACTIONS),
    "create_missing_payment_tx": Query(lambda T: _created(T).inserts, _inserts_sql(_LABEL)),
    "create_missing_payment_tx_plain": Query(lambda T: _created(T, "plain").inserts, _inserts_sql(_PLAIN)),
    "create_missing_payment_tx_items": Query(lambda T: _created(T).items.preview(T), CREATED_ITEMS),
    "create_missing_payment_tx_statuses": Query(lambda T: _created(T).statuses.preview(T), CREATED_STATUSES),
    "repoint_requests": Query(
        lambda T: repairs.repoint_requests(link_defects.mispointed_requests(T, found.multi(T))).preview(T),
        REPOINTED,
    ),
    "repoint_request_items": Query(
        lambda T: repairs.repoint_items(link_defects.mispointed_items(T, found.multi(T))).preview(T),
        REPOINTED_ITEMS,
    ),
    "delete_orphan_items": Query(
        lambda T: changes.delete_by_keys(
            T.payment_request_item, schedule_defects.orphan_items(T), "payment_request_item_id"
        ),
        f"""SELECT * FROM {{payment_request_item}} WHERE payment_request_item_id NOT IN (
              SELECT payment_request_item_id FROM ({found.ORPHANS}) o)""",
    ),
}
