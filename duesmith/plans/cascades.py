"""Queries over cascade deletes and guarded invoice removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money
from duesmith.functions.relations import key_list
from duesmith.operators import link_defects, removal, schedule_defects
from duesmith.operators.cascade import STEPS, Cascade, agreements_of_members, key_of
from duesmith.plans import Query
from duesmith.plans import defects as found
from duesmith.sources.book import Book, Layout
from duesmith.sources.layout import BUCKET_KEYS
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import new_folder, stored

# Tables that are summed up from others, and from which more are derived: stored first.
SUMMED = ("tx_transaction", "payment_process_batch", "member_agreement_group")
CANCELLED_BEFORE = "2000-01-01 00:00:00"

# --- cascade ------------------------------------------------------------------

AGREEMENTS = f"""
SELECT member_agreement_id FROM {{member_agreement}} WHERE member_agreement_id IN (
  SELECT entity_id FROM {{cancellation}} WHERE entity_id_type = 1 AND cancel_date < '{CANCELLED_BEFORE}')"""

ROOTS = f"""
agr AS ({AGREEMENTS}),
mat AS (SELECT tx.tx_transaction_id, tx.tx_invoice_id FROM {{invoice_request_item}} iri
        JOIN {{invoice_request}} ir ON ir.invoice_request_id = iri.invoice_request_id
        JOIN {{tx_transaction}} tx ON tx.tx_transaction_id = iri.tx_transaction_id
        WHERE ir.member_agreement_id IN (SELECT member_agreement_id FROM agr)),
pay AS (SELECT DISTINCT tx.item_id AS tx_payment_id FROM {{tx_transaction}} tx
        WHERE tx.tx_type_id IN (4, 5) AND tx.tx_invoice_id IN (SELECT tx_invoice_id FROM mat)),
left_tx AS (SELECT * FROM {{tx_transaction}} WHERE tx_invoice_id NOT IN (SELECT tx_invoice_id FROM mat)),
left_requests AS (SELECT * FROM {{payment_process_request}}
                  WHERE tx_payment_id NOT IN (SELECT tx_payment_id FROM pay)),
batch AS (SELECT DISTINCT b.payment_process_batch_id FROM {{payment_process_batch}} b
          JOIN {{payment_process_request}} r ON r.payment_process_batch_id = b.payment_process_batch_id
          JOIN pay ON pay.tx_payment_id = r.tx_payment_id
          WHERE NOT EXISTS (SELECT 1 FROM left_requests l
                            WHERE l.payment_process_batch_id = b.payment_process_batch_id)),
grp AS (SELECT member_agreement_group_id FROM {{member_agreement_group_role}}
        WHERE role_type = 1 AND member_agreement_id IN (SELECT member_agreement_id FROM agr))"""

_REQUESTS = "SELECT invoice_request_id FROM {invoice_request} WHERE member_agreement_id IN (SELECT member_agreement_id FROM agr)"
_ITEMS = "SELECT member_agreement_item_id FROM {member_agreement_item} WHERE member_agreement_id IN (SELECT member_agreement_id FROM agr)"
_ACTIVITIES = "SELECT activity_id FROM {activity} WHERE tx_transaction_id IN (SELECT tx_transaction_id FROM mat)"
_GATEWAY = "SELECT payment_process_request_id FROM {payment_process_request} WHERE tx_payment_id IN (SELECT tx_payment_id FROM pay)"
_RESTRICTIONS = (
    "SELECT member_agreement_group_restriction_id FROM {member_agreement_group_restriction} "
    "WHERE member_agreement_group_id IN (SELECT member_agreement_group_id FROM grp)"
)
_AGREEMENT = "member_agreement_id IN (SELECT member_agreement_id FROM agr)"
_INVOICE = "tx_invoice_id IN (SELECT tx_invoice_id FROM mat)"
_GROUP = "member_agreement_group_id IN (SELECT member_agreement_group_id FROM grp)"
_CANCELLED = (
    "(entity_id_type = 1 AND entity_id IN (SELECT member_agreement_id FROM agr)) "
    "OR (entity_id_type = 2 AND entity_id IN (SELECT tx_invoice_id FROM mat))"
)

# The delete condition of each table, in the order of the steps.
CONDITIONS = {
    "activity_time_log": f"""activity_transaction_id IN (
        SELECT activity_transaction_id FROM {{activity_transaction}} WHERE activity_id IN ({_ACTIVITIES}))""",
    "activity_transaction": f"activity_id IN ({_ACTIVITIES})",
    "activity": "tx_transaction_id IN (SELECT tx_transaction_id FROM mat)",
    "tx_transaction": _INVOICE,
    "payment_process_validation": f"payment_process_request_id IN ({_GATEWAY})",
    "payment_process_response": f"payment_process_request_id IN ({_GATEWAY})",
    "payment_process_request": "tx_payment_id IN (SELECT tx_payment_id FROM pay)",
    "payment_process_error": "payment_process_batch_id IN (SELECT payment_process_batch_id FROM batch)",
    "payment_process_batch": "payment_process_batch_id IN (SELECT payment_process_batch_id FROM batch)",
    "tx_payment": """tx_payment_id IN (SELECT tx_payment_id FROM pay) AND tx_payment_id NOT IN (
        SELECT item_id FROM left_tx WHERE tx_type_id IN (4, 5))""",
    "tx_invoice": _INVOICE,
    "fc_tx_transaction": """fc_tx_invoice_id IN (SELECT fc_tx_invoice_id FROM {fc_tx_invoice}
        WHERE original_tx_invoice_id IN (SELECT tx_invoice_id FROM mat))""",
    "fc_tx_payment": "original_tx_payment_id IN (SELECT tx_payment_id FROM pay)",
    "fc_tx_invoice": "original_tx_invoice_id IN (SELECT tx_invoice_id FROM mat)",
    "suspension_end_date": """suspension_id IN (SELECT suspension_id FROM {suspension}
        WHERE target_entity_id_type = 8 AND target_entity_id IN (SELECT member_agreement_id FROM agr))""",
    "suspension": "target_entity_id_type = 8 AND target_entity_id IN (SELECT member_agreement_id FROM agr)",
    "cancellation_detail": f"cancellation_id IN (SELECT cancellation_id FROM {{cancellation}} WHERE {_CANCELLED})",
    "cancellation": _CANCELLED,
    "member_agreement_sales_adviser": _AGREEMENT,
    "payment_request_item": f"""payment_request_id IN (
        SELECT payment_request_id FROM {{payment_request}} WHERE invoice_request_id IN ({_REQUESTS}))""",
    "payment_request": f"invoice_request_id IN ({_REQUESTS})",
    "invoice_request_item": f"invoice_request_id IN ({_REQUESTS})",
    "invoice_request": _AGREEMENT,
    "member_agreement_item_perpetual_pay_source": f"""member_agreement_item_perpetual_id IN (
        SELECT member_agreement_item_perpetual_id FROM {{member_agreement_item_perpetual}}
        WHERE member_agreement_item_id IN ({_ITEMS}))""",
    "member_agreement_item_pay_source": f"member_agreement_item_id IN ({_ITEMS})",
    "member_agreement_item_perpetual": f"member_agreement_item_id IN ({_ITEMS})",
    "member_agreement_group_restriction_agreements": f"member_agreement_group_restriction_id IN ({_RESTRICTIONS})",
    "member_agreement_group_restriction_promotions": f"member_agreement_group_restriction_id IN ({_RESTRICTIONS})",
    "member_agreement_group_restriction": _GROUP,
    "member_agreement_group_role": _GROUP,
    "member_agreement_group_rule": _GROUP,
    "member_agreement_group": _GROUP,
    "member_agreement_item": _AGREEMENT,
    "member_agreement_payment_plan_item": f"""member_agreement_payment_plan_id IN (
        SELECT member_agreement_payment_plan_id FROM {{member_agreement_payment_plan}} WHERE {_AGREEMENT})""",
    "member_agreement_payment_plan": _AGREEMENT,
    "promotion_effect_application": f"""promotion_effect_id IN (SELECT promotion_effect_id FROM {{promotion_effect}}
        WHERE member_agreement_promotion_id IN (
          SELECT member_agreement_promotion_id FROM {{member_agreement_promotion}} WHERE {_AGREEMENT}))""",
    "promotion_effect": f"""member_agreement_promotion_id IN (
        SELECT member_agreement_promotion_id FROM {{member_agreement_promotion}} WHERE {_AGREEMENT})""",
    "member_agreement_promotion": _AGREEMENT,
    "member_agreement": _AGREEMENT,
}

PLAN = f"WITH {ROOTS}" + " UNION ALL ".join(
    f"\nSELECT {n} AS step, '{table}' AS table_name, {key_of(table)} AS row_key FROM {{{table}}} WHERE {condition}"
    for n, (table, condition) in enumerate(CONDITIONS.items(), start=1)
)

# Survivors are too many columns to stack, so each table answers with its size and key sum.
SURVIVORS = f"WITH {ROOTS}" + " UNION ALL ".join(
    f"""
SELECT '{table}' AS table_name, count(*) AS surviving_rows, CAST(sum({key_of(table)}) AS BIGINT) AS key_sum
FROM {{{table}}} WHERE NOT ({condition})"""
    for table, condition in CONDITIONS.items()
)

_LEFT_PAYMENTS = """SELECT item_id AS tx_payment_id,
         abs(sum(CASE WHEN is_accounting_credit THEN -amount ELSE amount END)) AS amount,
         CASE WHEN sum(CASE WHEN is_accounting_credit THEN -amount ELSE amount END) < 0 THEN false ELSE true END
           AS is_reversal
  FROM left_tx WHERE tx_type_id IN (4, 5) GROUP BY item_id"""
REPRICED = f"""WITH {ROOTS}, priced AS ({_LEFT_PAYMENTS})
SELECT p.tx_payment_id, p.amount AS old_amount, CAST(n.amount AS DECIMAL(18,2)) AS new_amount,
       p.is_reversal AS old_is_reversal, n.is_reversal AS new_is_reversal
FROM {{tx_payment}} p JOIN pay ON pay.tx_payment_id = p.tx_payment_id
JOIN priced n ON n.tx_payment_id = p.tx_payment_id"""

# --- guarded removal ----------------------------------------------------------

_TARGETS = f"""
targets AS (SELECT DISTINCT tx_invoice_id FROM ({found.LINKED}) l),
txs AS (SELECT * FROM {{tx_transaction}} WHERE tx_invoice_id IN (SELECT tx_invoice_id FROM targets)),
pays AS (SELECT p.tx_payment_id, t.tx_invoice_id FROM {{tx_payment}} p
         JOIN txs t ON t.item_id = p.tx_payment_id AND t.tx_type_id = 4)"""

BLOCKED = f"""WITH {_TARGETS}
SELECT DISTINCT t.tx_invoice_id, 'payment_request_item' AS referrer
FROM {{payment_request_item}} r JOIN txs t ON t.tx_transaction_id = r.tx_transaction_id
UNION SELECT p.tx_invoice_id, 'payment_request'
FROM {{payment_request}} r JOIN pays p ON p.tx_payment_id = r.tx_payment_id
UNION SELECT t.tx_invoice_id, 'invoice_request_item'
FROM {{invoice_request_item}} r JOIN txs t ON t.tx_transaction_id = r.tx_transaction_id
UNION SELECT r.tx_invoice_id, 'invoice_request'
FROM {{invoice_request}} r JOIN targets g ON g.tx_invoice_id = r.tx_invoice_id"""

_IN_TXS = "tx_transaction_id IN (SELECT tx_transaction_id FROM txs)"
_IN_SALES = "tx_transaction_id IN (SELECT tx_transaction_id FROM txs WHERE tx_type_id = 1)"
_IN_PAYS = "tx_payment_id IN (SELECT tx_payment_id FROM pays)"
_IN_TARGETS = "tx_invoice_id IN (SELECT tx_invoice_id FROM targets)"
_DELETES = {
    5: ("activity_transaction", f"activity_id IN (SELECT activity_id FROM {{activity}} WHERE {_IN_SALES})"),
    6: ("activity", _IN_SALES),
    7: ("payment_process_request", _IN_PAYS),
    8: ("tx_payment", _IN_PAYS),
    9: ("member_rental", _IN_TXS),
    10: ("tx_transaction", _IN_TARGETS),
    11: ("tx_invoice", _IN_TARGETS),
}
_CLEARS = {
    1: ("payment_request_item", _IN_TXS),
    2: ("payment_request", _IN_PAYS),
    3: ("invoice_request_item", _IN_TXS),
    4: ("invoice_request", _IN_TARGETS),
}


def _removal_sql(targets: str, clears: bool) -> str:
    steps = [(n, *what, "clear") for n, what in _CLEARS.items()] if clears else []
    steps += [(n, *what, "delete") for n, what in _DELETES.items()]
    return f"WITH {targets}" + " UNION ALL ".join(
        f"""
SELECT {n} AS step, '{table}' AS table_name, {key_of(table)} AS row_key, '{action}' AS action
FROM {{{table}}} WHERE {condition}"""
        for n, table, condition, action in steps
    )


DRY_RUN = _removal_sql(_TARGETS, clears=True)
_OPEN_TARGETS = _TARGETS.replace("targets AS (", "suspects AS (", 1).replace(
    "txs AS (",
    "all_txs AS (SELECT * FROM {tx_transaction} WHERE tx_invoice_id IN (SELECT tx_invoice_id FROM suspects)),\n"
    "targets AS (SELECT tx_invoice_id FROM suspects WHERE tx_invoice_id NOT IN ("
    " SELECT t.tx_invoice_id FROM {payment_request_item} r JOIN all_txs t ON t.tx_transaction_id = r.tx_transaction_id"
    " UNION SELECT t.tx_invoice_id FROM {invoice_request_item} r JOIN all_txs t ON t.tx_transaction_id = r.tx_transaction_id"
    " UNION SELECT t.tx_invoice_id FROM {payment_request} r JOIN {tx_payment} p ON p.tx_payment_id = r.tx_payment_id"
    " JOIN all_txs t ON t.item_id = p.tx_payment_id AND t.tx_type_id = 4"
    " UNION SELECT tx_invoice_id FROM {invoice_request} WHERE tx_invoice_id IN (SELECT tx_invoice_id FROM suspects))),\n"
    "txs AS (",
    1,
)
PROTECTED = _removal_sql(_OPEN_TARGETS, clears=False)


def _cascade(T: Tables) -> Cascade:
    cancelled = schedule_defects.cancelled_agreements(T, CANCELLED_BEFORE)
    agreements = T.member_agreement.join(cancelled, "member_agreement_id", "left_semi")
    return Cascade(T, agreements)


def _sizes(before: Tables, after: Tables, tables) -> DataFrame:
    parts = [
        after[table].agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("surviving_rows"),
            F.sum(key_of(table)).cast("bigint").alias("key_sum"),
        )
        for table in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def _survivors(T: Tables) -> DataFrame:
    return _sizes(T, _cascade(T).apply(), [step.table for step in STEPS])


def _survivors_in_place(T: Tables) -> DataFrame:
    """The same in a book, published as one version."""
    spark = T.tx_invoice.sparkSession
    book = Book(spark, new_folder(spark, "book"))
    layouts = {step.table: Layout.bucketed(BUCKET_KEYS.get(step.table, step.key), 16) for step in STEPS}
    book.create("sources", T, {name: layouts.pop(name) for name in SUMMED})
    book.create("first", T.rebase(**{name: book.tables()[name] for name in SUMMED}), layouts)
    _cascade(T.replace(**{step.table: book.tables()[step.table] for step in STEPS})).apply_in(book, "cascade")
    return _sizes(T, book.tables(), [step.table for step in STEPS])


def _old_form(T: Tables) -> DataFrame:
    """The cascade as it was before promotions were stored."""
    cancelled = schedule_defects.cancelled_agreements(T, CANCELLED_BEFORE)
    return Cascade(T, T.member_agreement.join(cancelled, "member_agreement_id", "left_semi"), promotions=False).plan()


OLD_PLAN = f"WITH {ROOTS}" + " UNION ALL ".join(
    f"\nSELECT {n} AS step, '{table}' AS table_name, {key_of(table)} AS row_key FROM {{{table}}} WHERE {condition}"
    for n, (table, condition) in enumerate(CONDITIONS.items(), start=1)
    if not table.startswith(("promotion_", "member_agreement_promotion"))
)

# Ids as a user types them into a script.
LISTED = (4, 8, 12, 16, 100, 104, 1_000_000)


def _listed(T: Tables) -> DataFrame:
    return Cascade(T, key_list(T.member_agreement.sparkSession, "member_agreement_id", LISTED)).plan()


LISTED_PLAN = PLAN.replace(
    AGREEMENTS, f"\nSELECT member_agreement_id FROM {{member_agreement}} WHERE member_agreement_id IN {LISTED}"
)

SURVIVING_PAYMENTS = f"""WITH {ROOTS}, priced AS ({_LEFT_PAYMENTS})
SELECT p.* REPLACE (
  CAST(CASE WHEN n.tx_payment_id IS NULL THEN p.amount ELSE n.amount END AS DECIMAL(18,2)) AS amount,
  CASE WHEN n.tx_payment_id IS NULL THEN p.is_reversal ELSE n.is_reversal END AS is_reversal)
FROM (SELECT * FROM {{tx_payment}} WHERE NOT ({CONDITIONS["tx_payment"]})) p
LEFT JOIN (SELECT * FROM priced WHERE tx_payment_id IN (SELECT tx_payment_id FROM pay)) n
  ON n.tx_payment_id = p.tx_payment_id"""


def _repriced(T: Tables) -> DataFrame:
    return _cascade(T).repriced_payments().preview(T).withColumn("new_amount", money("new_amount"))


def _suspects(T: Tables) -> DataFrame:
    return link_defects.linked_invoices(T, found.multi(T))


def _dry_run(T: Tables) -> DataFrame:
    return removal.removal_plan(T, _suspects(T), protect=False)


def _images(T: Tables) -> DataFrame:
    plan = stored(_dry_run(T), "removal-plan", by=["table_name"])
    images = removal.before_images(T, plan, new_folder(plan.sparkSession, "before-images"))
    parts = [
        rows.select(F.lit(table).alias("table_name"), F.col(key_of(table)).alias("row_key"))
        for table, rows in images.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _image_of(table: str):
    def image(T: Tables) -> DataFrame:
        plan = stored(_dry_run(T), "removal-plan", by=["table_name"])
        return removal.before_images(T, plan, new_folder(plan.sparkSession, "before-images"), [table])[table]

    return image


def _cleared(table: str):
    """Rows of a cleared table that the plan names, after it was applied."""

    def rows(T: Tables) -> DataFrame:
        plan = stored(_dry_run(T), "removal-plan", by=["table_name"])
        keys = plan.where(F.col("table_name") == table).select(F.col("row_key").alias(key_of(table)))
        return removal.apply_removal(T, plan)[table].join(keys, key_of(table), "left_semi").select(*T[table].columns)

    return rows


def _removed(T: Tables) -> DataFrame:
    plan = stored(_dry_run(T), "removal-plan", by=["table_name"])
    after = removal.apply_removal(T, plan)
    parts = [
        after[table].agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("surviving_rows"),
            F.count(column or key_of(table)).alias("references"),
        )
        for table, _, column in removal.ACTIONS
    ]
    return reduce(DataFrame.unionByName, parts)


_CLEARED_COLUMNS = {table: column for table, _, column in removal.ACTIONS if column}
REMOVED = f"WITH {_TARGETS}" + " UNION ALL ".join(
    [
        f"""
SELECT '{table}' AS table_name, count(*) AS surviving_rows,
       count(CASE WHEN {condition} THEN NULL ELSE {_CLEARED_COLUMNS[table]} END) AS "references" FROM {{{table}}}"""
        for table, condition in _CLEARS.values()
    ]
    + [
        f"""
SELECT '{table}' AS table_name, count(*) AS surviving_rows, count(*) AS "references"
FROM {{{table}}} WHERE NOT ({condition})"""
        for table, condition in _DELETES.values()
    ]
)


QUERIES: dict[str, Query] = {
    "agreements_of_members": Query(
        lambda T: agreements_of_members(T, T.member_list.where(F.col("first_name") == "HOUSEHOLD")),
        """SELECT member_agreement_id FROM {member_agreement} WHERE party_role_id IN (
  SELECT party_role_id FROM {party_role} WHERE party_role_type_id = 1
    AND role_id IN (SELECT role_id FROM {member_list} WHERE first_name = 'HOUSEHOLD'))""",
    ),
    "agreement_cascade_plan": Query(lambda T: _cascade(T).plan(), PLAN),
    "cascade_apply": Query(_survivors, SURVIVORS),
    "cascade_apply_in_place": Query(_survivors_in_place, SURVIVORS),
    "payment_reprice_after_delete": Query(_repriced, REPRICED),
    "empty_batches": Query(
        lambda T: _cascade(T).empty_batches, f"WITH {ROOTS} SELECT payment_process_batch_id FROM batch"
    ),
    "removal_guard": Query(lambda T: removal.blocked_invoices(T, _suspects(T)), BLOCKED),
    "invoice_removal_plan": Query(lambda T: removal.removal_plan(T, _suspects(T)), PROTECTED),
    "removal_dry_run": Query(_dry_run, DRY_RUN),
    "removal_apply": Query(_removed, REMOVED),
    "cascade_surviving_payments": Query(lambda T: _cascade(T).apply()["tx_payment"], SURVIVING_PAYMENTS),
    "agreement_cascade_plan_old_form": Query(_old_form, OLD_PLAN),
    "agreement_cascade_plan_listed": Query(_listed, LISTED_PLAN),
    **{
        f"before_image_{table}": Query(_image_of(table), f"WITH {_TARGETS} SELECT * FROM {{{table}}} WHERE {condition}")
        for table, condition in (_DELETES[8], _DELETES[10], _CLEARS[2])
    },
    **{
        f"removal_cleared_{table}": Query(
            _cleared(table),
            f"WITH {_TARGETS} SELECT * REPLACE (NULL AS {_CLEARED_COLUMNS[table]}) FROM {{{table}}} WHERE {condition}",
        )
        for table, condition in _CLEARS.values()
    },
    "removal_run_label": Query(
        lambda T: T.tx_invoice.join(_suspects(T).distinct(), "tx_invoice_id", "left_semi").select(
            "tx_invoice_id", removal.run_label_of(F.col("target_date")).alias("run_label")
        ),
        f"""WITH {_TARGETS}
SELECT tx_invoice_id, strftime(target_date, 'invoice_removal_%Y_%m_%d_%H_%M_%S') AS run_label
FROM {{tx_invoice}} WHERE {_IN_TARGETS}""",
    ),
    "before_images": Query(_images, f"SELECT table_name, row_key FROM ({DRY_RUN}) p"),
}
