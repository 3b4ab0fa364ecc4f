"""Declared table schemas and the codes that carry meaning."""

from __future__ import annotations

# The status, type and link codes of the billing data model.
ACTIVE_STATUSES = (4, 5, 8, 9, 10, 11)
STATUS_NAMES = {
    0: "Invalid", 1: "NotFinalized", 2: "Processing", 3: "RequiresPayment", 4: "PendingStart",
    5: "Active", 6: "Expired", 7: "Cancelled", 8: "Delinquent", 9: "Depleted", 10: "Hold",
    11: "Freeze", 12: "Terminated",
}
ACTIVE = 5

TX_SALE = 1
TX_TAX = 2
TX_FEE = 3
TX_PAYMENT = 4
TX_TENDER = 5

LINK_INVOICE_REQUEST_ITEM = 2
LINK_PAYMENT_REQUEST_ITEM = 3
LINK_INVOICE_REQUEST = 4
LINK_SPONSOR = 8

ROLE_MEMBER = 1
ROLE_ORGANIZATION = 7

DO_NOT_PROCESS = 1
BILLED = 2

ENTITY_AGREEMENT = 1
ENTITY_INVOICE = 2
SUSPENSION_OF_AGREEMENT = 8

CASH_INTERFACES = (1, 2)
CARD_INTERFACES = (3, 11)

# Column lists by table, as Spark DDL.
TABLES: dict[str, str] = {
    "business_unit": (
        "business_unit_id int, name string, time_zone_name string, division_id int, division_name string"
    ),
    "party_role": (
        "party_role_id bigint, party_id bigint, role_id string, party_role_type_id int, business_unit_id "
        "int, created_date timestamp_ntz"
    ),
    "party_role_status": "party_role_id bigint, account_status int",
    "member_list": "party_role_id bigint, party_id bigint, role_id string, first_name string, last_name string",
    "organization_list": "party_role_id bigint, party_id bigint, role_id string, organization_name string",
    "party_property": "party_role_id bigint, type_id int, value string",
    "client_account": "client_account_id bigint",
    "client_account_party": "client_account_id bigint, party_id bigint, primary_party boolean",
    "item": "item_id bigint, upc string, name string",
    "tender_type": "tender_type_id int, name string, tender_interface_id int",
    "credit_card_type": "credit_card_type_id int, description string",
    "decline_reason": "decline_reason_id int, do_not_reprocess boolean",
    "general_ledger_code": "general_ledger_code_id int, code string, description string",
    "member_agreement": (
        "member_agreement_id bigint, party_role_id bigint, business_unit_id int, status int, start_date "
        "timestamp_ntz"
    ),
    "member_agreement_item": "member_agreement_item_id bigint, member_agreement_id bigint, item_id bigint",
    "member_agreement_item_perpetual": (
        "member_agreement_item_perpetual_id bigint, member_agreement_item_id bigint, price "
        "decimal(12,2), bill_count int"
    ),
    "member_agreement_item_pay_source": (
        "member_agreement_item_pay_source_id bigint, member_agreement_item_id bigint, from_foreign "
        "boolean, payment_value decimal(12,2), payment_installments int"
    ),
    "member_agreement_item_perpetual_pay_source": (
        "member_agreement_item_perpetual_pay_source_id bigint, member_agreement_item_perpetual_id bigint"
    ),
    "invoice_request": (
        "invoice_request_id bigint, member_agreement_id bigint, tx_invoice_id bigint, "
        "primary_tx_invoice_id bigint, bill_date timestamp_ntz, bill_date_utc timestamp_ntz, status int, "
        "process_type int"
    ),
    "invoice_request_item": (
        "invoice_request_item_id bigint, invoice_request_id bigint, member_agreement_item_id bigint, "
        "quantity decimal(16,7), tx_transaction_id bigint"
    ),
    "payment_request": (
        "payment_request_id bigint, invoice_request_id bigint, due_date timestamp_ntz, due_date_utc "
        "timestamp_ntz, tx_payment_id bigint, status int, process_type int"
    ),
    "payment_request_item": (
        "payment_request_item_id bigint, payment_request_id bigint, invoice_request_item_id bigint, "
        "fixed_amount decimal(15,3), tx_transaction_id bigint"
    ),
    "tx_invoice": (
        "tx_invoice_id bigint, client_account_id bigint, party_role_id bigint, target_business_unit_id "
        "int, target_date timestamp_ntz, target_date_utc timestamp_ntz, payment_due_date timestamp_ntz, "
        "payment_due_date_utc timestamp_ntz, tx_invoice_status_id int, billing_status int, link_type_id "
        "int, link_id bigint"
    ),
    "tx_transaction": (
        "tx_transaction_id bigint, tx_invoice_id bigint, tx_type_id int, group_id int, item_id bigint, "
        "amount decimal(18,2), is_accounting_credit boolean, link_type_id int, link_id bigint, "
        "description string, display_order int, target_date timestamp_ntz, target_date_utc "
        "timestamp_ntz, target_business_unit_id int, target_date_zone_format string, quantity "
        "decimal(16,7), unit_price decimal(12,3), comments string, work_unit_id bigint, price_id int"
    ),
    "tx_payment": (
        "tx_payment_id bigint, client_account_id bigint, party_role_id bigint, target_business_unit_id "
        "int, target_date timestamp_ntz, target_date_utc timestamp_ntz, target_date_zone_format string, "
        "amount decimal(18,2), tender_type_id int, is_multi_invoice boolean, is_declined boolean, "
        "is_reversal boolean, decline_reason_id int, credit_card_type_id int, link_type_id int, link_id "
        "bigint"
    ),
    "payment_process_batch": "payment_process_batch_id bigint, business_unit_id int",
    "payment_process_request": (
        "payment_process_request_id bigint, payment_process_batch_id bigint, tx_payment_id bigint, token "
        "string, total_amount decimal(18,2)"
    ),
    "payment_process_response": (
        "payment_process_response_id bigint, payment_process_request_id bigint, "
        "rebill_payment_process_request_id bigint, decline_tx_payment_id bigint, reference_id string, "
        "response_code string, response_message string"
    ),
    "payment_process_validation": "payment_process_validation_id bigint, payment_process_request_id bigint",
    "payment_process_error": "payment_process_error_id bigint, payment_process_batch_id bigint",
    "billing_service_tx": (
        "member_agreement_id bigint, party_role_id bigint, client_account_id bigint, tx_transaction_id "
        "bigint, tx_invoice_id bigint, group_id int, tx_type_id int, business_unit_id int, target_date "
        "timestamp_ntz, target_date_utc timestamp_ntz, link_type_id int, link_id bigint, description "
        "string, amount decimal(18,2), sale_item_id bigint, tx_payment_id bigint, is_payment_declined "
        "boolean, tender_type_id int, tender_type_name string, tender_interface_id int, "
        "credit_card_type_id int, gl_id int, due_date timestamp_ntz, due_date_utc timestamp_ntz, "
        "payment_process_batch_id bigint, gateway_batch_id bigint, decline_tx_payment_id bigint"
    ),
    "activity": "activity_id bigint, tx_transaction_id bigint, item_id bigint, start_time_utc timestamp_ntz",
    "activity_transaction": "activity_transaction_id bigint, activity_id bigint",
    "activity_time_log": "activity_time_log_id bigint, activity_transaction_id bigint",
    "member_rental": "member_rental_id bigint, tx_transaction_id bigint",
    "cancellation": "cancellation_id bigint, entity_id bigint, entity_id_type int, cancel_date timestamp_ntz",
    "cancellation_detail": "cancellation_detail_id bigint, cancellation_id bigint",
    "suspension": "suspension_id bigint, target_entity_id bigint, target_entity_id_type int",
    "suspension_end_date": "suspension_end_date_id bigint, suspension_id bigint",
    "member_agreement_sales_adviser": "member_agreement_sales_adviser_id bigint, member_agreement_id bigint",
    "member_agreement_group_role": (
        "member_agreement_group_role_id bigint, member_agreement_id bigint, member_agreement_group_id "
        "bigint, role_type int"
    ),
    "member_agreement_group": "member_agreement_group_id bigint",
    "member_agreement_group_rule": "member_agreement_group_rule_id bigint, member_agreement_group_id bigint",
    "member_agreement_group_restriction": (
        "member_agreement_group_restriction_id bigint, member_agreement_group_id bigint"
    ),
    "member_agreement_group_restriction_agreements": (
        "member_agreement_group_restriction_agreements_id bigint, member_agreement_group_restriction_id "
        "bigint"
    ),
    "member_agreement_group_restriction_promotions": (
        "member_agreement_group_restriction_promotions_id bigint, member_agreement_group_restriction_id "
        "bigint"
    ),
    "member_agreement_payment_plan": "member_agreement_payment_plan_id bigint, member_agreement_id bigint",
    "member_agreement_payment_plan_item": (
        "member_agreement_payment_plan_item_id bigint, member_agreement_payment_plan_id bigint"
    ),
    "member_agreement_promotion": "member_agreement_promotion_id bigint, member_agreement_id bigint",
    "promotion_effect": "promotion_effect_id bigint, member_agreement_promotion_id bigint",
    "promotion_effect_application": "promotion_effect_application_id bigint, promotion_effect_id bigint",
    "fc_tx_invoice": "fc_tx_invoice_id bigint, original_tx_invoice_id bigint",
    "fc_tx_transaction": "fc_tx_transaction_id bigint, fc_tx_invoice_id bigint",
    "fc_tx_payment": "fc_tx_payment_id bigint, original_tx_payment_id bigint",
    "error_log": "error_id bigint, time_utc timestamp_ntz, type string, source string, message string",
}
