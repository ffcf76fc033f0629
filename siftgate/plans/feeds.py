"""Declared feeds: sales and customer CSV, inventory workbooks, ledger JSON."""

from __future__ import annotations

from siftgate.functions.text import clean_email, clean_phone
from siftgate.spec import Audit, FieldSpec, Registry, SourceSpec


def every_row(condition: str) -> str:
    """Aggregate that holds if every row fulfils the condition, and there are rows."""
    return f"count(*) > 0 AND count_if({condition}) = count(*)"


# Columns, lengths, file patterns and audits of the known feeds.
SALES = SourceSpec(
    table="transactions",
    patterns=("sales_*.csv",),
    fields=(
        FieldSpec("transaction_id", max_length=100),
        FieldSpec("customer_id", max_length=100),
        FieldSpec("product_sku", max_length=100),
        FieldSpec("quantity", "int"),
        FieldSpec("unit_price", "float"),
        FieldSpec("total_amount", "float"),
        FieldSpec("sale_date", "date"),
        FieldSpec("sales_rep", max_length=100),
    ),
    grain=("transaction_id",),
    audits=(
        Audit("total_amount_positive", every_row("total_amount > 0")),
        Audit("unit_price_positive", every_row("unit_price > 0")),
    ),
)

CUSTOMERS = SourceSpec(
    table="customers",
    patterns=("customers-*.csv",),
    fields=(
        FieldSpec("customer_id", column="Customer Id", max_length=50),
        FieldSpec("first_name", column="First Name", max_length=100),
        FieldSpec("last_name", column="Last Name", max_length=100),
        FieldSpec("company_name", column="Company", max_length=100),
        FieldSpec("city", max_length=100),
        FieldSpec("country", max_length=100),
        FieldSpec("phone_one", column="Phone 1", max_length=25, clean=(clean_phone,)),
        FieldSpec("phone_two", column="Phone 2", max_length=25, clean=(clean_phone,)),
        FieldSpec("email", "email", max_length=100, clean=(clean_email,)),
        FieldSpec("subscription_date", "date", column="Subscription Date"),
        FieldSpec("website", max_length=100),
    ),
    grain=("customer_id",),
)

INVENTORY = SourceSpec(
    table="products",
    patterns=("inventory_*.xlsx",),
    format="excel",
    sheet="Products",
    skip_rows=1,
    fields=(
        FieldSpec("sku", column="SKU", max_length=100),
        FieldSpec("name", column="Product Name", max_length=100),
        FieldSpec("category", column="Category", max_length=100),
        FieldSpec("price", "float", column="Price"),
        FieldSpec("stock_quantity", "int", column="Stock Qty"),
        FieldSpec("supplier", column="Supplier", max_length=100),
        FieldSpec("last_updated", "timestamp", column="Last Updated"),
    ),
    grain=("sku",),
    audits=(Audit("price_positive", every_row("price > 0")),),
)

LEDGER = SourceSpec(
    table="ledger_entries",
    patterns=("ledger_*.json",),
    format="json",
    array_path="entries.item",
    fields=(
        FieldSpec("entry_id", "int"),
        FieldSpec("account_code", max_length=100),
        FieldSpec("account_name", max_length=100),
        FieldSpec("debit_amount", "float", nullable=True),
        FieldSpec("credit_amount", "float", nullable=True),
        FieldSpec("description", max_length=500),
        FieldSpec("transaction_date", "date"),
        FieldSpec("reference_number", max_length=100),
    ),
    grain=("entry_id",),
)

MASTER = Registry([SALES, CUSTOMERS, INVENTORY, LEDGER])
