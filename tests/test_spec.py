from dataclasses import replace

from pyspark.sql import types as T

from tidemark.spec import CUSTOMERS_SPEC, INVENTORY_SPEC, ORDERS_SPEC, SPECS


def test_registry_covers_every_captured_table():
    # Every captured table is driven by a spec, order items included.
    assert {"customers", "orders", "order_items", "inventory"} <= set(SPECS)
    assert all(s.topic.startswith("cdc.sales.") for s in SPECS.values() if s.name != "events")


def test_money_policy():
    assert ORDERS_SPEC.typed_columns()["total_amount"].dataType == T.DecimalType(12, 2)
    as_double = replace(ORDERS_SPEC, money="double").typed_columns()
    assert as_double["total_amount"].dataType == T.DoubleType()


def test_key_and_primary_key():
    assert INVENTORY_SPEC.key == "sku" and INVENTORY_SPEC.pk_col == "product_id"
    assert CUSTOMERS_SPEC.pk_col == CUSTOMERS_SPEC.key == "customer_id"
    assert CUSTOMERS_SPEC.defaults == {"loyalty_tier": "bronze"}
