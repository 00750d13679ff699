"""Table specifications: the single place that says what a replicated table is.

A ``TableSpec`` drives parsing, typing, keying, defaults and data-quality rules
for one captured table, so adding a table is adding a spec, never code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PRICE = T.DecimalType(10, 2)


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str                      # business key the replica is keyed by
    columns: T.StructType         # typed row image
    topic: str
    pk: str | None = None         # source primary key when it differs from ``key``
    defaults: dict = field(default_factory=dict)   # column -> literal used on insert
    lengths: dict = field(default_factory=dict)    # column -> VARCHAR length
    not_null: tuple = ()
    unique: tuple = ()
    money: str = "decimal"        # 'decimal' (exact) or 'double' (opt-in)

    @property
    def pk_col(self) -> str:
        return self.pk or self.key

    @property
    def two_keys(self) -> bool:
        """Whether the business key differs from the source primary key."""
        return self.pk is not None and self.pk != self.key

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.columns.fields]

    def typed_columns(self) -> T.StructType:
        """Column types after the money policy is applied."""
        if self.money == "decimal":
            return self.columns
        return T.StructType([
            T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType, True)
            for f in self.columns.fields
        ])


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Fixed values that must equal the captured source schema: topic names, column
# lists, VARCHAR lengths, defaults, NOT NULL / UNIQUE sets and value domains.
# ---------------------------------------------------------------------------
CUSTOMERS_SPEC = TableSpec(
    name="customers", key="customer_id", topic="cdc.sales.customers",
    columns=_s(("customer_id", T.IntegerType()), ("name", T.StringType()), ("email", T.StringType()),
               ("phone", T.StringType()), ("loyalty_tier", T.StringType())),
    defaults={"loyalty_tier": "bronze"},
    lengths={"name": 128, "email": 255, "phone": 32, "loyalty_tier": 16},
    not_null=("name", "email"), unique=("email",),
)
ORDERS_SPEC = TableSpec(
    name="orders", key="order_id", topic="cdc.sales.orders",
    columns=_s(("order_id", T.IntegerType()), ("customer_id", T.IntegerType()), ("total_amount", MONEY),
               ("status", T.StringType()), ("payment_method", T.StringType())),
    defaults={"status": "pending"},
    lengths={"status": 32, "payment_method": 32},
    not_null=("customer_id", "total_amount"),
)
ORDER_ITEMS_SPEC = TableSpec(
    name="order_items", key="item_id", topic="cdc.sales.order_items",
    columns=_s(("item_id", T.IntegerType()), ("order_id", T.IntegerType()), ("product_name", T.StringType()),
               ("quantity", T.IntegerType()), ("unit_price", PRICE)),
    lengths={"product_name": 255},
    not_null=("order_id", "product_name", "quantity", "unit_price"),
)
INVENTORY_SPEC = TableSpec(
    name="inventory", key="sku", pk="product_id", topic="cdc.sales.inventory",
    columns=_s(("product_id", T.IntegerType()), ("sku", T.StringType()), ("product_name", T.StringType()),
               ("category", T.StringType()), ("stock_quantity", T.IntegerType()), ("unit_price", PRICE)),
    defaults={"stock_quantity": 0},
    lengths={"sku": 32, "product_name": 255, "category": 64},
    not_null=("sku", "product_name"), unique=("sku",),
)

OP_DOMAIN = ("c", "u", "d", "r")
ORDER_STATUS_DOMAIN = ("pending", "shipped", "delivered", "cancelled")
LOYALTY_TIERS = ("bronze", "silver", "gold", "platinum")
PAYMENT_METHODS = ("card", "paypal", "transfer", "crypto")
# ---------------------------------------------------------------------------

# The change log derived from the provided ``events`` table (see plans/testdata.py):
# key ``k`` (user id), row image ``status`` + ``amount``.
EVENTS_SPEC = TableSpec(
    name="events", key="k", topic="cdc.sales.events",
    columns=_s(("k", T.LongType()), ("status", T.StringType()), ("amount", MONEY)),
    lengths={"status": 32},
    not_null=("status",),
)

SPECS = {s.name: s for s in (CUSTOMERS_SPEC, ORDERS_SPEC, ORDER_ITEMS_SPEC, INVENTORY_SPEC, EVENTS_SPEC)}
