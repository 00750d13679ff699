import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = local_session("4", 4, app="tidemark-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from tidemark.session import work_dir

    return work_dir(spark, "test")


def change(spec_name, op, before=None, after=None, ts_ms=0):
    """A change envelope; image values are strings, as the capture connector sends them."""
    as_text = lambda image: None if image is None else {k: None if v is None else str(v) for k, v in image.items()}
    return {"before": as_text(before), "after": as_text(after), "source": {"table": spec_name}, "op": op, "ts_ms": ts_ms}


# Invented rows: a customer who comes, moves up a tier and leaves; an order; a restocked article.
T0 = 1_700_000_000_000
PERSON = {"customer_id": 7311, "name": "Mira Test-Okafor", "email": "mira@mail.test", "phone": "0151 000 777", "loyalty_tier": "silver"}
ARTICLE = {"product_id": 88, "sku": "KETTLE/2L", "product_name": "Kettle, 2 litres", "category": "Küche", "stock_quantity": 12, "unit_price": "24.50"}
INSERT = change("customers", "c", after=PERSON, ts_ms=T0)
UPDATE = change("customers", "u", before={"customer_id": 7311, "loyalty_tier": "silver"}, after=PERSON | {"loyalty_tier": "gold"}, ts_ms=T0 + 40)
DELETE = change("customers", "d", before={"customer_id": 7311, "email": "mira@mail.test"}, ts_ms=T0 + 90)
ORDER = change("orders", "c", after={"order_id": 5150, "customer_id": 7311, "total_amount": "49.00", "status": "shipped", "payment_method": "transfer"}, ts_ms=T0 + 50)
INVENTORY = change("inventory", "u", before={"sku": "KETTLE/2L", "stock_quantity": 3}, after=ARTICLE, ts_ms=T0 + 60)


def raw_frame(spark, records, topic="cdc.sales.customers", start_offset=0):
    """Kafka-shaped rows; ``records`` are dicts (dumped to JSON) or raw strings/None."""
    from tidemark.sources.changes import RAW_SCHEMA

    rows = []
    for i, r in enumerate(records):
        value = json.dumps(r) if isinstance(r, dict) else r
        rows.append((None, value, topic, 0, start_offset + i, None))
    return spark.createDataFrame(rows, RAW_SCHEMA)
