import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starling.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="starling-test-")


def order_doc(order_id, customer_id=100, tier="SILVER", segment="B2C", status="NEW", items=None,
              amount=10.0, date="2026-02-01 08:00:00", **extra):
    doc = {
        "order_id": order_id,
        "customer": {"customer_id": customer_id, "segment": segment, "loyalty_tier": tier},
        "order_date": date,
        "status": status,
        "payment": {"method": "VOUCHER", "currency": "XTS", "amount": amount},
        "items": [] if items is None else items,
        "shipping": {"country": "Atlantis", "city": "Port Nowhere", "delivery_type": "BY_BOAT"},
    }
    doc.update(extra)
    return doc


def item(product_id, quantity=1, unit_price=10.0, category="books"):
    return {"product_id": product_id, "category": category, "quantity": quantity, "unit_price": unit_price}


def write_files(folder, files: dict):
    """files: name -> python object (dumped as JSON) or raw text."""
    os.makedirs(folder, exist_ok=True)
    for name, content in files.items():
        text = content if isinstance(content, str) else json.dumps(content, indent=2)
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    return folder
