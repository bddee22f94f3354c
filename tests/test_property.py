"""Equivalence property: order versions cut into consecutive batches give the same facts as one batch."""

import datetime as dt
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starling.sources.json_files import parse_json_arrays
from starling.store import pipeline
from starling.store.tables import Store

import json
from functools import reduce

version = st.fixed_dictionaries({
    "order_id": st.integers(1, 6),
    "status": st.sampled_from(["NEW", "SHIPPED"]),
    "customer": st.fixed_dictionaries({"customer_id": st.integers(100, 102), "segment": st.just("B2C"),
                                       "loyalty_tier": st.sampled_from(["BRONZE", "GOLD"])}),
    "order_date": st.just("2026-02-01 08:00:00"),
    "payment": st.fixed_dictionaries({"method": st.just("CARD"), "currency": st.just("EUR"),
                                      "amount": st.integers(1, 500)}),
    "items": st.lists(st.fixed_dictionaries({"product_id": st.integers(1000, 1003), "category": st.just("toys"),
                                             "quantity": st.integers(1, 3), "unit_price": st.integers(1, 9)}),
                      max_size=3),
})


def _landing(spark, docs, batch):
    files = spark.createDataFrame([(f"b{batch}.json", json.dumps(docs))], "file_name string, value string")
    ts = F.lit(dt.datetime(2026, 2, 1, 8) + dt.timedelta(hours=batch))
    p = parse_json_arrays(files)
    return p.select("file_name", "row_number", ts.alias("load_ts"), "payload", "reject_reason", "raw")


def _facts(store):
    items = sorted(tuple(str(x) for x in r) for r in
                   store.current("fact_order_items").select("order_id", "product_id", "quantity", "unit_price").collect())
    orders = sorted(tuple(str(x) for x in r) for r in
                    store.current("fact_orders").select("order_id", "status", "customer_id", "payment_amount").collect())
    return items, orders


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(version, min_size=1, max_size=10), cuts=st.lists(st.integers(1, 9), max_size=2))
def test_incremental_equals_one_batch(spark, docs, cuts):
    bounds = sorted({c for c in cuts if c < len(docs)})
    parts, lo = [], 0
    for b in bounds + [len(docs)]:
        parts.append(docs[lo:b])
        lo = b
    root = tempfile.mkdtemp(prefix="starling-prop-")
    inc = Store(spark, os.path.join(root, "inc"))
    for i, part in enumerate(parts):
        pipeline.load_batch(inc, _landing(spark, part, i))
    one = Store(spark, os.path.join(root, "one"))
    # one batch holding every version: same arrival order through (load_ts, file, row)
    everything = reduce(lambda a, b: a.unionByName(b), [_landing(spark, p, i) for i, p in enumerate(parts)])
    pipeline.load_batch(one, everything)
    assert _facts(inc) == _facts(one)
