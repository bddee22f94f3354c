import duckdb

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

FAST = ["parse_orders", "latest_event_per_user", "stg_items_replace", "dim_customer_scd1", "fact_order_items",
        "net_changes_orders", "merge_row_counts", "load_usage_hourly", "star_revenue", "audit_steps", "json_lines_load",
        "multi_document_rejects", "nested_landing", "rejects_items", "failed_batch_audit", "growing_item_changes", "batch_then_stream"]


def canon(v):
    import decimal
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    return str(v)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["shipping_country", "category", "loyalty_tier", "revenue", "orders", "items"]


def test_every_query_has_oracle():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    from starling.queries import QUERIES
    assert set(QUERIES) <= set(o)


def test_queries_match_duckdb_small(spark):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    for name in FAST:
        df = q[name](spark, SF_SMALL)
        cols = sorted(df.columns)
        got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
        res = con.execute(o[name])
        ocols = [d[0] for d in res.description]
        assert sorted(ocols) == cols, name
        idx = [ocols.index(c) for c in cols]
        exp = sorted(tuple(canon(r[i]) for i in idx) for r in res.fetchall())
        assert got == exp, name
