"""Files of several kinds in one area: made in one pass over the tables, each text and line parsed once."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import write_files
from starling import queries as q
from starling.sources import json_files as jf
from starling.sources.documents import documents_to_mixed_files, load_tables, order_documents


def _tables(spark, root):
    day = dt.datetime(1996, 3, 5, 7)
    rows = {
        "orders": ([(1, 10, "O", 5.5, day, "1-URGENT"), (2, 10, "F", 6.5, day, "5-LOW"), (3, 11, "P", 7.5, day, "2-HIGH"),
                    (4, 11, None, 8.5, day, None), (5, 10, "O", 9.5, None, "5-LOW"), (6, 99, "F", 1.5, None, "5-LOW"),
                    (7, None, "P", 2.5, None, "5-LOW"), (None, 10, "O", 3.5, day, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(1, 100, 1, 2.0, "F"), (1, 101, 2, 3.0, "O"), (2, 100, 1, 4.0, "F"), (3, 999, 1, 1.0, None), (8, 100, 1, 1.0, "F")],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_linestatus string"),
        "part": ([(100, "a \"b\"", 1.25), (101, None, 2.5)], "p_partkey long, p_type string, p_retailprice double"),
        "customer": ([(10, 1, -5.0, "X"), (11, 1, 5000.0, "Y")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "R")], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_mixed_files_are_made_in_one_pass(spark, tmp_root, monkeypatch):
    made = {}
    monkeypatch.setattr(q, "write_json_array_files", lambda files, path: made.update(files=files))
    q._mixed_files(spark, _tables(spark, tmp_root), "test")
    plan = made["files"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1 and plan.count("from_json(") == 0
    texts = sorted((r["file_name"] or "", r["value"].count("\n"), r["value"][:1]) for r in made["files"].collect())
    # the orders without a date are in a file without a name, kind after kind
    assert texts == [("", 3, "["), ("array/orders_199603_00000.json", 0, "["),
                     ("lines/orders_199603_ null.json", 0, "{"), ("lines/orders_199603_00000.json", 0, "{"), ("twice/orders_199603_00000.json", 1, "[")]


def test_mixed_files_query_counts_every_order(spark, tmp_root):
    got = {(r["kind"], r["outcome"]): r["row_count"] for r in q.q_multi_document_rejects(spark, _tables(spark, tmp_root)).collect()}
    assert got == {("lines", "loaded"): 2, ("twice", jf.REASON_MALFORMED): 1, ("array", "loaded"): 2,
                   ("__HIVE_DEFAULT_PARTITION__", jf.REASON_MALFORMED): 1}


def test_one_pass_makes_the_documents_of_one_call_for_each_kind(spark, tmp_root):
    t = load_tables(spark, _tables(spark, tmp_root))
    late = F.col("o_orderkey") % 2 == 0
    parts = order_documents(t, orders_where=~late, promote_tier=True, file_prefix="u1/").unionByName(
        order_documents(t, orders_where=late, file_prefix="u2/"))
    whole = order_documents(t, promote_tier=~late, file_prefix=F.when(late, "u2/").otherwise("u1/")).where("order_id IS NOT NULL")
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_lines_of_a_kind_are_the_documents(spark):
    docs = spark.createDataFrame([(2, "f", "lines", '{"b":2}'), (1, "f", "lines", '{"a":1}'), (3, "g", "twice", "{}"), (4, "h", "array", "{}")],
                                 "order_id int, file_name string, kind string, doc string")
    assert sorted(r["value"] for r in documents_to_mixed_files(docs).collect()) == ["[{}]", "[{}]\n[{}]", '{"a":1}\n{"b":2}']


def test_texts_and_lines_are_parsed_once(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {
        "lines.json": '{"order_id":1}\n\n[2]\nnull\n{"order_id":3\n{"order_id":4}',
        "twice.json": ' \n[{"order_id":1}]\n[{"order_id":2}]',
        "broken.json": '[{"order_id":1}\n{"order_id":2}',
        "array.json": '[{"order_id":5},null]',
        "root.json": '\n{"order_id":6}\n',
        "text.json": "no JSON",
    })
    rows = jf.landing_rows(jf.read_files(spark, src))
    # the array, another root, the first line, and each line: whatever names a parsed value does not parse it again
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 4
    got = sorted(((r["file_name"], r["row_number"], r["reject_reason"], r["id"], r["raw"]) for r in rows.withColumn(
        "id", F.try_variant_get("payload", "$.order_id", "int")).collect()), key=str)
    assert got == sorted([
        ("lines.json", 1, None, 1, None), ("lines.json", 2, jf.REASON_NOT_DOCUMENT, None, "[2]"),
        ("lines.json", 3, jf.REASON_NULL_DOCUMENT, None, "null"), ("lines.json", 4, jf.REASON_MALFORMED, None, '{"order_id":3'),
        ("lines.json", 5, None, 4, None), ("twice.json", 0, jf.REASON_MALFORMED, None, ' \n[{"order_id":1}]\n[{"order_id":2}]'),
        ("broken.json", 0, jf.REASON_MALFORMED, None, '[{"order_id":1}\n{"order_id":2}'), ("array.json", 1, None, 5, None),
        ("array.json", 2, jf.REASON_NULL_DOCUMENT, None, None), ("root.json", 1, None, 6, None),
        ("text.json", 0, jf.REASON_MALFORMED, None, "no JSON")], key=str)
