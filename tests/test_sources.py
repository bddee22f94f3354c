import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, item, order_doc, write_files
from starling.functions.paths import order_columns
from starling.sources import json_files as jf
from starling.sources.documents import documents_to_files, load_tables, order_documents


def test_array_scan_rows_and_lineage(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {
        "orders_20260201_08.json": [order_doc(1, items=[item(1000)]), order_doc(2), order_doc(3)],
        "orders_20260201_09.json": [order_doc(4)],
    })
    rows = jf.landing_rows(jf.read_files(spark, src)).select(
        "file_name", "row_number", F.variant_get("payload", "$.order_id", "int").alias("oid"), "reject_reason")
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [("orders_20260201_08.json", 1, 1, None), ("orders_20260201_08.json", 2, 2, None),
                   ("orders_20260201_08.json", 3, 3, None), ("orders_20260201_09.json", 1, 4, None)]


def test_bad_files_become_rejects_not_losses(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {
        "bad.json": "[{\"order_id\": 1,",
        "object.json": order_doc(7),
        "empty.json": [],
        "scalar.json": "42",
        "nulls.json": "[null]",
    })
    rows = {r["file_name"]: r for r in jf.landing_rows(jf.read_files(spark, src)).collect()}
    assert rows["bad.json"]["reject_reason"] == jf.REASON_MALFORMED
    assert rows["bad.json"]["raw"].startswith("[{")
    assert rows["object.json"]["reject_reason"] is None and rows["object.json"]["row_number"] == 1
    assert "empty.json" not in rows
    assert rows["scalar.json"]["reject_reason"] == jf.REASON_NOT_DOCUMENT
    assert rows["nulls.json"]["reject_reason"] == jf.REASON_NULL_DOCUMENT


def test_strict_mode_raises_on_malformed(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {"bad.json": "[{\"order_id\": 1,"})
    with pytest.raises(Exception):
        jf.landing_rows(jf.read_files(spark, src), strict=True).collect()


def test_path_casts_round_half_away_from_zero(spark):
    df = spark.createDataFrame([("f", '[{"order_id": 1, "payment": {"amount": 100.50}}, '
                                      '{"order_id": 2, "payment": {"amount": -100.50}}, '
                                      '{"order_id": 3, "payment": {"amount": 100.49}, "order_date": "2026-02-01 08:00:00"}]')],
                               "file_name string, value string")
    rows = jf.parse_json_arrays(df).select(*order_columns("payload")).orderBy("order_id").collect()
    assert [int(r["payment_amount"]) for r in rows] == [101, -101, 100]
    assert str(rows[2]["order_date"]) == "2026-02-01"
    cents = jf.parse_json_arrays(df).select(*order_columns("payload", money="cents")).orderBy("order_id").collect()
    assert [str(r["payment_amount"]) for r in cents] == ["100.50", "-100.50", "100.49"]


def test_documents_round_trip_on_test_tables(spark):
    t = load_tables(spark, SF_SMALL)
    files = documents_to_files(order_documents(t))
    rows = jf.landing_rows(files)
    assert rows.count() == t.orders.count()
    assert rows.where(F.col("reject_reason").isNotNull()).count() == 0
    # every file is bounded: one month and one key span
    per_file = files.select(F.size(F.from_json("value", "array<string>")).alias("n"))
    assert per_file.agg(F.max("n")).first()[0] <= 100_000


def test_file_listing_reads_no_content(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {"a.json": [order_doc(1)], "b.json": [order_doc(2)]})
    df = jf.list_files(spark, src)
    assert set(df.columns) == {"path", "length", "modificationTime", "file_name"}
    assert df.count() == 2
    assert "content" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_written_landing_folders_keep_file_names(spark, tmp_root):
    files = spark.createDataFrame([("x/orders_1.json", "[" + '{"order_id": 5}' + "]")], "file_name string, value string")
    out = os.path.join(tmp_root, "drop")
    jf.write_json_array_files(files, out)
    got = jf.landing_rows(jf.read_files(spark, out)).select("file_name", "row_number").collect()
    assert [tuple(r) for r in got] == [("x/orders_1.json", 1)]


def test_one_shot_load_and_adhoc_query(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {"a.json": [order_doc(1), order_doc(2)]})
    landing = os.path.join(tmp_root, "landing")
    assert jf.load_once(spark, src, landing).count() == 2
    assert jf.load_once(spark, src, landing).count() == 2          # known files are not loaded again
    write_files(src, {"b.json": [order_doc(3)]})
    assert jf.load_once(spark, src, landing).count() == 3
    os.remove(os.path.join(src, "b.json"))
    q = jf.query_files(spark, src).select(F.variant_get("payload", "$.order_id", "int").alias("o"))
    assert sorted(r["o"] for r in q.collect()) == [1, 2]


def test_text_after_the_root_is_never_lost(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "in"), {
        "lines.json": '{"order_id": 1}\n\n{"order_id": 2}\r\n{"order_id": oops}\n[3]\n',
        "two_arrays.json": '[{"order_id": 3}][{"order_id": 4}]',
        "comma.json": '[{"order_id": 3}],[{"order_id": 4}]',
        "junk.json": '[{"order_id": 5}] junk',
        "blank.json": " \n ",
        "spaced.json": ' \n[{"order_id": 6}]\n ',
    })
    rows = jf.landing_rows(jf.read_files(spark, src)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["file_name"], []).append((r["row_number"], r["reject_reason"], r["raw"]))
    assert sorted(by["lines.json"], key=str) == sorted(
        [(1, None, None), (2, None, None), (3, jf.REASON_MALFORMED, '{"order_id": oops}'), (4, jf.REASON_NOT_DOCUMENT, "[3]")], key=str)
    for name in ("two_arrays.json", "comma.json", "junk.json"):
        assert [(n, why) for n, why, _ in by[name]] == [(0, jf.REASON_MALFORMED)] and by[name][0][2].startswith("[{")
    assert "blank.json" not in by and [x[:2] for x in by["spaced.json"]] == [(1, None)]
    with pytest.raises(Exception):
        jf.landing_rows(jf.read_files(spark, src), strict=True).collect()


def test_folders_below_folders_and_names(spark, tmp_root):
    src = os.path.join(tmp_root, "area")
    write_files(os.path.join(src, "2026", "a b+c%"), {"x.json": [order_doc(1)]})
    write_files(src, {"x.json": [order_doc(2)]})
    for read in (lambda: jf.query_files(spark, src), lambda: jf.query_files(spark, "file://" + src + "/")):
        got = {(r["file_name"], r["o"]) for r in read().select("file_name", F.variant_get("payload", "$.order_id", "int").alias("o")).collect()}
        assert got == {("2026/a b+c%/x.json", 1), ("x.json", 2)}
    assert {r["file_name"] for r in jf.list_files(spark, src).collect()} == {"2026/a b+c%/x.json", "x.json"}


def test_json_lines_are_split_and_numbered(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "lines"), {"big.jsonl": "".join(f'{{"order_id": {i}}}\n' for i in range(20_000)) + "bad\n"})
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        raw = jf.read_lines(spark, src)
        assert raw.rdd.getNumPartitions() > 3
        rows = jf.landing_rows(raw).select("row_number", F.variant_get("payload", "$.order_id", "int").alias("o"), "reject_reason").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    good = sorted((r["row_number"], r["o"]) for r in rows if r["reject_reason"] is None)
    assert [o for _, o in good] == list(range(20_000)) and len({n for n, _ in good}) == 20_000
    assert [r["reject_reason"] for r in rows if r["reject_reason"]] == [jf.REASON_MALFORMED]


def test_file_names_of_large_keys_are_not_cut(spark):
    from starling.sources.documents import file_name_of

    got = [r[0] for r in spark.createDataFrame([(10 ** 11,), (10 ** 11 + 10 ** 5,), (7,)], "k long").select(
        file_name_of(F.to_date(F.lit("2026-03-01")), F.col("k"))).collect()]
    assert got == ["orders_202603_1000000.json", "orders_202603_1000001.json", "orders_202603_00000.json"]


def test_permissive_mode_rejects_bad_items(spark, tmp_root):
    from starling.plans import stage1

    src = write_files(os.path.join(tmp_root, "in"), {"a.json": [
        order_doc(1, items=[item(1000)]), order_doc(2, items=[dict(item(1000), quantity="two")]), order_doc(3, items=[dict(item(1000), unit_price="x")]),
        order_doc(4, items={"product_id": 1}), order_doc(5, items="none"), order_doc(6, items=[7]), order_doc(7), dict(order_doc(8), items=None)]})
    land = jf.landing_rows(jf.read_files(spark, src))
    assert sorted(int(r["order_id"]) for r in stage1.latest_orders(land, strict=False).collect()) == [1, 7, 8]
    assert {r["reason"] for r in stage1.rejected_rows(land, strict=False).collect()} == {stage1.REASON_BAD_VALUE}
    assert stage1.rejected_rows(land, strict=False).count() == 5


def test_line_numbers_across_splits_and_files(spark, tmp_root):
    import os

    from starling.sources.json_files import read_lines

    os.makedirs(f"{tmp_root}/lines/sub")
    texts = {f"sub/f{k}.json": "\n".join(json.dumps({"order_id": i, "pad": "p" * (i % 50)}) if i % 7 else " " for i in range(1, 40 * k)) + "\n" * (k % 3)
             for k in range(1, 9)}
    for name, text in texts.items():
        with open(f"{tmp_root}/lines/{name}", "w") as f:
            f.write(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = sorted((name, i + 1, line) for name, text in texts.items() for i, line in enumerate(text.split("\n")) if line.strip())
    try:
        for size in ("3000", "100000"):                    # four splits of a file; several files in a task
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert sorted(tuple(r) for r in read_lines(spark, f"{tmp_root}/lines").collect()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bad_cast_flag_equals_a_look_at_every_path(spark):
    """The flag against one that takes each path of each item by itself; string paths, which always cast, are not read."""
    from starling.functions import paths

    def bad(value, every):
        out = F.lit(False)
        for _, path, kind in every:
            raw = F.variant_get(value, path, "variant")
            out = out | (raw.isNotNull() & ~F.is_variant_null(raw) & paths.get_path(value, path, kind, strict=False).isNull())
        return out

    d = F.col("payload")
    raw, items = F.variant_get(d, "$.items", "variant"), F.try_variant_get(d, "$.items", "array<variant>")
    bad_item = F.exists(items, lambda x: ~F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)) | bad(x, paths.ITEM_PATHS))
    plain = bad(d, paths.ORDER_PATHS) | (raw.isNotNull() & ~F.is_variant_null(raw) & items.isNull()) | F.coalesce(bad_item, F.lit(False))

    odd = [None, True, 0, 7, -1.5, 1e30, 10**37, 10**40, "12", " 12 ", "1e3", "x", "", "2026-02-01", "2026-02-30", [], [1], {}, {"a": 1}]
    good = item(1000)
    docs = [order_doc(1), order_doc(2, items=[good, good])]
    for v in odd:
        docs += [order_doc(v), order_doc(3, customer_id=v), order_doc(4, tier=v), order_doc(5, amount=v), order_doc(6, date=v),
                 order_doc(7, status=v), {**order_doc(8), "items": v}, {**order_doc(9), "customer": v}, order_doc(10, items=[good, v])]
        docs += [order_doc(11, items=[good, {**good, k: v}]) for k in good]
    docs += [{k: w for k, w in order_doc(12).items() if k != gone} for gone in order_doc(12)]
    docs += [order_doc(13, items=[{k: w for k, w in good.items() if k != gone}]) for gone in good]
    rows = spark.createDataFrame([(json.dumps(x),) for x in docs] + [("null",), ("3",), ("[]",), (None,)], "text string").select(
        "text", F.parse_json("text").alias("payload"))
    flag = paths.bad_cast_flag("payload")
    got = rows.select("text", flag.alias("got"), plain.alias("want")).collect()
    assert [tuple(r) for r in got if r["got"] != r["want"]] == []
    assert {r["want"] for r in got} == {True, False}
    plan = rows.where(flag)._jdf.queryExecution().optimizedPlan().toString()
    assert "$.items" in plan and "$.status" not in plan


def test_permissive_load_judges_each_row_once_before_the_shuffle(spark, tmp_root):
    """What the reject count and the latest versions need of a document is one column, not two evaluations."""
    from starling.plans import stage1
    from starling.sources.json_files import landing_rows

    files = spark.createDataFrame([("a.json", json.dumps([order_doc(1, items=[item(1000)]), order_doc(2, amount="x"), order_doc(None)]))],
                                  "file_name string, value string")
    rows = stage1.judged(landing_rows(files), strict=False)
    assert sorted((r["order_id"] or 0, r["reason"]) for r in rows.collect()) == [
        (0, stage1.REASON_NULL_KEY), (1, None), (2, stage1.REASON_BAD_VALUE)]
    assert [int(r["order_id"]) for r in stage1.latest_judged(rows).collect()] == [1]


def test_text_of_an_array_is_made_once_and_texts_without_content_have_no_rows(spark):
    docs = spark.createDataFrame([(2, "f", '{"order_id":2}'), (1, "f", '{"order_id":1}')], "order_id int, file_name string, doc string")
    rows = jf.landing_rows(documents_to_files(docs))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("array_join(") == 1
    assert [r["row_number"] for r in rows.orderBy("row_number").collect()] == [1, 2]
    odd = spark.createDataFrame([("a", ""), ("b", " \r\n\t"), ("c", None), ("d", "[]"), ("e", " {} "), ("f", "x")], "file_name string, value string")
    got = {(r["file_name"], r["row_number"], r["reject_reason"]) for r in jf.landing_rows(odd).collect()}
    assert got == {("e", 1, None), ("f", 0, jf.REASON_MALFORMED)}


def test_items_are_counted_as_they_are_taken(spark):
    from starling.functions.paths import item_count

    docs = ['{"items":[{"a":1},{}]}', '{"items":[]}', '{"items":null}', '{}', '{"items":[1,null,"x",[2]]}', '{"items":{"a":1}}', '5']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string").select("i", F.parse_json("d").alias("p"))
    got = [r["n"] for r in df.orderBy("i").select(item_count("p", strict=False).alias("n")).collect()]
    assert got == [2, 0, 0, 0, 4, 0, 0]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        df.where("i = 5").select(item_count("p")).collect()
