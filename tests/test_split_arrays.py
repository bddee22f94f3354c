"""Large array files read in splits: same rows and row numbers as files read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from starling.sources.json_files import parse_json_arrays, read_files
from starling.sources.split_arrays import array_elements, read_split_arrays

ODD = ['brace } and {', 'quote " in "it"', "back\\slash \\\" mix \\\\", "comma , [1,2]", "ünï ☃ 漢字", "", "]", "\\", "line\nbreak \t tab"]


def element(rng, n):
    return {"order_id": n, "note": rng.choice(ODD) + rng.choice(ODD), "items": [{"q": rng.random(), "t": rng.choice(ODD)} for _ in range(rng.randrange(4))],
            "more": {"deep": {"deeper": [[], {}, [rng.choice(ODD)]]}}}


def canon(df):
    rows = df.select("file_name", "row_number", F.to_json("payload").alias("p"), "reject_reason", "raw").collect()
    return sorted(((r.file_name, r.row_number, r.p, r.reject_reason, r.raw) for r in rows), key=repr)


@pytest.fixture()
def tiny_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(folder, files):
    import os
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    return folder


def test_splits_give_the_rows_of_whole_files(spark, tmp_root, tiny_splits):
    rng = random.Random(3)
    docs = [element(rng, n) for n in range(60)]
    long = element(rng, 61) | {"pad": "x}{[]\\\"," * 600}                                # reaches over several splits
    mixed = [1, "two }", None, [1, [2, {"a": "}"}]], docs[0], True, {}, [], long, docs[1], -2.5e3]
    path = write(f"{tmp_root}/arrays", {
        "one_line.json": json.dumps(docs), "pretty.json": json.dumps(docs, indent=2, ensure_ascii=False) + "\n\n",
        "mixed.json": "\n  " + json.dumps(mixed) + " ", "long.json": json.dumps([docs[0], long, docs[1], long]),
        "empty.json": "[" + " " * 2000 + "]", "single.json": json.dumps([long]), "numbers.json": json.dumps(list(range(900)))})
    assert array_elements(spark, path, 1)[0].select("path").distinct().count() == 6
    assert canon(read_split_arrays(spark, path, from_bytes=1)) == canon(parse_json_arrays(read_files(spark, path)))


def test_large_files_that_are_no_single_array_are_read_whole(spark, tmp_root, tiny_splits):
    rng = random.Random(4)
    docs = [element(rng, n) for n in range(20)]
    text = json.dumps(docs)
    path = write(f"{tmp_root}/other", {
        "object.json": json.dumps({"a": docs}), "lines.json": "\n".join(json.dumps(d) for d in docs), "twice.json": text + text,
        "cut.json": text[:-700], "after.json": text + " x", "before.json": "x" + text, "blank.json": " \n" * 1500, "closed.json": text + "]",
        "open.json": "[" + text, "string.json": json.dumps("a}" * 900), "good.json": text})
    elements, other = array_elements(spark, path, 1)
    assert {p.rsplit("/", 1)[1] for p in other} == {"object.json", "lines.json", "twice.json", "cut.json", "after.json", "before.json",
                                                    "blank.json", "closed.json", "open.json", "string.json"}
    assert canon(read_split_arrays(spark, path, from_bytes=1)) == canon(parse_json_arrays(read_files(spark, path)))


def test_a_bad_element_is_a_reject_of_its_own(spark, tmp_root, tiny_splits):
    rng = random.Random(5)
    parts = [json.dumps(element(rng, n)) for n in range(30)]
    parts[17] = '{"order_id": 17, "bad" "value"}'
    path = write(f"{tmp_root}/bad", {"bad.json": "[" + ",".join(parts) + "]"})
    rows = canon(read_split_arrays(spark, path, from_bytes=1))
    assert len(rows) == 30 and [(r[1], r[4]) for r in rows if r[3]] == [(18, parts[17])]
    with pytest.raises(Exception, match="malformed JSON"):
        read_split_arrays(spark, path, from_bytes=1, strict=True).select("reject_reason").collect()


def test_small_files_are_read_whole_and_large_ones_by_several_tasks(spark, tmp_root, tiny_splits):
    rng = random.Random(6)
    path = write(f"{tmp_root}/sizes", {"small.json": json.dumps([element(rng, 1)]), "large.json": json.dumps([element(rng, n) for n in range(80)])})
    elements, _ = array_elements(spark, path, 5000)
    assert elements.where("path like '%small%'").isEmpty() and elements.select(F.spark_partition_id()).distinct().count() > 5
    assert canon(read_split_arrays(spark, path, from_bytes=5000)) == canon(parse_json_arrays(read_files(spark, path)))
