"""The pipeline's stages take the rows that are meant, where ids are null or repeat."""

import random

from starling.llm import decontaminate, minhash

SCHEMA = "doc_id long, text string, source string"


def _words(seed, n=60):
    r = random.Random(seed)
    return [f"w{r.randrange(10 ** 6)}" for _ in range(n)]


def _left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_keep_one_takes_rows_not_ids(spark):
    a, b, c, d, e = (_words(k) for k in range(5))
    near = " ".join(a[:-1] + ["other"])
    a, b, c, d, e = map(" ".join, (a, b, c, d, e))
    rows = [(1, a, "x"), (None, near, "x"), (None, b, "x"), (None, c, "x"), (1, d, "x"), (5, a.upper(), "x"), (5, e, "x"),
            (7, e, "x"), (8, "", "x"), (8, "", "y"), (None, None, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert _left(minhash.keep_one(docs, width=3, numerator=80)) == sorted(
        [(1, a), (None, b), (None, c), (1, d), (5, e), (8, ""), (8, ""), (None, None)], key=str)


def test_keep_one_leaves_one_of_identical_rows(spark):
    a, b, c = (" ".join(_words(k)) for k in range(3))
    rows = [(1, a, "x"), (1, a, "y"), (2, a, "x"), (None, b, "x"), (None, b, "y"), (None, b + " ", "x"), (3, c, "x"), (3, a, "x")]
    found = _left(minhash.keep_one(spark.createDataFrame(rows, SCHEMA), width=3, numerator=80))
    assert [(i, t.strip()) for i, t in found] == sorted([(1, a), (None, b), (3, c)], key=str)


def test_drop_contaminated_takes_rows_not_ids(spark):
    a, b, c, d = (" ".join(_words(k)) for k in range(4))
    rows = [(None, a, "x"), (None, b, "x"), (1, f"{c} {a}", "x"), (1, d, "x"), (2, None, "x"), (None, None, "x")]
    benchmark = spark.createDataFrame([(9, a)], "item_id long, text string")
    assert _left(decontaminate.drop_contaminated(spark.createDataFrame(rows, SCHEMA), benchmark)) == sorted(
        [(None, b), (1, d), (2, None), (None, None)], key=str)


def test_blocks_are_bounded_where_items_share_an_id(spark, monkeypatch):
    sizes, init = [], decontaminate.Windows.__init__

    def recorded(self, items, width):
        sizes.append(sum(len(b" ".join(words)) for _, words in items))
        init(self, items, width)

    monkeypatch.setattr(decontaminate.Windows, "__init__", recorded)
    texts = [" ".join(_words(k, 12)) for k in range(60)]
    benchmark = spark.createDataFrame([(7 if k < 30 else None, t) for k, t in enumerate(texts)] * 2, "item_id long, text string")
    docs = spark.createDataFrame([(k, texts[k] + " tail", "x") for k in range(0, 60, 2)] + [(99, "no such words", "x")], SCHEMA)
    found = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, benchmark, block_bytes=400).collect()}
    assert len(found) == 31 and not found[99]["hits"]
    assert all([tuple(h) for h in found[k]["hits"]] == [(0, 12)] and found[k]["items"] == [7 if k < 30 else None] for k in range(0, 60, 2))
    assert max(sizes) <= 2 * 400 and sum(sizes) == sum(map(len, texts))


def test_release_gives_freed_memory_back_to_the_system():
    """A few objects that stay among many freed ones don't hold the pages of all of them in a Python worker."""
    import os
    import subprocess
    import sys

    code = """
from starling.llm import common
def rss():
    return [int(x.split()[1]) // 1024 for x in open("/proc/self/status") if x.startswith("VmRSS")][0]
common.release()
start = rss()
many = [bytes(3000) for _ in range(60_000)]
few = many[::50]
del many
common.release()
print(rss() - start)
"""
    if not os.path.exists("/proc/self/status") or not hasattr(__import__("ctypes").CDLL(None), "malloc_trim"):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=100, check=True).stdout
    assert int(out.split()[-1]) < 60                # 174 MB were made; they all stayed
