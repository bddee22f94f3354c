"""HyperMinHash near-duplicates against brute force on planted groups, chains and hot buckets."""

import random

import numpy as np
from pyspark.sql import functions as F

from starling.llm import minhash
from starling.llm.common import connected_components


def brute(rows, width, num, den):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t).split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and den * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def planted():
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, n = [], 0

    def add(t):
        nonlocal n
        rows.append((n, " ".join(t)))
        n += 1
    for _ in range(60):
        add([rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))])
    for size in (2, 5, 40):
        base = [rng.choice(vocabulary) for _ in range(80)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                t[rng.randrange(80)] = rng.choice(vocabulary)
            add(t)
    base = [rng.choice(vocabulary) for _ in range(100)]        # a chain: neighbours link, ends don't
    for k in range(30):
        add(base)
        base = base[4:] + [rng.choice(vocabulary) for _ in range(4)]
    boiler = [rng.choice(vocabulary) for _ in range(30)]        # much shared, below the similarity
    for _ in range(40):
        add(boiler + [rng.choice(vocabulary) for _ in range(12)])
    for _ in range(20):
        add([rng.choice(vocabulary[:3]) for _ in range(rng.randrange(1, 6))])
    return rows


def test_components_equal_brute_force(spark):
    rows = planted()
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for width, num in ((3, 85), (5, 80)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
               minhash.near_duplicates(d, width=width, numerator=num, denominator=100).collect()}
        assert got == brute(rows, width, num, 100)


def test_outsiders_of_a_bucket_are_compared(spark, monkeypatch):
    """With tiles of a few members each, all members of a bucket are still compared across tiles."""
    rows = planted()
    d = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "TILE_BYTES", 3 * minhash.LEAST_WEIGHT)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(d).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 3, 85, 100).items()}


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(1)
    errors = []
    for n, common in ((2000, 1000), (2000, 1800), (300, 150), (5000, 0)):
        for _ in range(20):
            h = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            rng.shuffle(h)
            a, b = np.sort(h[:n]), np.sort(h[n - common:2 * n - common])
            ra, rb = minhash.registers_of(a), minhash.registers_of(b)
            j, _ = minhash.estimate(ra[None], rb[None], np.array([n]), np.array([n]))
            errors.append(j[0] - common / (2 * n - common))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_registers_are_leading_zeros_and_mantissa():
    low = minhash.REGISTERS.bit_length() - 1
    for zeros, mantissa in ((0, 0), (3, 517), (20, 1023)):
        rest = (1 << (63 - zeros)) | (mantissa << (63 - zeros - minhash.MANTISSA_BITS))
        h = np.array([(5 << (64 - low)) | (rest >> low)], np.uint64)
        assert minhash.registers_of(h)[5] == (zeros << minhash.MANTISSA_BITS) | mantissa


def test_components_of_stars_chains_and_rings(spark):
    edges = [(0, i) for i in range(1, 50)] + [(100 + i, 101 + i) for i in range(60)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    d = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["component"] for r in connected_components(d).collect()}
    assert got == {r["node"]: r["component"] for r in connected_components(d, local_edges=0).collect()}
    assert got == {i: 0 for i in range(50)} | {100 + i: 100 for i in range(61)} | {i: 200 for i in (200, 201, 202)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_copies_are_never_paired(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2500, "same text over and over again here")
                                 .otherwise(F.concat(F.lit("other words number "), "id")).alias("text"))
    out = minhash.near_duplicates(d)
    assert out.where("component_id = 0").count() == 2500 and out.where("kept").count() == 501


def test_words_hash_alike_in_pieces(monkeypatch):
    rng = random.Random(4)
    text = " ".join("x" * rng.choice([1, 3, 7, 900]) + str(k % 50) for k in range(600))
    data = np.frombuffer(f"  {text}\n\t{'y' * 70_000}".encode(), np.uint8)
    whole = minhash.WordHashes()(data)
    monkeypatch.setattr(minhash, "CHUNK", 64)
    for a, b in zip(whole, minhash.WordHashes()(data)):
        assert (a == b).all()
    assert [len(x) for x in minhash.WordHashes()(data[:0])] == [0, 0]
