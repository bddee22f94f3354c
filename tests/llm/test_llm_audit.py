"""Fingerprints, divergence audit and vector codes against brute force, with every odd case."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import divergence, fingerprints, vector_codes

CLASH = ["id", "last", "version", "at", "part", "extra", "to", "size", "term", "n", "shard", "place", "item", "value", "rank", "total",
         "code", "error", "comps", "near", "dim", "entry", "hash", "row", "of_label"]
WORDS = "stone river quiet Market über straße naïve LONG tale of the ship ça 漢字".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def document_rows():
    rows = [(i, prose(i, 40) + f" only{i}x", ["en", "de"][i % 2], f"s{i % 5}") for i in range(30)]
    rows += [(40, None, "en", "s1"), (41, "", None, None), (42, "12 34 !?", "fr", "quiet"), (43, prose(43, 4000), "en", "s0"),
             (None, prose(44, 30), "en", "s1"), (None, prose(44, 30), "en", "s1"), (None, prose(45, 30), "", ""),
             (5, prose(5, 40) + " only5x", "de", "s0"), (5, prose(46, 20), "de", "s0"), (47, "a" * 50_000, "en", "s2"), (48, "one two", "en", "s2")]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def with_clash(df):
    return df.select("*", *[F.lit("z").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(5, "text")


# ---- fingerprints ----

def brute_shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def check_fingerprints(rows, got, order):
    by_text = {}
    assert len(got) == len(rows)
    want = Counter()
    for i, r in enumerate(order):
        text, following = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        want[(r[0], len(text), hashlib.sha256((text[:len(text) - cut] + following[:cut]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    for r in got:
        assert by_text.setdefault(r.fingerprint, r.n_chars) == r.n_chars or r.n_chars < 10
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


@pytest.mark.parametrize("part_bytes", [300, 1 << 20])
def test_fingerprints_meet_the_next_document_across_ranges(spark, part_bytes):
    rows = [(3 * i, prose(i, 20 + i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = fingerprints.fingerprints(df, part_bytes=part_bytes).collect()
    check_fingerprints(rows, got, rows)
    near = {r.doc_id: r.near_edited for r in got}
    for i, (k, text) in enumerate(rows):
        a, b = brute_shingles(text), brute_shingles(fingerprints.edited(text, rows[(i + 1) % len(rows)][1]))
        assert abs(near[k] - len(a & b) / len(a | b)) < 5 * math.sqrt(0.25 / fingerprints.PERMUTATIONS)


def test_fingerprints_of_odd_rows(spark, docs):
    got = fingerprints.fingerprints(docs).collect()
    # of rows that repeat an id, the order is that of the text hashes
    version = {r.text: r.v for r in docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("v")).collect()}
    order = sorted(document_rows(), key=lambda r: (r[0] is None, r[0] or 0, version[r[1] or ""]))
    check_fingerprints(document_rows(), got, order)
    assert rows_of(fingerprints.fingerprints(with_clash(docs))) == rows_of(fingerprints.fingerprints(docs))
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0
    empty = {r.doc_id: r for r in got}
    assert empty[40].fingerprint == empty[41].fingerprint and empty[40].near_edited == 1 and empty[41].near_next < 1


def test_one_document_is_its_own_next(spark):
    row, = fingerprints.fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1


def test_one_row_repeated_is_cut_into_ranges(spark):
    rows = [(7, prose(1, 30))] * 300 + [(i, prose(i, 30)) for i in range(20, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check_fingerprints(rows, fingerprints.fingerprints(df, part_bytes=2000).collect(), rows)
    sizes = [r["count"] for r in fingerprints._in_ranges(df, "doc_id", "text", 2000).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 100


def near_rows():
    """Distinct texts, edits of several sizes, a chain of edits whose ends are no pair, copies, and odd rows."""
    rng = random.Random(5)
    rows = []
    for k in range(12):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(160)]
        for e in range(6):
            rows.append((100 * k + e, " ".join(words)))
            at = rng.randrange(0, 150)
            words = words[:at] + [f"v{rng.randrange(10 ** 6)}" for _ in range(rng.choice([1, 2, 4]))] + words[at + rng.randrange(4):]
    rows += [(2000 + i, rows[i][1].upper()) for i in range(0, 30, 7)]
    return rows + [(3000, None), (3001, ""), (3002, "two words"), (3003, "Two\nWORDS"), (None, rows[0][1]), (0, rows[0][1])]


def brute_components(rows):
    sets = [brute_shingles(t or "") for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for (k, _), x in zip(rows, label):
        if k is not None:
            least[x] = min(k, least.get(x, k))
    return sorted((str(k), len(s), str(least.get(x))) for (k, _), s, x in zip(rows, sets, label))


@pytest.mark.parametrize("tile_bytes", [8000, 8 << 20])
def test_near_documents_equal_brute_force(spark, tile_bytes):
    rows = near_rows()
    df = with_clash(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = fingerprints.near_documents(df, tile_bytes=tile_bytes).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    sizes = Counter(r.component_id for r in got)
    assert max(sizes.values()) > 3 and len(sizes) > 14


def test_near_documents_of_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints.near_documents(empty).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert fingerprints.near_documents(empty).count() == 0


# ---- divergence ----

def brute_audit(rows, top=200):
    docs = [(r[2] or "", r[3] or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in
                                      re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[1] or "")]) for r in rows]
    spread = Counter((lang, w) for lang, _, words in docs for w in set(words))
    kept = defaultdict(set)
    for (lang, w), n in spread.items():
        if n >= 3:
            kept[lang].add(w)
    counts = {(lang, s): Counter() for lang, s, _ in docs}
    for lang, s, words in docs:
        counts[lang, s].update(w for w in words if w in kept[lang])
    whole = defaultdict(Counter)
    for (lang, _), c in counts.items():
        whole[lang].update(c)

    def share(c, lang):
        total = sum(c.values()) + len(kept[lang])
        return {w: 1 + 10 ** 9 * (c[w] + 1) // total for w in kept[lang]}

    out = []
    for (lang, s), c in counts.items():
        p, q = share(c, lang), share(whole[lang], lang)
        pairs = []
        for (other_lang, o), d in counts.items():
            if other_lang == lang and o != s:
                r = share(d, lang)
                pairs.append((o, sum((p[w] - r[w]) ** 2 // r[w] for w in kept[lang])))
        terms = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept[lang] if c[w] > 0 and p[w] > q[w]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(x, lang, part, k + 1, s, v) for k, (x, v) in enumerate(found[:most])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_divergences_equal_brute_force(spark, docs, small, monkeypatch):
    if small:                                              # many shards, blocks, flushes and pieces
        monkeypatch.setattr(divergence, "SHARD_TERMS", 4)
        monkeypatch.setattr(divergence, "CELLS", 12)
        monkeypatch.setattr(divergence, "TERMS_HELD", 10)
        monkeypatch.setattr(divergence, "SLOTS_HELD", 5)
    got = rows_of(divergence.audit(docs, top=4 if small else 200, block_bytes=500 if small else 1 << 20))
    assert got == brute_audit(document_rows(), 4 if small else 200)


def test_divergences_of_other_columns_and_no_rows(spark, docs):
    assert rows_of(divergence.audit(with_clash(docs))) == rows_of(divergence.audit(docs))
    assert divergence.audit(docs.limit(0)).count() == 0


def test_a_language_without_kept_terms_has_pairs_of_zero(spark):
    df = spark.createDataFrame([(1, "a b", "xx", "s"), (2, "c d", "xx", "t"), (3, None, "xx", None)], SCHEMA)
    assert rows_of(divergence.audit(df)) == brute_audit([(1, "a b", "xx", "s"), (2, "c d", "xx", "t"), (3, None, "xx", None)])


def test_perfect_hash_is_minimal_and_knows_its_terms():
    for n in (0, 1, 2, 70, 5000):
        terms = [f"w{i}".encode() for i in range(n)]
        h = divergence.PerfectHash.unpacked(divergence.PerfectHash.packed(terms))
        if n:
            slots = h.slots(terms, divergence.hashes_of(terms))
            assert sorted(slots.tolist()) == list(range(n))
            assert [sorted(terms)[k] for k in h.order[slots].tolist()] == terms
            other = [f"x{i}".encode() for i in range(2000)]
            assert (h.slots(other, divergence.hashes_of(other)) == -1).all()


def test_perfect_hash_of_equal_hashes(monkeypatch):
    monkeypatch.setattr(divergence, "hashes_of", lambda terms: np.array([len(t) for t in terms], np.uint64))
    terms = [b"aa", b"bb", b"cc", b"d", b"eeee"]
    h = divergence.PerfectHash.unpacked(divergence.PerfectHash.packed(sorted(terms)))
    assert sorted(h.slots(terms, divergence.hashes_of(terms)).tolist()) == [0, 1, 2, 3, 4]
    assert h.slots([b"xx", b"yyy"], divergence.hashes_of([b"xx", b"yyy"])).tolist() == [-1, -1]


def test_shares_are_exact_for_great_counts():
    counts, total = np.array([0, 5, 10 ** 15 - 1, 4 * 10 ** 15]), np.int64(4 * 10 ** 15 + 7)
    assert divergence.shares(counts, total).tolist() == [1 + 10 ** 9 * (int(c) + 1) // int(total) for c in counts]


# ---- vector codes ----

def brute_codes(rows, entries=256, rounds=4):
    rows = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * x) for x in r[1]]))
    x = [[math.floor(1024 * v) for v in r[1]] for r in rows]
    d = len(x[0]) // 4
    parts = [[v[k * d:(k + 1) * d] for v in x] for k in range(4)]
    books = [[list(v) for v in p[:entries]] for p in parts]

    def assign(k):
        return [min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[k])) for v in parts[k]]

    for _ in range(rounds):
        for k in range(4):
            members = defaultdict(list)
            for v, (_, i) in zip(parts[k], assign(k)):
                members[i].append(v)
            for i, m in members.items():
                books[k][i] = [sum(c) // len(m) for c in zip(*m)]
    found = [assign(k) for k in range(4)]
    errors = [sum(found[k][i][0] for k in range(4)) for i in range(len(rows))]
    labels = defaultdict(int)
    for r, e in zip(rows, errors):
        labels[r[2]] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((("".join(f"{found[k][i][1]:02x}" for k in range(4))), digest, errors[i], labels[r[2]], r[0])
                   for i, r in enumerate(rows)), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(n=400, dim=8):
    rng = np.random.default_rng(5)
    rows = [(int(3 * i), (rng.integers(-3, 4, dim) / 2).tolist() if i % 2 else rng.normal(size=dim).astype(np.float32).tolist(),
             None if i % 9 == 0 else i % 4) for i in range(n)]
    rows += [(1, None, 1), (2, [1.0, None] * (dim // 2), 1), (4, [float("nan")] * dim, 1), (5, [float("inf")] + [0.0] * (dim - 1), 1),
             (7, [0.0] * dim, 2), (7, [0.0] * dim, 2), (7, [0.5] * dim, 2), (None, [0.25] * dim, None), (8, [-1e-9] * dim, 3)]
    return rows


def test_codes_equal_brute_force(spark):
    df = spark.createDataFrame(vector_rows(), VECTORS).repartition(5)
    got = vector_codes.report(vector_codes.encode(df))
    assert rows_of(got) == brute_codes(vector_rows())
    assert rows_of(vector_codes.report(vector_codes.encode(with_clash(df)))) == rows_of(got)
    assert rows_of(vector_codes.report(vector_codes.encode(df, pivots=1))) == rows_of(got)


def test_codes_of_fewer_rows_than_entries(spark):
    rows = vector_rows(20)
    assert rows_of(vector_codes.report(vector_codes.encode(spark.createDataFrame(rows, VECTORS)))) == brute_codes(rows)


def test_codes_of_no_rows_other_lengths_and_great_components(spark):
    df = spark.createDataFrame(vector_rows(20), VECTORS)
    assert vector_codes.report(vector_codes.encode(df.limit(0))).count() == 0
    odd = spark.createDataFrame([(901, [1.0] * 12, 1), (902, [], 1), (903, [1e30] * 8, 1)], VECTORS)
    got = {r.vec_id: r for r in vector_codes.report(vector_codes.encode(df.unionByName(odd))).collect()}
    assert [got[k].code for k in (901, 902, 903)] == [None] * 3 and got[3].code is not None
    plain = {r.vec_id: (r.code, r.error) for r in vector_codes.report(vector_codes.encode(df)).collect()}
    assert all(plain[k] == (got[k].code, got[k].error) for k in plain)


def test_pruned_search_equals_the_full_one():
    rng = np.random.default_rng(1)
    x, book = rng.integers(-2000, 2000, (3000, 16)), rng.integers(-2000, 2000, (256, 16))
    book[40] = book[7]
    x[:50] = book[40]
    fixed = vector_codes.chosen_pivots(book, 16)
    at, best, evaluated = vector_codes.nearest(x, vector_codes.pivot_distances(x, fixed), book, vector_codes.pivot_distances(book, fixed))
    full = ((x[:, None, :] - book[None]) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (best == full.min(1)).all() and evaluated < full.size
