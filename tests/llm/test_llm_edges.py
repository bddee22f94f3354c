"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import decontaminate, kn_quality, line_dedup, minhash, near_vectors, packing, secrets, toxicity, url_filter, warc
from starling.llm.common import scratch

WORDS = [f"{a}{b}" for a in ("tor", "mel", "san", "vik", "ul", "pra", "den", "os") for b in ("a", "en", "il", "ost", "um", "er")]
CLASH = ["id", "key", "row", "kept", "segment", "length", "part", "hits", "label", "score", "component_id", "n_lines", "drop", "band",
         "version", "spans", "toxic", "item", "digest", "payload", "trusted_id", "lang_mean", "mean", "nll", "gone_id", "gone_version",
         "version_", "version_doc_id", "row_id", "row_version", "n", "hit_id", "hit_version", "line", "first"]


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def document_rows():
    rows = [(i, words(i, 60) + "\nShared footer line of the site.", "en", f"s{i % 12}") for i in range(24)]
    rows += [(100, None, "en", "s1"), (101, "", "en", "s2"), (102, "   \n\n ", None, "s3"), (103, words(3, 30_000), "en", None),
             (None, words(77, 40), "en", "s4"), (104, words(0, 60) + "\nShared footer line of the site.", "de", "s5"),
             (105, words(105, 50), None, None), (105, words(105, 50), None, None), (106, "one two", "en", "s0"),
             (107, "One  TWO", "en", "s0"), (108, "x" * 200_000, "en", "s0"), (109, "\ud83d\ude00 ñandú Äpfel 漢字 " * 30, "es", "s6")]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(a, b.encode("utf-16", "surrogatepass").decode("utf-16") if b else b, c, d)
                                for a, b, c, d in document_rows()], SCHEMA)
    return df.withColumn("n_chars", F.char_length("text").cast("long"))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, 0) for i in range(20)] + [(None, 1, 1), (100, None, None), (5, 1, 0), (106, 0, 1), (106, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, words(2, 15)), (2, "one two"), (3, None), (4, ""), (None, words(4, 12)), (1, words(2, 15))],
                                 "item_id long, text string")


def operators(docs_labels):
    labels, bench = docs_labels
    return {
        "minhash": lambda d: minhash.near_duplicates(d),
        "packing": lambda d: packing.pack(d),
        "secrets": lambda d: secrets.digest(secrets.scan(d)),
        "toxicity": lambda d: toxicity.rate(d, toxicity.train(d, labels)),
        "line_dedup": lambda d: line_dedup.remove_boilerplate(d).select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed", "n_left"),
        "decontaminate": lambda d: decontaminate.digest(decontaminate.find_contamination(d, bench, slop=2)),
        "quality": lambda d: kn_quality.classify(d, labels),
    }


def canon(df):
    return sorted((tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in df.collect()))


@pytest.mark.parametrize("name", ["minhash", "packing", "secrets", "toxicity", "line_dedup", "decontaminate", "quality"])
def test_every_case_has_a_result_whatever_the_other_columns(spark, docs, labels, bench, name):
    op = operators((labels, bench))[name]
    plain = op(docs).cache()
    clash = docs.select("*", *[F.lit("z").alias(c) for c in CLASH])
    if name == "packing":
        plain, other = plain.drop("sequence_id", "offset"), op(clash).drop("sequence_id", "offset")
        assert plain.where("piece = 0").count() == docs.count()
    else:
        other = op(clash)
        assert plain.count() == docs.count()
    assert canon(plain) == canon(other)
    empty = op(docs.limit(0))
    assert empty.count() == 0 and empty.columns == op(docs).columns


def test_pipeline_stages_keep_the_columns_of_documents(spark, docs, labels, bench):
    for out in (kn_quality.keep_good(docs, labels), line_dedup.clean_documents(docs), minhash.keep_one(docs, width=5, numerator=80),
                decontaminate.drop_contaminated(docs, bench)):
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert 0 < out.count() <= docs.count()


def test_pipeline_stages_take_clashing_names_and_empty_side_tables(spark, docs, labels, bench):
    repeated = docs.unionByName(docs.where("doc_id < 6"))
    clash = repeated.select("*", *[F.lit("z").alias(c) for c in CLASH])
    stages = [lambda d: kn_quality.keep_good(d, labels), line_dedup.clean_documents, lambda d: minhash.keep_one(d, width=5, numerator=80),
              lambda d: decontaminate.drop_contaminated(d, bench)]
    for stage in stages:
        out = stage(clash)
        assert out.columns == clash.columns and all(r["z"] == ["z"] for r in out.select(F.array_distinct(F.array(*CLASH)).alias("z")).collect())
        assert canon(out.select(*docs.columns)) == canon(stage(repeated))
    assert kn_quality.keep_good(docs, labels.limit(0)).count() == docs.count()
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_the_model_equals_its_tables_laid_out(spark, docs):
    orders = kn_quality.train(docs.select("text"))
    low = np.full(1, 1 / kn_quality.SYMBOLS)
    for k, rows in enumerate(orders):
        weight = np.ones(kn_quality.SYMBOLS ** k)
        got = rows.collect()
        weight[[r["context"] for r in got]] = [r["rest"] for r in got]
        # a gram that doesn't occur has its context's weight times the probability of its last symbols
        low = (weight[:, None] * (np.tile(low.reshape(-1, kn_quality.SYMBOLS), (kn_quality.SYMBOLS, 1)) if k else low)).reshape(-1)
        if not k:
            low = np.full(kn_quality.SYMBOLS, low[0])
        low[[r["gram"] for r in got]] = [r["p"] for r in got]
    codes = np.concatenate([np.array([r["gram"] for r in got]), np.random.default_rng(3).integers(0, kn_quality.SYMBOLS ** 4, 300_000)])
    found = kn_quality.Model(orders).log_probabilities(codes.astype(np.int32))
    assert np.allclose(found, np.log(np.maximum(low[codes], 1e-9)), atol=1e-4)


def test_segments_end_with_many_documents_without_words(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT_DOCUMENTS", 8)
    rows = [(i, None if i % 2 else "") for i in range(50)] + [(60, "alpha beta")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = decontaminate.build_index(df)
    assert sorted(len(r["doc_ids"]) for r in index.collect()) == [3] + [8] * 6
    item = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.find_contamination(df, item).where("size(hits) > 0").collect()] == [60]


def test_minhash_defined_results(docs):
    got = {(r["doc_id"], r["n_shingles"]): r for r in minhash.near_duplicates(docs).collect()}
    by_id = {k[0]: v for k, v in got.items()}
    assert by_id[104]["component_id"] == 0 and not by_id[104]["kept"]          # a copy of document 0
    assert by_id[100]["n_shingles"] == by_id[101]["n_shingles"] == by_id[102]["n_shingles"] == 0
    assert all(by_id[i]["kept"] for i in (100, 101, 102))
    assert by_id[107]["component_id"] == 106                                   # two words are one shingle, case and space aside
    assert by_id[105]["kept"] and by_id[None]["component_id"] is None


def test_decontamination_defined_results(docs, bench):
    got = {r["doc_id"]: r for r in decontaminate.digest(decontaminate.find_contamination(docs, bench)).collect()}
    assert got[106]["n_hit"] == 2 and got[106]["n_items"] == 1 and got[106]["items_sha256"] == hashlib.sha256(b"2").hexdigest()
    assert got[2]["contaminated"] and got[4]["contaminated"] and not got[5]["contaminated"]
    assert got[100]["n_words"] == 0 and got[100]["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_decontamination_in_blocks_equals_one_block(docs, bench):
    def run(**kw):
        return canon(decontaminate.digest(decontaminate.find_contamination(docs, bench, slop=2, **kw)))
    assert run() == run(block_bytes=40, segment_words=64)


def test_phrases_across_documents_or_out_of_order_are_no_hits(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    a = item.split()
    d = spark.createDataFrame([(1, " ".join(a[:5])), (2, " ".join(a[5:])), (3, " ".join(reversed(a))), (4, "x " + item.upper() + "! y"),
                               (5, " ".join(a[:4] + ["new"] + a[4:]))], "doc_id long, text string")
    b = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_near_items"]) for r in decontaminate.digest(decontaminate.find_contamination(d, b, slop=2)).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 0, 2: 0, 3: 0, 4: 10, 5: 0}
    assert got[4][1] == 1 and got[5][1] == 1 and got[1][1] == 0


def test_lines_keep_their_first_place_and_near_threshold_counts_are_exact(spark):
    rows = [(i, f"own line {i}\nwide line", f"s{i % 10}") for i in range(30)] + [(i, "nine sites\nrest", f"s{i % 9}") for i in range(50, 80)]
    rows += [(200, None, "s0"), (201, "", "s1"), (202, "wide line\nwide line", "s2")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_dedup.remove_boilerplate(d, min_sites=10).select("row.doc_id", "text", "n_removed").collect()}
    assert got[0]["text"] == "own line 0\nwide line" and got[1]["text"] == "own line 1"
    assert got[50]["text"] == "nine sites\nrest" and got[60]["n_removed"] == 0
    assert got[202]["n_removed"] == 2 and got[202]["text"] == "" and got[200]["text"] is None


def test_many_sites_follow_the_estimate(spark):
    d = spark.range(3000).selectExpr("id as doc_id", "concat('a', id, '\nsame') as text", "concat('site', id) as source")
    out = line_dedup.remove_boilerplate(d, min_sites=500).agg(F.sum("n_removed")).first()[0]
    assert out == 2999


def test_packed_pieces_rebuild_the_tokens(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    special = [(200, "before <|endoftext|> after"), (201, "<|endoftext|>"), (202, "glued<|endoftext|>word and more"), (203, "<|endoftext| >")]
    docs = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(special, "doc_id long, text string"))
    assert 50256 in t.encode(special[0][1], add_special_tokens=False).ids
    rows = packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), with_ids=True).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_doc, by_seq = {}, {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and r["length"] == len(r["ids"])
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        assert sum((r["ids"] for r in pieces), []) == t.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert all(r["length"] == 1024 for r in pieces[1:])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(by_seq) <= -(-total // 1024) + 1


def test_vectors_that_cannot_link_and_copies(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(1, base.tolist()), (2, base.tolist()), (3, (2 * base).tolist()), (4, (base + 0.05 * rng.standard_normal(16)).tolist()),
            (5, None), (6, [0.0] * 16), (7, [float("nan")] + [1.0] * 15), (8, [None] + [1.0] * 15), (9, []), (10, [1e300] * 16),
            (11, [1e-300] * 16), (12, (-base).tolist()), (13, [1.0, 2.0]), (None, base.tolist()), (2, base.tolist())]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in ("key", "n", "pass", "at")])
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in near_vectors.near_vectors(d).collect())
    assert got == sorted([(1, 5, 1), (2, 5, 1), (2, 5, 1), (3, 5, 1), (4, 5, 1), (0, 5, 1), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9),
                          (10, 1, 10), (11, 1, 10), (12, 0, 12), (13, 0, 13)])
    assert near_vectors.near_vectors(d.limit(0)).count() == 0


@pytest.mark.parametrize("single", [True, False])
def test_passes_find_what_brute_force_finds(spark, single):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((12, 24))
    x = np.concatenate([centres[rng.integers(0, 12, 500)] + 0.17 * rng.standard_normal((500, 24)), rng.standard_normal((700, 24))])
    x = x.astype(np.float32).astype(np.float64)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{'float' if single else 'double'}>")
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(d, window=128, block=256).collect()}     # many windows and passes
    want = links.sum(1)
    assert want.max() > 15
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.995 * want.sum() and all(got[i]["n_links"] <= want[i] for i in got)
    assert {i: r["n_links"] for i, r in ((r["vec_id"], r) for r in near_vectors.near_vectors(d, window=2048, block=4096).collect())} \
        == {i: int(n) for i, n in enumerate(want)}


def test_archive_round_trip(spark):
    big = "<p>é漢</p>" * 40
    rows = [(5, "http://a/x", big), (3, "http://b/\r\ny", big), (4, None, big), (9, "u", "small"), (8, "u", "small"), (7, "u", None), (6, "u", ""),
            (None, "u", big), (11, "v", "z" * 300_000), (5, "http://a/x", big)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(0).alias(c) for c in ("digest", "id", "payload")])
    path = scratch(spark, "warc-test")
    warc.archive(d, path)
    records = warc.read_archive(spark, path)
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.describe(records).collect())
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        revisit = len(body) >= 100 and html == big and i != 3
        want.append((i or 0, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2], r[3])) or sorted(map(str, got)) == sorted(map(str, want))
    assert spark.read.parquet(f"{path}/payloads").count() == 4                  # big, small, empty, long: once each
    whole = {r["page_id"]: bytes(r["record"]) for r in warc.record_bytes(records).collect()}
    head, _, body = whole[3].partition(b"\r\n\r\n")
    length = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")][0].split()[1])
    assert body[:length].endswith(big.encode()) and body[length:] == b"\r\n\r\n" and b"%0D%0A" in head
    assert b"WARC-Type: revisit" in whole[5] and big.encode() not in whole[5]
    empty = scratch(spark, "warc-empty")
    warc.archive(d.limit(0), empty)
    assert warc.describe(warc.read_archive(spark, empty)).count() == 0


def test_url_rules_and_terms(spark):
    rows = [(1, "https://www.EXAMPLE.com/en/a?q#f"), (2, "http://m.example.com/en/"), (3, "http://x.net/es/1"), (4, "http://x.net/de/1"), (5, None),
            (6, "no-scheme.com/en/"), (7, "http://x.com"), (8, "http://x.org/porn/1"), (9, "http://x.org/poker"), (10, "http://x.org/poker-casino"),
            (11, "http://x.org/pokerface/casinos"), (12, ""), (13, "http://a.b://c.com/x")]
    d = spark.createDataFrame(rows, "page_id long, url string").select("*", *[F.lit("q").alias(c) for c in ("id", "host", "path")])
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(d).collect()}
    assert got[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[2][2:] == ("example.com/en/", "block") and got[3][2:] == ("net/es/", "block") and got[4][2:] == (None, "allow")
    assert got[5] == got[6] == got[12] == ("", "", None, "allow") and got[7] == ("x.com", "", None, "allow")
    assert [got[i][3] for i in (8, 9, 10, 11)] == ["block", "allow", "block", "allow"]
    assert url_filter.judge_urls(d.limit(0)).count() == 0


def test_secret_spans(spark):
    rows = [(1, 'token = "abcdefgh1" AKIAABCDEFGHIJKL short=1'), (2, "secret=short AKIA12"), (3, "é" * 5 + "0123456789abcdef" * 2 + "!"),
            (4, 'BASE = "s3cr3tVALUE99"\ndb_passphrase = BASE'), (5, 'A = B\nB = A\npwd = A'), (6, None),
            (7, "\n".join(f"c{i} = c{i - 1}" for i in range(1, 4000)) + '\nc0 = "Zz19xY-77aq"\nclient_secret = c3999')]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.digest(secrets.scan(d)).collect()}
    assert (got[1]["n_assign"], got[1]["n_access"], got[1]["n_hex"]) == (1, 1, 0)
    assert got[1]["base_sha256"] == hashlib.sha256(b"assign:0:18,access:20:36").hexdigest()
    assert got[2]["n_assign"] == got[2]["n_access"] == 0 and got[3]["spans"] == "hex:5:37"
    assert got[4]["spans"] == "literal:8:21" and got[5]["spans"] == "" and got[6]["spans"] == ""
    assert "literal:" in got[7]["spans"]


def test_toxicity_ranks_severity_and_stays_quiet_on_clean_text(spark):
    rng = random.Random(3)
    bad = ["grumbfoul", "vexnast", "slurpig", "hatemong"]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(WORDS) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.choice([1, 4, 12])):
                text[rng.randrange(60)] = rng.choice(bad) + rng.choice(["", "o", "en"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] < 300], "doc_id long, toxic int")
    model = toxicity.train(d, known)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in toxicity.rate(d, model).collect()}
    held = [i for i in range(300, 400)]
    assert sum(got[i]["toxic"] == (i % 4 == 0) for i in held) >= 97
    many = spark.createDataFrame([(1, " ".join(bad * 3)), (2, WORDS[0] + " " + bad[0]), (3, WORDS[0])], "doc_id long, text string")
    e = {r["doc_id"]: r["expected_severity"] for r in toxicity.rate(many, model).collect()}
    assert e[1] > e[2] > e[3]


def test_quality_rejects_junk_and_keeps_clean_text(spark):
    rows = [(i, words(i, 80), "en") for i in range(300)]
    junk = [(1000, " ".join(w + "%%%" for w in words(1, 80).split()), "en"), (1001, words(2, 80).upper() + "!!", "en"),
            (1002, " | ".join(words(3, 80).split()), "en"), (1003, " ".join(w for w in words(4, 8).split() for _ in range(12)), "en"),
            (1004, words(5, 80), "xx"), (1005, words(6, 3), "en")]
    d = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in kn_quality.classify(d, labels).collect()}
    assert all(got[i] for i in range(300)) and not any(got[i] for i in (1000, 1001, 1002, 1003)) and got[1004] and got[1005]


def test_model_is_a_distribution_and_equals_its_definition(spark):
    """Interpolated modified Kneser-Ney computed plainly for some n-grams."""
    texts = [words(i, 200) for i in range(30)]
    model = kn_quality.Model(kn_quality.train(spark.createDataFrame([(t,) for t in texts], "text string")))
    p = np.exp(model.table()).reshape(-1, 64)
    seen = np.zeros(64 ** 3, bool)
    counts = {}
    for t in texts:
        s = bytes(3) + kn_quality.symbols(t.encode())
        for i in range(3, len(s)):
            g = tuple(s[i - 3:i + 1])
            counts[g] = counts.get(g, 0) + 1
            seen[(g[0] * 64 + g[1]) * 64 + g[2]] = True
    assert np.allclose(p[seen].sum(1), 1, atol=1e-3)

    orders = {4: counts}
    for k in (3, 2, 1):
        lower = {}
        for g in orders[k + 1]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        orders[k] = lower

    def discounts(c):
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 2 - 3 * y * n[2] / n[1])
        return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw)] if n[0] and n[1] else [0.5] * 3

    def prob(g):
        k = len(g)
        if not k:
            return 1 / 64
        c, d = orders[k], discounts(orders[k])
        same = {h: v for h, v in c.items() if h[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return prob(g[1:])
        own = max(c.get(g, 0) - (d[min(c[g], 3) - 1] if g in c else 0), 0) / total
        return own + sum(min(d[min(v, 3) - 1], v) for v in same.values()) / total * prob(g[1:])

    some = list(counts)[:25] + [g[:3] + (35,) for g in list(counts)[:5]]
    for g in some:
        assert abs(p[(g[0] * 64 + g[1]) * 64 + g[2], g[3]] - prob(g)) < 1e-5


def test_a_worker_keeps_one_object_at_a_time():
    from starling.llm import common
    made = []
    first = common.keep("a", lambda: made.append("a") or object())
    assert common.keep("a", lambda: made.append("again") or object()) is first and made == ["a"]
    common.keep("b", lambda: made.append("b") or object())
    assert common.keep("a", lambda: made.append("a2") or object()) is not first and made == ["a", "b", "a2"]
    common.release()
    common.keep("a", lambda: made.append("a3") or object())
    assert made[-1] == "a3"
    common.release()


def test_words_are_learnt_when_they_are_looked_up(monkeypatch):
    encoder = packing.Encoder(None)
    texts = ["some words, and some more", "öl und words\nwords and öl", "some 22 words!"]
    assert [encoder.encode(t) for t in texts] == [encoder.whole(t) for t in texts]
    assert encoder.later["unseen"] == encoder.whole(" unseen")
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 1)                 # forgotten words are learnt again, in the midst of a text
    assert [encoder.encode(t) for t in texts] == [encoder.whole(t) for t in texts]
