"""The secret scan against a matcher written by hand, its lexer on ordinary lines, and linear time on hostile texts."""

import hashlib
import random
import string
import time

import pytest

from starling.llm import secrets

VALUE = set(string.ascii_letters + string.digits + "+/_.=-")
ACCESS = set(string.ascii_uppercase + string.digits)
HEX = set(string.digits + "abcdef")


def run_end(text, at, allowed):
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def assign_at(text, at):
    """``(start of the value, end)`` of an assignment that starts at ``at``, else None."""
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key"):
        if word != "api-key" and "".join(c.lower() if c in string.ascii_uppercase else c for c in text[at:at + len(word)]) == word:
            at += len(word)
            break
    else:
        return None
    at += text[at:at + 1] in ('"', "'")
    at = run_end(text, at, " ")
    if text[at:at + 1] not in (":", "="):
        return None
    at = run_end(text, at + 1, " ")
    at += text[at:at + 1] in ('"', "'")
    end = run_end(text, at, VALUE)
    return (at, end) if end > at else None


def by_hand(text):
    spans, at = [], 0
    while at < len(text):
        hit = assign_at(text, at)
        if hit and hit[1] - hit[0] >= 8:
            spans.append((at, 0, hit[1]))
        at = hit[1] if hit else at + 1
    for kind, prefix, allowed, least in ((1, "AKIA", ACCESS, 16), (2, "", HEX, 32)):
        at = 0
        while at < len(text):
            end = run_end(text, at + len(prefix), allowed) if text.startswith(prefix, at) else at
            found = end > at + len(prefix)
            if found and end - at >= least:
                spans.append((at, kind, end))
            at = end if found else at + 1
    return [f"{secrets.KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans)]


def texts():
    rng = random.Random(11)
    pieces = ["password", "PassWD", "secret", "Token", "api_key", "APIKEY", "paſſword", "toKen", '"', "'", " ", "  ", "\n", "=", ":", "==",
              "AKIA", "AKIAAKIA", "Z9", "deadbeef", "0123456789abcdef", "abc", "x.y/z+w", "-", "é", "\U0001f600", ";", "#", "//", "${a}", "pwd"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    return [*out, None, "", " ", 'password="' + "a" * 50_000 + '"', "é" * 9 + "token: 'abcd.efgh'", "token=token=token=short", "secret=secret=abcdefgh"]


def test_digest_equals_the_matcher_by_hand(spark):
    from starling.llm.queries import QUERIES
    rows = list(enumerate(texts()))
    d = spark.createDataFrame([*rows, (None, "token=abcdefgh1"), rows[3]], "doc_id long, text string")
    given = "/root/testdata/sf0.001"
    for table, got in ((d, secrets.digest(secrets.scan(d))),
                       (spark.read.parquet(f"{given}/documents.parquet"), QUERIES["op4_secret_scan"](spark, given))):
        want = []
        for r in table.select("doc_id", "text").collect():
            spans = by_hand(r["text"] or "")
            want.append((r["doc_id"], *[sum(s.startswith(k + ":") for s in spans) for k in secrets.KINDS[:3]],
                         hashlib.sha256(",".join(spans).encode()).hexdigest()))
        found = [(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got.collect()]
        order = lambda r: (r[0] is None, r)
        assert sorted(found, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("text, values", [
    ('url = https://x.y/z; pwd = "Abc12345x"', ["Abc12345x"]),
    ('# pwd = "Abc12345x"', ["Abc12345x"]),
    ("//auth=Zz19xY-77aq", ["Zz19xY-77aq"]),
    ("don't set pwd=Abc12345x, it's", ["Abc12345x"]),
    ('pwd = "abcdefghijklmnopqrstuvwxyzqwert"', ["abcdefghijklmnopqrstuvwxyzqwert"]),
    ('passphrase = "correct horse battery staple"', ["correct horse battery staple"]),
    ('app_pwd: "abcd efgh ijkl mnop"', ["abcd efgh ijkl mnop"]),
    ('auth="Zz19xY-77aq"', ["Zz19xY-77aq"]),
    ("auth= QWxhZGRpbjpvcGVuc2VzYW1l==\n", ["QWxhZGRpbjpvcGVuc2VzYW1l=="]),
    ('k = b"Zz19xY-77aq"\nauth = k', ["Zz19xY-77aq"]),
    ('{"private_key":"Zz19xY-77aq","other":1}', ["Zz19xY-77aq"]),
    ('pwd = "Abc12345x" // + "Abc12345y"', ["Abc12345x"]),
    ('password: "Please enter your password"', []),
    ('pwd = "short" # Abc12345x', []),
    ("The session: internationalization", []),
])
def test_literals_of_ordinary_lines(text, values):
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == values


def test_each_constant_counts_with_the_greatest_weight_that_reaches_it():
    text = 'a = "Zz19xY-77aq"\nsession = a\nb = a\nclient_secret = b\n'
    cycle = 'x = y\ny = x\ny = "Zz19xY-77aq"\nsession = x\npwd = x\n'
    for t in (text, cycle, "\n".join(reversed(text.splitlines()))):
        assert [t[a:b] for _, a, b in secrets.lexed_spans(t)] == ["Zz19xY-77aq"]
    assert secrets.lexed_spans('session = "abcdefgh"') == []
    assert secrets.lexed_spans('a = "Zz19xY-77aq"\nb = a\npwd = b\nb = pwd\n') == []        # the latest assignment counts


@pytest.mark.parametrize("unit", ["a/", "a.", "a=", "a:", '"', '"\\', "' \\", "{{ ", "${a", "//", "# ", "=", "a= ", " ", "A", "b'", "\n", "`a", "password=", "key='"])
def test_time_is_linear(unit):
    def seconds(n):
        start = time.perf_counter()
        secrets.all_spans(unit * (n // len(unit)) + "! =")
        return time.perf_counter() - start
    assert seconds(400_000) < 20 * seconds(100_000) + 0.5


def test_many_names_over_one_chain_of_constants():
    text = "\n".join(f"c{i} = c{i - 1}\nclient_secret{i} = c{i}" for i in range(1, 20_000)) + '\nc0 = "Zz19xY-77aq"'
    start = time.perf_counter()
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == ["Zz19xY-77aq"]
    assert time.perf_counter() - start < 20
