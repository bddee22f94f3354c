"""URL filter: ordered rules by longest match, then a weighted vocabulary counted by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strict terms weigh a whole rejection, soft terms a part of one.
STRICT = ("porn", "xxx", "hentai", "camgirl", "escort", "warez", "phishing", "malware")
SOFT = {"casino": 0.5, "poker": 0.5, "betting": 0.5, "adult": 0.5, "sex": 0.5, "nude": 0.5, "dating": 0.5, "viagra": 0.5,
        "crack": 0.5, "torrent": 0.5, "loan": 0.5, "pills": 0.5}
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))


def url_parts(url) -> tuple:
    """``(host, path)`` columns: host between the first ``://`` and ``/ ? #`` (A-Z lower-cased), path up to ``? #``.

    A null url and one without ``://`` give two empty texts.
    """
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host, path, rules: Sequence[tuple[str, str]]) -> tuple:
    """``(rule, verdict)`` columns of the longest fitting rule, null without one.

    A rule ``h/p`` fits host ``h`` and its subdomains when the path starts with ``/p``. Hosts that fit are suffixes of
    one another, so the longest host wins, then the longest path.
    """
    ordered = sorted(rules, key=lambda r: (-r[0].index("/"), -len(r[0]), r[0]))
    rule = verdict = None
    for text, decision in ordered:
        rule_host, rule_path = text[:text.index("/")], text[text.index("/"):]
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    return (rule, verdict) if ordered else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def build_automaton(strict: Sequence[str], soft: Mapping[str, float]) -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for term in strict:
        words.add_word(term.lower(), (term.lower(), True, 1.0))
    for term, weight in soft.items():
        if term.lower() not in words:
            words.add_word(term.lower(), (term.lower(), False, float(weight)))
    words.make_automaton()
    return words


def _alnum(c: str) -> bool:
    return c.isascii() and c.isalnum()


def count_terms(words: ahocorasick.Automaton, url: str) -> tuple[int, int, float]:
    """Strict hits, distinct soft hits and their weight; a hit needs no ASCII letter or digit on either side."""
    text, strict, soft = url.lower(), 0, {}
    for end, (term, is_strict, weight) in words.iter(text):
        start = end - len(term) + 1
        if (start and _alnum(text[start - 1])) or (end + 1 < len(text) and _alnum(text[end + 1])):
            continue
        if is_strict:
            strict += 1
        else:
            soft[term] = weight
    return strict, len(soft), sum(soft.values())


def judge_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               strict: Sequence[str] = STRICT, soft: Mapping[str, float] = SOFT, soft_weight: float = 1.0) -> DataFrame:
    """One row per row of ``pages``: id, url, host, path, rule, verdict, n_strict, n_soft, soft_weight.

    The verdict is the longest fitting rule's; without one it is ``block`` on one strict term or on distinct soft terms
    that weigh ``soft_weight`` together, else ``allow``. Null and empty urls have empty host and path, no hits and are
    allowed. Repeated rows are judged each; an empty table gives an empty result; other columns are not read.
    A narrow map: no shuffle, and the automaton is a parameter of fixed size.
    """
    strict, soft = tuple(strict), dict(soft)
    fields = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = build_automaton(strict, soft)
        for batch in batches:
            rows = [count_terms(words, u) if u and len(words) else (0, 0, 0.0) for u in batch.column("url").to_pylist()]
            n, d, w = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(n, pa.int64()),
                                              pa.array(d, pa.int64()), pa.array(w, pa.float64())],
                                             names=["id", "url", "n_strict", "n_soft", "soft_weight"])

    id_type = fields.schema["id"].dataType.simpleString()
    hits = fields.mapInArrow(count, f"id {id_type}, url string, n_strict long, n_soft long, soft_weight double")
    host, path = url_parts(F.col("url"))
    hits = hits.select("*", host.alias("host"), path.alias("path"))
    rule, ruled = matching_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("soft_weight") >= soft_weight), "block").otherwise("allow")
    return hits.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path", rule.alias("rule"),
                       F.coalesce(ruled, by_terms).alias("verdict"), "n_strict", "n_soft", "soft_weight")
