"""URL filters: host and path rules, then a weighted vocabulary counted by Aho-Corasick.

The host runs from after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path from there to ``?``, ``#``
or the end; a null url, or one without ``://``, has both empty.  A rule fits its host and all its subdomains when the
path starts with the rule's; the longest that fits decides.  Other urls are judged by their words: an automaton counts
strict and soft terms whose neighbours aren't ASCII letters or digits; one strict term blocks, or ``SOFT_TERMS`` distinct soft
terms that weigh ``SOFT_LIMIT`` together.

Edge cases: null or odd urls match no rule and no term and are allowed; a term that repeats in a url counts once; repeated
rows are judged alike; very long urls are read whole, in linear time; an empty table gives an empty result, and further
columns play no part.  The rules and the vocabulary are parameters, sent to the executors.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockweave.llm.shared import small_batches
from blockweave.llm.url_terms import SOFT, STRICT

#: Host, path, verdict.
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)
#: Weight of soft terms that blocks, and the least number of distinct ones: no soft term blocks alone.
SOFT_LIMIT, SOFT_TERMS = 2.0, 2


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and the rule's verdict."""
    host, path = F.col("host"), F.col("path")
    rule = verdict = F.lit(None).cast("string")
    for h, p, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("rule", rule).withColumn("ruled", verdict)


def vocabulary(terms: DataFrame) -> tuple[tuple[str, ...], dict[str, float]]:
    """Strict and soft terms of a table (term, weight); a null weight is a strict term.

    Terms are lower-cased; of equal ones the strict counts, else the highest weight.  The table is a parameter: it must fit the
    driver and the executors, a few million terms at most.
    """
    rows = terms.where("term is not null and term <> ''").select(F.lower("term").alias("term"), F.col("weight").cast("double").alias("weight"))
    found = rows.groupBy("term").agg(F.max(F.col("weight").isNull()).alias("strict"), F.max("weight").alias("weight")).collect()
    return tuple(sorted(r["term"] for r in found if r["strict"])), {r["term"]: r["weight"] for r in sorted(found) if not r["strict"]}


def automaton(strict=STRICT, soft=SOFT) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in soft.items():
        found.add_word(term, (term, weight))
    for term in strict:
        found.add_word(term, (term, None))
    found.make_automaton()
    return found


def _plain(char: str) -> bool:
    return char.isascii() and char.isalnum()


def count_terms(found: ahocorasick.Automaton, url: str) -> tuple[int, int, float]:
    """Strict hits, and number and weight of distinct soft terms."""
    url, strict, soft = url.lower(), 0, {}
    if not len(found):
        return 0, 0, 0.0
    for end, (term, weight) in found.iter(url):
        start = end - len(term) + 1
        if (start and _plain(url[start - 1])) or (end + 1 < len(url) and _plain(url[end + 1])):
            continue
        if weight is None:
            strict += 1
        else:
            soft[term] = weight
    return strict, len(soft), float(sum(soft.values()))


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=None, soft_limit: float = SOFT_LIMIT, soft_terms: int = SOFT_TERMS) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits and soft_weight."""
    soft = dict(SOFT if soft is None else soft)
    kind = dict(pages.dtypes)["page_id"]
    names = ["page_id", "host", "path", "rule", "ruled", "strict_hits", "soft_hits", "soft_weight"]

    def run(batches):
        found = automaton(strict, soft)
        for batch in batches:
            counts = [count_terms(found, url.as_py() or "") for url in batch.column("url")]
            found_counts = [pa.array([c[i] for c in counts], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64()))]
            yield pa.record_batch([*(batch.column(c) for c in names[:5]), *found_counts], names=names)

    ruled = with_rule(pages.select("page_id", "url"), rules)
    counted = ruled.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, ruled string, strict_hits int, soft_hits int, soft_weight double")
    own = F.when((F.col("strict_hits") > 0) | ((F.col("soft_hits") >= soft_terms) & (F.col("soft_weight") >= soft_limit)), "block").otherwise("allow")
    return counted.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "strict_hits", "soft_hits", "soft_weight")


def op5_url_filters(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    fits = [(h, p, v, f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))") for h, p, v in sorted(RULES, key=lambda r: (-len(r[0]) - len(r[1]), r))]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for h, p, _, f in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for _, _, v, f in fits)
    word = lambda terms: rf"'(^|[^a-z0-9])({terms})($|[^a-z0-9])'"
    weighed = [(w, "|".join(t for t, x in SOFT.items() if x == w)) for w in sorted(set(SOFT.values()))]
    # every run of ASCII letters and digits is a word, so that terms, which hold nothing else, are among a url's words
    soft = " + ".join(f"{w} * len(list_filter(said, lambda x: regexp_full_match(x, '{t}')))" for w, t in weighed)
    hits = f"len(list_filter(said, lambda x: regexp_full_match(x, '{'|'.join(SOFT)}')))"
    return rf"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw_host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, lower(coalesce(url, '')) AS low FROM pages),
p AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path, low, list_distinct(regexp_extract_all(low, '[a-z0-9]+')) AS said FROM u)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN regexp_matches(low, {word('|'.join(STRICT))}) OR ({hits} >= {SOFT_TERMS} AND {soft} >= {SOFT_LIMIT}) THEN 'block' ELSE 'allow' END AS verdict FROM p
"""


SQL = _sql()
