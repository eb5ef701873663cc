"""URL filters: host/path rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

A url's host runs from after the first ``://`` to ``/``, ``?``, ``#`` or its end (A-Z lower-cased), its
path from there to ``?``, ``#`` or its end; without ``://`` both are empty. The longest rule that fits
(host and all its subdomains, path prefix) gives the verdict. Other urls are blocked if one strict term
or at least `soft_limit` distinct soft terms stand in them, each with no letter or digit on either side.

Defined cases: a null or empty url has empty host and path, no rule and the verdict allow; repeated
rows are judged alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The production rules (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Terms of which one rejects, and terms of which several distinct ones reject.
STRICT = ("adult", "casino", "escort", "hentai", "jackpot", "milf", "porn", "viagra", "warez", "xxx")
SOFT = (
    "ads", "bet", "bets", "betting", "bonus", "buy", "cheap", "click", "coupon", "dating", "deals", "discount", "farm", "free",
    "gamble", "hot", "loan", "loans", "nude", "pills", "poker", "prize", "promo", "sex", "sexy", "slots", "spam", "track", "win",
)
SOFT_LIMIT = 2
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    """An Aho-Corasick automaton over all terms; a term's value is (term, is strict)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for term in soft:
        a.add_word(term, (term, False))
    for term in strict:
        a.add_word(term, (term, True))
    a.make_automaton()
    return a


def rejects(url: str | None, a, soft_limit: int) -> bool:
    url = (url or "").translate(_LOWER)
    seen = set()
    for end, (term, is_strict) in a.iter(url):
        start = end - len(term)
        if (start < 0 or url[start] not in _ALNUM) and (end + 1 >= len(url) or url[end + 1] not in _ALNUM):
            if is_strict:
                return True
            seen.add(term)
            if len(seen) >= soft_limit:
                return True
    return False


_LOWER = str.maketrans(UPPER, SMALL)
_ALNUM = frozenset(SMALL + "0123456789")


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of `pages` (page_id, url)."""

    @F.pandas_udf("boolean")
    def by_terms(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = automaton(tuple(strict), tuple(soft))
        for s in urls:
            yield s.map(lambda u: rejects(u, a, soft_limit), na_action=None).astype(bool)

    out = pages.select(
        "page_id",
        "url",
        F.translate(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?s).*?://([^/?#]*)", 1), UPPER, SMALL).alias("host"),
        F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # the longest is tested first
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    out = out.withColumns({"rule": rule, "_says": verdict})
    blocked = F.when(by_terms("url"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("_says", blocked).alias("verdict"))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


def _oracle() -> str:
    longest_first = sorted(RULES, key=lambda r: -len(r[0]) - len(r[1]))
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    soft = " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::int" for t in SOFT)
    return f"""
    WITH p AS (
      SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{SMALL}') AS u,
        translate(regexp_extract(coalesce(url, ''), '^(?s).*?://([^/?#]*)', 1), '{UPPER}', '{SMALL}') AS host,
        regexp_extract(coalesce(url, ''), '^(?s).*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, host, path,
      CASE {" ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest_first)} END AS rule,
      CASE {" ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest_first)}
        WHEN regexp_matches(u, '(^|[^a-z0-9])({"|".join(STRICT)})([^a-z0-9]|$)') OR {soft} >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
    FROM p"""


ORACLE = _oracle()
