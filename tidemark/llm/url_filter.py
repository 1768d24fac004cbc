"""URL filter: host and path rules first, then a weighted vocabulary matched by an Aho-Corasick automaton.

A term counts where no letter or digit touches it. A url is blocked for one strict term or for several distinct soft
ones. A null url has no host, no path, no terms and is allowed; so is an empty one. Host and path are empty without
``://``, the vocabulary still reads the whole url, however long. Repeated rows are judged alike. An empty table gives no
rows.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
STRICT = ("porn", "xxx", "escort", "escorts", "camgirls", "cheap-pills", "spam-farm", "malware", "warez", "phishing")
SOFT = ("casino", "poker", "betting", "adult", "dating", "pills", "viagra", "loan", "loans", "crypto", "free", "cheap",
        "download", "torrent", "spam", "clickbait", "sexy", "nude")
SOFT_LIMIT = 2


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path in one text) and its verdict; null if none fits."""
    named = ended = None
    for verdict, domain, folder in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(folder)
        named = F.when(fits, domain + folder) if named is None else named.when(fits, domain + folder)
        ended = F.when(fits, verdict) if ended is None else ended.when(fits, verdict)
    return named, ended


@lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    machine = ahocorasick.Automaton()
    for kind, terms in ((1, soft), (0, strict)):
        for term in terms:
            machine.add_word(term, (kind, term))
    machine.make_automaton()
    return machine


def _counts(url: str, machine) -> tuple[int, int]:
    found = (set(), set())
    for last, (kind, term) in machine.iter(url):
        first = last - len(term) + 1
        before, after = url[first - 1] if first else "/", url[last + 1] if last + 1 < len(url) else "/"
        if not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum()):
            found[kind].add(term)
    return len(found[0]), len(found[1])


def term_counts(url: Column, strict=STRICT, soft=SOFT) -> Column:
    """Numbers of distinct strict and soft terms of a url, as struct<n_strict, n_soft>."""
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("n_strict long, n_soft long")
    def count(urls: pd.Series) -> pd.DataFrame:
        machine = _automaton(strict, soft)
        return pd.DataFrame([_counts(u, machine) for u in urls], columns=["n_strict", "n_soft"])

    return count(ascii_lower(F.coalesce(url, F.lit(""))))


def judged(pages: DataFrame, url: str = "url", rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """The pages with host, path, n_strict, n_soft, rule and verdict; columns with these names are replaced."""
    given = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "n_strict", "n_soft")]
    host, path = host_and_path(pages[url])
    frame = pages.select(F.struct(*[pages[c] for c in given]).alias("row"), host.alias("host"), path.alias("path"),
                         term_counts(pages[url], strict, soft).alias("terms"))
    named, ended = longest_rule(F.col("host"), F.col("path"), rules)
    bad = (F.col("terms.n_strict") >= 1) | (F.col("terms.n_soft") >= soft_limit)
    verdict = F.coalesce(ended, F.when(bad, "block").otherwise("allow"))
    return frame.select("row.*", "host", "path", named.alias("rule"), verdict.alias("verdict"), "terms.n_strict", "terms.n_soft")
