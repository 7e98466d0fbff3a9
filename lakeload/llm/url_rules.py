"""Operator 13: URL filters by pattern rules, indexed by their rarest literal token.

A rule is a pattern over a url's address, which is its lower-cased host (after the first ``://`` up to ``/``, ``?``,
``#`` or the end) and all that follows it. In a pattern ``||`` at the start stands for the start of the host or of one
of its parent domains, ``^`` for an end of the address or any character but ASCII letters and digits, ``*`` for
anything; every other character stands for itself.

Index. The tokens of an address are its maximal runs of a-z and 0-9 (after lower-casing A-Z). A run in a pattern that
has ``||``, ``^`` or another literal character on either side is a whole token of every address that the pattern fits.
One pass over the urls counts in how many of them each such token occurs; every rule is filed under the rarest of its
tokens (ties to the smaller one), a rule without any under "always". The tokens of an address fetch its candidate
rules, and only those run their regular expression.

Verdict. ``SITES`` rules are a host and the start of a path; they keep the case of the path, and the longest that fits
gives ``rule`` and ``verdict``. Where none fits, the ``PATTERNS`` decide, after lower-casing A-Z: ``allow`` if one of
the exceptions fits, else ``block`` if any other pattern fits, else ``allow``; the deciding pattern, the longest
(ties to the smaller), is returned too.

The rules are a list on the driver, of at most ``MOST_BYTES``; tasks hold them and one batch of urls.

Defined results: a NULL url, or one without ``://``, has an empty host and path, no rule and the verdict ``allow``; each row
is judged on its own, so repeated rows and NULL ids keep theirs; an empty table gives no rows; columns other than
``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import read_table

MOST_BYTES = 32 << 20     # of all rules together, as every task holds them
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
TOKEN = re.compile("[a-z0-9]+")

# The site rules of the contract.
SITES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]
# The patterns of the method: pages that carry no prose of their own, and kinds of sites that are left out.
PATTERNS = [
    ("||wikipedia.org/", "allow"),
    ("||wikimedia.org/", "allow"),
    ("^porn^", "block"),
    ("^xxx^", "block"),
    ("^casino^", "block"),
    ("^viagra^", "block"),
    ("^torrent^", "block"),
    ("^doubleclick^", "block"),
    ("/wp-admin/", "block"),
    ("/wp-login.php", "block"),
    ("/cgi-bin/", "block"),
    ("/login^", "block"),
    ("/signin^", "block"),
    ("/signup^", "block"),
    ("/register^", "block"),
    ("/cart^", "block"),
    ("/checkout^", "block"),
    ("/search?", "block"),
    ("?s=", "block"),
    ("^sessionid=", "block"),
    ("^phpsessid=", "block"),
    ("^replytocom=", "block"),
    ("?page=*&ref=", "block"),
    (".exe^", "block"),
    (".apk^", "block"),
    (".zip^", "block"),
]


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str
    site: str | None = None      # the name of a site rule

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"{self.pattern}: {self.verdict!r} is no verdict")

    @property
    def regex(self) -> str:
        body, start = (self.pattern[2:], r"^(?:[^/?#]*\.)?") if self.pattern.startswith("||") else (self.pattern, "")
        special = {"*": "(?:.|\n)*", "^": "(?:^|$|[^0-9A-Za-z])"}
        return start + "".join(special.get(c) or re.escape(c) for c in body)

    @property
    def tokens(self) -> list[str]:
        """Literal runs that are whole tokens of every address that fits."""
        text = self.pattern.translate(LOWER)
        text = "^" + text[2:] if text.startswith("||") else text
        inner = lambda a, b: 0 < a and b < len(text) and "*" not in (text[a - 1], text[b])
        return sorted({m[0] for m in TOKEN.finditer(text) if inner(*m.span())})


def site_rules(sites: Iterable[tuple[str, str]] = SITES) -> list[Rule]:
    return [Rule("||" + name, verdict, name) for name, verdict in sites]


def pattern_rules(patterns: Iterable[tuple[str, str]] = PATTERNS) -> list[Rule]:
    return [Rule(pattern, verdict) for pattern, verdict in patterns]


def address_of(url: str | None) -> tuple[str, str]:
    """Host, lower-cased, and what follows it; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    return rest[:end].translate(LOWER), rest[end:]


def path_of(tail: str) -> str:
    return re.split("[?#]", tail, maxsplit=1)[0]


def tokens_of(url: str | None) -> set[str]:
    return set(TOKEN.findall("".join(address_of(url)).translate(LOWER)))


def token_counts(pages: DataFrame, tokens: Iterable[str]) -> dict[str, int]:
    """In how many urls each of the tokens (those of the rules) occurs."""
    wanted = frozenset(tokens)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for pdf in batches:
            for url in pdf["url"]:
                found.update(wanted & tokens_of(url))
        if found:
            yield pd.DataFrame({"token": list(found), "n": list(found.values())})
    counts = pages.select(F.col("url").cast("string").alias("url")).mapInPandas(run, "token string, n long")
    return {r.token: r.n for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class RuleIndex:
    """Rules by their rarest token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.rules = [(rule, re.compile(rule.regex)) for rule in rules]
        self.always: list[int] = []
        self.by_token: dict[str, list[int]] = defaultdict(list)
        for i, rule in enumerate(rules):
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
            (self.always if rarest is None else self.by_token[rarest]).append(i)

    def candidates(self, tokens: set[str]) -> list[int]:
        return self.always + [i for t in tokens if t in self.by_token for i in self.by_token[t]]

    def fitting(self, host: str, tail: str) -> list[Rule]:
        """The rules that fit the address: a site rule as it is written, a pattern in lower case."""
        lower = (host + tail).translate(LOWER)
        found = (self.rules[i] for i in self.candidates(set(TOKEN.findall(lower))))
        return [rule for rule, regex in found if regex.search(host + tail if rule.site else lower)]


def judged(index: RuleIndex, url: str | None) -> tuple[str, str, str | None, str, str | None]:
    """(host, path, rule, verdict, pattern) of a url."""
    host, tail = address_of(url)
    fitting = index.fitting(host, tail)
    sites = [r for r in fitting if r.site]
    if sites:
        rule = min(sites, key=lambda r: (-len(r.site), r.site))
        return host, path_of(tail), rule.site, rule.verdict, None
    for verdict in ("allow", "block"):
        if own := [r.pattern for r in fitting if r.verdict == verdict]:
            return host, path_of(tail), None, verdict, min(own, key=lambda p: (-len(p), p))
    return host, path_of(tail), None, "allow", None


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, pattern) for every row of ``pages``."""
    rules = site_rules() + pattern_rules() if rules is None else rules
    if sum(len(r.pattern.encode()) for r in rules) > MOST_BYTES:
        raise ValueError(f"the rules hold more than {MOST_BYTES} bytes")
    counts = token_counts(pages, {t for r in rules for t in r.tokens})

    @F.pandas_udf("host string, path string, rule string, verdict string, pattern string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = RuleIndex(rules, counts)
        for urls in batches:
            yield pd.DataFrame([judged(index, u) for u in urls], columns=["host", "path", "rule", "verdict", "pattern"])
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    return rows.withColumn("j", run("url")).select("page_id", "url", "j.host", "j.path", "j.rule", "j.verdict", "j.pattern")


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in row) + ")" for row in rows)


OP13_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM u),
a AS (SELECT row_number() OVER () AS id, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(tail, '^[^?#]*') AS path, translate(raw || tail, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS address FROM h),
r(rule, verdict) AS (VALUES {_values(SITES)}),
p(pattern, verdict, regex) AS (VALUES {_values([(x.pattern, x.verdict, x.regex) for x in pattern_rules()])}),
s AS (SELECT id, arg_max(rule, length(rule)) AS rule, arg_max(r.verdict, length(rule)) AS verdict FROM a JOIN r
      ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
     AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY id),
m AS (SELECT id, pattern, verdict, row_number() OVER (PARTITION BY id ORDER BY verdict, length(pattern) DESC, pattern) AS n
      FROM a JOIN p ON regexp_matches(address, regex))
SELECT a.page_id, a.host, a.path, s.rule, coalesce(s.verdict, m.verdict, 'allow') AS verdict,
       CASE WHEN s.rule IS NULL THEN m.pattern END AS pattern
FROM a LEFT JOIN s ON s.id = a.id LEFT JOIN m ON m.id = a.id AND m.n = 1
"""
