"""URL filter: host/path rules first, else a weighted vocabulary searched by Aho-Corasick.

A url is split literally: the host follows the first ``://`` up to ``/``,
``?``, ``#`` or the end (A-Z lower-cased), the path follows up to ``?``, ``#``
or the end. A rule fits its host and all subdomains where the path starts
with the rule's path; the longest fitting rule decides. Without a rule, one
strict term or ``min_soft`` distinct soft terms reject; a term counts only
between characters that are neither letters nor digits (or the ends).

Defined cases: a null url, or one without ``://``, has empty host and path and
fits no rule; its whole text is still searched for terms (null: none). Each
row is judged alone, so repeated rows and ties cannot matter; an empty table
gives an empty table; other columns of the input are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tremor.session import table

# fixed values of the query: (host + path, verdict)
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
STRICT = ("adult", "casino", "porn", "spam", "viagra", "xxx")
SOFT = ("ads", "bets", "bonus", "cheap", "click", "farm", "free", "jackpot", "loans", "pills", "track", "win")
MIN_SOFT = 2


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the module states; both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    end = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


class UrlFilter:
    """Rules and vocabulary, compiled once for each task."""

    def __init__(self, rules: Sequence[tuple[str, str]], strict: Sequence[str], soft: Sequence[str], min_soft: int):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.lower(), []).append((slash + path, rule, verdict))
        self.min_soft = min_soft
        self.terms = ahocorasick.Automaton()
        for term in soft:
            self.terms.add_word(term.lower(), (term.lower(), False))
        for term in strict:
            self.terms.add_word(term.lower(), (term.lower(), True))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """Longest fitting (rule, verdict): tries the host and each parent domain."""
        best, domain = None, host
        while domain:
            for prefix, rule, verdict in self.by_host.get(domain, ()):
                if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                    best = (rule, verdict)
            domain = domain.partition(".")[2]
        return best

    def rejects(self, url: str | None) -> bool:
        text = (url or "").lower()
        seen = set()
        if not text or not len(self.terms):
            return False
        for end, (term, strict) in self.terms.iter(text):
            before, after = end - len(term), end + 1
            if (before >= 0 and text[before].isalnum()) or (after < len(text) and text[after].isalnum()):
                continue
            if strict:
                return True
            seen.add(term)
        return len(seen) >= self.min_soft

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = split_url(url)
        hit = self.rule(host, path)
        if hit:
            return host, path, hit[0], hit[1]
        return host, path, None, "block" if self.rejects(url) else "allow"


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    min_soft: int = MIN_SOFT,
) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of (page_id, url)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = UrlFilter(rules, strict, soft, min_soft).judge
        for b in batches:
            out = [judge(u) for u in b.column(1).to_pylist()]
            cols = [pa.array([row[k] for row in out], pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select("page_id", "url").mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string"
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every url of ``pages``."""
    return judge_urls(table(spark, sf_dir, "pages"))


def _word(term: str) -> str:
    return f"regexp_matches(lower(coalesce(url, '')), '(^|[^\\p{{L}}\\p{{N}}]){term}([^\\p{{L}}\\p{{N}}]|$)')"


ORACLE_SQL = rf"""
WITH s AS (
  SELECT page_id, url,
    CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), u AS (
  SELECT page_id, url, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(h) + 1), '(?s)^[^?#]*') AS path
  FROM (SELECT *, regexp_extract(rest, '(?s)^[^/?#]*') AS h FROM s)
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN {" OR ".join(map(_word, STRICT))} THEN 'block'
  WHEN {" + ".join(_word(t) + "::INT" for t in SOFT)} >= {MIN_SOFT} THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""
