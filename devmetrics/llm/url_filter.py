"""URL filter: host and path rules first, then a weighted vocabulary found with an Aho-Corasick automaton.

A term counts where it stands between characters that are neither ASCII letters nor digits (or the ends of the
url). A strict term weighs as much as the rejection needs, a soft one weighs 1: a url is rejected on one strict or on
``soft_needed`` distinct soft terms. Only A-Z are lower-cased.

Defined cases: null url or no ``://``: host and path are empty; null urls hold no terms and are allowed; extra
columns are left out of the result; an empty table gives an empty result; repeated rows are judged row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.common import LOWER, UPPER, ascii_lower

#: Rules of the registered query, verdict and host/path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))

#: Vocabulary (a parameter). One strict term rejects a url; soft terms reject it together.
STRICT = ("casino", "escort", "hentai", "malware", "phishing", "porn", "porno", "sex", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "adult", "bet", "bets", "betting", "bonus", "cheap", "click", "coupon", "crack", "dating", "deal", "deals",
        "farm", "free", "gambling", "jackpot", "loan", "loans", "lottery", "nude", "offer", "offers", "pill", "pills",
        "poker", "prize", "promo", "slots", "track", "tracker", "win", "winner")
SOFT_NEEDED = 2


def find_terms(url: str, automaton) -> tuple[dict[str, int], dict[str, int]]:
    """Counts of the strict and of the soft terms with boundaries on both sides."""
    strict: dict[str, int] = {}
    soft: dict[str, int] = {}
    for end, (term, is_strict) in automaton.iter(url):
        before, after = url[end - len(term):end - len(term) + 1] if end >= len(term) else "", url[end + 1:end + 2]
        if not (before.isascii() and before.isalnum() or after.isascii() and after.isalnum()):
            found = strict if is_strict else soft
            found[term] = found.get(term, 0) + 1
    return strict, soft


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, strict: tuple[str, ...] = STRICT,
               soft: tuple[str, ...] = SOFT, soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict and n_soft (hits), n_distinct_soft per row of (page_id, url).

    Rules and terms are parameters held on the driver and sent with the task; only the url column is read."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, _, path = rule.partition("/")
        by_host.setdefault(host, []).append((f"/{path}", rule, verdict))
    to_lower = str.maketrans(UPPER, LOWER)

    def rule_for(host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        at = 0
        while at >= 0:
            for prefix, rule, verdict in by_host.get(host[at:], ()):
                if path.startswith(prefix):
                    if best[0] is None or (-len(rule), rule) < (-len(best[0]), best[0]):
                        best = rule, verdict
                    break
            at = host.find(".", at) + 1 or -1
        return best

    @F.pandas_udf("rule string, verdict string, n_strict int, n_soft int, n_distinct_soft int")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for terms, is_strict in ((soft, False), (strict, True)):
            for term in terms:
                automaton.add_word(term, (term, is_strict))
        automaton.make_automaton()
        for urls, hosts, paths in batches:
            out = []
            for url, host, path in zip(urls, hosts, paths):
                hard, mild = find_terms((url or "").translate(to_lower), automaton)
                rule, verdict = rule_for(host, path)
                weight = len(hard) * soft_needed + len(mild)
                verdict = verdict or ("block" if weight >= soft_needed else "allow")
                out.append((rule, verdict, sum(hard.values()), sum(mild.values()), len(mild)))
            yield pd.DataFrame(out, columns=["rule", "verdict", "n_strict", "n_soft", "n_distinct_soft"])

    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("")
    parts = pages.select("page_id", "url", F.coalesce(rest, F.lit("")).alias("__rest"))
    parts = parts.select("page_id", "url", ascii_lower(F.regexp_extract("__rest", "^[^/?#]*", 0)).alias("host"),
                         F.regexp_extract("__rest", "^[^/?#]*([^?#]*)", 1).alias("path"))
    return parts.select("page_id", "host", "path", judge("url", "host", "path").alias("__j")).select("page_id", "host", "path", "__j.*")


def oracle_sql() -> str:
    """Rules and terms as SQL conditions."""
    lower = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    hits = lambda terms: " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::INT" for t in terms)
    fits = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fits.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{verdict} {rule}'")
    return f"""
WITH rest AS (
  SELECT page_id, {lower} AS u, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, u, translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (
  SELECT *, CASE {' '.join(fits)} END AS fit, {hits(STRICT)} AS n_strict, {hits(SOFT)} AS n_soft FROM parts)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule,
       CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 1)
            WHEN n_strict > 0 OR n_soft >= {SOFT_NEEDED} THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""
