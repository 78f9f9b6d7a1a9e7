"""URL filters: pattern rules found by their rarest literal token, in built-in functions only.

A rule is stored once, under one of the tokens that each of its URLs must contain: the one that the fewest URLs
contain. A URL looks up its own tokens, and only the rules found there run their regular expression. Rules without
such a token are candidates for every URL. The rules are a list that a person maintains (``MAX_RULES`` at most), so
the index is a literal of the plan: one scan, no shuffle, no row leaves its task.

Two kinds of rule:

* site rules ``host/path``: the host and its subdomains, where the path starts with the rule's (case matters); the
  longest fitting rule decides, of equally long ones the first in code point order;
* pattern rules over the URL in lower case, if no site rule fits: ``*`` any text, ``^`` a separator or the end,
  ``|`` the start or end, ``||`` the start of a host label. A fitting allow rule wins over block rules; without any
  the URL is allowed.

A null URL, or one without ``://``, has an empty host and an empty path and fits no site rule.
"""

from __future__ import annotations

import json
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.base import lower_ascii, query, table

MAX_RULES = 50_000
SLOTS = 1024
ANY_URL = ""

# --- fixed values: site rules (rule, verdict) of the registered query
SITE_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

# --- fixed values: pattern rules (rule, verdict) of the registered query
PATTERN_RULES = [
    ("||ads.*^", "block"),
    ("||ads-", "block"),
    ("||adserver.*^", "block"),
    ("||track.*^", "block"),
    ("/banner/", "block"),
    ("/banners/*.gif", "block"),
    ("/popup/", "block"),
    ("/casino/", "block"),
    ("/porn/", "block"),
    ("/viagra", "block"),
    (".exe|", "block"),
    (".apk|", "block"),
    ("^utm_medium=spam^", "block"),
    ("/casino/history/", "allow"),
    ("|ftp://*/mirror/", "allow"),
]


@dataclass(frozen=True)
class Rule:
    rule: str
    verdict: str
    site: bool
    pattern: str
    tokens: tuple[str, ...]


def _literal(text: str) -> str:
    return "".join("\\" + c if c in string.punctuation else c for c in text)


def site_rule(rule: str, verdict: str) -> Rule:
    """``host/path`` as a rule over the host and path put together."""
    host, slash, path = rule.partition("/")
    host = host.lower()
    tokens = re.findall(r"(?<![^\W_])[a-z0-9]+(?=[^a-z0-9])", (host + slash + path).lower(), re.ASCII)
    return Rule(rule, verdict, True, r"^(?:[^/]*\.)?" + _literal(host + slash + path), tuple(tokens))


def pattern_rule(rule: str, verdict: str) -> Rule:
    """A wildcard pattern as a rule over the URL in lower case."""
    body, head, tail = rule.lower(), "", ""
    if body.startswith("||"):
        body, head = body[2:], r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?"
    elif body.startswith("|"):
        body, head = body[1:], "^"
    if body.endswith("|"):
        body, tail = body[:-1], r"\z"
    pieces = {"*": r"[\s\S]*", "^": r"(?:[^a-z0-9_.%-]|\z)"}
    # A run of letters is a whole token of the URL only if the pattern fixes what stands beside it.
    fenced = ("/" if head else "*") + body + ("/" if tail else "*")
    tokens = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", fenced, re.ASCII)
    return Rule(rule, verdict, False, head + "".join(pieces.get(c, _literal(c)) for c in body) + tail, tuple(tokens))


def tokens_of(url: Column) -> Column:
    """Distinct runs of letters and digits of a URL in lower case."""
    return F.array_distinct(F.split(lower_ascii(url), "[^a-z0-9]+"))


def rarest_tokens(urls: Column | str, pages: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many rows of ``pages`` contain each literal token of the rules: as many numbers as the rules have tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    seen = (pages.select(F.explode(tokens_of(F.col(urls) if isinstance(urls, str) else urls)).alias("token"))
            .where(F.col("token").isin(wanted)).groupBy("token").count())
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in seen.collect()}


def index_of(rules: list[Rule], counts: dict[str, int]) -> list[dict[str, list[dict]]]:
    """Rules by slot of their token and by token."""
    slots: list[dict[str, list[dict]]] = [{} for _ in range(SLOTS)]
    for r in rules:
        token = min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=ANY_URL)
        entry = {"size": len(r.rule), "rule": r.rule, "verdict": r.verdict, "site": r.site, "pattern": r.pattern}
        slots[_slot(token)].setdefault(token, []).append(entry)
    return slots


def _slot(token: str) -> int:
    """The same number as ``_slot_column`` gives: tokens are ASCII letters and digits."""
    return int.from_bytes(token[:2].encode().ljust(2, b"\0"), "big") * 31 % SLOTS if token else 0


def _slot_column(token: Column) -> Column:
    first, second = F.ascii(token), F.ascii(F.substring(token, 2, 1))
    return (first * 256 + second) * 31 % SLOTS


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null URL or one without ``://``."""
    text = F.coalesce(url, F.lit(""))
    start = F.instr(text, "://")
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    return (lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)),
            F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2))


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the site rule that decided, else null), ``pattern_rule`` (the
    pattern rule that decided, else null) and ``verdict`` (``allow`` or ``block``).

    Columns of these names that ``pages`` already has are replaced. Repeated rows stay repeated; an empty table stays
    empty.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; an index in the plan holds at most {MAX_RULES}")
    index = json.dumps(index_of(rules, rarest_tokens(url, pages, rules)))
    entry = "array<struct<size:int,rule:string,verdict:string,site:boolean,pattern:string>>"
    slots = F.from_json(F.lit(index), f"array<map<string,{entry}>>")
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = host_and_path(F.col(url))
    site, lowered = F.concat(host, path), lower_ascii(text)

    tokens = F.array_union(tokens_of(text), F.array(F.lit(ANY_URL)))
    found = F.flatten(F.transform(tokens, lambda t: F.coalesce(
        F.element_at(F.element_at(slots, _slot_column(t) + 1), t), F.array().cast(entry))))
    fits = F.filter(found, lambda r: F.when(r["site"], F.regexp_like(site, r["pattern"]))
                    .otherwise(F.regexp_like(lowered, r["pattern"])))
    # a one-element generator: the matching above is done once, not once for each column that uses it
    once = pages.select("*", F.explode(F.array(F.struct(
        host.alias("host"), path.alias("path"), fits.alias("fits")))).alias("_found"))
    of_site = F.filter("_found.fits", lambda r: r["site"])
    of_pattern = F.filter("_found.fits", lambda r: ~r["site"])
    # smallest of (-size, rule): the longest rule, then the first
    best = F.array_min(F.transform(of_site, lambda r: F.struct((-r["size"]).alias("a"), r["rule"].alias("rule"),
                                                               r["verdict"].alias("verdict"))))
    first = F.array_min(F.transform(of_pattern, lambda r: F.struct(r["verdict"].alias("verdict"),
                                                                   r["rule"].alias("rule"))))
    return once.withColumns({
        "host": F.col("_found.host"), "path": F.col("_found.path"), "rule": best["rule"],
        "pattern_rule": F.when(best.isNull(), first["rule"]),
        "verdict": F.coalesce(best["verdict"], first["verdict"], F.lit("allow")),
    }).drop("_found")


RULES = [site_rule(*r) for r in SITE_RULES] + [pattern_rule(*r) for r in PATTERN_RULES]


def _rows(rules: list[Rule]) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quote(r.rule)}, {quote(r.verdict)}, {quote(r.pattern)})" for r in rules)


SQL = f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT page_id, coalesce(url, '') AS url, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM parts),
sites AS (
  SELECT page_id, url, translate(raw_host, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM named),
site_rules(rule, verdict, pattern) AS (VALUES {_rows([r for r in RULES if r.site])}),
pattern_rules(rule, verdict, pattern) AS (VALUES {_rows([r for r in RULES if not r.site])}),
judged AS (
  SELECT *,
    (SELECT min(struct_pack(a := -length(r.rule), rule := r.rule, verdict := r.verdict)) FROM site_rules r
      WHERE (s.host = split_part(r.rule, '/', 1) OR ends_with(s.host, '.' || split_part(r.rule, '/', 1)))
        AND starts_with(s.path, substr(r.rule, instr(r.rule, '/')))) AS best,
    (SELECT min(struct_pack(verdict := r.verdict, rule := r.rule)) FROM pattern_rules r
      WHERE regexp_matches(translate(s.url, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), r.pattern)) AS found
  FROM sites s)
SELECT page_id, host, path, best.rule AS rule, CASE WHEN best IS NULL THEN found.rule END AS pattern_rule,
       coalesce(best.verdict, found.verdict, 'allow') AS verdict
FROM judged"""


@query("op1_url_filter", SQL)
def op1_url_filter(spark, folder):
    return filter_urls(table(spark, folder, "pages", "page_id", "url"), RULES).drop("url")
