"""URL verdicts by pattern rules that are indexed under their rarest literal token.

A rule is a regular expression with the literal tokens (runs of ASCII letters and
digits) that every URL it matches must hold whole. Pass 1 counts, over all URLs,
how many hold each rule token; every rule is then filed under its rarest one.
Pass 2 cuts each URL into tokens, fetches the rules filed under them (and the few
rules that have no such token) and runs only those regular expressions, strongest
rule first, until one matches. Both passes are narrow; rules beyond
``BLOCK_RULES`` are taken in further passes that carry the strongest match along.

Two kinds of rules, strongest first:

* place rules, ``host/path``: fit the host and its subdomains if the path starts
  with the rule's; the longest wins, of equal lengths the one of the longer host;
* filter rules: ``*`` is any text, ``^`` a separator or the end, a leading ``||``
  the start of a host or subdomain, ``|`` the start or end; ``@@`` makes an
  exception, which wins. They are matched without regard to the case of A-Z.

Results: a URL that no rule matches is allowed. A null URL is empty; without
``://`` host and path are empty, and only filter rules can match. Rows that repeat
get a row each; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import chunks

#: Rules that one pass sends to its tasks.
BLOCK_RULES = 100_000
ALLOW, BLOCK = "allow", "block"

#: Filter rules that decide where no place rule fits: adverts and trackers, account and shop pages, endless
#: listings, files that are no text, and sites of a kind that training text does not want.
FILTERS = tuple("""
    ||ad. ||ads. ||adserver. ||adservice. ||banner. ||doubleclick. ||track. ||tracker. ||tracking. /adserver/ /ads/*
    ^login^ ^signin^ ^signup^ ^logout^ ^register^ ^checkout^ ^basket^ ^wp-admin^ ^wp-login.php ^cgi-bin^ ^phpmyadmin^
    ^search?q= ^search?query= ?sessionid= &sessionid= ?phpsessid= &phpsessid= /calendar/*/*/* ^print=1^
    .exe^ .msi^ .apk^ .dmg^ .iso^ .zip^ .rar^ .7z^ .tar.gz^ .jpg^ .jpeg^ .png^ .gif^ .webp^ .svg^ .mp3^ .mp4^ .avi^ .mov^
    .css^ .woff^ .woff2^
    ^porn^ ^xxx^ ^casino^ ^poker^ ^gambling^ ^viagra^ ^torrent^ ^torrents^ ^warez^
    @@/robots.txt| @@^login^help^
    """.split())

_TOKEN = re.compile(r"[A-Za-z0-9]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_PLACE = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
_HOST_START = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#]*\.)?"
_SEPARATOR = r"(?:[^a-z0-9_.%\-]|$)"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: frozenset[str]
    is_place: bool
    strength: tuple


def place_rule(name: str, verdict: str) -> Rule:
    """A rule ``host/path``: everything on the host and its subdomains under the path."""
    host, slash, path = name.partition("/")
    host, path = host.translate(_LOWER), slash + path
    tokens = _TOKEN.findall(host)
    # the last run of the path may go on in a URL
    tokens += [m[0] for m in _TOKEN.finditer(path) if m.end() < len(path)]
    return Rule(name, verdict, rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(path) or '(?:/|$)'}",
                frozenset(t.translate(_LOWER) for t in tokens), True, (2, len(host) + len(path), len(host), name))


def filter_rule(text: str) -> Rule:
    """A rule in filter syntax; ``@@`` marks an exception that allows."""
    body = text.removeprefix("@@").translate(_LOWER)
    inner = body.removeprefix("||").removeprefix("|").removesuffix("|")
    start = _HOST_START if body.startswith("||") else "^" if body.startswith("|") else ""
    end = "$" if len(body) > 1 and body.endswith("|") else ""
    middle = "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in inner)
    tokens = set()
    for m in _TOKEN.finditer(inner):
        before = inner[m.start() - 1] if m.start() else "|" if start else "*"
        after = inner[m.end()] if m.end() < len(inner) else "|" if end else "*"
        if before != "*" and after != "*":  # cut on both sides in every URL that matches
            tokens.add(m[0])
    allows = text.startswith("@@")
    return Rule(text, ALLOW if allows else BLOCK, f"(?s){start}{middle}{end}", frozenset(tokens), False,
                (1 if allows else 0, len(inner), 0, text))


def host_and_path(url: str) -> tuple[str, str]:
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    host = _PLACE.match(rest)[0]
    return host.translate(_LOWER), _PATH.match(rest, len(host))[0]


def tokens_of(url: str) -> set[str]:
    return {t.translate(_LOWER) for t in _TOKEN.findall(url)}


class RuleIndex:
    """Rules filed under one token each; ``strongest(url, host, path)`` runs the fetched ones."""

    def __init__(self, rules: Sequence[Rule], holders: dict[str, int]):
        self.filed: dict[str, list[int]] = {}
        self.loose: list[int] = []
        self.rules = sorted(rules, key=lambda r: r.strength, reverse=True)
        self.run = [re.compile(r.pattern).search for r in self.rules]
        for i, r in enumerate(self.rules):
            if r.tokens:
                rarest = min(r.tokens, key=lambda t: (holders.get(t, 0), t))
                self.filed.setdefault(rarest, []).append(i)
            else:
                self.loose.append(i)

    def fetched(self, url: str) -> list[int]:
        """Numbers of the rules to run, strongest first."""
        out = list(self.loose)
        for t in self.filed.keys() & tokens_of(url):
            out += self.filed[t]
        return sorted(out)

    def strongest(self, url: str, host: str, path: str) -> Rule | None:
        place, lowered = None, None
        for i in self.fetched(url):
            if self.rules[i].is_place:
                place = host + path if place is None else place
                if host and self.run[i](place):
                    return self.rules[i]
            else:
                lowered = url.translate(_LOWER) if lowered is None else lowered
                if self.run[i](lowered):
                    return self.rules[i]
        return None


def token_holders(urls: DataFrame, tokens: frozenset[str]) -> dict[str, int]:
    """How many of the rows' ``url`` hold each of the rule tokens (one count a token at the driver)."""
    sent = urls.sparkSession.sparkContext.broadcast(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for url in b.column(0).to_pylist():
                seen.update(sent.value & tokens_of(url))
        yield pa.RecordBatch.from_pydict({"token": list(seen), "n": list(seen.values())},
                                         pa.schema([("token", pa.string()), ("n", pa.int64())]))

    counted = urls.select("url").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in counted.toLocalIterator()}


_SCHEMA = [("url", pa.string()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
           ("pattern", pa.string()), ("verdict", pa.string())]


def judge(pages: DataFrame, places: Sequence[tuple[str, str]], filters: Sequence[str] = FILTERS, id_col: str = "page_id",
          url_col: str = "url", block_rules: int = BLOCK_RULES) -> DataFrame:
    """``page_id, host, path, rule, pattern, verdict`` of every row.

    ``places`` are (``host/path``, verdict) pairs, ``filters`` rules in filter
    syntax. ``rule`` names the place rule that decides, ``pattern`` the filter rule;
    both are null where none matches.
    """
    rules = [place_rule(name, verdict) for name, verdict in places] + [filter_rule(text) for text in filters]
    rules.sort(key=lambda r: r.strength, reverse=True)
    none = [F.lit(None).cast("string").alias(c) for c in ("host", "path", "rule", "pattern", "verdict")]
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), *none)
    kind = rows.schema["page_id"].dataType.simpleString()
    holders = token_holders(rows, frozenset().union(*(r.tokens for r in rules)))
    # blocks from the strongest on: a row that a block has decided is not looked at again
    for at in range(0, max(len(rules), 1), block_rules):
        sent = pages.sparkSession.sparkContext.broadcast((rules[at:at + block_rules], holders))

        def decide(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = RuleIndex(*sent.value)
            for b in chunks(batches, "url"):
                out: list[tuple] = []
                for url, _, _, rule, pattern, verdict in zip(*(b.column(i).to_pylist() for i in range(1, 7)), strict=True):
                    host, path = host_and_path(url)
                    if verdict is None and (found := index.strongest(url, host, path)):
                        rule, pattern = (found.name, None) if found.is_place else (None, found.name)
                        verdict = found.verdict
                    out.append((url, host, path, rule, pattern, verdict))
                columns = [pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _SCHEMA, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["page_id", *(n for n, _ in _SCHEMA)])

        rows = rows.mapInArrow(decide, f"page_id {kind}, " + ", ".join(f"{n} string" for n, _ in _SCHEMA))
    return rows.select("page_id", "host", "path", "rule", "pattern", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"))


def oracle_sql(places: Sequence[tuple[str, str]], filters: Sequence[str] = FILTERS) -> str:
    """DuckDB SQL that tries every rule on every URL."""
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    place_rows = ", ".join(f"({text(n)}, {text(n.split('/')[0])}, {text(n[len(n.split('/')[0]):])}, {text(v)})" for n, v in places)
    filter_rows = ", ".join(f"({text(f)}, {text(r.pattern)}, {text(r.verdict)}, {r.strength[0]}, {r.strength[1]})"
                            for f in filters for r in (filter_rule(f),))
    return f"""
WITH places(rule, host, path, verdict) AS (VALUES {place_rows}),
filters(pattern, expression, verdict, allows, size) AS (VALUES {filter_rows}),
urls AS (SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url FROM pages),
rests AS (
  SELECT *, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS written FROM rests),
parts AS (
  SELECT row, page_id, translate(url, '{upper}', '{lower}') AS url, translate(written, '{upper}', '{lower}') AS host,
         regexp_extract(substr(rest, length(written) + 1), '^[^?#]*') AS path
  FROM hosts),
placed AS (
  SELECT row, arg_max(rule, [length(rule), length(r.host)]) AS rule, arg_max(verdict, [length(rule), length(r.host)]) AS verdict
  FROM parts p JOIN places r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY row),
filtered AS (
  SELECT row, pattern, verdict FROM (
    SELECT row, pattern, f.verdict, row_number() OVER (PARTITION BY row ORDER BY allows DESC, size DESC, pattern DESC) AS place
    FROM parts p JOIN filters f ON regexp_matches(p.url, f.expression))
  WHERE place = 1)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN f.pattern END AS pattern,
       coalesce(q.verdict, f.verdict, 'allow') AS verdict
FROM parts LEFT JOIN placed q USING (row) LEFT JOIN filtered f USING (row)
"""
