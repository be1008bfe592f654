"""URL rules: the index against trying every rule, parsing, strength, odd input."""

import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from batchtrace.llm import url_rules as U
from batchtrace.llm.queries import PLACES

URLS = ["http://www.example.com/en/1", "http://EXAMPLE.com/en/", "http://a.www.example.com/en/x?y#z", "http://example.com/EN/1",
        "http://example.com", "http://notexample.com/en/", "https://x.net/es/1", "https://net/fr/", "https://x.net/esx/", "http://x.org/a/login?b",
        "http://ads.x.org/", "http://x.org/ads/1", "http://loads.x.org/", "http://x.org/file.EXE", "http://x.org/file.exercise",
        "http://x.org/login/help/", "no scheme /login", "", None, "://h/p", "a://b://c/d", "http://x.org/robots.txt", "http://x.org/calendar/2024/01/02",
        "http://user@example.com:80/en/", "http://x.org/" + "a/" * 30000 + "login", "ftp://münchen.com/ü?é", "http://x.org/\n/login/"]


def by_every_rule(url, places, filters):
    """Plain rules read from the contract, all of them tried."""
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        written = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(written):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in written)
    fit = []
    for name, verdict in places:
        h, _, p = name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(name), len(h), name, verdict))
    if fit:
        return host, path, max(fit)[2], max(fit)[3]
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in url)
    found = [r for r in map(U.filter_rule, filters) if re.search(r.pattern, lowered)]
    return host, path, None, max(found, key=lambda r: r.strength).verdict if found else "allow"


@pytest.mark.parametrize("block", [100_000, 7])
def test_judge_equals_trying_every_rule(spark, block):
    rows = [(i, u, "extra", "extra") for i, u in enumerate(URLS * 2)] + [(None, URLS[0], "e", "e"), (3, URLS[3], "e", "e")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(3)
    got = sorted(map(str, U.judge(df, PLACES, block_rules=block).drop("pattern").collect()))
    from pyspark.sql import Row
    want = sorted(str(Row(page_id=i, host=h, path=p, rule=r, verdict=v))
                  for i, u, _, _ in rows for h, p, r, v in (by_every_rule(u, PLACES, U.FILTERS),))
    assert got == want


def test_judge_equals_its_sql(spark):
    rows = [(i, u) for i, u in enumerate(URLS) if not u or "\n" not in u]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    want = sorted(con.execute(U.oracle_sql(PLACES)).fetchall(), key=str)
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string"), PLACES)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_table_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(none, PLACES).columns == ["page_id", "host", "path", "rule", "pattern", "verdict"]
    assert U.judge(none, PLACES).count() == 0
    one = U.judge(spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string"), (), ()).first()
    assert (one.host, one.rule, one.verdict) == ("x.com", None, "allow")


def test_rules_are_filed_under_their_rarest_token():
    rules = [U.place_rule("example.com/en/", "block"), U.filter_rule("||ads."), U.filter_rule("*a*")]
    index = U.RuleIndex(rules, {"com": 900, "example": 50, "en": 200, "ads": 2})
    assert {t: [index.rules[i].name for i in n] for t, n in index.filed.items()} == {"example": ["example.com/en/"], "ads": ["||ads."]}
    assert [index.rules[i].name for i in index.loose] == ["*a*"]
    assert not {index.rules[i].name for i in index.fetched("http://other.com/en/")} & {"example.com/en/", "||ads."}


def test_the_rarest_token_comes_from_all_urls(spark):
    urls = spark.createDataFrame([("http://a.com/x-x",), ("http://b.com/X",), ("",)], "url string").repartition(3)
    assert U.token_holders(urls, frozenset({"com", "x", "zz"})) == {"com": 2, "x": 2}


_PART = st.sampled_from(["ads", "ad", "a", "login", "en", "com", "net", "www", ".", "/", "-", "?", "x1"])


@settings(max_examples=300, deadline=None)
@given(st.lists(_PART, min_size=1, max_size=7), st.lists(st.sampled_from(["*", "^", "||", "|", "ads", "login", ".", "/", "a", "x1"]), min_size=1, max_size=5))
def test_no_matching_url_lacks_a_rule_token(url_parts, rule_parts):
    rule, url = U.filter_rule("".join(rule_parts)), "http://" + "".join(url_parts)
    if re.search(rule.pattern, url):
        assert rule.tokens <= U.tokens_of(url)


@settings(max_examples=300, deadline=None)
@given(st.lists(_PART, min_size=1, max_size=7), st.sampled_from([n for n, _ in PLACES] + ["com", "example.com/en", "www.net/a-b"]))
def test_no_fitting_place_lacks_a_rule_token(url_parts, name):
    rule, url = U.place_rule(name, "block"), "http://" + "".join(url_parts)
    host, path = U.host_and_path(url)
    if re.search(rule.pattern, host + path):
        assert rule.tokens <= U.tokens_of(url)
