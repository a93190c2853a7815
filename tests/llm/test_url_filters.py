"""Url rules against a plain scan of all rules."""

import random

from cases import rows_of
from conftest import SMALL

from aisflow.llm import queries, url_filters

RULES = [*queries.URL_RULES, ("block", "a.b.c/x/"), ("allow", "b.c/x/y/"), ("block", "b.c"), ("allow", "b.c/x/y/"), ("block", "b.c/x/y/"), ("allow", "c/é")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[at:].split("?")[0].split("#")[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at]), path


def brute(page_id, url):
    host, path = parts(url)
    best, key = (None, "allow"), (-1, -1)
    for host_, path_, verdict in sorted(url_filters.parse_rules(RULES), key=lambda r: r[2] == "block"):
        if host and (host == host_ or host.endswith("." + host_)) and path.startswith(path_):
            own = (len(host_ + path_), len(host_))
            if own >= key:
                best, key = (host_ + path_, verdict), own
    return (page_id, host, path, *best)


URLS = [
    None, "", "no scheme", "http://", "https://COM", "http://com/", "http://example.com/en/1", "http://WWW.Example.com/en/?q=/es/",
    "http://deep.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/a#b", "http://x.net/esa", "http://x.net?/es/",
    "http://net/fr/", "ftp://a.b.c/x/y/z", "s://q.a.b.c/x/y/", "s://b.c/x/y/é", "s://b.c", "s://é.c/é/", "http://a://b.c/", "http://c/é\nx", "http://.com/", "http://b.c./x/y/",
]


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "h", "clash", "clash", 1) for k, u in enumerate(urls)], "page_id long, url string, html string, rule string, key string, slice int")


def rules(spark):
    rows = [*url_filters.parse_rules(RULES), (None, "/", "block"), ("", "/", "block")]
    return spark.createDataFrame(rows, url_filters.RULE_SCHEMA)


def test_against_a_scan_of_the_rules(spark):
    rng = random.Random(5)
    hosts = ["com", "a.com", "example.com", "www.example.com", "b.c", "a.b.c", "x.a.b.c", "net", "y.net", "hot.com"]
    paths = ["", "/", "/en/", "/es/q", "/fr/", "/x/", "/x/y/", "/x/y/z?en", "/é"]
    urls = URLS + [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + ["http://hot.com/same"] * 200
    expected = sorted((brute(k, u) for k, u in enumerate(urls)), key=repr)
    frame = pages(spark, urls)
    for slice_rows in (10_000, 25):
        assert rows_of(url_filters.judge(frame, rules(spark), slice_rows=slice_rows)) == expected


def test_null_ids_repeated_rows_empty_tables(spark):
    frame = spark.createDataFrame([(None, "http://example.com/en/", "")] * 3, "page_id long, url string, html string")
    assert rows_of(url_filters.judge(frame, rules(spark))) == [(None, "example.com", "/en/", "example.com/en/", "block")] * 3
    assert url_filters.judge(frame.limit(0), rules(spark)).collect() == []
    unruled = url_filters.judge(frame, rules(spark).limit(0), default="block").collect()
    assert [(r.rule, r.verdict) for r in unruled] == [(None, "block")] * 3


def test_given_pages(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    got = {r.page_id: (r.rule, r.verdict) for r in queries.op3_url_sweep(spark, SMALL).collect()}
    global RULES
    saved, RULES = RULES, queries.URL_RULES
    expected = {r.page_id: brute(r.page_id, r.url)[3:] for r in rows}
    RULES = saved
    assert got == expected and len(got) == len(rows)


def test_many_nested_rules_and_very_long_urls(spark):
    """Rules that are open over many slices, labels that begin alike, and urls of a million characters."""
    labels = ["a", "b", "ab", "a-b", "a.b"]
    lines = [("block", f"{x}.{y}/p") for x in labels for y in labels] + [("allow", f"{x}/p/q") for x in labels] + [("block", "z.a.b/")]
    urls = [f"http://{w}.{x}.{y}/p{tail}" for w in ("", "www", "z") for x in labels for y in labels for tail in ("", "/q", "q")]
    urls += ["http://z.a.b/" + "x" * 1_000_000, "http://" + "q" * 1_000_000 + ".a.b/p"]
    frame = pages(spark, urls)
    table = spark.createDataFrame(url_filters.parse_rules(lines), url_filters.RULE_SCHEMA)
    global RULES
    saved, RULES = RULES, lines
    expected = sorted((brute(k, u) for k, u in enumerate(urls)), key=repr)
    RULES = saved
    for slice_rows in (1000, 4, 1):
        assert rows_of(url_filters.judge(frame, table, slice_rows=slice_rows)) == expected
