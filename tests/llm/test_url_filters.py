"""Rules against a plain version, and block decisions carried over links."""

import re

from conftest import SMALL

from contest_analytics.llm import queries, url_filters as U


def plain(url, rules=queries.URL_RULES):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [
        (len(h + p), verdict == "allow", h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, True, None, None))
    return host, path, best[2], best[3]


def test_query_against_plain_rules(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()}
    rows = queries.op4_url_filters(spark, SMALL).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or "allow")


def page(url, canonical=None, refresh=None):
    link = f'<LINK href="{canonical}" rel="canonical">' if canonical else ""
    meta = f"<meta http-equiv='refresh' content='0; url={refresh}'>" if refresh else ""
    return url, f"<html><head>{link}{meta}</head><body>canonical</body></html>"


def test_blocks_reach_aliases_and_allows_stay(spark):
    pages = [
        page("http://a.net/1", canonical="https://example.org/es/x"),  # alias of a blocked url
        page("http://b.net/2", refresh="/3"),  # redirects to the next
        page("http://b.net/3", canonical="http://a.net/1#top"),  # a chain of three
        page("http://c.org/4", canonical="//a.net/1"),  # explicitly allowed: stays
        page("http://d.net/5", canonical="http://d.net/5"),  # names itself
        page("http://e.net/6"),
        page("http://f.net/dir/7", refresh="8"),
        page("http://f.net/dir/8"),
        page("http://g.net/9"),  # redirected by the table
    ]
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    redirects = spark.createDataFrame([("http://g.net/9", "HTTP://Example.org/es/x"), (None, "http://e.net/6")], "from_url string, to_url string")
    got = {r.page_id: r.verdict for r in U.filter_urls(df, queries.URL_RULES, redirects).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block"}


def test_hard_rows(spark):
    rows = [
        (1, None, None), (1, None, None), (2, "", ""), (3, "no scheme", "x"), (4, "http://", "<link rel=canonical>"),
        (5, "http://EXAMPLE.org/en/1?x#y", None), (6, "://example.org/en/1", None), (7, "http://x.com/de/" + "a" * 9000, ""),
        (None, "http://org/", None), (8, "http://com/fr", None), (9, "http://notexample.org/es/", None), (9, "http://example.org/es/", None),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, verdict string")
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in U.filter_urls(df, queries.URL_RULES).collect())
    want = []
    for page_id, url, _ in rows:
        host, path, rule, verdict = plain(url)
        want.append((str(page_id), host, path, str(rule), verdict or "allow"))
    assert got == sorted(want)
    assert U.filter_urls(df.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in U.filter_urls(df, []).collect()} == {"allow"}


def test_sql_twin_on_pages_with_links(spark, tmp_path):
    """Canonical links and refreshes in all their spellings, against the SQL twin."""
    import duckdb

    from contest_analytics.llm import oracle, queries

    def canonical(link):
        return f'<head><LINK href="{link}" rel=canonical></head>'

    pages = [
        ("https://shop.com/de/1", None), ("http://shop.com/1", canonical("https://shop.com/de/1")),
        ("http://mirror.net/a/b", canonical("http://shop.com/1")), ("http://mirror.net/a/c", "<meta content='0; URL=b' http-equiv=\"refresh\">"),
        ("http://mirror.net/d", canonical("/a/c")), ("http://x.org/1", canonical("//mirror.net/d")), ("http://other.net/", canonical("e?q=1#top")),
        ("http://www.example.org/en/12", ""), ("http://EXAMPLE.org/es/", None), ("http://notexample.org/es/", None),
        ("http://a.com/fr/x", canonical("https://shop.com/de/1")), (None, canonical("http://shop.com/1")), ("no scheme", None), ("http://", None),
        ("http://mirror.net/d", None), ("http://free.net/?x", "<link rel=stylesheet href=/a/c>"),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id bigint, url string, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(oracle.filtered(queries.URL_RULES)).fetchall()
    got = [tuple(r) for r in queries.op4_url_filters(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    verdicts = {r[0]: r[4] for r in got}
    assert [verdicts[i] for i in (0, 1, 2, 3, 4, 5, 10, 15)] == ["block", "block", "block", "block", "block", "allow", "allow", "allow"]
