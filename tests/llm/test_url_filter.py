import pytest
from pyspark.sql import functions as F

from tests.llm.hard_rows import plain
from tillwork.llm.url_filter import host_and_path, judge_urls, page_links

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def canonical(url):
    return f'<head><link data-x="1" rel="canonical" href="{url}"></head>'


def refresh(url):
    return f"<META content='0; url={url}' http-equiv='Refresh'>"


def judged(spark, rows, **kw):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule int")
    return {r["page_id"]: r for r in plain(judge_urls(pages, RULES, **kw))}


def test_rules_longest_wins_and_covers_subdomains(spark):
    urls = [
        "http://A.Example.NET/en/1", "http://a.example.net/de/1", "http://net/", "http://xnet/", "http://x.net", "https://b.example.com/de/2?q#f",
        "http://x.org/fr/", "http://x.org/fr", None, "no url", "", "http://x.net/?http://y.org/fr/",
    ]
    got = judged(spark, [(i, u, None, "h", 1) for i, u in enumerate(urls)])
    assert [got[i]["rule"] for i in range(len(urls))] == [
        "example.net/en/", "net/", "net/", None, None, "example.com/de/", "org/fr/", None, None, None, None, "net/"
    ]
    assert [got[i]["verdict"] for i in range(len(urls))] == ["allow", "block", "block", "allow", "allow", "block", "allow", "allow", "allow", "allow", "allow", "block"]
    assert (got[0]["host"], got[0]["path"]) == ("a.example.net", "/en/1")
    assert (got[8]["host"], got[8]["path"], got[9]["host"], got[4]["path"]) == ("", "", "", "")


def test_block_spreads_to_aliases_and_allow_takes_precedence(spark):
    rows = [
        (1, "http://a.com/1", canonical("http://bad.net/x"), "h", 1),  # its canonical address is blocked
        (2, "http://b.com/2#top", refresh("/3"), "h", 1), (3, "http://b.com/3", refresh("//a.com/1"), "h", 1),  # aliases of 1
        (4, "http://c.com/4", canonical("http://x.org/fr/1"), "h", 1), (5, "http://x.net/5", canonical("http://c.com/4"), "h", 1),  # allowed resource, own block
        (6, "http://d.com/6", None, "h", 1), (6, "http://d.com/6", None, "h", 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule int")
    got = plain(judge_urls(pages, RULES))
    assert [(r["page_id"], r["verdict"]) for r in sorted(got, key=lambda r: r["page_id"])] == [
        (1, "block"), (2, "block"), (3, "block"), (4, "allow"), (5, "block"), (6, "allow"), (6, "allow")
    ]


def test_block_spreads_across_http_and_https(spark):
    rows = [
        (1, "http://a.com/1", None, "h", 1), (2, "https://b.com/2", canonical("https://a.com/1"), "h", 1),  # 1 is the canonical address of 2
        (3, "http://b.com/2", refresh("https://bad.net/x"), "h", 1), (4, "https://a.com/1#f", None, "h", 1),
        (5, "http://c.com/5", canonical("https://c.com/5"), "h", 1), (6, "http://d.com/6", None, "h", 1), (7, "https://d.com/6", None, "h", 1),
        (8, "ftp://a.com/1", None, "h", 1),
    ]
    got = judged(spark, rows)
    assert {i: r["verdict"] for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow"}
    assert {got[i]["resource"] for i in (1, 2, 3, 4)} == {"http://b.com/2"}
    assert [got[i]["resource"] for i in (5, 6, 7)] == ["http://c.com/5", "http://d.com/6", "https://d.com/6"]


def test_links(spark):
    rows = [("http://a.com/x/y?q", canonical("z&amp;w")), ("http://a.com", '<link rel="stylesheet" href="s.css">' + canonical("HTTP://B.com/#f")), (None, canonical("http://c.com/"))]
    links = page_links(spark.createDataFrame(rows, "url string, html string"))
    assert {(r["src"], r["dst"]) for r in links.collect()} == {("http://a.com", "http://b.com/"), ("http://a.com/x/y?q", "http://a.com/x/z&w")}


def test_redirects_in_a_long_chain(spark):
    rows = [(i, f"http://h{i}.com/", None, "h", 1) for i in range(40)]
    chain = [(f"http://h{i}.com/", f"http://h{i + 1}.com/") for i in range(39)] + [("http://h39.com/", "http://bad.net/")]
    got = judged(spark, rows, redirects=spark.createDataFrame(chain, "src string, dst string"))
    assert {r["verdict"] for r in got.values()} == {"block"}


def test_empty(spark):
    assert judged(spark, []) == {}
    host, path = host_and_path(F.lit(None).cast("string"))
    assert tuple(spark.range(1).select(host, path).first()) == ("", "")


@pytest.mark.parametrize("name", ["op4_url_filter", "op6_mix"])
def test_sql(spark, name):
    from check_oracle import compare, connect
    from tillwork.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, name, QUERIES[name], ORACLES[name])[0] == "same"


def test_sql_on_linked_pages(spark, tmp_path):
    """Canonical links, refreshes, both schemes, allow and block in one component: the SQL has the same rule."""
    import random

    import duckdb

    from tillwork.llm import queries

    rng = random.Random(3)
    hosts = ["a.com", "b.com", "x.net", "example.net", "C.example.com", "x.org", "d.org"]
    urls = [f"{rng.choice(['http', 'https', 'HTTPS'])}://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randrange(9)}" for _ in range(150)]
    rows = []
    for i, url in enumerate(urls):
        target = rng.choice([rng.choice(urls), "/de/1", "//x.net/en/2", "3", "https://example.net/en/5#top", url.replace("http://", "https://")])
        html = rng.choice([None, "", canonical(target), refresh(target), canonical(target) + refresh(rng.choice(urls)), "<p>none</p>"])
        rows.append((i, url + rng.choice(["", "#f", "?q=1"]), html))
    rows += [(900, None, canonical("http://x.net/")), (901, "no url", refresh("http://a.com/en/1")), (902, "https://only.com/1", canonical("http://only.com/1"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame.coalesce(1).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    want = con.execute(queries.ORACLES["op4_url_filter"])
    names = [d[0] for d in want.description]
    found = judge_urls(frame, queries.URL_RULES)
    assert found.columns == names
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want.fetchall()))
    spread = [r for r in found.collect() if r["rule"] is None and r["verdict"] == "block"]
    assert len(spread) > 3 and page_links(frame).count() > 50
