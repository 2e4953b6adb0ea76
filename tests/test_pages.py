from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from entityflow.operators.enrich import distinct_slugs, enrich_stars
from entityflow.sources import cards, markup, pages, papers, sites

NOW = "2026-09-12 12:00:00"

NEWS_HTML = """<html><body>
<article><h2><a href="/2026/a?x=1&amp;y=2"> Big &amp;
 bold </a></h2><time datetime="2026-09-12T08:00:00Z">ignored</time></article>
<article><h3><a href="https://o.example.org/b">Relative</a></h3><time>2 hours ago</time></article>
<article><h2><a href="/old">Old</a></h2><time datetime="2026-09-10T08:00:00Z"></time></article>
<article><h2><a href="/none">No time</a></h2></article>
<article><h2><a>No link</a></h2><time>1 hour ago</time></article>
<article><h2><a href="/bad">Bad time</a></h2><time>soon</time></article>
</body></html>"""

FEED = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>q</title>
<entry><id> http://p/1 </id><title> A
B </title><summary>Code at https://github.com/o/r.git now</summary><published>2024-01-02T03:04:05Z</published>
<author><name> Ann </name></author><author><name> </name></author><author><name>Bob &amp; Co</name></author></entry>
<entry><id>http://p/2</id><title>Solo</title><author><name>One</name></author><published> </published></entry>
<entry><id>http://p/3</id><title>  </title></entry><entry><title>No id</title></entry></feed>"""


def page_table(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")


def on_sites(spark, rows):
    return sites.pages_for_site(page_table(spark, rows), sites.site_config(spark))


def test_selectors():
    page = markup.Page("<div class='a b'><p>x<br>y</p><ul><li>1<li>2</ul></div><a href='/companies/z'><li>q</li></a><span class='a'></span>")
    find = lambda s: [n.tag for n in markup.select(page.nodes, s)]
    assert find("div.a.b") == ["div"] and find("p") == ["p"] and find(".a") == ["div", "span"]
    assert find("div > p") == ["p"] and find("div > li") == [] and find("div li") == ["li", "li"]
    assert find("a[href^='/companies/']:has(> li)") == ["a"] and find("a[href='/x']") == [] and find("[href]") == ["a"]
    assert find("p, span") == ["p", "span"] and markup.Page("<p>x<br>y</p>").nodes[0].text() == "xy"


def test_site_config(spark):
    by_kind = {r["kind"]: r["count"] for r in sites.site_config(spark).groupBy("kind").count().collect()}
    assert by_kind == {"news": 5, "job": 5, "paper": 5, "product": 7, "company": 5}


def test_pages_meet_their_site(spark):
    rows = [
        ("https://venturebeat.com/category/ai/", "x"), ("https://unknown.example.org/", "x"),
        ("https://www.futurepedia.io/ai-tools/ai-agents?page=3", "x"), ("https://www.futurepedia.io/ai-tools/ai-agents-more", "x"),
        ("https://RemoteOK.com/remote-ai-jobs", "x"),
    ]
    got = {(r["page_id"], r["kind"], r["site_name"]) for r in on_sites(spark, rows).collect()}
    assert got == {(0, "news", "VentureBeat AI"), (2, "product", "ai-agents"), (4, "job", "RemoteOK")}


def test_news_cards(spark):
    got = cards.extract_cards(on_sites(spark, [("https://venturebeat.com/category/ai/", NEWS_HTML), ("https://venturebeat.com/x", None)]), NOW)
    assert sorted((r["title"], r["url"], str(r["published_at"])) for r in got.collect()) == [
        ("Big & bold", "https://venturebeat.com/2026/a?x=1&y=2", "2026-09-12 08:00:00"),
        ("Relative", "https://o.example.org/b", "2026-09-12 10:00:00"),
    ]


def test_self_selector_and_own_extractor(spark):
    row = SimpleNamespace(card_selector="a.card", title_selector="self", link_selector="self", time_selector="time")
    assert list(cards.signal_cards("<a class='card' href='/q'>T <time>now</time></a>", row)) == [("T now", "/q", "now")]
    pages_ = on_sites(spark, [("https://venturebeat.com/category/ai/", "a b"), ("https://venturebeat.com/2", "c")]).withColumn("extractor", F.lit("words"))
    mine = {"words": lambda html, row: [(w, "h", None) for w in html.split()] if html != "c" else 1 / 0}
    assert sorted(r["title"] for r in cards.raw_cards(pages_, ["page_id"], mine).collect()) == ["a", "b"]


def test_directory_cards(spark):
    product = (
        '<div class="x bg-card"><a href="/inner">i</a><a href="https://www.futurepedia.io/tool/my-tool?r=1"><p> My <b>Tool</b> </p></a>'
        '<div class="flex justify-between text-lg"><span> Free Trial </span></div></div>'
        '<div class="bg-card"><a href="https://www.futurepedia.io/tool/x"><p></p></a></div><div class="bg-cards"><p>no</p></div>'
        '<div class="bg-card"><a href="https://www.futurepedia.io/tool/y"><p>Y</p></a></div>'
    )
    company = (
        '<a href="/companies/acme"><li><span class="text-2xl"> Acme </span><span class="text-gray-700">Paris</span>'
        '<span class="text-gray-700">1,234 Employees</span></li></a><a href="/companies/logo">x</a>'
        '<a href="/companies/noname"><li></li></a><a href="/companies/b"><li><i class="text-2xl">B</i></li></a>'
    )
    both = on_sites(spark, [
        ("https://www.futurepedia.io/ai-tools/marketing?page=2", product), ("https://www.ycombinator.com/companies/industry/nlp", company),
    ])
    got = [(r["name"], r["url"], r["pricing_raw"]) for r in cards.extract_product_cards(both).orderBy("card_no").collect()]
    assert got == [("MyTool", "https://www.futurepedia.io/tool/my-tool?r=1", "Free Trial"), ("Y", "https://www.futurepedia.io/tool/y", None)]
    got = [(r["name"], r["url"], r["employee_count"]) for r in cards.extract_company_cards(both).orderBy("card_no").collect()]
    assert got == [("Acme", "https://www.ycombinator.com/companies/acme", 1234), ("B", "https://www.ycombinator.com/companies/b", None)]


def test_job_rows(spark):
    html = """<table><tr class="job x" data-id="1" data-href="/j/1" data-company="A &amp; B"><td><script type="application/ld+json">
{"title": "AI Engineer", "datePosted": "2026-09-12T01:00:00+00:00"}</script></td></tr>
<tr class="job" data-id="2" data-href="/j/2"><script type="application/ld+json">{"title":"Old","datePosted":"2026-09-01"}</script></tr>
<tr class="job" data-id="3" data-href="/j/3"><script type="application/ld+json">{bad</script></tr>
<tr class="job" data-id="4"><script type="application/ld+json">{"title":"No link","datePosted":"2026-09-12"}</script></tr>
<tr class="jobs" data-id="5" data-href="/j/5"><script type="application/ld+json">{"title":"Other class","datePosted":"2026-09-12"}</script></tr>
<tr class="job" data-id="6" data-href="/j/6"><script type="application/ld+json">{"title":"No company","datePosted":"2026-09-12"}</script></tr>
<tr class="job" data-id="7" data-href="/j/7"><script type="application/ld+json">{"title":"Relative","datePosted":"2 hours ago"}</script></tr></table>"""
    got = cards.extract_job_postings(on_sites(spark, [("https://remoteok.com/remote-ai-jobs", html)]), NOW)
    assert sorted((r["title"], r["url"], r["company"]) for r in got.collect()) == [
        ("AI Engineer", "https://remoteok.com/j/1", "A & B"), ("No company", "https://remoteok.com/j/6", None),
    ]


@pytest.mark.parametrize("per", ["file", "line"])
def test_feed_pages(spark, tmp_path, per):
    one_line = FEED.replace("A\nB", "A&#10;B").replace("\n", "")
    if per == "file":
        (tmp_path / "a.xml").write_text(FEED)
        (tmp_path / "b.xml").write_text(FEED.replace("</feed>", ""))
        (tmp_path / "c.xml").write_text("")
    else:
        (tmp_path / "all.txt").write_text(one_line + "\n" + one_line.replace("</feed>", "") + "\n")
    rows = papers.read_papers(spark, str(tmp_path), per=per).orderBy("entry_no").collect()
    assert [(r["title"], r["paper_url"], r["authors"], r["github_url"], r["published"]) for r in rows] == [
        ("A B", "http://p/1", ["Ann", "Bob & Co"], "https://github.com/o/r.git", "2024-01-02T03:04:05Z"),
        ("Solo", "http://p/2", ["One"], None, None),
    ]
    assert str(rows[0]["published_date"]) == "2024-01-02 03:04:05" and rows[1]["published_date"] is None
    assert papers.read_papers(spark, str(tmp_path), per=per, max_bytes=10).count() == 0


def test_page_readers(spark, sf, tmp_path):
    all_pages = pages.read_pages(spark, f"{sf}/pages.parquet")
    assert all_pages.count() == spark.read.parquet(f"{sf}/pages.parquet").count()
    (tmp_path / "p.html").write_bytes(b"<a href=\"/x\">\xff</a>")
    (tmp_path / "big.html").write_bytes(b"x" * 100)
    got = pages.read_page_files(spark, str(tmp_path), max_bytes=50).collect()
    assert [r["html"] for r in got] == ['<a href="/x">�</a>']
    links = pages.page_links(page_table(spark, [("u", '<a class="k" href="/1">a</a><A href="/2"></A><a href="/3">')]))
    assert [(r["link_no"], r["href"]) for r in links.collect()] == [(0, "/1"), (1, "/3")]


def test_stars(spark, tmp_path):
    stars = spark.createDataFrame([("o/r", 5), ("o/none", None)], "slug string, stargazers_count int")
    stars.write.json(str(tmp_path / "s"))
    read = papers.read_repo_stars(spark, str(tmp_path / "s"), "json")
    assert {r["slug"]: r["stargazers_count"] for r in read.collect()} == {"o/r": 5, "o/none": 0}
    rows = [
        (0, 0, 1, "p1", "https://github.com/o/r.git"), (0, 0, 2, "p2", "https://github.com/o/r"), (0, 0, 3, "p3", None),
        (0, 0, 4, "p4", "https://github.com/o/none"), (0, 0, 5, "p5", "https://github.com/o/missing"), (1, 0, 0, "p6", "https://github.com/o/r.git"),
    ]
    df = spark.createDataFrame(rows, "source_rank int, page_no int, row_id int, paper_url string, github_url string")
    got = {r["paper_url"]: r["github_stars"] for r in enrich_stars(df, read).collect()}
    assert got == {"p1": 5, "p2": None, "p3": None, "p4": 0, "p5": None, "p6": 5}
    by_slug = {r["paper_url"]: r["github_stars"] for r in enrich_stars(df, read, key="slug").collect()}
    assert by_slug == {"p1": 5, "p2": 5, "p3": None, "p4": 0, "p5": None, "p6": 5}
    assert {r["slug"] for r in distinct_slugs(df).collect()} == {"o/r", "o/none", "o/missing"}


def test_bodies_stay_where_they_are(spark, tmp_path, capsys):
    """At any broadcast threshold, site rows reach the pages without a shuffle or broadcast."""
    place = str(tmp_path / "pages")
    spark.createDataFrame([(1, "https://venturebeat.com/category/ai/", "<p>x</p>")], "page_id bigint, url string, html string").write.parquet(place)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            joined = sites.pages_for_site(spark.read.parquet(place), sites.site_config(spark))
            joined.explain()
            plan = capsys.readouterr().out
            assert "Exchange" not in plan and "Join" not in plan
            assert [r.site_name for r in joined.collect()] == ["VentureBeat AI"]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_long_site_lists_are_joined(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "https://venturebeat.com/x"), (2, "https://www.futurepedia.io/ai-tools/marketing?page=2"), (3, "https://nowhere.example")], "page_id bigint, url string")
    config = sites.site_config(spark)
    want = sorted(map(tuple, sites.pages_for_site(pages, config).collect()))
    monkeypatch.setattr(sites, "SITE_ROWS", 3)
    assert sorted(map(tuple, sites.pages_for_site(pages, config).collect())) == want and len(want) == 2


def test_runs_from_another_folder(tmp_path):
    """Arrow functions find the package although the workers start elsewhere."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from entityflow.session import build_session
from entityflow.operators.chunks import chunk_text
from entityflow.sources import cards, sites
spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false"}})
pages = spark.createDataFrame([(1, "https://www.ycombinator.com/companies/industry/nlp", "<a href='/companies/c'><li><b class='text-2xl'>Zed</b></li></a>")], "page_id bigint, url string, html string")
print("FOUND", cards.extract_company_cards(sites.pages_for_site(pages, sites.site_config(spark))).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND 1" in out.stdout, out.stderr[-2000:]


def test_bare_start_tags_are_read_in_runs(monkeypatch):
    """Thousands of nested elements without attributes cost no parser step each; the page is read as before."""
    steps = []
    plain = markup.HTMLParser.parse_starttag
    monkeypatch.setattr(markup.HTMLParser, "parse_starttag", lambda self, i: steps.append(i) or plain(self, i))
    page = markup.Page("<a href=/d>" + "<i><b>" * 2000 + "De<br>ep</a><i><li>x<LI>y</i><script><p></script>", implied=True)
    assert len(steps) < 10
    assert [page.nodes[0].text(), len(page.nodes)] == ["Deep", 4006]
    assert [(n.text(), n.parent.tag) for n in markup.select(page.nodes, "li")] == [("x", "i"), ("y", "i")]
    assert [n.text() for n in markup.select(page.nodes, "script, p")] == ["<p>"]


@pytest.mark.parametrize("name", ["fx_wild_pages", "fx_card_pages"])
def test_pages_are_dealt_by_number(spark, tmp_path, name):
    """A small file whose rows each become a page is no single task, and a filter on the body stays behind the dealing out."""
    from catalogue.fixtures import TASK_PAGES, view

    place = str(tmp_path / "customer.parquet")
    spark.range(2 * TASK_PAGES + 1).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(place)
    df = view(spark, str(tmp_path), name).filter(F.col("html").contains("<"))
    assert df.rdd.getNumPartitions() == 3 and df.count() == 2 * TASK_PAGES + 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Exchange")


def test_company_pages_are_dealt_by_number(spark, tmp_path):
    """The directory pages of the full run are read by as many tasks as their number asks for, not by one per small file."""
    from catalogue.fixtures import TASK_PAGES
    from catalogue.queries import company_pages

    place = str(tmp_path / "customer.parquet")
    spark.range(2 * TASK_PAGES + 1).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(place)
    df = company_pages(spark, str(tmp_path)).filter(F.col("html").isNotNull())
    assert df.rdd.getNumPartitions() == 3 and df.count() == 2 * TASK_PAGES + 1
