from datetime import datetime

import pytest
from pyspark.sql import functions as F

from entityflow.plans import records, run
from entityflow.schemas import CONTENT, JOB, NEWS, PRODUCT, RECORD_TYPES, RESEARCH_PAPER, STARTUP, envelope_schema
from entityflow.sinks import envelopes, tabs
from entityflow.sources import papers, sites

from test_pages import FEED, NEWS_HTML

RUN = "2026-09-12 12:00:00"


@pytest.fixture(scope="module")
def made(spark):
    startups = spark.createDataFrame([("Open AI", "https://c/1", 10), (None, "https://c/2", 1)], "name string, url string, employee_count int")
    products = spark.createDataFrame([("Tool", "https://t/1", " free ")], "name string, url string, pricing_raw string")
    paper = spark.createDataFrame(
        [("T", ["A", 'B "q"'], "http://p/1", None, None, datetime(2024, 1, 2))],
        "title string, authors array<string>, paper_url string, github_url string, github_stars int, published_date timestamp",
    )
    jobs = spark.createDataFrame(
        [("Remote SWE", "", "Board", datetime(2026, 9, 12)), ("No date", "X", "Board", None)],
        "title string, company string, site_name string, published_at timestamp",
    )
    news = spark.createDataFrame([("H", "https://n/1", "Site", "https://n", datetime(2026, 9, 12))],
                                 "title string, url string, site_name string, site_url string, published_at timestamp")
    return {
        STARTUP: envelopes.startup_envelopes(startups, RUN), PRODUCT: envelopes.product_envelopes(products, RUN),
        RESEARCH_PAPER: envelopes.paper_envelopes(paper, RUN), JOB: envelopes.job_envelopes(jobs, RUN),
        NEWS: envelopes.news_envelopes(news, RUN),
    }


def test_envelopes_follow_the_declared_schema(made):
    for record_type in RECORD_TYPES:
        df = made[record_type]
        declared = envelope_schema(record_type)
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [(f.name, f.dataType.simpleString()) for f in declared]
        assert df.count() == 1  # a row without a required field is no record
        row = df.first()
        assert (row["schemaVersion"], row["recordType"], row["collectedAt"]) == ("1.0", record_type, datetime(2026, 9, 12, 12))


def test_tabs(made):
    first = lambda df: tuple(df.first())
    at = datetime(2026, 9, 12, 12)
    assert first(tabs.startups_tab(made[STARTUP])) == ("Open AI", 10, "Y Combinator", "https://c/1", at)
    assert first(tabs.products_tab(made[PRODUCT])) == ("Tool", "FREE", "Futurepedia", "https://t/1", at)
    assert first(tabs.papers_tab(made[RESEARCH_PAPER])) == ("T", 'A, B "q"', "http://p/1", None, None, datetime(2024, 1, 2))
    assert first(tabs.jobs_tab(made[JOB])) == ("Board", datetime(2026, 9, 12), True, "Software Engineer")
    assert first(tabs.news_tab(made[NEWS])) == ("H", "https://n/1", datetime(2026, 9, 12), None, "Site")
    assert tabs.as_text(tabs.news_tab(made[NEWS])).first()["summary"] == "None"


def test_mapping_log_tab_rounds_half_to_even(spark):
    log = spark.createDataFrame([("a", "a", 85.25, False), ("b", "b", 94.736, True)],
                                "raw_name string, canonical_name string, match_score double, matched_seed boolean")
    assert [r["match_score"] for r in tabs.mapping_log_tab(log).collect()] == [85.2, 94.7]


def test_flatten_and_backups(spark, made, tmp_path):
    assert tabs.flatten(made[STARTUP]).columns == [
        "schemaVersion", "recordType", "collectedAt", "source.name", "source.url", "content.entityName", "content.data.employeeCount",
    ]
    for _ in range(2):  # replaced on each run
        places = tabs.write_backups({"papers": made[RESEARCH_PAPER], "startups": made[STARTUP]}, str(tmp_path))
    back = spark.read.option("header", True).option("escape", '"').csv(places["papers"])
    assert back.count() == 1 and back.first()["content.authors"] == '["A","B \\"q\\""]'


def test_publish_to_folder_and_database(spark, made, tmp_path):
    wanted = {"Startups": tabs.startups_tab(made[STARTUP]), "News": tabs.news_tab(made[NEWS]).filter("headline = 'gone'")}
    places = tabs.publish_tabs(wanted, folder=str(tmp_path))
    assert tabs.read_tab(spark, places["Startups"]).first()["employeeCount"] == "10"
    assert [tuple(r) for r in tabs.read_tab(spark, places["News"]).collect()] == [(tabs.EMPTY_MARKER,)]
    # A later run with rows replaces the marker.
    tabs.publish_tabs({"News": tabs.news_tab(made[NEWS])}, folder=str(tmp_path))
    assert tabs.read_tab(spark, places["News"]).first()["headline"] == "H"
    spark.sql("CREATE DATABASE IF NOT EXISTS tracked")
    places = tabs.publish_tabs(wanted, database="tracked")
    assert spark.table(places["News"]).first()[0] == tabs.EMPTY_MARKER
    with pytest.raises(ValueError):
        tabs.publish_tabs(wanted)


def test_store_prunes_by_type(spark, made, tmp_path, capsys):
    envelopes.write_store(envelopes.envelope_store(made), str(tmp_path / "store"))
    store = spark.read.parquet(str(tmp_path / "store"))
    assert store.count() == 5
    found = envelopes.query_content(store, JOB, {"company": "$.company"}, collected_from=RUN, collected_to="2026-09-13 00:00:00", schema_version="1.0")
    assert [r["company"] for r in found.collect()] == ["Board"]
    assert envelopes.query_content(store, JOB, {}, collected_to=RUN).count() == 0
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "PushedFilters" in plan and "collectedAt" in plan


def test_full_run(spark, tmp_path):
    config = sites.site_config(spark)
    pages = spark.createDataFrame([
        (1, "https://venturebeat.com/category/ai/", NEWS_HTML),
        (2, "https://remoteok.com/remote-ai-jobs", '<tr class="job" data-id="1" data-href="/j" data-company="Open AI"><script type="application/ld+json">'
            '{"title":"ML Engineer","datePosted":"2026-09-12"}</script></tr>'),
        (3, "https://www.futurepedia.io/ai-tools/marketing?page=1", '<div class="bg-card"><a href="https://www.futurepedia.io/tool/a"><p>Mistral</p></a></div>' * 2),
        (4, "https://www.futurepedia.io/ai-tools/marketing?page=3", '<div class="bg-card"><a href="https://www.futurepedia.io/tool/z"><p>After a gap</p></a></div>'),
        (5, "https://www.ycombinator.com/companies/industry/nlp", '<a href="/companies/c"><li><b class="text-2xl">Zed</b></li></a>'),
    ], "page_id bigint, url string, html string")
    feed = spark.createDataFrame([(0, 0, FEED), (0, 2, FEED)], "source_rank int, page_no int, body string")
    stars = spark.createDataFrame([("o/r", 7)], "slug string, stargazers_count int")
    builders = {
        STARTUP: lambda: records.startups(pages, config, RUN),
        PRODUCT: lambda: records.products(pages, config, RUN),
        RESEARCH_PAPER: lambda: records.papers(records.feed_entries(feed), stars, RUN),
        JOB: lambda: records.jobs(pages, config, RUN, RUN),
        NEWS: lambda: records.news(pages, config, RUN, RUN),
    }
    out = run.run(spark, builders, str(tmp_path / "a"))
    assert not out.errors
    assert {r["record_type"]: r["n_rows"] for r in out.summary.collect()} == {
        STARTUP: 1, PRODUCT: 1, RESEARCH_PAPER: 2, JOB: 1, NEWS: 2, "MAPPING_LOG": 3,
    }
    log = {r["raw_name"]: (r["canonical_name"], r["match_score"], r["matched_seed"]) for r in out.log.collect()}
    assert log["Open AI"] == ("OpenAI", 100.0, True) and log["Mistral"] == ("Mistral AI", 95.0, True) and log["Zed"][0] == "Zed" and not log["Zed"][2]
    assert out.records[JOB].select("content.company").first()[0] == "OpenAI"
    assert {r["title"]: r["github_stars"] for r in out.records[RESEARCH_PAPER].select("content.title", "content.github_stars").collect()} == {"A B": 7, "Solo": None}
    assert set(out.tabs) == set(tabs.TAB_NAMES) and set(out.backups) == set(tabs.BACKUP_NAMES)

    def broken():
        raise RuntimeError("site down")

    out = run.run(spark, {**builders, NEWS: broken}, str(tmp_path / "b"), publish=False)
    assert out.errors == {NEWS: "RuntimeError: site down"}
    assert {r["record_type"]: r["n_rows"] for r in out.summary.collect()}[NEWS] == 0
    assert spark.read.option("header", True).csv(out.backups["news"]).count() == 0


def test_feed_archive_pages(spark):
    rows = [(i % 2, f"u{i}", datetime(2024, 1, 1 + i % 28)) for i in range(250)]
    df = spark.createDataFrame(rows, "source_rank int, paper_url string, published timestamp").withColumn("page_no", F.lit(0))
    got = records.feed_from_archive(df)
    assert {(r["source_rank"], r["page_no"]): r["count"] for r in got.groupBy("source_rank", "page_no").count().collect()} == {
        (0, 0): 100, (0, 1): 25, (1, 0): 100, (1, 1): 25,
    }


def test_content_types_cover_all_records():
    assert set(CONTENT) == set(RECORD_TYPES)
    assert papers.FEED_SCHEMA.startswith("entry ARRAY")
