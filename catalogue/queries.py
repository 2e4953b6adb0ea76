"""Every operator as a query over whole test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.fixtures import NOW, spread, table, view
from entityflow.functions import labels, names, text, times, urls
from entityflow.operators import chunks, dedup, enrich, filters, graph, graph_state, replies, reports, resolve, timed, vector_index, vectors
from entityflow.operators.pin import pin
from entityflow.plans import records, run
from entityflow.schemas import CONTENT, DEFAULT_TARGET, JOB, NEWS, PRODUCT, REQUIRED, RESEARCH_PAPER, STARTUP, PRICING_VALUES
from entityflow.session import configure, settle, work_path
from entityflow.sinks import envelopes, tabs
from entityflow.sources import cards, pages, papers, sites
from entityflow.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
REPLY_SCHEMA_JSON = '{"title": "ProductContent", "type": "object"}'


def query(fn: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    configured.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = configured
    return configured


def as_time(column) -> F.Column:
    return F.date_format(column, TIME_FORMAT)


# --- shared inputs ----------------------------------------------------------------


def raw_papers(spark, sf):
    """fx_papers cleaned the way feed entries are."""
    return view(spark, sf, "fx_papers").select(
        "row_id", "source_rank", "page_no",
        text.clean_title("title").alias("title"),
        text.clean_array(F.split("authors_raw", ";")).alias("authors"),
        text.strip("paper_url").alias("paper_url"),
        "summary",
        text.first_repo_url("summary").alias("github_url"),
        F.col("published"),
        times.parse_iso("published").alias("published_date"),
    )


def usable_papers(spark, sf):
    return filters.require(raw_papers(spark, sf), ["title", "paper_url"])


def startup_rows(spark, sf):
    return view(spark, sf, "fx_startups").select(
        "row_id", "source_rank", "page_no", "href",
        urls.absolute_url("href", F.lit(sites.COMPANY_SITE[1])).alias("url"),
        "name", text.employee_count("badge").alias("employee_count"),
    )


def news_rows(spark, sf):
    rows = view(spark, sf, "fx_news").select(
        "row_id", "title", urls.absolute_url("href", "base_url").alias("url"),
        F.lit("Example News").alias("site_name"), F.col("base_url").alias("site_url"), "raw_time",
    )
    return timed.fresh_by_text(rows, "raw_time", "published_at", NOW)


def job_rows(spark, sf):
    return view(spark, sf, "fx_jobs").withColumn("published_at", times.as_instant(NOW))


def enriched_papers(spark, sf):
    return enrich.enrich_stars(dedup.first_seen(usable_papers(spark, sf), "paper_url"), view(spark, sf, "fx_stars"))


KEEP = ("row_id",)


def envelope_tables(spark, sf):
    return {
        STARTUP: envelopes.startup_envelopes(startup_rows(spark, sf), NOW, KEEP),
        PRODUCT: envelopes.product_envelopes(view(spark, sf, "fx_products"), NOW, KEEP),
        RESEARCH_PAPER: envelopes.paper_envelopes(enriched_papers(spark, sf), NOW, KEEP),
        JOB: envelopes.job_envelopes(job_rows(spark, sf), NOW, KEEP),
        NEWS: envelopes.news_envelopes(news_rows(spark, sf), NOW, KEEP),
    }


def name_uses(spark, sf):
    jobs = view(spark, sf, "fx_jobs").select("row_id", labels.company_or_site("company", "site_name").alias("company"))
    return resolve.occurrences({
        STARTUP: (view(spark, sf, "fx_startups"), "name", "row_id"),
        PRODUCT: (view(spark, sf, "fx_products"), "name", "row_id"),
        JOB: (jobs, "company", "row_id"),
    })


def logged_uses(spark, sf):
    uses = name_uses(spark, sf)
    return resolve.mapping_log(uses, settle(resolve.resolve(uses), "name-map"))


# --- names and resolution ------------------------------------------------------------


@query
def normalize_names(spark, sf):
    return view(spark, sf, "fx_names").select(
        "name_id", names.normalize_name("raw_name").alias("norm"), names.tight_name("raw_name").alias("tight")
    )


@query
def resolve_names(spark, sf):
    out = resolve.resolve(view(spark, sf, "fx_names"))
    return out.withColumn("match_score", F.bround("match_score", 1))


@query
def resolve_names_joined(spark, sf):
    """The cascade as equality joins, the way it runs with a seed list of any length."""
    out = resolve.resolve(view(spark, sf, "fx_names"), small=0)
    return out.withColumn("match_score", F.bround("match_score", 1))


@query
def resolve_batch(spark, sf):
    return resolve.resolve_batch(view(spark, sf, "fx_names"))


@query
def mapping_log(spark, sf):
    return logged_uses(spark, sf).select(
        "table_rank", "record_type", "row_id", "raw_name", "canonical_name",
        F.bround("match_score", 1).alias("match_score"), "matched_seed",
    )


@query
def review_queue(spark, sf):
    log = filters.unmatched(logged_uses(spark, sf))
    return log.groupBy("raw_name", "canonical_name").agg(F.count(F.lit(1)).alias("n_uses"))


@query
def resolve_scores(spark, sf):
    """Best weighted ratio per distinct normal form, over all seeds."""
    norms = view(spark, sf, "fx_names").select(names.normalize_name("raw_name").alias("norm")).distinct()
    scored = resolve.best_scores(norms, resolve.seed_table(spark))
    return scored.select("norm", F.col("form").alias("best_seed"), F.round("score", 3).alias("score"))


@query
def resolve_many_seeds(spark, sf):
    """Best weighted ratio per distinct normal form, over all customer names as seeds."""
    norms = view(spark, sf, "fx_names").select(names.normalize_name("raw_name").alias("norm")).distinct()
    seeds = table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("seed_rank"), F.col("c_name").alias("seed"))
    scored = resolve.best_scores(norms, seeds)
    return scored.select("norm", F.col("form").alias("best_seed"), F.round("score", 3).alias("score"))


@query
def resolve_low_threshold(spark, sf):
    """The cascade at threshold 90, where the partial ratios matter."""
    out = resolve.resolve(view(spark, sf, "fx_names"), threshold=90.0, scores=True)
    return out.withColumn("match_score", F.bround("match_score", 1))


@query
def apply_mapping(spark, sf):
    products = envelopes.product_envelopes(view(spark, sf, "fx_products"), NOW, KEEP)
    resolved = settle(resolve.resolve(products, raw="content.startupName"), "name-map")
    mapped = resolve.apply_mapping(products, resolved, "content.startupName")
    return mapped.select("row_id", "content.startupName", "content.pricingModel")


@query
def lookup_tiers(spark, sf):
    """Which exact tier decides each distinct name."""
    seeds = resolve.seed_table(spark)
    distinct = view(spark, sf, "fx_names").select("raw_name").distinct()
    tiers = resolve.lookup_tight(
        resolve.lookup_exact(distinct.withColumn("norm", names.normalize_name("raw_name")), seeds), seeds
    )
    return tiers.select("raw_name", "norm", "exact_name", "tight_match")


# --- times -----------------------------------------------------------------------------


@query
def parse_times(spark, sf):
    return view(spark, sf, "fx_times").select(
        "event_id", as_time(times.parse_time("raw_time", NOW)).alias("parsed")
    )


@query
def parse_clock_times(spark, sf):
    """Dates with clock times, offsets and leading words."""
    fx = view(spark, sf, "fx_clock_times").withColumn("at", times.parse_time("raw_time", NOW))
    return fx.select("event_id", as_time("at").alias("parsed"), times.is_fresh("at", NOW).alias("fresh"))


@query
def parse_iso_dates(spark, sf):
    return view(spark, sf, "fx_papers").select("row_id", as_time(times.parse_iso("published")).alias("published"))


@query
def fresh_rows(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return filters.fresh_only(events, "ts", NOW).select("event_id", "user_id", as_time("ts").alias("ts"))


@query
def fresh_news(spark, sf):
    return news_rows(spark, sf).select("row_id", "title", "url", as_time("published_at").alias("published_at"))


@query
def quarantined_times(spark, sf):
    parsed = timed.add_time(view(spark, sf, "fx_times"), "raw_time", "parsed", NOW)
    _, bad = filters.split_bad(parsed, ["parsed"])
    return bad.select("event_id", "raw_time", F.array_join("faults", ",").alias("faults"))


# --- labels ----------------------------------------------------------------------------


@query
def pricing_models(spark, sf):
    return view(spark, sf, "fx_products").select("row_id", labels.pricing_model("pricing_raw").alias("pricing_model"))


@query
def enum_check(spark, sf):
    raw = view(spark, sf, "fx_products").select("row_id", F.upper(text.strip("pricing_raw")).alias("pricingModel"))
    return filters.valid_enum(raw)


@query
def role_families(spark, sf):
    return view(spark, sf, "fx_jobs").select(
        "row_id", labels.role_family("title").alias("role_family"), labels.is_remote("title").alias("is_remote"),
        labels.company_or_site("company", "site_name").alias("company"),
    )


# --- papers ----------------------------------------------------------------------------


@query
def repo_links(spark, sf):
    return raw_papers(spark, sf).select("row_id", "github_url")


@query
def repo_slugs(spark, sf):
    return enrich.distinct_slugs(raw_papers(spark, sf))


@query
def star_enrichment(spark, sf):
    out = enrich.enrich_stars(usable_papers(spark, sf), view(spark, sf, "fx_stars"))
    return out.select("row_id", "paper_url", "github_url", "github_stars")


@query
def star_enrichment_by_slug(spark, sf):
    out = enrich.enrich_stars(usable_papers(spark, sf), view(spark, sf, "fx_stars"), key="slug")
    return out.select("row_id", "paper_url", "github_url", "github_stars")


@query
def repo_stars(spark, sf):
    """Star table written and read back through its reader."""
    place = work_path(spark, "repo-stars")
    view(spark, sf, "fx_stars").write.parquet(place)
    return papers.read_repo_stars(spark, place)


@query
def clean_titles(spark, sf):
    return view(spark, sf, "fx_papers").select("row_id", text.clean_title("title").alias("title"))


@query
def clean_authors(spark, sf):
    return raw_papers(spark, sf).select("row_id", F.array_join("authors", "|").alias("authors"))


@query
def required_fields(spark, sf):
    return usable_papers(spark, sf).select("row_id", "paper_url", "title")


@query
def first_seen_papers(spark, sf):
    return dedup.first_seen(usable_papers(spark, sf), "paper_url").select("row_id", "paper_url", "source_rank", "page_no")


@query
def take_until_target(spark, sf):
    return dedup.take_until(usable_papers(spark, sf), "paper_url", 300).select("row_id", "paper_url", "source_rank", "page_no")


@query
def take_until_tags(spark, sf):
    """Whole tags until 600 unique companies are met."""
    return dedup.take_until(startup_rows(spark, sf), "href", 600, page=None).select("row_id", "href", "source_rank")


@query
def target_pages(spark, sf):
    return dedup.target_grains(usable_papers(spark, sf), "paper_url", 300)


@query
def page_windows(spark, sf):
    feed = raw_papers(spark, sf).drop("page_no").withColumn("published", F.col("published_date"))
    order = [F.desc_nulls_last("published"), F.col("paper_url"), F.col("row_id")]
    out = dedup.page_window(feed, "source_rank", order, page_size=10, cap=150, salt_by="row_id")
    return out.select("row_id", "source_rank", "page_no", "feed_rank")


@query
def atom_entries(spark, sf):
    """Feed pages of up to 100 entries written as files and read back."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\n"), F.lit("&#10;"))
    entry = F.concat(
        F.lit("<entry><id>"), esc(F.col("paper_url")), F.lit("</id><title>"), esc(F.col("title")), F.lit("</title><summary>"),
        esc(F.col("summary")), F.lit("</summary><published>"), F.col("published"), F.lit("</published>"),
        F.array_join(
            F.transform(F.split("authors_raw", ";"), lambda a: F.concat(F.lit("<author><name>"), a, F.lit("</name></author>"))), ""
        ),
        F.lit("</entry>"),
    )
    feed = view(spark, sf, "fx_papers").withColumn("page", F.floor(F.col("row_id") / 100)).groupBy("page").agg(
        F.array_join(F.array_sort(F.collect_list(entry)), "").alias("entries")
    )
    place = work_path(spark, "feed")
    feed.select(F.concat(
        F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>feed</title>'), "entries", F.lit("</feed>")
    ).alias("value")).write.text(place)
    out = papers.read_papers(spark, place, per="line")
    return out.select(
        "title", "paper_url", "github_url", F.array_join("authors", "|").alias("authors"), "published",
    )


# --- reports ----------------------------------------------------------------------------


@query
def source_counts(spark, sf):
    docs = table(spark, sf, "documents").select("source", F.substring("source", 4, 10).cast("int").alias("source_rank"))
    return reports.counts_by_source(docs, "source", "source_rank")


@query
def source_status(spark, sf):
    """Sources with at least one document over 12,000 characters."""
    docs = table(spark, sf, "documents")
    return reports.source_status(docs, docs.filter("n_chars > 12000"), "source")


@query
def union_sources(spark, sf):
    tagged = reports.union_sources({
        "papers": usable_papers(spark, sf).select(F.col("row_id")),
        "startups": view(spark, sf, "fx_startups").select(F.col("row_id")),
        "products": view(spark, sf, "fx_products").select(F.col("row_id")),
    })
    return tagged.groupBy("source_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("row_id").alias("sum_ids"))


@query
def run_summary(spark, sf):
    return reports.run_summary(envelope_tables(spark, sf), logged_uses(spark, sf))


@query
def target_check(spark, sf):
    return reports.target_check(reports.run_summary(envelope_tables(spark, sf)))


# --- sinks ------------------------------------------------------------------------------


@query
def tab_startups(spark, sf):
    tab = tabs.startups_tab(envelopes.startup_envelopes(startup_rows(spark, sf), NOW))
    return tab.withColumn("collectedAt", as_time("collectedAt"))


@query
def tab_products(spark, sf):
    tab = tabs.products_tab(envelopes.product_envelopes(view(spark, sf, "fx_products"), NOW))
    return tab.withColumn("collectedAt", as_time("collectedAt"))


@query
def tab_papers(spark, sf):
    tab = tabs.papers_tab(envelopes.paper_envelopes(enriched_papers(spark, sf), NOW))
    return tab.withColumn("published_date", as_time("published_date"))


@query
def tab_jobs(spark, sf):
    tab = tabs.jobs_tab(envelopes.job_envelopes(job_rows(spark, sf), NOW))
    return tab.withColumn("date", as_time("date"))


@query
def tab_news(spark, sf):
    tab = tabs.news_tab(envelopes.news_envelopes(news_rows(spark, sf), NOW))
    return tab.withColumn("publishedAt", as_time("publishedAt"))


@query
def tab_mapping_log(spark, sf):
    return tabs.mapping_log_tab(logged_uses(spark, sf))


@query
def tab_text(spark, sf):
    return tabs.as_text(tabs.startups_tab(envelopes.startup_envelopes(startup_rows(spark, sf), NOW)))


@query
def publish_tabs(spark, sf):
    """All six tabs published; one line per tab with its rows."""
    made = envelope_tables(spark, sf)
    wanted = {run.TABS[t][0]: run.TABS[t][1](df) for t, df in made.items()}
    wanted["Entity Mapping Log"] = tabs.mapping_log_tab(logged_uses(spark, sf))
    places = tabs.publish_tabs(wanted, folder=work_path(spark, "tabs"))
    return reports.run_summary({name: tabs.read_tab(spark, place) for name, place in places.items()})


@query
def publish_empty(spark, sf):
    """A news tab with nothing fresh left (a run three days later) holds one marker row."""
    late = filters.fresh_only(news_rows(spark, sf), "published_at", "2024-02-03 00:00:00")
    places = tabs.publish_tabs(
        {"News": tabs.news_tab(envelopes.news_envelopes(late, NOW))}, folder=work_path(spark, "tabs")
    )
    return tabs.read_tab(spark, places["News"])


@query
def flatten_columns(spark, sf):
    flat = tabs.flatten(envelopes.startup_envelopes(startup_rows(spark, sf), NOW, KEEP), sep="_")
    return flat.withColumn("collectedAt", as_time("collectedAt"))


@query
def backup_csv(spark, sf):
    """Paper records written as CSV and read back as text."""
    made = envelopes.paper_envelopes(enriched_papers(spark, sf), NOW)
    place = tabs.write_backups({"research_papers": made}, work_path(spark, "backups"))["research_papers"]
    back = spark.read.option("header", True).option("escape", '"').csv(place)
    return back.select(
        "recordType", F.col("`content.title`").alias("title"), F.col("`content.authors`").alias("authors"),
        F.col("`content.paper_url`").alias("paper_url"), F.col("`content.github_stars`").alias("github_stars"),
    )


@query
def envelope_store(spark, sf):
    """The store written by record type, read back and counted with its content checked."""
    place = work_path(spark, "store")
    envelopes.write_store(envelopes.envelope_store(envelope_tables(spark, sf)), place)
    store = spark.read.parquet(place)
    return store.select(
        "recordType", "schemaVersion", as_time("collectedAt").alias("collectedAt"), "source_name", "source_url",
        F.coalesce(
            F.get_json_object("content", "$.entityName"), F.get_json_object("content", "$.startupName"),
            F.get_json_object("content", "$.title"), F.get_json_object("content", "$.company"),
            F.get_json_object("content", "$.headline"),
        ).alias("subject"),
    )


@query
def content_query(spark, sf):
    place = work_path(spark, "store")
    envelopes.write_store(envelopes.envelope_store(envelope_tables(spark, sf)), place)
    found = envelopes.query_content(
        spark.read.parquet(place), STARTUP,
        {"entity_name": "$.entityName", "employee_count": "$.data.employeeCount"},
        collected_from="2024-01-30 00:00:00", collected_to="2024-02-01 00:00:00", schema_version="1.0",
    )
    return found.select("entity_name", F.col("employee_count").cast("int").alias("employee_count"))


@query
def employee_counts(spark, sf):
    return view(spark, sf, "fx_startups").select("row_id", text.employee_count("badge").alias("employee_count"))


# --- pages and cards --------------------------------------------------------------------


@query
def page_links(spark, sf):
    got = pages.page_links(pages.read_pages(spark, f"{sf.rstrip('/')}/pages.parquet"))
    return got.select("page_id", "link_no", "href", urls.absolute_url("href", "url").alias("link"))


@query
def absolute_urls(spark, sf):
    return view(spark, sf, "fx_news").select("row_id", urls.absolute_url("href", "base_url").alias("url"))


@query
def size_cap(spark, sf):
    """Pages whose body is at most 1,500 bytes."""
    got = pages.read_pages(spark, f"{sf.rstrip('/')}/pages.parquet", max_bytes=1_500)
    return got.select("page_id", F.octet_length("html").alias("n_bytes"))


def card_pages(spark, sf):
    """fx_card_pages with the address of a real site per kind, joined to the site rows."""
    address = (
        F.when(F.col("kind") == "news", sites.NEWS_SITES[0][1])
        .when(F.col("kind") == "product", F.concat(F.lit(f"{sites.PRODUCT_SITE[1]}/ai-tools/marketing?page="), (F.col("page_id") % 40 + 1).cast("string")))
        .otherwise(sites.JOB_SITES[4][1])
    )
    fx = view(spark, sf, "fx_card_pages").select("page_id", address.alias("url"), "html")
    return sites.pages_for_site(fx, sites.site_config(spark))


@query
def site_pages(spark, sf):
    return card_pages(spark, sf).select("page_id", "kind", "source_rank", "site_name", "extractor")


@query
def card_extraction(spark, sf):
    got = cards.extract_cards(card_pages(spark, sf), NOW)
    return got.select("page_id", "site_name", "card_no", "title", "url", as_time("published_at").alias("published_at"))


@query
def product_cards(spark, sf):
    return cards.extract_product_cards(card_pages(spark, sf))


@query
def job_postings(spark, sf):
    got = cards.extract_job_postings(card_pages(spark, sf), NOW)
    return got.select("page_id", "row_no", "title", "url", "company", as_time("published_at").alias("published_at"))


def wild_pages(spark, sf):
    """Pages with unclosed elements, deep nesting and every way of quoting, placed on job sites."""
    jobs = sites.JOB_SITES
    address = F.when(F.col("kind") == "rows", jobs[4][1]).when(F.col("kind") == "list", jobs[2][1]).otherwise(sites.NEWS_SITES[0][1])
    fx = view(spark, sf, "fx_wild_pages").select("page_id", F.col("kind").alias("page_kind"), address.alias("url"), "html")
    pages = sites.pages_for_site(fx, sites.site_config(spark))
    # The news site's links are in headings; these pages have plain ones.
    plain = F.col("page_kind").isin("deep", "broken")
    return pages.withColumn("title_selector", F.when(plain, "a").otherwise(F.col("title_selector"))).withColumn(
        "link_selector", F.when(plain, "a").otherwise(F.col("link_selector")))


@query
def wild_cards(spark, sf):
    """Cards as a browser sees them: an unclosed item ends at the next one, so no card takes another one's time."""
    got = cards.extract_cards(wild_pages(spark, sf), NOW)
    return got.select("page_id", "card_no", "title", "url", as_time("published_at").alias("published_at"))


@query
def wild_job_rows(spark, sf):
    got = cards.extract_job_postings(wild_pages(spark, sf), NOW)
    return got.select("page_id", "row_no", "title", "url", "company")


def failing(html, row):
    raise ValueError("unreadable")


@query
def page_failures(spark, sf):
    """Pages whose reading fails come out as rows with the reason."""
    pages = wild_pages(spark, sf).withColumn("extractor", F.when(F.col("page_kind") == "broken", "failing").otherwise(F.col("extractor")))
    return cards.page_failures(pages, extractors={"failing": failing})


@query
def rejected_bodies(spark, sf):
    """Page bodies over a size cap, with their size and the reason."""
    return filters.rejected_bodies(table(spark, sf, "pages"), "html", 1_500)


def company_pages(spark, sf):
    """One directory page per start-up row, its name escaped into the markup."""
    name = F.replace(F.replace(F.col("name"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(
        F.lit('<main><a class="x" href="'), "href", F.lit('"><li><div><span class="text-2xl b">'), name,
        F.lit('</span><span class="text-gray-700">Berlin</span><span class="text-gray-700">'), "badge",
        F.lit('</span></div></li></a><a href="/companies/logo"><img src="l.png"></a></main>'),
    )
    tag = F.element_at(F.array(*[F.lit(t) for t in sites.COMPANY_TAGS]), F.col("source_rank") + 1)
    fx = spread(view(spark, sf, "fx_startups")).select(
        F.col("row_id").alias("page_id"),
        F.concat(F.lit(f"{sites.COMPANY_SITE[1]}/companies/industry/"), tag).alias("url"), html.alias("html"),
    )
    return sites.pages_for_site(pin(fx, "html", F.col("html")), sites.site_config(spark))


@query
def company_cards(spark, sf):
    return cards.extract_company_cards(company_pages(spark, sf))


# --- chunks and replies --------------------------------------------------------------------


@query
def collapse_ws(spark, sf):
    return view(spark, sf, "fx_paragraphs").select("doc_id", text.collapse_whitespace("text").alias("text"))


@query
def text_chunks(spark, sf):
    """Every document whole, at the default chunk size."""
    got = chunks.chunk_text(table(spark, sf, "documents").select("doc_id", "text"))
    return got.select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"), F.sha2("chunk", 256).alias("digest"))


@query
def paragraph_chunks(spark, sf):
    return chunks.chunk_text(view(spark, sf, "fx_paragraphs"), max_chars=200)


@query
def prompts(spark, sf):
    got = chunks.with_prompt(chunks.chunk_text(table(spark, sf, "documents").select("doc_id", "text")), REPLY_SCHEMA_JSON)
    return got.select("doc_id", "chunk_no", F.sha2("prompt", 256).alias("digest"))


def checked_replies(spark, sf):
    return replies.validate_json(
        view(spark, sf, "fx_replies"), CONTENT[PRODUCT], REQUIRED[PRODUCT], enums={"pricingModel": PRICING_VALUES}
    )


@query
def valid_replies(spark, sf):
    return checked_replies(spark, sf).select(
        "doc_id", "chunk_no", "provider_rank", "is_valid", F.col("parsed.startupName").alias("startupName"),
        F.col("parsed.pricingModel").alias("pricingModel"),
    )


@query
def first_valid(spark, sf):
    return replies.first_valid(checked_replies(spark, sf))


# --- URL keys and dedup ------------------------------------------------------------------------


@query
def canonical_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.canonical_url("url").alias("canonical"))


@query
def url_keys(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.url_key("url").alias("url_key"))


@query
def unseen_urls(spark, sf):
    """Pages whose key none of the http pages carries."""
    keyed = table(spark, sf, "pages").select("page_id", "url", urls.url_key("url").alias("url_key"))
    seen = keyed.filter(F.col("url").startswith("http://"))
    return dedup.unseen(keyed, seen).select("page_id", "url_key")


@query
def ttl_dedup(spark, sf):
    got = dedup.ttl_dedup(table(spark, sf, "events"), "user_id", "ts", 24)
    return got.select("user_id", F.unix_micros("ts").alias("ts_us"))


# --- streams: the events file read as a stream, run until its input is used up ---------------


def table_stream(spark, sf, name):
    """A table's file, or all files of its folder, as a stream; as a pattern, since a plain path must be a folder."""
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf.rstrip('/')}/{{{name}.parquet}}")


def event_stream(spark, sf):
    return table_stream(spark, sf, "events")


def drained(spark, stream, label):
    sink = work_path(spark, label)
    feeds.run_to_table(stream, sink, work_path(spark, f"{label}-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


@query
def ttl_dedup_hot_key(spark, sf):
    """One key holds a third of all rows, and a time to live of one hour makes long runs of accepted times."""
    events = table(spark, sf, "events").withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).cast("bigint"))
    got = dedup.ttl_dedup(events, "k", "ts", 1)
    return got.select("k", F.unix_micros("ts").alias("ts_us"))


@query
def fresh_stream(spark, sf):
    fresh = feeds.fresh_stream(event_stream(spark, sf).select("event_id", "user_id", "ts"), now=NOW)
    got = drained(spark, fresh, "fresh-stream")
    return got.select("event_id", "user_id", as_time("ts").alias("ts"))


@query
def ttl_dedup_stream(spark, sf):
    events = event_stream(spark, sf).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    # The last row has no key and is later than all others: it closes the stream.
    place, last = work_path(spark, "closing-row"), table(spark, sf, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("ts"))
    last.select(F.lit(None).cast(events.schema["user_id"].dataType).alias("user_id"), (F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("ts")).write.parquet(place)
    closing = spark.readStream.schema(events.schema).parquet(place)
    got = drained(spark, feeds.ttl_dedup_stream(events.unionByName(closing), "user_id"), "ttl-stream")
    return got.select("user_id", F.unix_micros("ts").alias("ts_us"))


@query
def dedup_stream(spark, sf):
    """One micro-batch of the whole file: exactly one row per user remains."""
    once = feeds.dedup_stream(event_stream(spark, sf).select("user_id", "ts"), "user_id")
    return drained(spark, once, "dedup-stream").select("user_id")


@query
def unseen_stream(spark, sf):
    keyed = table_stream(spark, sf, "pages").select(urls.url_key("url").alias("url_key"), "page_id", "url")
    sink, seen = work_path(spark, "new-pages"), work_path(spark, "seen-pages")
    feeds.unseen_stream(keyed, sink, seen, work_path(spark, "unseen-checkpoint")).awaitTermination()
    return spark.read.parquet(sink).select("url_key", "page_id", "url")


# --- graph and vectors ----------------------------------------------------------------------------


def graph_inputs(spark, sf):
    startups = view(spark, sf, "fx_startups").select("row_id", F.col("name").alias("entityName"))
    products = view(spark, sf, "fx_products").select(F.col("name").alias("startupName"), "url")
    both = resolve.occurrences({STARTUP: (startups, "entityName", None), PRODUCT: (products, "startupName", None)})
    resolved = settle(resolve.resolve(both), "name-map")
    return (
        resolve.apply_mapping(startups, resolved, "entityName"),
        resolve.apply_mapping(products, resolved, "startupName"),
        usable_papers(spark, sf).select("paper_url", "authors"),
    )


@query
def graph_nodes(spark, sf):
    return graph.graph_nodes(*graph_inputs(spark, sf))


@query
def graph_edges(spark, sf):
    startups, products, authored = graph_inputs(spark, sf)
    links = view(spark, sf, "fx_links").filter("link_type = 'paper_startup'")
    founded = links.join(startups, links.startup_row_id == startups.row_id).select("person", "entityName")
    return graph.graph_edges(startups, products, authored, founded)


def graph_in_batches(spark, sf):
    """(path, last batch) of a graph state fed by three batches: drafts, late versions and records that go again, then the given ones."""
    startups, products, authored = graph_inputs(spark, sf)
    links = view(spark, sf, "fx_links").filter("link_type = 'paper_startup'")
    founded = links.join(startups, links.startup_row_id == startups.row_id).select("person", "entityName")

    def changes(version, papers=authored, products=products):
        version = F.lit(version)
        parts = [graph_state.startup_changes(startups, version), graph_state.product_changes(products, version),
                 graph_state.paper_changes(papers, version), graph_state.founder_changes(founded, version)]
        return reduce(DataFrame.unionByName, parts)

    drafts = authored.withColumn("authors", F.concat(F.slice("authors", 1, 1), F.array(F.lit("Draft Author"))))
    passing = authored.withColumn("paper_url", F.concat("paper_url", F.lit("#gone")))
    elsewhere = products.withColumn("startupName", F.concat(F.lit("Not "), "startupName"))
    odd = F.pmod(F.xxhash64("record_id"), F.lit(2)) == 1
    path = work_path(spark, "graph")
    drawn = changes(1, drafts, elsewhere)
    graph_state.apply_changes(drawn.where(~odd).unionByName(graph_state.paper_changes(passing, F.lit(1))), path, 0)
    graph_state.apply_changes(changes(3).where(odd), path, 1)
    gone = graph_state.removals(graph_state.paper_changes(passing, F.lit(2)))
    graph_state.apply_changes(changes(2).where(~odd).unionByName(drawn.where(odd)).unionByName(gone), path, 2)
    return path, 2


@query
def graph_nodes_updated(spark, sf):
    return graph_state.nodes(spark, *graph_in_batches(spark, sf))


@query
def graph_edges_updated(spark, sf):
    return graph_state.edges(spark, *graph_in_batches(spark, sf))


@query
def people_in_both(spark, sf):
    links = view(spark, sf, "fx_links").filter("link_type = 'person_job'")
    return graph.people_in_both(usable_papers(spark, sf), links)


@query
def startups_from_papers(spark, sf):
    startups, _, authored = graph_inputs(spark, sf)
    links = view(spark, sf, "fx_links").filter("link_type = 'paper_startup'")
    return graph.startups_from_papers(startups, authored, links.select(F.col("startup_row_id").alias("row_id"), "paper_url"))


@query
def products_of_startup(spark, sf):
    startups, products, _ = graph_inputs(spark, sf)
    return graph.products_of_startup(products, startups)


@query
def same_parent(spark, sf):
    return graph.same_parent(graph_inputs(spark, sf)[1])


@query
def similar_vectors(spark, sf):
    """The ten nearest vectors of each label's first vector."""
    emb = table(spark, sf, "embeddings")
    queries = emb.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return vectors.similar(emb, queries, k=10)


@query
def similar_indexed(spark, sf):
    """The same through the inverted-list index, with all cells visited and all codes kept, so that the result is exact."""
    emb = table(spark, sf, "embeddings")
    queries = emb.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    index = vector_index.build_index(emb)
    return vector_index.search(index, emb, queries, k=10, probes=len(index.cells), keep=emb.count())


@query
def near_duplicates(spark, sf):
    return vectors.near_duplicates(table(spark, sf, "embeddings"), 0.4)


@query
def near_duplicates_banded(spark, sf):
    """Planted copies, scaled and shifted, of every vector, found by shared band keys."""
    return vectors.near_duplicates_banded(view(spark, sf, "fx_near_vectors"), 0.98)


# --- whole plans ---------------------------------------------------------------------------------


# What names a record of each type, besides the resolved company name.
RECORD_KEYS = {STARTUP: "source.url", PRODUCT: "source.url", RESEARCH_PAPER: "content.paper_url", JOB: "content.role_family", NEWS: "content.url"}


def digest(key) -> F.Column:
    """Order-free digest of a text column: the sum of the first 32 bits of the rows' MD5."""
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")), F.lit(0)).cast("bigint")


def whole_run(spark, sf, target=None):
    fx_pages, fx_companies = card_pages_raw(spark, sf), company_pages(spark, sf)
    config = sites.site_config(spark)
    stars = view(spark, sf, "fx_stars")
    company_html = fx_companies.select("page_id", "url", "html")
    result = run.run(
        spark,
        {
            STARTUP: lambda: records.startups(company_html, config, NOW, target),
            PRODUCT: lambda: records.products(fx_pages, config, NOW, target),
            RESEARCH_PAPER: lambda: records.papers(raw_papers(spark, sf), stars, NOW, target),
            JOB: lambda: records.jobs(fx_pages, config, NOW, NOW),
            NEWS: lambda: records.news(fx_pages, config, NOW, NOW),
        },
        work_path(spark, "run"),
    )
    if result.errors:
        raise RuntimeError(f"record plans failed: {result.errors}")
    parts = [df.agg(F.lit(t).alias("record_type"), digest(F.col(RECORD_KEYS[t])).alias("content_digest")) for t, df in result.records.items()]
    parts.append(result.log.agg(F.lit("MAPPING_LOG").alias("record_type"), F.lit(0).cast("bigint").alias("content_digest")))
    return result.summary.join(reports.union_sources(parts), "record_type")


@query
def full_run(spark, sf):
    """Pages and feeds to records, names resolved, backups and tabs written; rows and content digest per record type."""
    return whole_run(spark, sf)


@query
def full_run_with_target(spark, sf):
    """The same, with each directory and feed read until 1,000 unique rows are met."""
    return whole_run(spark, sf, DEFAULT_TARGET)


def card_pages_raw(spark, sf):
    return card_pages(spark, sf).select("page_id", "url", "html")
