"""DuckDB counterpart of each query, written independently of the Spark code."""

from __future__ import annotations

from catalogue.fixtures import NOW, with_views

ORACLES: dict[str, str] = {}

NOW_TS = f"TIMESTAMP '{NOW}'"


def _time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def _norm(expr: str) -> str:
    no_suffix = (
        f"regexp_replace(lower({_strip(expr)}), "
        r"'\b(inc\.?|llc|ltd\.?|corp\.?|co\.?|gmbh|s\.a\.|plc)\b\.?', '', 'g')"
    )
    words = rf"regexp_replace({no_suffix}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
    return rf"trim(regexp_replace({words}, '\s+', ' ', 'g'))"


def _iso(expr: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({expr}, '^\d{{4}}-\d{{2}}-\d{{2}}') "
        f"THEN make_timestamp(epoch_us(try_cast({expr} AS TIMESTAMPTZ))) END"
    )


# --- names ---------------------------------------------------------------------------------

ORACLES["normalize_names"] = with_views(
    f"SELECT name_id, {_norm('raw_name')} AS norm, replace({_norm('raw_name')}, ' ', '') AS tight FROM fx_names", "fx_names"
)


def _resolved(names_sql: str) -> str:
    """CTEs ending in ``res`` (raw_name, canonical_name, match_score, matched_seed), one row per distinct name."""
    return f"""
nm AS (SELECT raw_name, {_norm('raw_name')} AS norm FROM (SELECT DISTINCT raw_name FROM ({names_sql}) WHERE raw_name IS NOT NULL)),
sd AS (SELECT seed_rank, seed, {_norm('seed')} AS snorm FROM fx_seeds),
fz AS (SELECT nm.raw_name, sd.seed, sd.seed_rank,
  CASE WHEN length(norm) + length(snorm) >= 20 AND abs(length(norm) - length(snorm)) = 1 AND levenshtein(norm, snorm) = 1
       THEN (1 - 1.0::DOUBLE / (length(norm) + length(snorm))) * 100 ELSE 95.0 END AS score
  FROM nm, sd
  WHERE norm <> '' AND snorm <> ''
   AND greatest(length(norm), length(snorm))::DOUBLE / least(length(norm), length(snorm)) < 1.5
   AND ((length(norm) + length(snorm) >= 20 AND abs(length(norm) - length(snorm)) = 1 AND levenshtein(norm, snorm) = 1)
     OR list_has_all(string_split(norm, ' '), string_split(snorm, ' '))
     OR list_has_all(string_split(snorm, ' '), string_split(norm, ' ')))),
fb AS (SELECT raw_name, seed, score FROM fz QUALIFY row_number() OVER (PARTITION BY raw_name ORDER BY score DESC, seed_rank) = 1),
ex AS (SELECT raw_name, norm,
  (SELECT s.seed FROM sd s WHERE s.snorm = nm.norm ORDER BY seed_rank DESC LIMIT 1) AS exact_name,
  (SELECT s.seed FROM sd s WHERE replace(s.snorm, ' ', '') = replace(nm.norm, ' ', '') ORDER BY seed_rank DESC LIMIT 1) AS tight_match
  FROM nm),
res AS (SELECT ex.raw_name, coalesce(exact_name, tight_match, fb.seed, {_strip('ex.raw_name')}) AS canonical_name,
  CASE WHEN coalesce(exact_name, tight_match) IS NOT NULL THEN 100.0::DOUBLE ELSE round(fb.score, 1)::DOUBLE END AS match_score,
  coalesce(exact_name, tight_match, fb.seed) IS NOT NULL AS matched_seed
  FROM ex LEFT JOIN fb ON fb.raw_name = ex.raw_name)"""


ORACLES["resolve_names"] = with_views(
    f"WITH {_resolved('SELECT raw_name FROM fx_names')} SELECT raw_name, canonical_name, match_score, matched_seed FROM res",
    "fx_seeds", "fx_names",
)
ORACLES["resolve_names_joined"] = ORACLES["resolve_names"]
ORACLES["resolve_batch"] = with_views(
    f"WITH {_resolved('SELECT raw_name FROM fx_names')} SELECT raw_name, canonical_name FROM res", "fx_seeds", "fx_names"
)
ORACLES["lookup_tiers"] = with_views(
    f"WITH {_resolved('SELECT raw_name FROM fx_names')} SELECT raw_name, norm, exact_name, tight_match FROM ex",
    "fx_seeds", "fx_names",
)

USES = """
SELECT 0 AS table_rank, 'STARTUP' AS record_type, row_id, name AS raw_name FROM fx_startups
UNION ALL SELECT 1, 'PRODUCT', row_id, name FROM fx_products
UNION ALL SELECT 2, 'JOB', row_id, coalesce(nullif(company, ''), site_name) FROM fx_jobs"""
USE_VIEWS = ("fx_seeds", "fx_startups", "fx_products", "fx_jobs")

ORACLES["mapping_log"] = with_views(
    f"WITH uses AS ({USES}), {_resolved('SELECT raw_name FROM uses')} SELECT table_rank, record_type, row_id, u.raw_name, "
    "canonical_name, match_score, matched_seed FROM uses u JOIN res ON res.raw_name = u.raw_name", *USE_VIEWS,
)
ORACLES["tab_mapping_log"] = with_views(
    f"WITH uses AS ({USES}), {_resolved('SELECT raw_name FROM uses')} SELECT u.raw_name, "
    "canonical_name, match_score, matched_seed FROM uses u JOIN res ON res.raw_name = u.raw_name", *USE_VIEWS,
)
ORACLES["review_queue"] = with_views(
    f"WITH uses AS ({USES}), {_resolved('SELECT raw_name FROM uses')} SELECT u.raw_name, canonical_name, count(*) AS n_uses "
    "FROM uses u JOIN res ON res.raw_name = u.raw_name WHERE NOT matched_seed GROUP BY ALL", *USE_VIEWS,
)
ORACLES["apply_mapping"] = with_views(
    f"""WITH {_resolved('SELECT name AS raw_name FROM fx_products')}
SELECT row_id, canonical_name AS startupName,
 CASE lower({_strip('pricing_raw')}) WHEN 'free' THEN 'FREE' WHEN 'freemium' THEN 'FREEMIUM'
  WHEN 'contact for pricing' THEN 'ENTERPRISE' WHEN 'contact sales' THEN 'ENTERPRISE' ELSE 'PAID' END AS pricingModel
FROM fx_products p JOIN res ON res.raw_name = p.name""",
    "fx_seeds", "fx_products",
)

# The weighted ratio spelled out in SQL: every text pair the score needs goes through one
# table-driven longest-common-subsequence (a row is the running maximum of its candidates).


def _words(expr: str) -> str:
    return f"list_filter(string_split({expr}, ' '), lambda t: t <> '')"


def _joined(expr: str) -> str:
    return f"coalesce(array_to_string(list_sort({expr}), ' '), '')"


WINDOWS = """SELECT a, b, kind, sh AS x, substr(lg, greatest(1, e - length(sh) + 1), least(e, length(lg)) - greatest(1, e - length(sh) + 1) + 1) AS y
 FROM (SELECT a, b, kind, sh, lg, unnest(range(1, length(lg) + length(sh))) AS e FROM sides WHERE sh <> '')"""
SCORES = f"""
wsd AS (SELECT min(seed_rank) AS rk, {_norm('seed')} AS b FROM fx_seeds GROUP BY 2),
wnm AS (SELECT DISTINCT {_norm('raw_name')} AS a FROM fx_names),
pr AS (SELECT a, b, rk, {_words('a')} AS wa, {_words('b')} AS wb FROM wnm, wsd),
pw AS (SELECT *, list_filter(list_distinct(wa), lambda t: NOT list_contains(wb, t)) AS oa, list_filter(list_distinct(wb), lambda t: NOT list_contains(wa, t)) AS ob,
 list_filter(list_distinct(wa), lambda t: list_contains(wb, t)) AS cm FROM pr),
px AS (SELECT a, b, rk, {_joined('wa')} AS sa, {_joined('wb')} AS sb, {_joined('oa')} AS da, {_joined('ob')} AS db, {_joined('cm')} AS sc, len(wa) * len(wb) AS n_words,
 CASE WHEN a = '' OR b = '' THEN 0 ELSE greatest(length(a), length(b))::DOUBLE / least(length(a), length(b)) END AS stretch FROM pw),
tx AS (SELECT a, b, 'p' AS kind, a AS u, b AS v FROM px UNION ALL SELECT a, b, 's', sa, sb FROM px UNION ALL SELECT a, b, 'd', da, db FROM px),
sides AS (SELECT a, b, kind, CASE WHEN length(u) <= length(v) THEN u ELSE v END AS sh, CASE WHEN length(u) <= length(v) THEN v ELSE u END AS lg FROM tx
 UNION ALL SELECT a, b, kind, v, u FROM tx WHERE length(u) = length(v)),
windows AS ({WINDOWS}),
need AS (SELECT u AS x, v AS y FROM tx UNION SELECT x, y FROM windows),
dp AS (SELECT x, y, 0 AS i, list_transform(range(0, length(y) + 1), lambda j: 0) AS r FROM need
 UNION ALL SELECT x, y, i + 1, list_transform(range(1, length(y) + 2), lambda j: list_max(list_slice(cand, 1, j))) FROM (
  SELECT x, y, i, list_transform(range(0, length(y) + 1), lambda j: CASE WHEN j = 0 THEN 0
   ELSE greatest(r[j + 1], CASE WHEN substr(x, i + 1, 1) = substr(y, j, 1) THEN r[j] + 1 ELSE 0 END) END) AS cand FROM dp WHERE i < length(x))),
lc AS (SELECT x, y, r[len(r)] AS n FROM dp WHERE i = length(x)),
ra AS (SELECT a, b, kind, length(u) + length(v) - 2 * n AS dist, CASE WHEN length(u) + length(v) = 0 THEN 100.0
  ELSE (1 - (length(u) + length(v) - 2 * n)::DOUBLE / (length(u) + length(v))) * 100 END AS score
 FROM tx JOIN lc ON lc.x = tx.u AND lc.y = tx.v),
pa AS (SELECT a, b, kind, max((1 - (length(w.x) + length(w.y) - 2 * n)::DOUBLE / (length(w.x) + length(w.y))) * 100) AS score
 FROM windows w JOIN lc ON lc.x = w.x AND lc.y = w.y GROUP BY ALL),
al AS (SELECT px.*, p.score AS plain, s.score AS sorted_score, d.dist AS dd, length(sc) AS sl, CASE WHEN sc = '' THEN 0 ELSE 1 END AS gap,
  coalesce(pp.score, 0) AS part, coalesce(ps.score, 0) AS part_s, coalesce(pd.score, 0) AS part_d
 FROM px JOIN ra p ON p.a = px.a AND p.b = px.b AND p.kind = 'p' JOIN ra s ON s.a = px.a AND s.b = px.b AND s.kind = 's'
 JOIN ra d ON d.a = px.a AND d.b = px.b AND d.kind = 'd'
 LEFT JOIN pa pp ON pp.a = px.a AND pp.b = px.b AND pp.kind = 'p' LEFT JOIN pa ps ON ps.a = px.a AND ps.b = px.b AND ps.kind = 's'
 LEFT JOIN pa pd ON pd.a = px.a AND pd.b = px.b AND pd.kind = 'd'),
ts AS (SELECT *, CASE WHEN n_words = 0 THEN 0.0 WHEN sc <> '' AND (da = '' OR db = '') THEN 100.0 ELSE greatest(
   (1 - dd::DOUBLE / (2 * (sl + gap) + length(da) + length(db))) * 100,
   CASE WHEN sc = '' THEN 0 ELSE (1 - (1.0::DOUBLE + length(da)) / (2 * sl + 1 + length(da))) * 100 END,
   CASE WHEN sc = '' THEN 0 ELSE (1 - (1.0::DOUBLE + length(db)) / (2 * sl + 1 + length(db))) * 100 END) END AS set_score FROM al),
wr AS (SELECT a, b, rk, CASE WHEN a = '' OR b = '' THEN 0.0::DOUBLE
  WHEN stretch < 1.5 THEN greatest(plain, greatest(sorted_score, set_score) * 0.95)
  ELSE greatest(plain, part * sc_f, (CASE WHEN sc <> '' THEN 100.0 ELSE greatest(part_s, part_d) END) * 0.95 * sc_f) END AS score
 FROM (SELECT *, CASE WHEN stretch <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS sc_f FROM ts)),
top AS (SELECT a, b, score FROM wr QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(score, 9) DESC, rk) = 1)"""
ORACLES["resolve_scores"] = with_views(
    f"WITH RECURSIVE {SCORES} SELECT a AS norm, b AS best_seed, round(score, 3) AS score FROM top", "fx_seeds", "fx_names"
)
# The same with all customer names as seeds.
ORACLES["resolve_many_seeds"] = with_views(
    f"WITH RECURSIVE fx_seeds AS (SELECT c_custkey AS seed_rank, c_name AS seed FROM customer), {SCORES} "
    "SELECT a AS norm, b AS best_seed, round(score, 3) AS score FROM top", "fx_names"
)
LOW_FORM = f"(SELECT seed FROM fx_seeds WHERE {_norm('seed')} = top.b ORDER BY seed_rank DESC LIMIT 1)"
LOW_OK = "(score >= 90 AND least(length(a), length(b))::DOUBLE / greatest(length(a), length(b), 1) >= 0.6)"
ORACLES["resolve_low_threshold"] = with_views(
    f"""WITH RECURSIVE {SCORES}, {_resolved('SELECT raw_name FROM fx_names')}
SELECT ex.raw_name, coalesce(exact_name, tight_match, CASE WHEN {LOW_OK} THEN {LOW_FORM} END, {_strip('ex.raw_name')}) AS canonical_name,
 CASE WHEN coalesce(exact_name, tight_match) IS NOT NULL THEN 100.0::DOUBLE ELSE round(score, 1) END AS match_score,
 coalesce(exact_name, tight_match) IS NOT NULL OR {LOW_OK} AS matched_seed
FROM ex JOIN top ON top.a = ex.norm""", "fx_seeds", "fx_names",
)

# --- times ------------------------------------------------------------------------------------

REL = r"(\d+)\s*(second|minute|hour|day|week|month|year)s?\s*ago"
PARSED = f"""CASE WHEN raw_time = '' THEN NULL
 WHEN lower({_strip('raw_time')}) IN ('just now', 'moments ago', 'now') THEN {NOW_TS}
 WHEN lower({_strip('raw_time')}) = 'yesterday' THEN {NOW_TS} - INTERVAL 24 HOURS
 WHEN regexp_matches(lower(raw_time), '{REL}') THEN
  make_timestamp(epoch_us({NOW_TS}) - try_cast(regexp_extract(lower(raw_time), '{REL}', 1) AS BIGINT)
   * CASE regexp_extract(lower(raw_time), '{REL}', 2) WHEN 'second' THEN 1000000 WHEN 'minute' THEN 60000000
     WHEN 'hour' THEN 3600000000 WHEN 'day' THEN 86400000000 WHEN 'week' THEN 604800000000
     WHEN 'month' THEN 2592000000000 ELSE 31536000000000 END)
 ELSE make_timestamp(epoch_us(try_cast(raw_time AS TIMESTAMPTZ))) END"""

ORACLES["parse_times"] = with_views(f"SELECT event_id, {_time(PARSED)} AS parsed FROM fx_times", "fx_times")
ORACLES["quarantined_times"] = with_views(
    f"SELECT event_id, raw_time, 'parsed' AS faults FROM fx_times WHERE ({PARSED}) IS NULL", "fx_times"
)
ORACLES["parse_iso_dates"] = with_views(f"SELECT row_id, {_time(_iso('published'))} AS published FROM fx_papers", "fx_papers")


def _fresh(expr: str, now: str = NOW_TS) -> str:
    return f"({expr}) >= {now} - INTERVAL 24 HOURS AND ({expr}) <= {now} + INTERVAL 5 MINUTES"


ORACLES["fresh_rows"] = f"SELECT event_id, user_id, {_time('ts')} AS ts FROM events WHERE {_fresh('ts')}"
ORACLES["fresh_stream"] = ORACLES["fresh_rows"]

NEWS_URL = """CASE WHEN href LIKE '//%' THEN 'https:' || href WHEN href LIKE '/%' THEN 'https://news.example.com' || href ELSE href END"""
NEWS = f"SELECT row_id, title, {NEWS_URL} AS url, base_url, {PARSED} AS published_at FROM fx_news"
ORACLES["fresh_news"] = with_views(
    f"SELECT row_id, title, url, {_time('published_at')} AS published_at FROM ({NEWS}) WHERE {_fresh('published_at')}", "fx_news"
)
ORACLES["absolute_urls"] = with_views(f"SELECT row_id, {NEWS_URL} AS url FROM fx_news", "fx_news")

# --- labels ---------------------------------------------------------------------------------------

PRICING = """CASE lower(trim(pricing_raw)) WHEN 'free' THEN 'FREE' WHEN 'freemium' THEN 'FREEMIUM'
 WHEN 'contact for pricing' THEN 'ENTERPRISE' WHEN 'contact sales' THEN 'ENTERPRISE' ELSE 'PAID' END"""
ORACLES["pricing_models"] = with_views(f"SELECT row_id, {PRICING} AS pricing_model FROM fx_products", "fx_products")
ORACLES["enum_check"] = with_views(
    """SELECT row_id, upper(trim(pricing_raw)) AS pricingModel FROM fx_products
WHERE upper(trim(pricing_raw)) IN ('FREE', 'FREEMIUM', 'PAID', 'ENTERPRISE')""", "fx_products",
)
ROLE = """CASE WHEN regexp_matches(lower(title), 'ml engineer|machine learning engineer') THEN 'ML Engineer'
 WHEN contains(lower(title), 'data scientist') THEN 'Data Scientist'
 WHEN regexp_matches(lower(title), 'research (scientist|engineer)') THEN 'Research Scientist'
 WHEN regexp_matches(lower(title), '(ai|artificial intelligence) engineer') THEN 'AI Engineer'
 WHEN regexp_matches(' ' || lower(title) || ' ', 'software engineer| swe ') THEN 'Software Engineer' ELSE 'Other' END"""
JOB_ROWS = f"""SELECT row_id, {ROLE} AS role_family, contains(lower(title), 'remote') AS is_remote,
 coalesce(nullif(company, ''), site_name) AS company FROM fx_jobs"""
ORACLES["role_families"] = with_views(JOB_ROWS, "fx_jobs")

# --- papers --------------------------------------------------------------------------------------------

TITLE = f"replace({_strip('title')}, chr(10), ' ')"
AUTHORS = f"list_filter(list_transform(string_split(authors_raw, ';'), lambda a: {_strip('a')}), lambda a: a <> '')"
GITHUB = r"nullif(regexp_extract(summary, 'https?://github\.com/[\w.-]+/[\w.-]+'), '')"
SLUG = (
    r"CASE WHEN regexp_matches({0}, 'github\.com/[\w.-]+/[\w.-]+') THEN regexp_extract({0}, 'github\.com/([\w.-]+)/', 1) || '/' "
    r"|| regexp_replace(regexp_extract({0}, 'github\.com/[\w.-]+/([\w.-]+)', 1), '\.git$', '') END"
)
PAPERS = f"""pp AS (SELECT row_id, source_rank, page_no, paper_url, {TITLE} AS title, {AUTHORS} AS authors, {GITHUB} AS github_url,
 published, {_iso('published')} AS published_date FROM fx_papers),
ok AS (SELECT * FROM pp WHERE paper_url <> '' AND title <> '')"""
FIRST = """fs AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY paper_url ORDER BY source_rank, page_no, row_id) = 1)"""


def _starred(rows: str) -> str:
    slug = SLUG.format("github_url")
    return f"""fl AS (SELECT {slug} AS slug, github_url FROM {rows} WHERE github_url IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY {slug} ORDER BY source_rank, page_no, row_id) = 1),
hit AS (SELECT fl.github_url, coalesce(stargazers_count, 0) AS github_stars FROM fl JOIN fx_stars s ON s.slug = fl.slug),
st AS (SELECT r.*, hit.github_stars FROM {rows} r LEFT JOIN hit ON hit.github_url = r.github_url)"""


ORACLES["repo_links"] = with_views(f"SELECT row_id, {GITHUB} AS github_url FROM fx_papers", "fx_papers")
ORACLES["repo_slugs"] = with_views(
    f"WITH {PAPERS} SELECT DISTINCT {SLUG.format('github_url')} AS slug FROM pp WHERE github_url IS NOT NULL", "fx_papers"
)
ORACLES["star_enrichment"] = with_views(
    f"WITH {PAPERS}, {_starred('ok')} SELECT row_id, paper_url, github_url, github_stars FROM st", "fx_papers", "fx_stars"
)
ORACLES["star_enrichment_by_slug"] = with_views(
    f"WITH {PAPERS} SELECT row_id, paper_url, github_url, CASE WHEN s.slug IS NOT NULL THEN coalesce(stargazers_count, 0) END "
    f"AS github_stars FROM ok LEFT JOIN fx_stars s ON s.slug = {SLUG.format('github_url')}", "fx_papers", "fx_stars",
)
ORACLES["repo_stars"] = with_views("SELECT slug, coalesce(stargazers_count, 0) AS stargazers_count FROM fx_stars", "fx_stars")
ORACLES["clean_titles"] = with_views(f"SELECT row_id, {TITLE} AS title FROM fx_papers", "fx_papers")
ORACLES["clean_authors"] = with_views(f"SELECT row_id, array_to_string({AUTHORS}, '|') AS authors FROM fx_papers", "fx_papers")
ORACLES["required_fields"] = with_views(f"WITH {PAPERS} SELECT row_id, paper_url, title FROM ok", "fx_papers")
ORACLES["first_seen_papers"] = with_views(
    f"WITH {PAPERS}, {FIRST} SELECT row_id, paper_url, source_rank, page_no FROM fs", "fx_papers"
)
GRAINS = """g AS (SELECT source_rank, page_no, count(*) FILTER (WHERE fresh) AS new_rows FROM (
  SELECT o.source_rank, o.page_no, fs.row_id IS NOT NULL AS fresh FROM ok o LEFT JOIN fs ON fs.row_id = o.row_id) GROUP BY ALL),
c AS (SELECT *, sum(new_rows) OVER (ORDER BY source_rank, page_no) AS running_total FROM g)"""
ORACLES["target_pages"] = with_views(
    f"WITH {PAPERS}, {FIRST}, {GRAINS} SELECT source_rank, page_no, new_rows, running_total::BIGINT AS running_total "
    "FROM c WHERE running_total - new_rows < 300", "fx_papers",
)
ORACLES["take_until_target"] = with_views(
    f"WITH {PAPERS}, {FIRST}, {GRAINS} SELECT row_id, paper_url, source_rank, page_no FROM fs WHERE EXISTS "
    "(SELECT 1 FROM c WHERE c.source_rank = fs.source_rank AND c.page_no = fs.page_no AND running_total - new_rows < 300)",
    "fx_papers",
)
ORACLES["take_until_tags"] = with_views(
    """WITH fs AS (SELECT row_id, href, source_rank FROM fx_startups
 QUALIFY row_number() OVER (PARTITION BY href ORDER BY source_rank, page_no, row_id) = 1),
t AS (SELECT s.source_rank, count(fs.row_id) AS n FROM (SELECT DISTINCT source_rank FROM fx_startups) s
 LEFT JOIN fs ON fs.source_rank = s.source_rank GROUP BY 1),
c AS (SELECT source_rank, n, sum(n) OVER (ORDER BY source_rank) AS total FROM t)
SELECT row_id, href, fs.source_rank FROM fs JOIN c ON c.source_rank = fs.source_rank WHERE total - n < 600""",
    "fx_startups",
)
ORACLES["page_windows"] = with_views(
    f"""WITH {PAPERS}, r AS (SELECT row_id, source_rank, row_number() OVER (PARTITION BY source_rank
 ORDER BY published_date DESC NULLS LAST, paper_url, row_id) AS rn FROM pp)
SELECT row_id, source_rank, CAST(floor((rn - 1) / 10.0) AS INT) AS page_no, CAST(rn AS INT) AS feed_rank FROM r WHERE rn <= 150""",
    "fx_papers",
)
ORACLES["atom_entries"] = with_views(
    f"WITH {PAPERS} SELECT title, paper_url, github_url, array_to_string(authors, '|') AS authors, published FROM ok", "fx_papers"
)

# --- reports ----------------------------------------------------------------------------------------------

ORACLES["source_counts"] = """
WITH c AS (SELECT source, CAST(substr(source, 4) AS INT) AS source_rank, count(*) AS new_rows FROM documents GROUP BY ALL)
SELECT source, source_rank, new_rows, CAST(sum(new_rows) OVER (ORDER BY source_rank) AS BIGINT) AS running_total FROM c"""
ORACLES["source_status"] = """
SELECT source, count(*) FILTER (WHERE n_chars > 12000) AS n_rows,
 CASE WHEN count(*) FILTER (WHERE n_chars > 12000) > 0 THEN 'ok' ELSE 'no rows' END AS status FROM documents GROUP BY source"""
ORACLES["union_sources"] = with_views(
    f"""WITH {PAPERS} SELECT source_name, count(*) AS n_rows, CAST(sum(row_id) AS BIGINT) AS sum_ids FROM (
SELECT 'papers' AS source_name, row_id FROM ok UNION ALL SELECT 'startups', row_id FROM fx_startups
UNION ALL SELECT 'products', row_id FROM fx_products) GROUP BY 1""",
    "fx_papers", "fx_startups", "fx_products",
)
RECORD_COUNTS = f"""counts AS (SELECT 'STARTUP' AS record_type, count(*) AS n_rows FROM fx_startups
UNION ALL SELECT 'PRODUCT', count(*) FROM fx_products
UNION ALL SELECT 'RESEARCH_PAPER', count(*) FROM fs
UNION ALL SELECT 'JOB', count(*) FROM fx_jobs
UNION ALL SELECT 'NEWS', count(*) FROM ({NEWS}) WHERE {_fresh('published_at')})"""
RECORD_VIEWS = ("fx_papers", "fx_startups", "fx_products", "fx_jobs", "fx_news")
ORACLES["run_summary"] = with_views(
    f"WITH {PAPERS}, {FIRST}, {RECORD_COUNTS} SELECT record_type, n_rows FROM counts UNION ALL "
    f"SELECT 'MAPPING_LOG', count(*) FROM ({USES})", *RECORD_VIEWS,
)
ORACLES["target_check"] = with_views(
    f"WITH {PAPERS}, {FIRST}, {RECORD_COUNTS} SELECT record_type, n_rows, 1000 AS target, n_rows >= 1000 AS met "
    "FROM counts WHERE record_type IN ('STARTUP', 'PRODUCT', 'RESEARCH_PAPER')", *RECORD_VIEWS,
)
ORACLES["publish_tabs"] = with_views(
    f"""WITH {PAPERS}, {FIRST}, {RECORD_COUNTS}
SELECT CASE record_type WHEN 'STARTUP' THEN 'Startups' WHEN 'PRODUCT' THEN 'Products' WHEN 'RESEARCH_PAPER' THEN 'Research Papers'
 WHEN 'JOB' THEN 'Jobs' ELSE 'News' END AS record_type, n_rows FROM counts
UNION ALL SELECT 'Entity Mapping Log', count(*) FROM ({USES})""", *RECORD_VIEWS,
)

# --- sinks -----------------------------------------------------------------------------------------------------

EMPLOYEES = r"try_cast(replace(regexp_extract(badge, '(?i)([0-9,]+)\s+employees?', 1), ',', '') AS INT)"
ORACLES["employee_counts"] = with_views(f"SELECT row_id, {EMPLOYEES} AS employee_count FROM fx_startups", "fx_startups")
ORACLES["tab_startups"] = with_views(
    f"""SELECT name AS entityName, {EMPLOYEES} AS employeeCount, 'Y Combinator' AS source,
 'https://www.ycombinator.com' || href AS sourceUrl, '{NOW}' AS collectedAt FROM fx_startups""", "fx_startups",
)
ORACLES["tab_text"] = with_views(
    f"""SELECT name AS entityName, coalesce(CAST({EMPLOYEES} AS VARCHAR), 'None') AS employeeCount, 'Y Combinator' AS source,
 'https://www.ycombinator.com' || href AS sourceUrl, '{NOW}' AS collectedAt FROM fx_startups""", "fx_startups",
)
ORACLES["tab_products"] = with_views(
    f"SELECT name AS startupName, {PRICING} AS pricingModel, 'Futurepedia' AS source, url AS sourceUrl, '{NOW}' AS collectedAt "
    "FROM fx_products", "fx_products",
)
ORACLES["tab_papers"] = with_views(
    f"""WITH {PAPERS}, {FIRST}, {_starred('fs')} SELECT title, array_to_string(authors, ', ') AS authors, paper_url, github_url,
 github_stars, {_time('published_date')} AS published_date FROM st""", "fx_papers", "fx_stars",
)
ORACLES["tab_jobs"] = with_views(
    f"SELECT company, '{NOW}' AS date, is_remote, role_family FROM ({JOB_ROWS})", "fx_jobs"
)
ORACLES["tab_news"] = with_views(
    f"""SELECT title AS headline, url, {_time('published_at')} AS publishedAt, CAST(NULL AS VARCHAR) AS summary,
 'Example News' AS source FROM ({NEWS}) WHERE {_fresh('published_at')}""", "fx_news",
)
LATE = "TIMESTAMP '2024-02-03 00:00:00'"
ORACLES["publish_empty"] = with_views(
    f"""SELECT '(no data collected this run)' AS value WHERE NOT EXISTS
 (SELECT 1 FROM ({NEWS}) WHERE {_fresh('published_at')} AND {_fresh('published_at', LATE)})""", "fx_news",
)
ORACLES["flatten_columns"] = with_views(
    f"""SELECT row_id, '1.0' AS "schemaVersion", 'STARTUP' AS "recordType", '{NOW}' AS "collectedAt", 'Y Combinator' AS source_name,
 'https://www.ycombinator.com' || href AS source_url, name AS "content_entityName", {EMPLOYEES} AS "content_data_employeeCount"
FROM fx_startups""", "fx_startups",
)
ORACLES["backup_csv"] = with_views(
    f"""WITH {PAPERS}, {FIRST}, {_starred('fs')} SELECT 'RESEARCH_PAPER' AS "recordType", title,
 '[' || array_to_string(list_transform(authors, lambda a: '"' || a || '"'), ',') || ']' AS authors, paper_url,
 CAST(github_stars AS VARCHAR) AS github_stars FROM st""", "fx_papers", "fx_stars",
)
ORACLES["envelope_store"] = with_views(
    f"""WITH {PAPERS}, {FIRST},
s AS (SELECT 'STARTUP' AS "recordType", 'Y Combinator' AS source_name, 'https://www.ycombinator.com' || href AS source_url, name AS subject
 FROM fx_startups
UNION ALL SELECT 'PRODUCT', 'Futurepedia', url, name FROM fx_products
UNION ALL SELECT 'RESEARCH_PAPER', NULL, NULL, title FROM fs
UNION ALL SELECT 'JOB', NULL, NULL, coalesce(nullif(company, ''), site_name) FROM fx_jobs
UNION ALL SELECT 'NEWS', 'Example News', base_url, title FROM ({NEWS}) WHERE {_fresh('published_at')})
SELECT "recordType", '1.0' AS "schemaVersion", '{NOW}' AS "collectedAt", source_name, source_url, subject FROM s""",
    *RECORD_VIEWS,
)
ORACLES["content_query"] = with_views(
    f"SELECT name AS entity_name, {EMPLOYEES} AS employee_count FROM fx_startups", "fx_startups"
)

# --- pages and cards ------------------------------------------------------------------------------------------------

ORACLES["page_links"] = r"""
WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1) AS hrefs FROM pages
 WHERE octet_length(encode(html)) <= 5000000),
e AS (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS link_no FROM l)
SELECT page_id, CAST(link_no AS INT) AS link_no, href,
 CASE WHEN href LIKE '//%' THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || href
  WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS link FROM e"""
ORACLES["size_cap"] = "SELECT page_id, octet_length(encode(html)) AS n_bytes FROM pages WHERE octet_length(encode(html)) <= 1500"
ORACLES["site_pages"] = with_views(
    """SELECT page_id, kind, CASE kind WHEN 'job' THEN 4 ELSE 0 END AS source_rank,
 CASE kind WHEN 'news' THEN 'VentureBeat AI' WHEN 'product' THEN 'marketing' ELSE 'RemoteOK' END AS site_name,
 CASE kind WHEN 'news' THEN 'cards' WHEN 'product' THEN 'product_cards' ELSE 'job_rows' END AS extractor FROM fx_card_pages""",
    "fx_card_pages",
)
ORACLES["card_extraction"] = with_views(
    """SELECT page_id, 'VentureBeat AI' AS site_name, 0 AS card_no, 'Story & more' AS title,
 'https://venturebeat.com' || regexp_extract(html, '<a href="([^"]*)"', 1) AS url,
 replace(replace(regexp_extract(html, 'datetime="([^"]*)"', 1), 'T', ' '), 'Z', '') AS published_at
FROM fx_card_pages WHERE kind = 'news'""", "fx_card_pages",
)
ORACLES["product_cards"] = with_views(
    """SELECT page_id, 0 AS source_rank, 0 AS card_no, regexp_extract(html, '<p>(.*?)</p>', 1) AS name,
 regexp_extract(html, '<a href="([^"]*)"', 1) AS url, regexp_extract(html, '<span>(.*?)</span>', 1) AS pricing_raw
FROM fx_card_pages WHERE kind = 'product'""", "fx_card_pages",
)
ORACLES["job_postings"] = with_views(
    """SELECT page_id, 0 AS row_no, regexp_extract(html, '"title":"([^"]*)"', 1) AS title,
 'https://remoteok.com' || regexp_extract(html, 'data-href="([^"]*)"', 1) AS url, regexp_extract(html, 'data-company="([^"]*)"', 1) AS company,
 replace(replace(regexp_extract(html, '"datePosted":"([^"]*)"', 1), 'T', ' '), 'Z', '') AS published_at
FROM fx_card_pages WHERE kind = 'job'""", "fx_card_pages",
)
ORACLES["company_cards"] = with_views(
    f"""SELECT row_id AS page_id, source_rank, 0 AS card_no, {_strip('name')} AS name, href,
 'https://www.ycombinator.com' || href AS url, {EMPLOYEES} AS employee_count FROM fx_startups WHERE {_strip('name')} <> ''""",
    "fx_startups",
)

# --- chunks and replies -------------------------------------------------------------------------------------------------

COLLAPSED = r"regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]{2,}', ' ', 'g')"


def _chunks(table: str, size: int) -> str:
    """CTE ``ck`` (doc_id, chunk_no, chunk)."""
    return f"""cl AS (SELECT doc_id, {COLLAPSED} AS t FROM {table}),
fold AS (SELECT doc_id, t, list_reduce(
  list_transform(string_split(t, chr(10) || chr(10)), lambda p: {{'done': CAST([] AS VARCHAR[]), 'cur': p}}),
  lambda a, x: CASE
   WHEN length(a.cur) + length(x.cur) + 2 > {size} THEN
    CASE WHEN length(x.cur) > {size} THEN {{'done': list_concat(
       list_concat(a.done, CASE WHEN a.cur <> '' THEN [a.cur] ELSE CAST([] AS VARCHAR[]) END),
       list_transform(range(1, length(x.cur) + 1, {size}), lambda i: substr(x.cur, i, {size}))), 'cur': ''}}
    ELSE {{'done': list_concat(a.done, CASE WHEN a.cur <> '' THEN [a.cur] ELSE CAST([] AS VARCHAR[]) END), 'cur': x.cur}} END
   WHEN a.cur <> '' THEN {{'done': a.done, 'cur': a.cur || chr(10) || chr(10) || x.cur}}
   ELSE {{'done': a.done, 'cur': x.cur}} END,
  {{'done': CAST([] AS VARCHAR[]), 'cur': ''}}) AS r FROM cl),
arr AS (SELECT doc_id, CASE WHEN length(t) <= {size} THEN [t]
  ELSE list_concat(r.done, CASE WHEN r.cur <> '' THEN [r.cur] ELSE CAST([] AS VARCHAR[]) END) END AS cs FROM fold),
ck AS (SELECT doc_id, CAST(generate_subscripts(cs, 1) - 1 AS INT) AS chunk_no, unnest(cs) AS chunk FROM arr)"""


ORACLES["collapse_ws"] = with_views(f"SELECT doc_id, {COLLAPSED} AS text FROM fx_paragraphs", "fx_paragraphs")
ORACLES["paragraph_chunks"] = with_views(
    f"WITH {_chunks('fx_paragraphs', 200)} SELECT doc_id, chunk_no, chunk FROM ck", "fx_paragraphs"
)
ORACLES["text_chunks"] = (
    f"WITH {_chunks('documents', 12000)} SELECT doc_id, chunk_no, CAST(length(chunk) AS INT) AS n_chars, sha256(chunk) AS digest FROM ck"
)
PROMPT = (
    "'Extract structured data from the content below and return ONLY a single JSON object that strictly matches this JSON Schema "
    "-- no prose, no markdown code fences, just the raw JSON object.' || chr(10) || chr(10) || 'SCHEMA:' || chr(10) || "
    "'{\"title\": \"ProductContent\", \"type\": \"object\"}' || chr(10) || chr(10) || 'CONTENT:' || chr(10) || chunk"
)
ORACLES["prompts"] = f"WITH {_chunks('documents', 12000)} SELECT doc_id, chunk_no, sha256({PROMPT}) AS digest FROM ck"

CHECKED = """SELECT doc_id, chunk_no, provider_rank,
 coalesce(raw LIKE '{%' AND raw LIKE '%"startupName":"%' AND regexp_matches(raw, '"pricingModel":"(FREE|FREEMIUM|PAID|ENTERPRISE)"'), false) AS is_valid, raw
FROM fx_replies"""
FIELDS = """CASE WHEN is_valid THEN regexp_extract(raw, '"startupName":"([^"]*)"', 1) END AS "startupName",
 CASE WHEN is_valid THEN regexp_extract(raw, '"pricingModel":"([^"]*)"', 1) END AS "pricingModel" """
ORACLES["valid_replies"] = with_views(
    f"SELECT doc_id, chunk_no, provider_rank, is_valid, {FIELDS} FROM ({CHECKED})", "fx_replies"
)
ORACLES["first_valid"] = with_views(
    f"""SELECT doc_id, chunk_no, provider_rank, {FIELDS} FROM ({CHECKED}) WHERE is_valid
 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no, provider_rank) = 1""", "fx_replies",
)

# --- URL keys and dedup ---------------------------------------------------------------------------------------------------

CANONICAL = r"""'https://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1))
 || regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '')
 || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END"""
KEPT = r"""list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
 lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_[^=]*|ref|sid|sessionid|session_id|phpsessid|jsessionid)(=|$)'))"""
KEYED = f"kp AS (SELECT page_id, url, {KEPT} AS kept FROM pages), ky AS (SELECT page_id, url, {CANONICAL} AS canonical FROM kp)"
ORACLES["canonical_urls"] = f"WITH {KEYED} SELECT page_id, canonical FROM ky"
ORACLES["url_keys"] = f"WITH {KEYED} SELECT page_id, sha256(canonical) AS url_key FROM ky"
ORACLES["unseen_urls"] = f"""WITH {KEYED} SELECT page_id, sha256(canonical) AS url_key FROM ky
WHERE canonical NOT IN (SELECT canonical FROM ky WHERE url LIKE 'http://%')"""
ORACLES["unseen_stream"] = f"""WITH {KEYED} SELECT sha256(canonical) AS url_key, page_id, url FROM ky
QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY page_id) = 1"""
ORACLES["ttl_dedup"] = """
WITH RECURSIVE e AS (SELECT DISTINCT user_id, ts FROM events),
acc AS (SELECT user_id, min(ts) AS ts FROM e GROUP BY user_id
 UNION ALL SELECT e.user_id, min(e.ts) FROM acc JOIN e ON e.user_id = acc.user_id AND e.ts >= acc.ts + INTERVAL 24 HOURS GROUP BY e.user_id)
SELECT user_id, epoch_us(ts) AS ts_us FROM acc"""
ORACLES["ttl_dedup_hot_key"] = """
WITH RECURSIVE e AS (SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN -1 ELSE CAST(user_id AS BIGINT) END AS k, ts FROM events),
acc AS (SELECT k, min(ts) AS ts FROM e GROUP BY k
 UNION ALL SELECT e.k, min(e.ts) FROM acc JOIN e ON e.k = acc.k AND e.ts >= acc.ts + INTERVAL 1 HOUR GROUP BY e.k)
SELECT k, epoch_us(ts) AS ts_us FROM acc"""
ORACLES["ttl_dedup_stream"] = ORACLES["ttl_dedup"]
ORACLES["dedup_stream"] = "SELECT DISTINCT user_id FROM events"

# --- graph and vectors --------------------------------------------------------------------------------------------------------

NAMED = "SELECT name AS raw_name FROM fx_startups UNION SELECT name FROM fx_products"
GRAPH = f"""{PAPERS}, {_resolved(NAMED)},
gs AS (SELECT row_id, canonical_name AS "entityName" FROM fx_startups f JOIN res ON res.raw_name = f.name),
gp AS (SELECT DISTINCT canonical_name AS "startupName", url FROM fx_products f JOIN res ON res.raw_name = f.name),
ga AS (SELECT DISTINCT unnest(authors) AS person, paper_url FROM ok)"""
GRAPH_VIEWS = ("fx_seeds", "fx_papers", "fx_startups", "fx_products", "fx_links")


def _node(kind: str, key: str) -> str:
    return f"sha256('{kind}|' || {key})"


ORACLES["graph_nodes"] = with_views(
    f"""WITH {GRAPH}, n AS (SELECT 'Startup' AS node_type, "entityName" AS name FROM gs WHERE "entityName" <> ''
UNION SELECT 'Product', url FROM gp UNION SELECT 'Paper', paper_url FROM ok UNION SELECT 'Person', person FROM ga)
SELECT sha256(node_type || '|' || name) AS id, node_type, name FROM n""", *GRAPH_VIEWS,
)
ORACLES["graph_edges"] = with_views(
    f"""WITH {GRAPH}
SELECT {_node('Person', 'person')} AS src, 'AUTHORED' AS edge_type, {_node('Paper', 'paper_url')} AS dst FROM ga
UNION ALL SELECT {_node('Startup', '"startupName"')}, 'PUBLISHES', {_node('Product', 'url')} FROM gp
 WHERE "startupName" <> '' AND "startupName" IN (SELECT "entityName" FROM gs)
UNION ALL SELECT DISTINCT {_node('Person', 'person')}, 'FOUNDED', {_node('Startup', '"entityName"')}
 FROM fx_links l JOIN gs ON gs.row_id = l.startup_row_id WHERE link_type = 'paper_startup'""", *GRAPH_VIEWS,
)
ORACLES["graph_nodes_updated"] = ORACLES["graph_nodes"]
ORACLES["graph_edges_updated"] = ORACLES["graph_edges"]
ORACLES["people_in_both"] = with_views(
    f"""WITH {PAPERS} SELECT DISTINCT person FROM (SELECT unnest(authors) AS person FROM ok)
WHERE person IN (SELECT person FROM fx_links WHERE link_type = 'person_job')""", "fx_papers", "fx_links",
)
ORACLES["startups_from_papers"] = with_views(
    f"""WITH {GRAPH} SELECT DISTINCT "entityName", l.paper_url FROM fx_links l JOIN gs ON gs.row_id = l.startup_row_id
WHERE link_type = 'paper_startup' AND l.paper_url IN (SELECT paper_url FROM ok)""", *GRAPH_VIEWS,
)
ORACLES["products_of_startup"] = with_views(
    f"""WITH {GRAPH} SELECT "startupName", url, count(*) OVER (PARTITION BY "startupName") AS n_products FROM gp
WHERE "startupName" IN (SELECT "entityName" FROM gs)""", *GRAPH_VIEWS,
)
ORACLES["same_parent"] = with_views(
    f"""WITH {GRAPH}, w AS (SELECT "startupName", url, count(*) OVER (PARTITION BY "startupName") AS n_products FROM gp
WHERE "startupName" <> '') SELECT * FROM w WHERE n_products > 1""", *GRAPH_VIEWS,
)
ORACLES["similar_vectors"] = """
WITH q AS (SELECT label AS query_id, embedding AS qv FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
s AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(qv AS DOUBLE[])), 6) AS score FROM embeddings, q)
SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
QUALIFY rank <= 10"""
ORACLES["near_duplicates"] = """
SELECT b.vec_id, min(a.vec_id) AS dup_of FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.4 GROUP BY b.vec_id"""

# --- whole plans ---------------------------------------------------------------------------------------------------------------

def _run_oracle(cut: str) -> str:
    """Records of the whole run; ``cut`` is the condition on the rows read before a grain."""
    def digest(key, rows):
        return f"(SELECT coalesce(sum(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)), 0)::BIGINT FROM {rows})"

    return with_views(
        f"""WITH {PAPERS}, {FIRST}, {GRAINS},
rp AS (SELECT paper_url AS k FROM fs WHERE EXISTS (SELECT 1 FROM c WHERE c.source_rank = fs.source_rank
 AND c.page_no = fs.page_no AND {cut.format("running_total - new_rows")})),
su AS (SELECT source_rank, href FROM fx_startups WHERE {_strip('name')} <> ''
 QUALIFY row_number() OVER (PARTITION BY href ORDER BY source_rank, row_id) = 1),
st AS (SELECT source_rank, count(*) AS n, sum(count(*)) OVER (ORDER BY source_rank) AS total FROM su GROUP BY source_rank),
rs AS (SELECT 'https://www.ycombinator.com' || href AS k FROM su JOIN st USING (source_rank) WHERE {cut.format("total - n")}),
pg AS (SELECT page_id % 40 AS page, count(*) AS n, sum(count(*)) OVER (ORDER BY page_id % 40) AS total
 FROM fx_card_pages WHERE kind = 'product' GROUP BY 1),
gap AS (SELECT min(p.page) AS page FROM range(0, 41) AS p(page) WHERE p.page NOT IN (SELECT page FROM pg)),
rq AS (SELECT 'https://www.futurepedia.io/tool/t' || page_id AS k FROM fx_card_pages, gap JOIN pg ON pg.page = page_id % 40
 WHERE kind = 'product' AND {cut.format("total - n")} AND pg.page < gap.page),
rj AS (SELECT 'AI Engineer' AS k FROM fx_card_pages WHERE kind = 'job'),
rn AS (SELECT 'https://venturebeat.com/n/' || page_id AS k FROM fx_card_pages WHERE kind = 'news')
SELECT 'STARTUP' AS record_type, (SELECT count(*) FROM rs) AS n_rows, {digest("k", "rs")} AS content_digest
UNION ALL SELECT 'PRODUCT', (SELECT count(*) FROM rq), {digest("k", "rq")}
UNION ALL SELECT 'RESEARCH_PAPER', (SELECT count(*) FROM rp), {digest("k", "rp")}
UNION ALL SELECT 'JOB', (SELECT count(*) FROM rj), {digest("k", "rj")}
UNION ALL SELECT 'NEWS', (SELECT count(*) FROM rn), {digest("k", "rn")}
UNION ALL SELECT 'MAPPING_LOG', (SELECT count(*) FROM rs) + (SELECT count(*) FROM rq) + (SELECT count(*) FROM rj), 0""",
        "fx_papers", "fx_startups", "fx_card_pages",
    )


ORACLES["full_run"] = _run_oracle("{0} >= 0")
ORACLES["full_run_with_target"] = _run_oracle("{0} < 1000")

# --- wild inputs ---------------------------------------------------------------------------------------------------------------

ORACLES["parse_clock_times"] = with_views(
    """SELECT event_id, expected AS parsed, coalesce(CAST(expected AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-31 00:05:00', false) AS fresh
FROM fx_clock_times""", "fx_clock_times",
)
ORACLES["wild_cards"] = with_views(
    """SELECT page_id, CAST(CASE kind WHEN 'list' THEN 0 ELSE 0 END AS INT) AS card_no, CASE kind WHEN 'list' THEN 'Bmore' ELSE 'Deep' END AS title,
 CASE kind WHEN 'list' THEN 'https://weworkremotely.com/' || page_id ELSE 'https://venturebeat.com/d' END AS url, '2024-01-30 10:00:00' AS published_at
FROM fx_wild_pages WHERE kind IN ('list', 'deep')""", "fx_wild_pages",
)
ORACLES["wild_job_rows"] = with_views(
    """SELECT page_id, CAST(0 AS INT) AS row_no, 'AI Engineer' AS title, 'https://remoteok.com/j/' || page_id AS url, 'L''Or &amp; Co' AS company
FROM fx_wild_pages WHERE kind = 'rows'""", "fx_wild_pages",
)
ORACLES["page_failures"] = with_views(
    """SELECT page_id, 'https://venturebeat.com/category/ai/' AS url, 'ValueError: unreadable' AS failure
FROM fx_wild_pages WHERE kind = 'broken'""", "fx_wild_pages",
)
ORACLES["rejected_bodies"] = """SELECT page_id, url, CAST(strlen(html) AS INT) AS bytes, 'over the size cap' AS reason FROM pages WHERE strlen(html) > 1500"""
ORACLES["similar_indexed"] = ORACLES["similar_vectors"]
ORACLES["near_duplicates_banded"] = with_views(
    """SELECT b.vec_id, min(a.vec_id) AS dup_of FROM fx_near_vectors a JOIN fx_near_vectors b ON a.vec_id < b.vec_id
WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.98 GROUP BY b.vec_id""", "fx_near_vectors",
)
