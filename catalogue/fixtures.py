"""Derived input views over the test tables.

The test tables hold no company names, cards, feeds or replies, so each view
derives messy but deterministic input of that kind from a whole table. The same
text runs in Spark and in DuckDB, except where SPARK_ONLY gives another.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.operators.pin import pin
from entityflow.session import configure

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# The fixed clock of all views.
NOW = "2024-01-31 00:00:00"

VIEWS = {
    "fx_seeds": r"""
SELECT * FROM (VALUES (0,'OpenAI'),(1,'Anthropic'),(2,'Google DeepMind'),(3,'Meta AI'),(4,'Mistral AI'),(5,'Cohere'),
 (6,'Stability AI'),(7,'Hugging Face'),(8,'xAI'),(9,'Perplexity AI'),(10,'Inflection AI'),(11,'Adept'),(12,'Runway'),
 (13,'ElevenLabs'),(14,'Midjourney')) AS v(seed_rank, seed)
""",
    "fx_names": r"""
SELECT c_custkey AS name_id, v.raw_name
FROM customer JOIN (VALUES (0,'OpenAI, Inc.'),(1,'Open AI'),(2,'OPENAI'),(3,'Hugging Face S.A.'),(4,'Mistral'),
 (5,'Perplexity'),(6,'Stability'),(7,'Meta'),(8,'DeepMind'),(9,'Cohere Health'),(10,'Cohere AI'),(11,'Scale AI'),
 (12,'AI Meta'),(13,'Anthropics'),(14,'Anthropc'),(15,'Midjourney UK'),(16,'X.AI'),(17,'Co-op Labs'),
 (18,'Café Labs Ltd.'),(19,' Runway ML '),(20,''),(21,'Inc.')) AS v(i, raw_name) ON c_custkey % 22 = v.i
""",
    "fx_times": r"""
SELECT event_id, v.prefix || CASE WHEN v.unit = '' THEN '' ELSE CAST(event_id % 40 AS STRING) || v.unit END AS raw_time
FROM events JOIN (VALUES (0,'',' seconds ago'),(1,'',' minutes ago'),(2,'',' hours ago'),(3,'',' days ago'),
 (4,'',' weeks ago'),(5,'',' months ago'),(6,'',' years ago'),(7,'Posted ','hours ago'),(8,'Just now',''),
 (9,' Moments ago ',''),(10,'Yesterday',''),(11,'2024-01-30T10:00:00Z',''),(12,'2024-01-30T10:00:00+02:00',''),
 (13,'2024-01-31',''),(14,'an hour ago',''),(15,'',''),(16,'2024-01-31T00:05:00Z',''),
 (17,'2024-01-31T00:05:01Z',''),(18,'99999999999999999999 years ago','')) AS v(i, prefix, unit) ON event_id % 19 = v.i
""",
    "fx_clock_times": r"""
SELECT event_id, v.raw_time, v.expected
FROM events JOIN (VALUES (0,'Sep 9, 2026 10:30 AM','2026-09-09 10:30:00'),(1,'Thu, 10 Sep 2026 10:00:00 GMT','2026-09-10 10:00:00'),
 (2,'2026-09-12 08:00 UTC','2026-09-12 08:00:00'),(3,'September 9, 2026 at 10:30','2026-09-09 10:30:00'),(4,'12 Sep 2026 08:00','2026-09-12 08:00:00'),
 (5,'Updated Sep 9, 2026','2026-09-09 00:00:00'),(6,'Posted on: Jan 30, 2024, 11:59 pm','2024-01-30 23:59:00'),(7,'Jan 30, 2024 12:05 AM','2024-01-30 00:05:00'),
 (8,'30 Jan 2024 10:00:05 +0530','2024-01-30 04:30:05'),(9,'2024/01/30 23:30 -02:00','2024-01-31 01:30:00'),(10,'Jan 30, 2024 25:00',CAST(NULL AS STRING)),
 (11,'Jan 30, 2024 13:00 pm',CAST(NULL AS STRING)),(12,'at 10:30',CAST(NULL AS STRING)),(13,'Tue Jan 30 2024 9:05 a.m.','2024-01-30 09:05:00')) AS v(i, raw_time, expected)
 ON event_id % 14 = v.i
""",
    "fx_wild_pages": r"""
SELECT c_custkey AS page_id, CASE c_custkey % 4 WHEN 0 THEN 'list' WHEN 1 THEN 'deep' WHEN 2 THEN 'rows' ELSE 'broken' END AS kind,
 CASE c_custkey % 4
 WHEN 0 THEN '<ul><li class=feature><a href=/1>A</a><li class=feature><a href=/' || CAST(c_custkey AS STRING) || '>B<p>more</a><time datetime="2024-01-30T10:00:00Z">x</time></ul>'
 WHEN 1 THEN '<article><a href="/d">' || repeat('<i><b>', 2000) || 'Deep</a><time datetime="2024-01-30T10:00:00Z">x</time></article>'
 WHEN 2 THEN '<table><tr class=' || chr(39) || 'x job' || chr(39) || ' data-id=1 data-href=' || chr(39) || '/j/' || CAST(c_custkey AS STRING) || chr(39)
  || ' data-company="L&#x27;Or &amp;amp; Co"><td><script type="application/ld+json">{"title":"AI Engineer","datePosted":"2024-01-30T10:00:00Z"}</script>'
  || '<tr class=job data-id=2 data-href=/k><td>no record</table>'
 ELSE '<article>x<time></time></article>' END AS html
FROM customer
""",
    "fx_near_vectors": r"""
SELECT vec_id, embedding FROM embeddings
UNION ALL SELECT 1000000 + vec_id, embedding FROM embeddings WHERE vec_id % 3 = 0
UNION ALL SELECT 2000000 + vec_id, transform(embedding, x -> CAST(x * 2 + CAST(0.001 AS FLOAT) AS FLOAT)) FROM embeddings
""",
    "fx_startups": r"""
SELECT c_custkey AS row_id, CAST(c_custkey % 5 AS INT) AS source_rank, CAST(c_custkey % 7 AS INT) AS page_no,
 '/companies/c' || CAST(c_custkey % 900 AS STRING) AS href, n.raw_name AS name,
 CASE c_custkey % 4 WHEN 0 THEN '1,234 employees' WHEN 1 THEN CAST(c_custkey AS STRING) || ' Employee'
 WHEN 2 THEN 'Founded 2019' ELSE ', employees' END AS badge
FROM customer JOIN fx_names n ON n.name_id = c_custkey
""",
    "fx_products": r"""
SELECT /*+ BROADCAST(n) */ p_partkey AS row_id, CAST(p_partkey % 7 AS INT) AS source_rank, CAST(p_partkey % 40 AS INT) AS page_no,
 'https://tools.example.com/tool/t' || CAST(p_partkey % 1500 AS STRING) AS url, n.raw_name AS name, v.pricing_raw
FROM part JOIN (SELECT * FROM fx_names WHERE name_id < 150) n ON n.name_id = p_partkey % 150
 JOIN (VALUES (0,'Free'),(1,' freemium '),(2,'PAID'),(3,'Free Trial'),(4,'Contact for Pricing'),(5,'contact sales'),
 (6,'???'),(7,''),(8,CAST(NULL AS STRING))) AS v(i, pricing_raw) ON p_partkey % 9 = v.i
""",
    "fx_papers": r"""
SELECT doc_id AS row_id, CAST(doc_id % 5 AS INT) AS source_rank, CAST(((doc_id - doc_id % 5) / 5) % 20 AS INT) AS page_no,
 CASE WHEN doc_id % 41 = 0 THEN '' ELSE 'http://papers.example.org/abs/' || CAST(doc_id % 700 AS STRING) END AS paper_url,
 CASE WHEN doc_id % 43 = 0 THEN '' ELSE ' Paper' || chr(10) || CAST(doc_id % 700 AS STRING) || ' ' END AS title,
 'Author ' || CAST(doc_id % 90 AS STRING) || ' ; ;Author ' || CAST(doc_id % 13 AS STRING) AS authors_raw,
 CASE doc_id % 4 WHEN 0 THEN 'Code: https://github.com/org' || CAST(doc_id % 50 AS STRING) || '/repo'
 WHEN 1 THEN 'See https://github.com/org' || CAST(doc_id % 50 AS STRING) || '/repo.git for code'
 WHEN 2 THEN 'At http://github.com/org' || CAST(doc_id % 50 AS STRING) || '/repo.' ELSE 'No code' END AS summary,
 CASE WHEN doc_id % 37 = 0 THEN 'n/a' ELSE '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0') || 'T10:00:00Z' END AS published
FROM documents
""",
    "fx_stars": r"""
SELECT DISTINCT 'org' || CAST(doc_id % 40 AS STRING) || '/repo' AS slug,
 CASE WHEN doc_id % 40 = 7 THEN CAST(NULL AS INT) ELSE CAST((doc_id % 40) * 11 AS INT) END AS stargazers_count
FROM documents
""",
    "fx_jobs": r"""
SELECT /*+ BROADCAST(n) */ p_partkey AS row_id, v.title, CASE p_partkey % 3 WHEN 0 THEN n.raw_name WHEN 1 THEN '' ELSE CAST(NULL AS STRING) END AS company,
 'Board ' || CAST(p_partkey % 5 AS STRING) AS site_name
FROM part JOIN (SELECT * FROM fx_names WHERE name_id < 150) n ON n.name_id = p_partkey % 150
 JOIN (VALUES (0,'Senior ML Engineer (Remote)'),(1,'Machine Learning Engineer'),(2,'Data Scientist'),(3,'Research Engineer, remote'),
 (4,'AI Engineer'),(5,'SWE'),(6,'Sweeper'),(7,'ML Engineer / Data Scientist'),(8,'Account Manager')) AS v(i, title) ON p_partkey % 9 = v.i
""",
    "fx_news": r"""
SELECT t.event_id AS row_id, 'Story ' || CAST(t.event_id AS STRING) AS title, t.raw_time,
 CASE t.event_id % 3 WHEN 0 THEN '/a/' || CAST(t.event_id AS STRING) WHEN 1 THEN '//cdn.example.net/b'
 ELSE 'https://other.example.org/c' END AS href, 'https://news.example.com/category/ai/' AS base_url
FROM fx_times t
""",
    "fx_card_pages": r"""
SELECT c_custkey AS page_id, CASE c_custkey % 3 WHEN 0 THEN 'news' WHEN 1 THEN 'product' ELSE 'job' END AS kind,
 CASE c_custkey % 3
 WHEN 0 THEN '<article><h2><a href="/n/' || CAST(c_custkey AS STRING) || '">Story &amp; more</a></h2><time datetime="2024-01-30T10:00:00Z">x</time></article><article><h2><a href="/m">No time</a></h2></article>'
 WHEN 1 THEN '<div class="p-2 bg-card"><a href="https://www.futurepedia.io/tool/t' || CAST(c_custkey AS STRING) || '"><p>Tool ' || CAST(c_custkey AS STRING) || '</p></a><div class="flex justify-between text-lg"><span>Freemium</span></div></div>'
 ELSE '<tr class="job" data-id="1" data-href="/j/' || CAST(c_custkey AS STRING) || '" data-company="Acme"><td><script type="application/ld+json">{"title":"AI Engineer","datePosted":"2024-01-30T10:00:00Z"}</script></td></tr><tr class="job" data-id="2" data-href="/k"><td><script type="application/ld+json">{bad</script></td></tr>' END AS html
FROM customer
""",
    "fx_paragraphs": r"""
SELECT doc_id, repeat('a', CAST(doc_id % 90 AS INT)) || chr(10) || chr(10) || chr(10) || repeat('b', CAST(doc_id % 130 AS INT))
 || chr(10) || chr(10) || repeat('c ', CAST(doc_id % 7 AS INT)) || '  ' || chr(9) || repeat('d', CAST(doc_id % 260 AS INT)) AS text
FROM documents
""",
    "fx_replies": r"""
SELECT d.doc_id, c.chunk_no, p.provider_rank,
 CASE (d.doc_id + c.chunk_no * 2 + p.provider_rank) % 6 WHEN 0 THEN '{"startupName":"A","pricingModel":"FREE"}'
 WHEN 1 THEN 'not json' WHEN 2 THEN '{"startupName":"B"}' WHEN 3 THEN '{"startupName":"C","pricingModel":"CHEAP"}'
 WHEN 4 THEN '{"startupName":"D","pricingModel":"PAID","extra":1}' ELSE CAST(NULL AS STRING) END AS raw
FROM documents d CROSS JOIN (VALUES (0),(1)) AS c(chunk_no) CROSS JOIN (VALUES (0),(1),(2)) AS p(provider_rank)
""",
    "fx_links": r"""
SELECT DISTINCT 'Author ' || CAST(doc_id % 90 AS STRING) AS person,
 'http://papers.example.org/abs/' || CAST(doc_id % 700 AS STRING) AS paper_url, doc_id % 150 AS startup_row_id,
 CASE WHEN doc_id % 6 = 0 THEN 'paper_startup' ELSE 'person_job' END AS link_type
FROM documents
""",
}

# The product and job views look up names 0..149 only: at most 150 rows, hence the
# broadcast hint (a comment to DuckDB).
DEPENDS = {
    "fx_startups": ["fx_names"],
    "fx_products": ["fx_names"],
    "fx_jobs": ["fx_names"],
    "fx_news": ["fx_times"],
}

# DuckDB multiplies documents by two constant lists; Spark explodes them in place.
DUCKDB_ONLY = {
    "fx_near_vectors": r"""
SELECT vec_id, embedding FROM embeddings
UNION ALL SELECT 1000000 + vec_id, embedding FROM embeddings WHERE vec_id % 3 = 0
UNION ALL SELECT 2000000 + vec_id, list_transform(embedding, lambda x: CAST(x * 2 + CAST(0.001 AS FLOAT) AS FLOAT)) FROM embeddings
""",
}
SPARK_ONLY = {
    "fx_replies": r"""
SELECT doc_id, chunk_no, provider_rank,
 CASE (doc_id + chunk_no * 2 + provider_rank) % 6 WHEN 0 THEN '{"startupName":"A","pricingModel":"FREE"}'
 WHEN 1 THEN 'not json' WHEN 2 THEN '{"startupName":"B"}' WHEN 3 THEN '{"startupName":"C","pricingModel":"CHEAP"}'
 WHEN 4 THEN '{"startupName":"D","pricingModel":"PAID","extra":1}' ELSE CAST(NULL AS STRING) END AS raw
FROM documents LATERAL VIEW explode(array(0, 1)) c AS chunk_no LATERAL VIEW explode(array(0, 1, 2)) p AS provider_rank
""",
}


# Views that make a page body of every row of a table. A body is far larger than its row, so the rows are dealt to tasks by
# their number and not by the size of the file, before the body is made.
PAGE_VIEWS = {"fx_wild_pages": "customer", "fx_card_pages": "customer"}
TASK_PAGES = 4_000


def spread(rows: DataFrame) -> DataFrame:
    """Rows that each become a page, dealt evenly to tasks."""
    return rows.repartition(max(1, math.ceil(rows.count() / TASK_PAGES)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived view as a DataFrame."""
    configure(spark)
    needed = [*DEPENDS.get(name, []), name]
    text = " ".join(SPARK_ONLY.get(n, VIEWS[n]) for n in needed)
    for base in TABLES:
        if base in text:
            rows = table(spark, sf_dir, base)
            (spread(rows) if base == PAGE_VIEWS.get(name) else rows).createOrReplaceTempView(base)
    for n in needed:
        df = spark.sql(SPARK_ONLY.get(n, VIEWS[n]))
        df.createOrReplaceTempView(n)
    # Filters on the body stay behind the dealing out.
    return pin(df, "html", F.col("html")).select(df.columns) if name in PAGE_VIEWS else df


def with_views(sql: str, *names: str) -> str:
    """A DuckDB query preceded by the views it uses."""
    ordered: list[str] = []
    for name in names:
        ordered += [n for n in [*DEPENDS.get(name, []), name] if n not in ordered]
    heads = ",\n".join(f"{n} AS ({DUCKDB_ONLY.get(n, VIEWS[n]).strip()})" for n in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        recursive = body[5:].lstrip()[:10].upper() == "RECURSIVE "
        body = body[5:].lstrip()
        body = body[10:] if recursive else body
        return f"WITH {'RECURSIVE ' if recursive else ''}{heads},\n{body}"
    return f"WITH {heads}\n{body}"
