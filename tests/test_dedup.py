import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityflow.operators import dedup, filters, joins, reports

ORDER = ("source_rank", "page_no", "row_id")


def rows_df(spark, rows):
    return spark.createDataFrame(rows, "source_rank int, page_no int, row_id bigint, k string")


def random_rows(seed, n=300, keys=60):
    rng = random.Random(seed)
    return [(rng.randint(0, 4), rng.randint(0, 5), i, f"k{rng.randint(0, keys)}") for i in range(n)]


def python_take_until(rows, target, by_page):
    """Grain by grain, the way a crawl reads: stop before the first grain once the target is met."""
    seen, out = set(), []
    grain = (lambda r: r[:2]) if by_page else (lambda r: r[:1])
    for g in sorted({grain(r) for r in rows}):
        if len(seen) >= target:
            break
        for r in sorted(x for x in rows if grain(x) == g):
            if r[3] not in seen:
                seen.add(r[3])
                out.append(r)
    return sorted(out)


def test_first_seen_is_unique_and_order_stable(spark):
    rows = random_rows(1)
    want = {}
    for r in sorted(rows):
        want.setdefault(r[3], r)
    for parts in (1, 7):
        got = dedup.first_seen(rows_df(spark, rows).repartition(parts), "k").collect()
        assert sorted(tuple(r) for r in got) == sorted(want.values())


def test_first_seen_limits_before_the_shuffle(spark, capsys):
    dedup.first_seen(rows_df(spark, random_rows(1)), "k").explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("target", [1, 20, 45, 10_000])
@pytest.mark.parametrize("by_page", [True, False])
def test_take_until(spark, target, by_page):
    rows = random_rows(2)
    page = "page_no" if by_page else None
    order = ORDER if by_page else ("source_rank", "page_no", "row_id")
    got = dedup.take_until(rows_df(spark, rows), "k", target, page=page, order=order)
    assert sorted(tuple(r) for r in got.select("source_rank", "page_no", "row_id", "k").collect()) == python_take_until(rows, target, by_page)


def test_target_zero_means_default(spark):
    rows = random_rows(2)
    assert dedup.take_until(rows_df(spark, rows), "k", 0).count() == len({r[3] for r in rows})


def test_contiguous_pages(spark):
    df = rows_df(spark, [(0, 0, 1, "a"), (0, 1, 2, "b"), (0, 3, 3, "c"), (1, 1, 4, "d"), (2, 0, 5, "e")])
    got = {tuple(r) for r in dedup.contiguous_pages(df).collect()}
    assert got == {(0, 0), (0, 1), (2, 0)}
    assert {tuple(r) for r in dedup.contiguous_pages(df, first_page=1).collect()} == {(0, 1), (1, 1)}


@pytest.mark.parametrize("salts", [1, 5])
def test_page_window(spark, salts):
    rng = random.Random(5)
    # One category holds most rows.
    rows = [("hot" if i % 4 else "cold", f"u{i}", rng.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "category string, paper_url string, published int")
    got = dedup.page_window(df, page_size=10, cap=45, salts=salts).collect()
    for category in ("hot", "cold"):
        want = sorted((r for r in rows if r[0] == category), key=lambda r: (-r[2], r[1]))[:45]
        mine = sorted((r for r in got if r["category"] == category), key=lambda r: r["feed_rank"])
        assert [r["paper_url"] for r in mine] == [r[1] for r in want]
        assert [r["page_no"] for r in mine] == [i // 10 for i in range(45)]


def greedy(times, ttl):
    out, last = [], None
    for t in sorted(set(times)):
        if last is None or t >= last + ttl:
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize("chunk_times", [dedup.CHUNK_TIMES, 7, 1])
@pytest.mark.parametrize("tasks", [1, 6])
def test_ttl_dedup(spark, chunk_times, tasks):
    rng = random.Random(9)
    start = datetime(2024, 1, 1)
    # Key "hot" holds most of the rows.
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 20)}", start + timedelta(minutes=rng.randint(0, 20_000))) for _ in range(600)]
    data += [("edge", start + timedelta(hours=h)) for h in (0, 1, 20, 24, 31, 62, 48)] + [(None, start), ("hot", None)]
    data += [("grid", start + timedelta(hours=h)) for h in range(300)] + [("dense", start + timedelta(seconds=s)) for s in range(300)]
    df = spark.createDataFrame(data, "k string, ts timestamp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(tasks == 1).lower())
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = [(r["k"], r["ts"]) for r in dedup.ttl_dedup(df, "k", "ts", 24, chunk_times=chunk_times).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {(k, t) for k in {d[0] for d in data if d[0]} for t in greedy([d[1] for d in data if d[0] == k and d[1]], timedelta(hours=24))}
    assert len(got) == len(set(got)) and set(got) == want


def test_jump_maps_compose():
    """Maps of stretches, one after the other, leave the same open time as the walk over all times."""
    rng = random.Random(4)
    for _ in range(400):
        ttl = rng.choice([1, 5, 40, 300])
        times = np.array(sorted(rng.sample(range(1, 2000), rng.randint(1, 120))))
        cuts = sorted(rng.sample(range(1, len(times) + 1), rng.randint(0, min(5, len(times)))))
        open_at, found = -10**9, []
        for part in np.split(times, cuts):
            if not len(part):
                continue
            found += dedup.accepted_times(part, open_at, ttl)
            upto, opens = dedup.jump_map(part, ttl)
            at = int(np.searchsorted(upto, open_at))
            if at < len(upto):
                open_at = int(upto[at] + ttl if opens is None else opens[at])
            assert len(upto) <= int((part < part[0] + ttl).sum()) + 1
        assert found == greedy(times.tolist(), ttl) and open_at == found[-1] + ttl


def test_ttl_jobs_do_not_follow_the_data(spark):
    """Short and long chains, few and many keys: the same number of jobs."""
    start = datetime(2020, 1, 1)
    tracker, seen = spark.sparkContext.statusTracker(), []
    for n, keys in ((20, 1), (3000, 1), (3000, 500)):
        df = spark.createDataFrame([(f"a{i % keys}", start + timedelta(hours=20 * i)) for i in range(n)], "k string, ts timestamp")
        spark.sparkContext.setJobGroup(f"ttl-{n}-{keys}", "ttl")
        got = [(r["k"], r["ts"]) for r in dedup.ttl_dedup(df, "k", "ts", 24, chunk_times=50).collect()]
        seen.append(len(tracker.getJobIdsForGroup(f"ttl-{n}-{keys}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(got) == sorted((f"a{k}", t) for k in range(keys) for t in greedy([start + timedelta(hours=20 * i) for i in range(k, n, keys)], timedelta(hours=24)))
    assert max(seen) <= min(seen) + 4 and max(seen) < 25


def test_ttl_example(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", start + timedelta(hours=h)) for h in (0, 1, 20, 31, 62)], "k string, ts timestamp")
    got = sorted(r["ts"] for r in dedup.ttl_dedup(df, "k", "ts").collect())
    assert got == [start + timedelta(hours=h) for h in (0, 31, 62)]


def test_unseen(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "url_key string, n int")
    seen = spark.createDataFrame([("a",), ("a",)], "url_key string")
    assert sorted(tuple(r) for r in dedup.unseen(new, seen).collect()) == [("b", 2), ("b", 3)]


def test_left_lookup_spreads_null_keys(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    right = spark.createDataFrame([("k3", 1), ("k6", 2)], "k string, v int")
    got = joins.left_lookup(left, right, "k", "id")
    assert got.count() == 1000
    assert sorted((r["k"], r["v"]) for r in got.filter("v is not null").collect()) == [("k3", 1), ("k6", 2)]
    assert got.filter("k is null and v is not null").count() == 0


def test_filters(spark):
    df = spark.createDataFrame([("a", "x"), ("", "x"), (None, "x"), ("b", None)], "a string, b string")
    assert [r["a"] for r in filters.require(df, ["a", "b"]).collect()] == ["a"]
    good, bad = filters.split_bad(df, ["a", "b"])
    assert good.count() == 2 and sorted(str(r["faults"]) for r in bad.collect()) == ["['a']", "['b']"]
    assert filters.under_size_cap(spark.createDataFrame([("é",), ("ab",), ("abc",)], "h string"), "h", 2).count() == 2
    assert [r[0] for r in df.select(filters.has_value("a")).collect()] == [True, False, False, True]


def test_reports(spark):
    a, b = spark.range(3).toDF("n"), spark.range(2).toDF("n")
    tagged = reports.union_sources({"x": a, "y": b})
    assert tagged.count() == 5 and reports.union_sources([a, b]).count() == 5
    counts = reports.counts_by_source(tagged.withColumn("r", F.when(F.col("source_name") == "x", 1).otherwise(0)), "source_name", "r")
    assert [(r["source_name"], r["new_rows"], r["running_total"]) for r in counts.orderBy("running_total").collect()] == [("y", 2, 2), ("x", 3, 5)]
    expected = spark.createDataFrame([("x",), ("z",)], "source_name string")
    status = {r["source_name"]: (r["n_rows"], r["status"]) for r in reports.source_status(expected, tagged, "source_name").collect()}
    assert status == {"x": (3, "ok"), "z": (0, "no rows")}
    summary = reports.run_summary({"STARTUP": a, "NEWS": b}, a)
    assert {r["record_type"]: r["n_rows"] for r in summary.collect()} == {"STARTUP": 3, "NEWS": 2, "MAPPING_LOG": 3}
    assert [(r["record_type"], r["target"], r["met"]) for r in reports.target_check(summary).collect()] == [("STARTUP", 1000, False)]
    empty, error = reports.or_empty(spark, lambda: 1 / 0, a.schema)
    assert empty.count() == 0 and error.startswith("ZeroDivisionError")


def test_no_target_keeps_everything(spark):
    rows = random_rows(2)
    df = rows_df(spark, rows)
    for none in (None, 0):
        assert dedup.take_until(df, "k", none).count() == len({r[3] for r in rows})
        assert dedup.target_grains(df, "k", none).count() == len({r[:2] for r in rows})
    many = spark.range(3000).selectExpr("cast(id % 3 as int) AS source_rank", "cast(id div 100 as int) AS page_no", "id AS row_id", "cast(id as string) AS k")
    assert dedup.take_until(many, "k").count() == 3000


@pytest.mark.parametrize("salts", [1, 7, 100])
def test_page_window_levels_and_uncut(spark, salts):
    rows = [(i % 2, f"u{i:04}", i % 50) for i in range(900)]
    df = spark.createDataFrame(rows, "category int, paper_url string, published int")
    want = {}
    for c in (0, 1):
        for n, r in enumerate(sorted((r for r in rows if r[0] == c), key=lambda r: (-r[2], r[1]))):
            want[r[1]] = (n + 1, n // 100)
    cut = dedup.page_window(df, cap=120, salts=salts)
    assert {r.paper_url: (r.feed_rank, r.page_no) for r in cut.collect()} == {k: v for k, v in want.items() if v[0] <= 120}
    whole = dedup.page_window(df, cap=None)
    assert {r.paper_url: (r.feed_rank, r.page_no) for r in whole.collect()} == want
