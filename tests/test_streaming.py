import pytest
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from entityflow.operators.dedup import ttl_dedup
from entityflow.streaming import feeds
from entityflow.streaming import seen as seen_table

START = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp"


def write_batches(spark, folder, batches):
    """One file per micro-batch, in arrival order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/day={i:03d}")


def stream(spark, folder):
    return (
        spark.readStream.schema(f"{SCHEMA}, day string").option("maxFilesPerTrigger", 1).parquet(str(folder)).select("k", "ts")
    )


def drain(spark, df, tmp_path, name):
    feeds.run_to_table(df, str(tmp_path / name), str(tmp_path / f"{name}-cp")).awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


CLOSING = [(None, START + timedelta(days=400))]


@pytest.mark.parametrize("order", ["in order", "shuffled", "backwards"])
def test_ttl_stream_equals_batch(spark, tmp_path, order):
    """However the rows are dealt to micro-batches, the accepted times are those of the batch twin."""
    rng = random.Random(2)
    rows = [(("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 6)}"), START + timedelta(minutes=rng.randint(0, 9000))) for _ in range(400)]
    rows += [("edge", START + timedelta(hours=h)) for h in (150, 151, 170, 174)] + [(None, START + timedelta(hours=3)), ("k1", None)]
    rows.sort(key=lambda r: r[1] or START)
    if order == "backwards":
        rows.reverse()
    if order == "shuffled":
        rng.shuffle(rows)
    write_batches(spark, tmp_path / "in", [*(rows[i : i + 120] for i in range(0, len(rows), 120)), CLOSING])
    found = feeds.ttl_dedup_stream(stream(spark, tmp_path / "in"), "k", lateness_hours=24 if order == "in order" else 200)
    got = drain(spark, found, tmp_path, "ttl")
    want = ttl_dedup(spark.createDataFrame(rows, SCHEMA), "k", "ts")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_ttl_stream_late_rows(spark, tmp_path):
    """A late row within the lateness takes its place in time, and moves the ones after it; an older one has missed its turn."""
    at = lambda *hours: [("a", START + timedelta(hours=h)) for h in hours]
    write_batches(spark, tmp_path / "in", [at(40, 64), at(30), at(53, 90), at(1, 70) + [("b", START + timedelta(hours=2))], at(200), at(100), CLOSING])
    got = drain(spark, feeds.ttl_dedup_stream(stream(spark, tmp_path / "in"), "k", lateness_hours=36), tmp_path, "ttl")
    # 30 came in time, so 40 and 53 repeat it and 64 is accepted; 1 and 100 came too late, as did b.
    assert sorted(tuple(r) for r in got.collect()) == [("a", START + timedelta(hours=h)) for h in (30, 64, 90, 200)]


def test_ttl_stream_waits_for_the_watermark(spark, tmp_path):
    write_batches(spark, tmp_path / "in", [[("a", START)], [("b", START + timedelta(hours=30))]])
    got = drain(spark, feeds.ttl_dedup_stream(stream(spark, tmp_path / "in"), "k"), tmp_path, "ttl")
    assert [tuple(r) for r in got.collect()] == [("a", START)]


def test_ttl_stream_example(spark, tmp_path):
    hours = [0, 1, 20, 31, 62]
    write_batches(spark, tmp_path / "in", [*([("a", START + timedelta(hours=h))] for h in hours), CLOSING])
    got = drain(spark, feeds.ttl_dedup_stream(stream(spark, tmp_path / "in"), "k"), tmp_path, "ttl")
    assert sorted(r["ts"] for r in got.collect()) == [START + timedelta(hours=h) for h in (0, 31, 62)]


def test_cheap_dedup_drops_repeats_within_the_window(spark, tmp_path):
    write_batches(spark, tmp_path / "in", [[("a", START), ("a", START + timedelta(hours=1)), ("b", START)], [("a", START + timedelta(hours=2))]])
    got = drain(spark, feeds.dedup_stream(stream(spark, tmp_path / "in"), "k"), tmp_path, "dd")
    assert sorted(r["k"] for r in got.collect()) == ["a", "b"]


def test_fresh_stream(spark, tmp_path):
    hours = [0, 1, 30, 48, 49]
    write_batches(spark, tmp_path / "in", [[("a", START + timedelta(hours=h)) for h in hours]])
    now = (START + timedelta(hours=48)).strftime("%Y-%m-%d %H:%M:%S")
    got = drain(spark, feeds.fresh_stream(stream(spark, tmp_path / "in"), now=now), tmp_path, "fresh")
    assert sorted(r["ts"] for r in got.collect()) == [START + timedelta(hours=h) for h in (30, 48)]
    # Without a clock the micro-batch time decides, and everything here is long past.
    assert drain(spark, feeds.fresh_stream(stream(spark, tmp_path / "in")), tmp_path, "live").count() == 0


def test_unseen_stream_and_rerun(spark, tmp_path):
    sink, seen, cp = (str(tmp_path / n) for n in ("sink", "seen", "cp"))
    write_batches(spark, tmp_path / "in", [[("a", START), ("a", START + timedelta(hours=1)), ("b", START)], [("b", START), ("c", START)]])

    def go(checkpoint):
        feeds.unseen_stream(stream(spark, tmp_path / "in"), sink, seen, checkpoint, key="k").awaitTermination()
        return sorted((r["k"], r["ts"]) for r in spark.read.parquet(sink).collect())

    want = [("a", START), ("b", START), ("c", START)]
    assert go(cp) == want
    # A repeat of every batch (lost progress) replaces the same folders and changes nothing.
    assert go(str(tmp_path / "cp2")) == want
    assert spark.read.parquet(seen).select("k").distinct().count() == 3


def test_state_column_types(spark, tmp_path):
    numeric = spark.createDataFrame([(7, START), (7, START), (None, START + timedelta(days=9))], "k bigint, ts timestamp")
    numeric.coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(numeric.schema).parquet(str(tmp_path / "in"))
    got = drain(spark, feeds.ttl_dedup_stream(arriving, "k"), tmp_path, "n")
    assert [tuple(r) for r in got.select("k", F.col("ts")).collect()] == [(7, START)]


def test_unseen_stream_over_batches_and_broken_table(spark, tmp_path):
    from entityflow.streaming import feeds

    source = str(tmp_path / "in")
    schema = "url_key string, body string"
    want = {}
    for n in range(3):
        rows = [(f"k{i}", f"b{n}-{i}") for i in range(n * 5, n * 5 + 10)] + [(f"k{n}", "again")]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
        feeds.unseen_stream(stream, str(tmp_path / "out"), str(tmp_path / "seen"), str(tmp_path / "check")).awaitTermination()
        for k, _ in rows:
            want.setdefault(k, n)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.url_key: r.batch for r in got} == want and len(got) == len(want)

    broken = tmp_path / "broken" / "batch=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    query = feeds.unseen_stream(spark.readStream.schema(schema).json(source), str(tmp_path / "out2"), str(tmp_path / "broken"), str(tmp_path / "check2"))
    with pytest.raises(Exception):
        query.awaitTermination()


@pytest.mark.parametrize("use_filter", [True, False])
def test_unseen_stream_over_ten_batches(spark, tmp_path, use_filter):
    """Generations are merged, few are left, and the filter changes no result."""
    rng = random.Random(8)
    batches = [[(f"k{rng.randrange(60 + 25 * n)}", START + timedelta(minutes=n)) for _ in range(40)] for n in range(10)]
    write_batches(spark, tmp_path / "in", batches)
    want = {}
    for n, rows in enumerate(batches):
        for k, _ in rows:
            want.setdefault(k, n)
    places = [str(tmp_path / p) for p in ("out", "seen", "check")]
    feeds.unseen_stream(stream(spark, tmp_path / "in"), *places, key="k", use_filter=use_filter).awaitTermination()
    got = spark.read.parquet(places[0]).collect()
    assert {r["k"]: r["batch"] for r in got} == want and len(got) == len(want)
    left = seen_table.manifest(spark, places[1], 9)
    assert [g[1] for g in left] == [1, 1, 0, 0]  # eight batches in two merged generations, two that wait
    keys = [r["k"] for name, _, _ in left for r in spark.read.parquet(f"{places[1]}/{name}").collect()]
    assert sorted(keys) == sorted(want)


def test_filters_name_few_slots(spark, tmp_path):
    """Keys that were never seen are hardly ever looked up, seen ones always."""
    seen = str(tmp_path / "seen")
    keys = spark.range(5000).selectExpr("concat('k', id) AS k")
    seen_table.add_batch(keys, "k", seen, 0, [])
    generations = seen_table.manifest(spark, seen, 0)
    fresh = spark.range(300).selectExpr("concat('new', id) AS k")
    assert seen_table.known_keys(fresh, "k", seen, generations).count() < 0.1 * 5000
    assert seen_table.known_keys(fresh, "k", seen, generations, use_filter=False).count() > 0.9 * 5000
    known = seen_table.known_keys(keys.limit(50), "k", seen, generations)
    assert known.join(keys.limit(50), "k").count() == 50


def test_table_without_manifests_is_taken_in(spark, tmp_path):
    seen = str(tmp_path / "seen")
    spark.createDataFrame([("a", 3), ("b", 5)], "k string, slot int").write.partitionBy("slot").parquet(f"{seen}/batch=-1")
    write_batches(spark, tmp_path / "in", [[("a", START), ("c", START)], [("b", START), ("c", START), ("d", START)]])
    feeds.unseen_stream(stream(spark, tmp_path / "in"), str(tmp_path / "out"), seen, str(tmp_path / "check"), key="k").awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["c", "d"]


@pytest.mark.parametrize("files", [1, 3])
def test_stream_reads_a_table_file_or_folder(spark, tmp_path, files):
    """A table of one file and one kept as a folder of part files arrive whole."""
    from catalogue.queries import QUERIES

    rows = spark.createDataFrame([(i, f"http://example.org/{i % 20}", "<p>x</p>") for i in range(30)], "page_id bigint, url string, html string")
    if files == 1:
        rows.toPandas().to_parquet(tmp_path / "pages.parquet")
    else:
        rows.repartition(files).write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["unseen_stream"](spark, str(tmp_path))
    assert sorted((r["page_id"], r["url"]) for r in got.collect()) == [(i, f"http://example.org/{i}") for i in range(20)]
