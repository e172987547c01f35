"""Feeds of several documents, repaired entries, first rows per key, pruned writes, exact purges."""

from __future__ import annotations

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.functions import times, url
from newsloom.operators import collect, dedupe, upsert
from newsloom.operators.components import summed_before
from newsloom.schemas import TABLES
from newsloom.sources import feeds
from newsloom.sources.store import RunStore, export_runs, timestamps_as_text
from newsloom.sources.suffixes import suffix_rules

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)


def rss(*items: tuple[str, str], end: str = "</channel></rss>") -> str:
    body = "".join(f"<item><title>{t}</title><link>{k}</link></item>" for t, k in items)
    return f"<rss><channel><title>News</title>{body}{end}"


@pytest.fixture(scope="module")
def entries(spark):
    rows = [("one", f"{d}.xml", rss(*((f"t{d}{i}", f"http://x.com/{d}/{i}") for i in range(3)))) for d in range(4)]
    rows += [("two", "a.xml", rss(("only", "http://y.com/1"))), ("stray", "a.xml", rss(("s", "http://z.com/1")))]
    return feeds.feed_entries(spark.createDataFrame(rows, "feed string, document string, value string"))


@pytest.fixture(scope="module")
def registry(spark):
    rows = [("one", 0, 1.0, "n", None, "en"), ("two", 1, None, "n", None, ""), ("one", 7, 0.1, "again", None, "en")]
    return spark.createDataFrame(rows, "name string, feed_order int, weight double, category string, market string, language string")


def collected(spark, entries, registry, limit=None):
    return collect.collect_items(entries, registry, suffix_rules(spark), "r", F.lit(NOW), F.lit(NOW), limit, None)


def test_order_is_unique_over_documents(spark, entries, registry):
    items = collected(spark, entries, registry)
    rows = items.select("seq", "title").orderBy("seq").collect()
    assert [r.title for r in rows] == [f"t{d}{i}" for d in range(4) for i in range(3)] + ["only"]
    assert len({r.seq for r in rows}) == len(rows)
    survivors = dedupe.deduplicate(items)
    assert survivors.count() == dedupe.dedupe_stats(dedupe.survivors(items)).first()["final_count"]


def test_limit_holds_per_feed(spark, entries, registry):
    titles = {r.title for r in collected(spark, entries, registry, 4).select("title").collect()}
    assert titles == {"t00", "t01", "t02", "t10", "only"}


def test_unregistered_feeds_are_listed(entries, registry):
    assert [tuple(r) for r in collect.unregistered_feeds(entries, registry).collect()] == [("stray", 1)]


def test_small_faults_are_repaired(spark):
    faulty = rss(("A & B", "http://x.com/?a=1&b=2"), ("C&nbsp;D &amp; &#38;", "http://x.com/2"), ("", ""), end="")
    found = spark.createDataFrame([("f", faulty)], "feed string, value string")
    got = [(r.title, r.link) for r in feeds.feed_entries(found).orderBy("pos").collect()]
    assert got == [("A & B", "http://x.com/?a=1&b=2"), ("C D & &", "http://x.com/2"), ("", "")]
    lost = feeds.unreadable_entries(found).collect()
    assert [r.pos for r in lost] == [2] and lost[0].fragment.startswith("<item>")


def test_first_row_of_a_repeated_key_stays(spark):
    target = spark.createDataFrame([(1, "old", 0)], "k int, v string, seq int")
    source = spark.createDataFrame([(2, "late", 9), (2, "first", 3), (1, "again", 1)], "k int, v string, seq int")
    got = upsert.insert_ignore(target, source, ["k"], F.col("seq")).orderBy("k").collect()
    assert [(r.k, r.v) for r in got] == [(1, "old"), (2, "first")]
    assert upsert.insert_ignore(target, source, ["k"]).count() == 2


def items_of(spark, *runs: str):
    names = [f.name for f in spark.createDataFrame([], TABLES["items"]).schema]
    frame = spark.createDataFrame([(run, f"id{i}") for run in runs for i in range(2)], "run_id string, item_id string")
    schema = spark.createDataFrame([], TABLES["items"]).schema
    return frame.select(*[F.col(n) if n in frame.columns else F.lit(None).cast(schema[n].dataType).alias(n) for n in names])


def test_writes_read_only_their_own_partitions(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    store.save_items(items_of(spark, "r1", "r2", "r3"))
    touched = store._touched("items", items_of(spark, "r2"))
    assert {r.run_id for r in touched.collect()} == {"r2"}
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "run_id" in plan.split("PartitionFilters: [")[1].split("]")[0].replace("isnotnull(run_id", "")
    store.save_items(items_of(spark, "r2", "r2"))
    assert store.read("items").count() == 6


@pytest.mark.parametrize("run_id", ["run 1:1", "a/b", "50%", "plain", "x=y", "%41"])
def test_purge_finds_escaped_runs(spark, tmp_path, run_id):
    store = RunStore(spark, str(tmp_path / "store"))
    store.save_items(items_of(spark, run_id, "other"))
    store.purge([run_id])
    assert {r.run_id for r in store.read("items").collect()} == {"other"}


def test_suffix_rules_of_any_depth(spark):
    rules = suffix_rules(spark, "com\na.b.c.d.e.com\n*.w.x.y.z.com\n!free.w.x.y.z.com\n")
    hosts = {
        "http://q.p.a.b.c.d.e.com/": "p.a.b.c.d.e.com",
        "http://n.m.k.w.x.y.z.com/": "m.k.w.x.y.z.com",
        "http://deep.free.w.x.y.z.com/": "free.w.x.y.z.com",
        "http://other.com/": "other.com",
    }
    df = spark.createDataFrame([(h,) for h in hosts], "u string")
    got = {r.u: r.d for r in url.with_registered_domain(df, "u", rules, "d").collect()}
    assert got == hosts


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Mon, 29 Jan 2024", "2024-01-29T00:00:00+00:00"),
        ("29 Jan 24\n", "2024-01-29T00:00:00+00:00"),
        ("Mon Jan 29 10:00:05 2024", "2024-01-29T10:00:05+00:00"),
        ("Mon Jan  9 10:00:05 EST 2024", "2024-01-09T15:00:05+00:00"),
        ("\t2024-01-29T10:00:00Z\n", "2024-01-29T10:00:00+00:00"),
        ("soon", None),
    ],
)
def test_more_feed_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.format_iso8601(times.parse_feed_date(F.col("t")))).first()[0] == expected


def test_nested_timestamps_become_text(spark):
    df = spark.sql("select timestamp '2024-01-01 00:00:00Z' as t, array(named_struct('a', timestamp '2024-01-02 00:00:00Z')) as l")
    row = timestamps_as_text(df).first()
    assert row.t == "2024-01-01 00:00:00+00:00" and row.l[0].a == "2024-01-02 00:00:00+00:00"


def test_sums_before_a_row_in_ranges(spark):
    rng = random.Random(3)
    rows = [(g, o, rng.randint(0, 9)) for g, n in (("a", 300), ("b", 1), ("c", 20)) for o in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o int, v int")
    got = {(r.g, r.o): r.s for r in summed_before(df, ["g"], ["o"], "v", into="s").collect()}
    assert got == {(g, o): sum(v for h, q, v in rows if h == g and q < o) for g, o, _ in rows}
    assert summed_before(df.limit(0), ["g"], ["o"], "v", into="s").collect() == []


def test_documents_of_a_feed_follow_each_other(spark):
    # documents without an order of their rows, one feed with many of them
    rows = [("big", f"d{i:03d}", p, f"t{i}") for i in range(120) for p in range(1 + i % 3)] + [("small", "d000", 0, "t")]
    entries = spark.createDataFrame(rows, "feed string, document string, pos int, title string")
    got = sorted((r.feed, r.place) for r in collect.placed_in_feed(entries).collect())
    assert got == [("big", i) for i in range(len(rows) - 1)] + [("small", 0)]
    first = {r.document: r.place for r in collect.placed_in_feed(entries).filter("feed = 'big' and pos = 0").collect()}
    assert first["d000"] == 0 and first["d001"] == 1 and first["d002"] == 3 and first["d003"] == 6


def topics_table(spark, scores):
    names = spark.createDataFrame([], TABLES["topics"]).schema
    frame = spark.createDataFrame(scores, "run_id string, topic_id int, narrative_signal_score double")
    return frame.select(*[F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in names])


def test_every_run_is_exported(spark, tmp_path):
    scores = [("r 1", i, float(i % 4)) for i in range(6)] + [("r2", 7, None), ("r2", 8, -1.0)]
    out = str(tmp_path / "out")
    export_runs(items_of(spark, "r 1", "r2", "bare"), topics_table(spark, scores), out, 3)
    lines = spark.read.schema("item_id string, run_id string, title string").json(f"{out}/items").collect()
    assert sorted((r.run_id, r.item_id) for r in lines) == [(run, f"id{i}") for run in ("bare", "r 1", "r2") for i in range(2)]
    arrays = spark.read.schema("value string, run_id string").text(f"{out}/topics").collect()
    # a missing score counts as 0, ties go to the lower topic
    assert {r.run_id: [t["topic_id"] for t in json.loads(r.value)] for r in arrays} == {"r 1": [3, 2, 1], "r2": [7, 8]}
    assert "top_keywords" in json.loads(arrays[0].value)[0]
    export_runs(items_of(spark, "r2"), topics_table(spark, []), out)
    assert spark.read.schema("item_id string, run_id string").json(f"{out}/items").count() == 2


def test_indexed_store_opens_few_files_and_merges_runs(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"), "files", rows_per_file=20)
    assert store.read("items").count() == store.look_up("items", "canonical_url", "u").count() == 0
    rows = items_of(spark, *[f"r{i}" for i in range(40)])
    store.save_items(rows.withColumn("canonical_url", F.concat("run_id", F.lit("/"), "item_id")))
    files = store.keyed["items"].files()
    found = store.look_up("items", "canonical_url", "r7/id1")
    assert [(r.run_id, r.item_id) for r in found.collect()] == [("r7", "id1")]
    assert len(found.inputFiles()) < len(files)
    assert {r.run_id for r in store.read_items("r12").collect()} == {"r12"}
    # a column without an index still answers, from the whole table
    assert store.look_up("items", "item_id", "id0").count() == store.read("items").filter("title is null").count() / 2
    store.purge(["r7", "none"])
    assert store.read("items").count() == 78 and store.read_items("r7").count() == 0


def test_writers_that_meet_take_turns(spark, tmp_path, monkeypatch):
    store, other = (RunStore(spark, str(tmp_path / "store"), "files") for _ in range(2))
    run = spark.createDataFrame([("a",)], "run_id string")
    row = run.select(*[F.col(f.name) if f.name == "run_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in store.read("runs").schema])
    table, real, met = store.keyed["runs"], store.keyed["runs"]._commit, []

    def late(manifest, version):
        if not met:
            met.append(version)
            other.save_run(row.withColumn("run_id", F.lit("b")))
        real(manifest, version)

    monkeypatch.setattr(table, "_commit", late)
    store.save_run(row)
    assert sorted(r.run_id for r in store.read("runs").collect()) == ["a", "b"]
    # two runs of one row each, one file
    assert table.version() == 2 and len(table.files()) == 1
