"""Feed files to stored runs."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsloom.lineage import checkpoint_dir, stored
from newsloom.operators import collect
from newsloom.operators.cluster import ClusterSettings
from newsloom.plans.run import RunSettings, run
from newsloom.sources import feeds as feed_source
from newsloom.sources.store import RunStore, flat_columns
from newsloom.sources.suffixes import suffix_rules

NOW = datetime(2026, 2, 14, tzinfo=timezone.utc)
RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom"><channel>
<title>My &amp; Feed</title><link>http://x.com</link><atom:link href="http://x.com/rss" rel="self"/>
<item><title><![CDATA[One <b>bold</b>]]></title><link> https://www.Example.com/a?utm_source=x&amp;b=1#t </link>
<description>first</description><pubDate>Fri, 13 Feb 2026 10:00:00 GMT</pubDate><source url="u">The Source</source></item>
<item><title>Two</title><guid>https://news.example.co.uk/two</guid><dc:creator>Jane</dc:creator>
<dc:date>2026-02-13T10:00:00+08:00</dc:date></item>
<item><title>  </title><link>https://e.com/no-title</link></item>
<item><title>No date</title><link>https://e.com/undated</link><pubDate>some day</pubDate></item>
<item><title>Old</title><link>https://e.com/old</link><pubDate>Sun, 01 Feb 2026 10:00:00 GMT</pubDate></item>
<item><title>On the edge</title><link>https://e.com/edge</link><pubDate>Sat, 07 Feb 2026 00:00:00 GMT</pubDate></item>
<item><title>Beyond the limit</title><link>https://e.com/beyond</link></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title type="text">Atom</title>
<entry><title type="html">E1 &lt;i&gt;x&lt;/i&gt;</title><link rel="self" href="http://s"/>
<link rel="alternate" href="http://a.com/1"/><summary>sum</summary><published>2026-02-13T10:00:00Z</published>
<updated>2026-02-14T10:00:00Z</updated><author><name>Bob</name><email>b@x.y</email></author></entry>
<entry><title>E2</title><link href="http://a.com/2"/><content>body</content><updated>2026-02-12T00:00:00Z</updated>
<source><title>Elsewhere</title></source></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="r" xmlns="http://purl.org/rss/1.0/"><channel><title></title></channel>
<item rdf:about="u"><title>R1</title><link>http://r.com/1</link></item></rdf:RDF>"""
CUT = RSS[: RSS.index("<item><title>  ")] + "<item><title>half</ti"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    for name, value in {"rss": RSS, "atom": ATOM, "rdf": RDF, "cut": CUT, "bad": "no feed"}.items():
        (base / f"feed={name}").mkdir()
        (base / f"feed={name}" / "today.xml").write_text(value, encoding="utf-8")
    return feed_source.read_feed_documents(spark, str(base))


@pytest.fixture(scope="module")
def items(spark, landed):
    names = ["rss", "atom", "rdf", "cut", "bad", "silent"]
    rows = [(n, i, 0.5 if n == "cut" else None, "news", None, "" if n == "rss" else "fr") for i, n in enumerate(names)]
    registry = spark.createDataFrame(
        rows, "name string, feed_order int, weight double, category string, market string, language string"
    )
    found = collect.collect_items(
        feed_source.feed_entries(landed), registry, suffix_rules(spark), "run-a", F.lit(NOW), F.lit(NOW), max_items=6
    )
    return found.cache()


def test_entries_become_items(items):
    rows = items.orderBy("seq").collect()
    assert [(r["source_name"], r["title"]) for r in rows] == [
        ("rss", "One <b>bold</b>"), ("rss", "Two"), ("rss", "No date"), ("rss", "On the edge"),
        ("atom", "E1 <i>x</i>"), ("atom", "E2"), ("rdf", "R1"), ("cut", "One <b>bold</b>"), ("cut", "Two"),
    ]
    first, second = rows[0], rows[1]
    assert first["canonical_url"] == "https://www.example.com/a?b=1" and first["publisher_domain"] == "example.com"
    assert (first["summary"], first["has_summary"], first["text_len"]) == ("first", True, 20)
    assert (second["summary"], second["has_summary"], second["text_len"]) == ("Two", False, 6)
    assert second["publisher_domain"] == "example.co.uk"
    payloads = [r["json_payload"] for r in rows]
    names = ["The Source", "Jane", "My & Feed", "My & Feed", "Bob (b@x.y)", "Elsewhere", "r.com", "The Source", "Jane"]
    assert [p["publisher_name"] for p in payloads] == names
    assert [p["language"] for p in payloads[3:5]] == ["en", "fr"]
    assert payloads[0]["original_link"] == "https://www.Example.com/a?utm_source=x&b=1#t"
    assert [r["source_weight"] for r in rows[-3:]] == [1.0, 0.5, 0.5]


def test_dates_of_items(items):
    dated = {r["canonical_url"]: r["s"] for r in items.select("canonical_url", F.unix_seconds("published_at").alias("s")).collect()}
    expected = {
        "https://www.example.com/a?b=1": datetime(2026, 2, 13, 10, tzinfo=timezone.utc),
        "https://news.example.co.uk/two": datetime(2026, 2, 13, 2, tzinfo=timezone.utc),
        "https://e.com/undated": NOW,
        "https://e.com/edge": datetime(2026, 2, 7, tzinfo=timezone.utc),
        "http://a.com/1": datetime(2026, 2, 13, 10, tzinfo=timezone.utc),
        "http://r.com/1": NOW,
    }
    assert {u: dated[u] for u in expected} == {u: int(d.timestamp()) for u, d in expected.items()}


def test_unreadable_documents_are_set_aside(landed):
    assert [r["feed"] for r in feed_source.unreadable_documents(landed).collect()] == ["bad"]


def test_recovered_feed_title(landed):
    cut = feed_source.feed_entries(landed.filter("feed = 'cut'")).select("feed_title").distinct().collect()
    assert [r[0] for r in cut] == ["My & Feed"]


@pytest.mark.parametrize("fmt", ["parquet", "json", "files"])
def test_run_is_stored_and_read_back(spark, items, tmp_path, fmt):
    store = RunStore(spark, str(tmp_path / "store"), fmt)
    assert store.read_items("run-a").count() == store.read_topics("run-a").count() == 0
    settings = RunSettings(watchlist_keywords=["bold"], top_k_topics=3)
    result = run(items, "run-a", F.lit(NOW), store, str(tmp_path / "out"), settings)

    stored_items = {r["item_id"]: r for r in store.read_items("run-a").collect()}
    topics = store.read_topics("run-a").collect()
    assert len(stored_items) == 7 and len(topics) == 1
    assert {r["topic_signature"] for r in stored_items.values()} == {topics[0]["topic_signature"]}
    assert topics[0]["topic_volume"] == 7 and topics[0]["representative_items"][0]["published_at"] is not None
    assert topics[0]["json_payload"]["score_breakdown"]["watchlist_bonus"] == 80.0
    buckets = {r["s"]: r["count"] for r in store.read("topic_buckets").withColumn("s", F.unix_seconds("bucket_start")).collect()}
    assert sum(buckets.values()) == 7 and int(datetime(2026, 2, 13, tzinfo=timezone.utc).timestamp()) in buckets
    row = store.read("runs").first()
    assert row["status"] == "completed" and len(row["config_hash"]) == 16
    assert row["stats"].asDict() == {
        "fetched_count": 9, "deduped_count": 7, "topic_count": 1, "noise_ratio": 0.0,
        "missing_summary_ratio": pytest.approx(4 / 7), "error": None,
    }
    assert result.top_topics.count() == 1

    exported = [json.loads(line) for p in Path(tmp_path / "out" / "items").glob("*.json") for line in p.open(encoding="utf-8")]
    assert len(exported) == 7
    assert any(e["published_at"] == "2026-02-13 10:00:00+00:00" for e in exported)
    (array,) = [line for p in Path(tmp_path / "out" / "topics").glob("*.txt") for line in p.open(encoding="utf-8")]
    assert json.loads(array)[0]["topic_signature"] == topics[0]["topic_signature"]

    # A second write of the run: items stay, topics take volume and score only.
    changed = result.top_topics.withColumns({"topic_volume": F.lit(99).cast("bigint"), "unique_domains": F.lit(99).cast("bigint")})
    store.save_items(result.items.withColumn("title", F.lit("changed")))
    assert store.save_topics(changed).count() == 0
    assert store.read_items("run-a").filter("title = 'changed'").count() == 0
    again = store.read_topics("run-a").first()
    assert again["topic_volume"] == 99 and again["unique_domains"] == topics[0]["unique_domains"]

    store.save_run(store.read("runs").withColumn("run_id", F.lit("run-b")))
    store.purge(["run-a"])
    assert store.read_items("run-a").count() == store.read("topic_buckets").count() == 0
    assert [r["run_id"] for r in store.read("runs").collect()] == ["run-b"]


def test_failed_run_is_stored(spark, items, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="weekly"):
        run(items, "run-f", F.lit(NOW), store, settings=RunSettings(bucket_interval="weekly"))
    row = store.read("runs").first()
    assert row["status"] == "failed" and "weekly" in row["stats"]["error"]
    assert store.read_items("run-f").count() == 0


def test_run_without_items_writes_nothing(spark, items, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    assert run(items.filter("false"), "run-e", F.lit(NOW), store) is None
    assert store.read("runs").count() == 0 and not (tmp_path / "store").exists()


def test_colliding_signatures_keep_the_best_topic(spark, items, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    top = run(items, "run-c", F.lit(NOW)).top_topics
    worse = top.withColumns({"topic_id": F.lit(5), "narrative_signal_score": F.lit(1.0)})
    assert store.save_topics(worse.unionByName(top)).first()["n_rows"] == 2
    assert [r["topic_id"] for r in store.read_topics("run-c").collect()] == [0]


def test_topic_reduction_in_a_run(spark, tmp_path):
    rows = []
    for i in range(60):
        words = ["alpha beta gamma", "omega sigma kappa", "red green blue"][i % 3]
        rows.append(
            (i, f"id{i}", "r", f"http://x.com/{i}", "x.com", NOW, NOW, "f", 1.0, f"{words} {i}", words, True, 9, f"h{i}", -1, "")
        )
    schema = (
        "seq bigint, item_id string, run_id string, canonical_url string, publisher_domain string, published_at timestamp,"
        " fetched_at timestamp, source_name string, source_weight double, title string, summary string,"
        " has_summary boolean, text_len int, content_hash string, topic_id int, topic_signature string"
    )
    settings = RunSettings(clustering=ClusterSettings(min_topic_size=10, eps=0.4, components=2, nr_topics=2))
    result = run(spark.createDataFrame(rows, schema), "r", F.lit(NOW), settings=settings)
    assert sorted((r["topic_id"], r["topic_volume"]) for r in result.topics.collect()) == [(0, 40), (1, 20)]
    assert result.stats.first()["topic_count"] == 2


def test_unknown_storage_format(spark):
    with pytest.raises(ValueError, match="csv"):
        RunStore(spark, "/nowhere", "csv")


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == folder
    path = stored(spark.range(3), "probe").inputFiles()[0]
    assert path.removeprefix("file://").startswith(f"{folder}/probe-")


def test_nested_columns_become_json_text(spark):
    rows = spark.range(1).select("id", F.array(F.lit(1), F.lit(2)).alias("xs"), F.create_map(F.lit("k"), F.lit(3)).alias("m"))
    assert [tuple(r) for r in flat_columns(rows).collect()] == [(0, "[1,2]", '{"k":3}')]
