"""Deduplication, topics, keywords and upserts on small tables."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.operators import collect, dedupe, keywords, topics, upsert

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
COLUMNS = "seq bigint, canonical_url string, content_hash string, source_weight double, published_at timestamp"


def kept(spark, rows):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], COLUMNS)
    stats = dedupe.dedupe_stats(dedupe.survivors(df)).first().asDict()
    return dedupe.deduplicate(df).orderBy("pos").collect(), stats


def test_same_url_keeps_the_heavier(spark):
    rows, stats = kept(spark, [("a1", "h1", 0.8, T0), ("a1", "h2", 0.9, T0)])
    assert [r["source_weight"] for r in rows] == [0.9]
    assert stats == {"original_count": 2, "duplicates_by_url": 1, "duplicates_by_hash": 0, "final_count": 1}


def test_same_content_keeps_the_heavier(spark):
    rows, stats = kept(spark, [("a1", "h", 0.8, T0), ("a2", "h", 0.9, T0)])
    assert [r["source_weight"] for r in rows] == [0.9]
    assert stats["duplicates_by_hash"] == 1


def test_equal_weight_keeps_the_newer(spark):
    later = datetime(2026, 2, 1, tzinfo=timezone.utc)
    rows, _ = kept(spark, [("a1", "h1", 0.8, T0), ("a1", "h2", 0.8, later)])
    assert [r["content_hash"] for r in rows] == ["h2"]


def test_without_duplicates_all_stay(spark):
    rows, stats = kept(spark, [("a1", "h1", 1.0, T0), ("a2", "h2", 1.0, T0), ("a3", "h3", 1.0, T0)])
    assert len(rows) == 3 and stats["duplicates_by_url"] == stats["duplicates_by_hash"] == 0


def test_no_items(spark):
    rows, stats = kept(spark, [])
    assert rows == [] and set(stats.values()) == {0}


def in_order(rows):
    """Survivors by going through the rows once per phase."""
    for key in (1, 2):
        best = {}
        for row in rows:
            held = best.get(row[key])
            if held is None or row[3:5] > held[3:5]:
                best[row[key]] = row
        rows = list(best.values())
    return [r[0] for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_dedupe_with_many_ties(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i, f"u{rng.randrange(60)}", f"h{rng.randrange(40)}", rng.choice([0.5, 1.0]), T0 + timedelta(days=rng.randrange(3)))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    wide = dedupe.deduplicate(df).orderBy("pos").collect()
    assert [r["seq"] for r in wide] == in_order(rows)
    narrow = dedupe.deduplicate_narrow(df).orderBy("pos").select(wide[0].__fields__).collect()
    assert narrow == wide


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="by_title"):
        dedupe.survivors(spark.range(1), "by_title")


def topic_items(spark, n=200, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        topic = 1 if i % 3 == 0 else rng.choice([-1, 0, 2])
        rows.append(
            ("run", topic, i, f"https://x/{i}", f"d{rng.randrange(14)}.com", rng.choice([0.5, 0.75, 1.0]),
             T0 + timedelta(hours=rng.randrange(60)), f"title {i}", "s" * 300, f"h{rng.randrange(150)}")
        )
    schema = (
        "run_id string, topic_id int, pos bigint, canonical_url string, publisher_domain string, source_weight double,"
        " published_at timestamp, title string, summary string, content_hash string"
    )
    return rows, spark.createDataFrame(rows, schema).repartition(4)


def test_topic_records(spark):
    rows, items = topic_items(spark)
    words = spark.createDataFrame([("run", 1, [f"k{i}" for i in range(20)])], "run_id string, topic_id int, keywords array<string>")
    records = {r["topic_id"]: r for r in topics.topic_records(items, words, "hourly").collect()}
    assert set(records) == {0, 1, 2}
    for topic, record in records.items():
        mine = [r for r in rows if r[1] == topic]
        domains = Counter(r[4] for r in mine)
        assert record["topic_volume"] == len(mine) and record["unique_domains"] == len(domains)
        assert record["avg_source_weight"] == pytest.approx(sum(r[5] for r in mine) / len(mine))
        assert record["duplicate_ratio"] == pytest.approx(1 - len({r[9] for r in mine}) / len(mine))
        assert record["top_domains"] == [d for d, _ in domains.most_common(5)]
        assert record["domain_counts"] == dict(domains.most_common(10))
        hours = Counter(r[6].strftime("%Y-%m-%dT%H:00:00+00:00") for r in mine)
        assert [tuple(b) for b in record["counts_by_bucket"]] == sorted(hours.items())
        best = sorted(mine, key=lambda r: (-r[5], -r[6].timestamp()))[:5]
        assert [i["url"] for i in record["representative_items"]] == [r[3] for r in best]
        assert all(len(i["summary"]) == 200 for i in record["representative_items"])
        assert record["top_keywords"] == ([f"k{i}" for i in range(15)] if topic == 1 else [])
    attached = topics.attach_signatures(items, topics.topic_records(items, words)).collect()
    assert {r["topic_signature"] for r in attached if r["topic_id"] == -1} == {""}
    assert {r["topic_signature"] for r in attached if r["topic_id"] == 1} == {records[1]["topic_signature"]}


def test_rankings_are_cut_before_the_shuffle(spark):
    _, items = topic_items(spark)
    for df in (topics.representatives(items), topics.ranked_domains(items), collect.first_per_feed(items, 3, "run_id", "pos")):
        assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_noise_handling(spark):
    rows, items = topic_items(spark)
    assert topics.handle_noise(items, "keep").count() == len(rows)
    assert topics.handle_noise(items, "drop").count() == sum(r[1] != -1 for r in rows)
    with pytest.raises(ValueError, match="merge"):
        topics.handle_noise(items, "merge")


def test_keywords(spark):
    rows = [(0, "Alpha alpha alpha", "beta x"), (0, "beta", "gamma_1"), (1, "beta beta", "delta"), (-1, "omega", "omega")]
    items = spark.createDataFrame(rows, "topic_id int, title string, summary string").withColumn("run_id", F.lit("r1"))
    found = {r["topic_id"]: r["keywords"] for r in keywords.topic_keywords(items).collect()}
    # 3 ln(1 + 4/3) > 1 ln(1 + 4/1) > 2 ln(1 + 4/4), the average topic having 4 words.
    assert found == {0: ["alpha", "gamma_1", "beta"], 1: ["delta", "beta"]}


def test_keywords_stay_inside_their_run(spark):
    rows = [("r1", 0, "alpha", "alpha"), ("r2", 0, "beta", "beta")]
    items = spark.createDataFrame(rows, "run_id string, topic_id int, title string, summary string")
    found = {(r["run_id"], r["topic_id"]): r["keywords"] for r in keywords.topic_keywords(items).collect()}
    assert found == {("r1", 0): ["alpha"], ("r2", 0): ["beta"]}


def test_reduce_topics(spark):
    counts = spark.createDataFrame(
        [(0, "a", 50), (0, "b", 50), (1, "c", 40), (1, "d", 40), (2, "c", 3), (3, "b", 2), (4, "z", 1)],
        "topic_id int, term string, n bigint",
    ).withColumn("run_id", F.lit("r1"))
    merged = {r["topic_id"]: r["merged_id"] for r in keywords.reduce_topics(counts, 2).collect()}
    assert merged == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0}


def test_merge_upsert_replaces_only_the_named_columns(spark):
    schema = "k int, a string, b string"
    target = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], schema)
    source = spark.createDataFrame([(2, "A2", None), (3, "A3", "B3")], schema)
    merged = sorted(map(tuple, upsert.merge_upsert(target, source, ["k"], ["b"]).collect()))
    assert merged == [(1, "a1", "b1"), (2, "a2", None), (3, "A3", "B3")]
    ignored = sorted(map(tuple, upsert.insert_ignore(target, source, ["k"]).collect()))
    assert ignored == [(1, "a1", "b1"), (2, "a2", "b2"), (3, "A3", "B3")]
    assert [r["k"] for r in upsert.fk_violations(source, target, ["k"]).collect()] == [3]


def test_colliding_keys(spark):
    rows = spark.createDataFrame([(1, 0.5, "x"), (1, 0.9, "y"), (2, None, "z")], "k int, score double, v string")
    best = upsert.one_per_key(rows, ["k"], -F.coalesce("score", F.lit(0.0)))
    assert sorted(r["v"] for r in best.collect()) == ["y", "z"]
    assert [tuple(r) for r in upsert.repeated_keys(rows, ["k"]).collect()] == [(1, 2)]


def test_first_rows_are_one_per_key_and_leave_single_keys_alone(spark):
    rows = [(1, "a", 2, "x"), (1, "a", 1, "y"), (1, None, 4, "z"), (1, None, 3, "u"), (None, None, 1, "v"), (2, "b", 1, "w")]
    found = spark.createDataFrame(rows, "k int, l string, n int, v string")
    expected = upsert.one_per_key(found, ["k", "l"], F.col("n"))
    first = upsert.first_rows(found, ["k", "l"], F.col("n"))
    assert first.columns == found.columns and sorted(r["v"] for r in first.collect()) == ["u", "v", "w", "y"]
    assert sorted(map(repr, first.collect())) == sorted(map(repr, expected.collect()))
    assert upsert.first_rows(found, ["k", "l"]).count() == 4
    single = found.filter("v in ('x', 'z', 'w')")
    assert "Exchange" not in upsert.first_rows(single, ["k", "l"], F.col("n"))._jdf.queryExecution().executedPlan().toString()


def test_representatives_find_their_texts(spark):
    published = datetime(2024, 1, 31, tzinfo=timezone.utc)
    rows = [
        (i, "r", i % 3 - 1, i, 1.0 + i % 2, published, f"http://x.com/{i}", "x.com", f"t{i}", "s" * (150 + i))
        for i in range(100)
    ]
    full = spark.createDataFrame(
        rows,
        "seq bigint, run_id string, topic_id int, pos bigint, source_weight double, published_at timestamp,"
        " canonical_url string, publisher_domain string, title string, summary string",
    )
    whole = topics.representatives(full)
    apart = topics.representatives(full.drop("title", "summary"), texts=full.select("seq", "title", "summary"))
    assert apart.columns == whole.columns
    found = sorted(map(tuple, apart.collect()))
    assert found == sorted(map(tuple, whole.collect())) and len(found) == 10
    assert max(len(r[6]) for r in found) <= 200
    plan = apart._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_terms_are_weighed_without_joining_them(spark):
    rng = random.Random(3)
    cells = {(run, topic, f"w{rng.randrange(40)}"): rng.randrange(1, 30) for run in ("r", "s", None) for topic in range(5) for _ in range(25)}
    counts = spark.createDataFrame([(*key, n) for key, n in cells.items()], "run_id string, topic_id int, term string, n long")
    words, totals = Counter(), Counter()
    for (run, topic, term), n in cells.items():
        words[run, topic] += n
        totals[run, term] += n
    expected = {}
    for run, topic in [key for key in words if key[0]]:
        sizes = [n for (r, _), n in words.items() if r == run]
        weights = {t: n * math.log1p(sum(sizes) // len(sizes) / totals[r, t]) for (r, k, t), n in cells.items() if (r, k) == (run, topic)}
        best = sorted(weights, key=lambda t: (-weights[t], t))[:6]
        expected |= {(run, topic, t): (i + 1, weights[t] / words[run, topic]) for i, t in enumerate(best)}
    ranked = keywords.ranked_keywords(counts, 6)
    found = {(r.run_id, r.topic_id, r.term): (r["rank"], pytest.approx(r.score)) for r in ranked.collect()}
    assert found == expected and ranked.columns == ["run_id", "topic_id", "term", "rank", "score"]
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "term" in line]


def test_counts_of_moved_topics_are_those_of_their_items(spark):
    rows = [(0, "ab cd ab", "r"), (1, "cd ef", "r"), (2, "ab", "r"), (2, "gh", "s"), (-1, "ab", "r")]
    found = spark.createDataFrame([(t, x, "", r) for t, x, r in rows], "topic_id int, title string, summary string, run_id string")
    moves = spark.createDataFrame([(0, 1), (1, 0), (5, 0)], "topic_id int, new_id int")
    moved = found.join(moves, "topic_id", "left").withColumn("topic_id", F.coalesce("new_id", "topic_id"))
    got = keywords.moved_counts(keywords.term_counts(found), moves)
    expected = keywords.term_counts(moved)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect())) and got.dtypes == expected.dtypes
